"""Build long expressions once.

A geometry function is a few hundred column operations, each a call into the
JVM.  Applied to a column by name, its result depends on nothing but the
arguments, so it is kept and used again in the same Spark application.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import TypeVar
from weakref import WeakKeyDictionary

from pyspark import SparkContext

F = TypeVar("F", bound=Callable)

_built: WeakKeyDictionary = WeakKeyDictionary()


def built_once(function: F) -> F:
    """Keep results of calls whose arguments are all names and numbers."""

    @functools.wraps(function)
    def wrapper(*args, **kwargs):
        given = (*args, *kwargs.values())
        context = SparkContext._active_spark_context
        if context is None or not all(isinstance(a, (str, int)) for a in given):
            return function(*args, **kwargs)
        kept = _built.setdefault(context, {})
        key = (function.__module__, function.__qualname__, args, tuple(sorted(kwargs.items())))
        if key not in kept:
            kept[key] = function(*args, **kwargs)
        return kept[key]

    return wrapper
