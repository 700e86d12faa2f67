"""Defaults of a load, and where jobs may keep shared files."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Fixed values.
TABLE_PREFIX = "ign_bdtopo_"
DEDUP_SUFFIX = "_dedup"
FEATURE_KEY = "cleabs"
VERSION = "3-5"
VERSION_DATE = "2025-09-15"
PROJECTION = "LAMB93"
TARGET_SRID = 4326
BATCH_SIZE = 5000


@dataclass
class LoadSettings:
    """One run of the load job.

    ``catalog`` may stay empty for the session catalog.  ``altitudes`` keeps the heights of points,
    ``losses`` records the values that could not be read.
    """

    schema: str
    catalog: str = ""
    table_prefix: str = TABLE_PREFIX
    departments: str = "all"
    layers: list[str] = field(default_factory=list)
    version: str = VERSION
    version_date: str = VERSION_DATE
    projection: str = PROJECTION
    target_srid: int = TARGET_SRID
    lang: str = "en"
    batch_size: int = BATCH_SIZE
    features_per_task: int = 200_000
    altitudes: bool = False
    losses: bool = True
    concurrent_layers: int = 4


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the session's ``spark.checkpoint.dir``.

    Only where that is unset, as in a bare local session, a temporary folder
    of this machine serves instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        import tempfile

        base = tempfile.mkdtemp(prefix="mapstrata-")
    return f"{base.rstrip('/')}/mapstrata/{purpose}-{uuid.uuid4().hex[:12]}"
