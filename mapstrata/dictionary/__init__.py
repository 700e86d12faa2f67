"""The data dictionary: what layers and columns mean, in two languages.

Three data files lie beside this module (fixed values, in plain text):
``layers.csv`` names the layers with their theme and own columns,
``themes.csv`` the columns shared by all layers and by each theme, and
``columns.csv`` the texts of columns in both languages, some of them for one layer only.  French
titles of layers follow from the layer names, which are French already, and so
does the text of a column that has none.
Pass other files of the same form to describe another edition.
"""

from __future__ import annotations

import csv
import logging
import re
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

FOLDER = Path(__file__).parent
COMMON = "common"
EXTENT = "extent"
LANGUAGES = ("en", "fr")
# Table text of a layer the dictionary does not know.
UNKNOWN_LAYER = {"en": "Map layer", "fr": "Couche"}


def _rows(name: str, folder: Path) -> list[dict[str, str]]:
    with open(folder / name, encoding="utf-8", newline="") as file:
        return list(csv.DictReader(file))


def french(name: str) -> str:
    """``date_d_apparition`` as ``Date d'apparition``."""
    text = re.sub(r"\b([dl]) (?=[aeiouhy])", r"\1'", name.replace("_", " "))
    return text[:1].upper() + text[1:]


@lru_cache(maxsize=8)
def entries(folder: Path = FOLDER) -> tuple[tuple[str, str, str, str], ...]:
    """``(layer, column, lang, text)``; a column of a layer comes once per language."""
    themes = {r["theme"]: r["columns"].split() for r in _rows("themes.csv", folder)}
    texts = {(r["layer"], r["column"]): r for r in _rows("columns.csv", folder)}
    out = []
    for row in _rows("layers.csv", folder):
        layer = row["layer"]
        names = themes[COMMON] + themes[row["theme"]] + row["columns"].split()
        for column in dict.fromkeys(names):
            known = texts.get((layer, column), texts.get(("", column), {}))
            out.append((layer, column, "en", known.get("en") or ""))
            out.append((layer, column, "fr", known.get("fr") or french(column)))
    return tuple(out)


@lru_cache(maxsize=8)
def layer_titles(folder: Path = FOLDER) -> dict[str, dict[str, str]]:
    """Layer -> theme and titles by language."""
    return {
        r["layer"]: {"theme": r["theme"], "en": r["title"], "fr": french(r["layer"])}
        for r in _rows("layers.csv", folder)
    }


def layers() -> list[str]:
    return list(layer_titles())


def column_descriptions(layer: str, lang: str = "en") -> dict[str, str]:
    """Column texts of a layer in ``lang``, else in English.

    Empty, with a warning, for a layer the dictionary does not know.
    """
    texts: dict[str, str] = {}
    for name, column, entry_lang, text in entries():
        if name == layer and (entry_lang == lang or (entry_lang == "en" and column not in texts)):
            texts[column] = text
    if not texts:
        logger.warning("layer %s is not in the dictionary", layer)
    return texts


def extent_descriptions(lang: str = "en") -> dict[str, str]:
    """Texts of the extent columns, which tables hold beside the source's."""
    names = next(r["columns"] for r in _rows("themes.csv", FOLDER) if r["theme"] == EXTENT)
    texts = {r["column"]: r for r in _rows("columns.csv", FOLDER) if not r["layer"]}
    return {n: texts[n]["fr" if lang == "fr" else "en"] for n in names.split()}


def table_description(layer: str, version: str, version_date: str = "", lang: str = "en") -> str:
    titles = layer_titles().get(layer)
    if titles is None:
        logger.warning("layer %s is not in the dictionary", layer)
        title = f"{UNKNOWN_LAYER.get(lang, UNKNOWN_LAYER['fr'])} {layer}"
    else:
        title = titles.get(lang, titles["en"])
    parts = [title, f"v{version}"]
    if version_date:
        parts.append(f"edition {version_date}")
    return ", ".join(parts)


# -- the same as tables and columns ----------------------------------------


def dictionary_table(spark: SparkSession) -> DataFrame:
    """``(layer, column, lang, text)``: a fixed few thousand rows."""
    return spark.createDataFrame(
        list(entries()), "layer string, column string, lang string, text string"
    )


def titles_table(spark: SparkSession) -> DataFrame:
    """``(layer, theme, en, fr)``, one row per known layer."""
    rows = [(name, t["theme"], t["en"], t["fr"]) for name, t in layer_titles().items()]
    return spark.createDataFrame(rows, "layer string, theme string, en string, fr string")


def describe_columns(requests: DataFrame, lang: str) -> DataFrame:
    """Add ``comment`` to ``(layer, column)`` rows: the text in ``lang``, else
    in English, else empty."""
    table = dictionary_table(requests.sparkSession)
    texts = table.groupBy("layer", "column").agg(
        F.max(F.when(F.col("lang") == lang, F.col("text"))).alias("_own"),
        F.max(F.when(F.col("lang") == "en", F.col("text"))).alias("_english"),
    )
    # The dictionary is a fixed size of a few hundred kilobytes.
    joined = requests.join(F.broadcast(texts), ["layer", "column"], "left")
    comment = F.coalesce(F.col("_own"), F.col("_english"), F.lit(""))
    return joined.withColumn("comment", comment).drop("_own", "_english")


def describe_tables(
    requests: DataFrame, version: Column, version_date: Column, lang: str
) -> DataFrame:
    """Add ``description`` to rows with a ``layer`` column."""
    titles = titles_table(requests.sparkSession).select(
        "layer", F.col(lang if lang in LANGUAGES else "en").alias("_title")
    )
    unknown = F.concat(F.lit(UNKNOWN_LAYER.get(lang, UNKNOWN_LAYER["fr"]) + " "), F.col("layer"))
    joined = requests.join(F.broadcast(titles), "layer", "left")
    text = F.concat_ws(
        ", ",
        F.coalesce(F.col("_title"), unknown),
        F.concat(F.lit("v"), version),
        F.when(version_date != "", F.concat(F.lit("edition "), version_date)),
    )
    return joined.withColumn("description", text).drop("_title")
