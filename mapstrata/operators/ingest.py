"""From source rows to table rows in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.casts import Cast, has_bad_seconds, ingestion_schema
from mapstrata.functions.geometry import BBOX_COLUMNS, GEOMETRY_Z_TYPE, has_heights, st_geom_from_wkt, with_bbox
from mapstrata.functions.projection import check_pair, st_transform, utm_zones
from mapstrata.functions.reuse import built_once
from mapstrata.settings import TARGET_SRID

GEOMETRY_COLUMN = "geometry"
LOSSES_TYPE = "array<struct<column:string,reason:string,raw:string>>"


def add_metadata(df: DataFrame, dept: Column | str, layer: str) -> DataFrame:
    """Add ``dept`` (a literal code or a column) and ``layer``."""
    return df.withColumns(
        {"dept": F.lit(dept) if isinstance(dept, str) else dept, "layer": F.lit(layer)}
    )


def geometry_column(
    schema: T.StructType,
    source_srid: int = 0,
    target_srid: int = TARGET_SRID,
    altitudes: bool = False,
    zones: bool = True,
) -> Column:
    """The table geometry from WKT text or from a geometry struct.

    A struct keeps the heights it has; ``altitudes`` asks for those of texts.  ``zones`` is
    False where no geometry is in a transverse Mercator system.
    """
    check_pair(source_srid, target_srid)
    kind = schema[GEOMETRY_COLUMN].dataType
    as_text = isinstance(kind, T.StringType)
    high = altitudes if as_text else has_heights(kind)
    if as_text:
        zones = source_srid in utm_zones()
    return _projected(as_text, source_srid, target_srid, high, zones)


@built_once
def _projected(as_text: bool, source_srid: int, target_srid: int, z: bool, zones: bool) -> Column:
    # As a column: the projection uses it inside lambdas.
    parsed = st_geom_from_wkt(F.col(GEOMETRY_COLUMN), source_srid, z) if as_text else GEOMETRY_COLUMN
    return st_transform(parsed, target_srid, z, zones)


def select_columns(
    schema: T.StructType,
    casts: dict[str, Cast] | None = None,
    source_srid: int = 0,
    target_srid: int = TARGET_SRID,
    altitudes: bool = False,
    zones: bool = True,
) -> list[Column]:
    """One output column per input column: geometry, casts, the rest as is.

    A source without a known reference system (SRID 0) keeps its
    coordinates, and its geometry keeps SRID 0 so that the checks show it.
    """
    casts = casts or {}
    columns = []
    for field in schema.fields:
        if field.name == GEOMETRY_COLUMN:
            column = geometry_column(schema, source_srid, target_srid, altitudes, zones)
        elif field.name in casts:
            column = casts[field.name](F.col(f"`{field.name}`"))
        else:
            column = F.col(f"`{field.name}`")
        columns.append(column.alias(field.name))
    return columns


def ingest(
    df: DataFrame,
    schema: T.StructType | None = None,
    source_srid: int = 0,
    target_srid: int = TARGET_SRID,
    extent: bool = True,
    altitudes: bool = False,
    zones: bool = True,
) -> DataFrame:
    """Typed rows of a layer.

    ``altitudes`` keeps the heights of geometries that come as text; those of structs are
    kept anyway.  ``zones`` is False where no geometry is in a transverse Mercator system.

    ``schema`` is the schema at rest; its date and timestamp columns are cast
    from text.  Without it columns keep the types they have.  A frame with no
    geometry and nothing to cast is returned as it is.
    """
    casts: dict[str, Cast] = {}
    if schema is not None:
        _, casts = ingestion_schema(schema)
        casts = {name: cast for name, cast in casts.items() if name in df.columns}
    has_geometry = GEOMETRY_COLUMN in df.columns
    if not casts and not has_geometry:
        return df
    out = df.select(*select_columns(df.schema, casts, source_srid, target_srid, altitudes, zones))
    return with_bbox(out, GEOMETRY_COLUMN) if has_geometry and extent else out


LOSSES_COLUMN = "_losses"


def with_losses(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add to ``_losses`` the texts that the casts of ``schema`` turn into NULL.

    The column is an array of (column, reason, raw), NULL for a row that loses nothing; what the
    scan has told in it stays.
    """
    _, casts = ingestion_schema(schema)
    found = []
    for name, cast in casts.items():
        if name in df.columns:
            value, kind = F.col(f"`{name}`"), schema[name].dataType.simpleString()
            loss = F.struct(F.lit(name).alias("column"), F.lit(f"not a {kind}").alias("reason"), value.alias("raw"))
            found.append(F.when(value.isNotNull() & cast(value).isNull(), loss))
    told = [F.col(LOSSES_COLUMN)] if LOSSES_COLUMN in df.columns else []
    if not found:
        return df if told else df.withColumn(LOSSES_COLUMN, F.lit(None).cast(LOSSES_TYPE))
    lost = F.array_compact(F.array(*found))
    whole = F.concat(F.coalesce(told[0], F.array().cast(LOSSES_TYPE)), lost) if told else lost
    whole = whole.cast(LOSSES_TYPE)
    return df.withColumn(LOSSES_COLUMN, F.when(F.size(whole) > 0, whole))


def loss_rows(df: DataFrame, *columns: str) -> DataFrame:
    """One row per lost value: ``columns``, column, reason, raw."""
    lost = df.filter(F.col(LOSSES_COLUMN).isNotNull())
    return lost.select(*columns, F.inline(LOSSES_COLUMN))


def at_rest(schema: T.StructType, altitudes: bool = False) -> T.StructType:
    """The schema at rest of a layer, extent columns included."""
    fields = list(schema.fields)
    if altitudes:
        fields = [T.StructField(f.name, GEOMETRY_Z_TYPE) if f.name == GEOMETRY_COLUMN else f for f in fields]
    if GEOMETRY_COLUMN in schema.names:
        fields += [T.StructField(n, T.DoubleType()) for n in BBOX_COLUMNS if n not in schema.names]
    return T.StructType(fields)


# --------------------------------------------------------------------------
# Rows a tolerant cast would lose


def date_like_columns(schema: T.StructType) -> list[str]:
    """Text columns named like a date."""
    return [
        f.name
        for f in schema.fields
        if "date" in f.name.lower() and isinstance(f.dataType, T.StringType)
    ]


def bad_datetimes(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with impossible seconds in any date column, with the columns' names.

    One pass: every row comes once, however many of its columns are bad.
    """
    columns = columns if columns is not None else date_like_columns(df.schema)
    if not columns:
        return df.withColumn("bad_columns", F.array().cast("array<string>")).filter(F.lit(False))
    named = F.array(*[F.when(has_bad_seconds(F.col(f"`{c}`")), F.lit(c)) for c in columns])
    return df.withColumn("bad_columns", F.array_compact(named)).filter(F.size("bad_columns") > 0)


def cast_losses(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per date column: values, and values which the cast turns into NULL."""
    _, casts = ingestion_schema(schema)
    casts = {name: cast for name, cast in casts.items() if name in df.columns}
    counts = df.agg(
        *[F.count(F.col(f"`{n}`")).alias(f"v{i}") for i, n in enumerate(casts)],
        *[
            F.count_if(F.col(f"`{n}`").isNotNull() & cast(F.col(f"`{n}`")).isNull()).alias(f"l{i}")
            for i, (n, cast) in enumerate(casts.items())
        ],
    )
    rows = [
        F.struct(
            F.lit(n).alias("column"), F.col(f"v{i}").alias("values"), F.col(f"l{i}").alias("lost")
        )
        for i, n in enumerate(casts)
    ]
    return counts.select(F.inline(F.array(*rows)))
