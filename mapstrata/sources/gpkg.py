"""GeoPackage files as a Spark data source.

``spark.read.format("gpkg").option("layer", "batiment").load(path)`` reads one
layer from every ``*.gpkg`` file below a path or glob.  A task reads one range
of feature ids by a primary-key seek and yields small Arrow batches, so its
memory does not depend on the length of the range.  Files must be on a path
which the driver and all executors can open.

Read options
  layer            name of the layer (needed unless ``listing``)
  listing          ``true``: one row per file and layer instead of features
  index            ``true``, with ``listing``: also columns, and where to cut a layer
  ranges           the cuts of a layer as an index has found them; no container is opened to plan
  featuresPerTask  length of a range of feature ids, default 200000
  batchSize        features per Arrow batch, default 5000
  geometry         ``struct`` (default), or ``wkb`` for the raw bytes
  altitudes        ``true`` for structs with the heights of the points
  losses           ``true`` for a column ``_losses`` with the values that read as NULL
  window           ``xmin,ymin,xmax,ymax`` in the layer's coordinates: features whose box touches
                   it, by the container's spatial index where it has one
  departments      codes, separated by commas: other containers are not opened
  pushdown         ``true`` to take filters; only together with the session
                   setting ``spark.sql.python.filterPushdown.enabled``

Write options
  layer            name of the layer
  srid             reference system of the file, default 4326
  spatialIndex     ``true`` to write the spatial index that ``window`` uses
  maxFileBytes     size at which a task starts its next file, default 128 MiB, or 32 MiB if ``compressed``
  compressed       ``true`` for containers in Zstandard frames, ``*.gpkg.zst``
  declared         declared types other than those of the rows, as in ``seen=DATETIME,n=INTEGER``;
                   the values are written as they are

A ``geometry`` column of bytes is taken for WKB and written as it is.

A container ``*.gpkg.zst`` is read like any other, but as a whole: each task that opens it unpacks it in memory.
"""

from __future__ import annotations

import base64
import glob
import json
import os
import re
import sqlite3
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import timezone
from urllib.parse import quote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_type

from mapstrata.functions.casts import ingestion_schema
from mapstrata.functions.geometry import GEOMETRY_TYPE, GEOMETRY_Z_TYPE, has_heights
from mapstrata.sources import wkb

GEOMETRY_COLUMN = "geometry"
LOSSES_COLUMN = "_losses"
#: A department that no container has.
NO_DEPARTMENT = "-"
LOSSES_TYPE = T.ArrayType(
    T.StructType([T.StructField(n, T.StringType()) for n in ("column", "reason", "raw")])
)
LISTING_SCHEMA = "path string, layer string, kind string, srid int, crs string, n_features long"
INDEX_SCHEMA = (
    LISTING_SCHEMA
    + ", key string, geometry string, columns array<struct<name:string,declared:string>>, z int"
    + ", cuts array<long>, stop long, xmin double, ymin double, xmax double, ymax double"
)
FEATURES_PER_TASK = 200_000
BATCH_SIZE = 5000
FILES_PER_LISTING_TASK = 16
METADATA_THREADS = 16
COMPRESSED = ".zst"
SUFFIXES = (".gpkg", ".gpkg" + COMPRESSED)
MAX_FILE_BYTES = 128 << 20
# Before compression; about one range of features, as each task has to unpack the whole.
MAX_COMPRESSED_BYTES = 32 << 20
# A department code standing alone in a path.
DEPARTMENT = re.compile(r"(?<![A-Za-z0-9])(D\d{2}[0-9AB])(?![A-Za-z0-9])")

# Declared column type -> Spark type at rest.  Anything else
# is text.  Binary columns travel and rest as base64 text.
TYPES = {
    "BOOLEAN": T.BooleanType(),
    "TINYINT": T.IntegerType(),
    "SMALLINT": T.IntegerType(),
    "MEDIUMINT": T.IntegerType(),
    "INT32": T.IntegerType(),
    "INT": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "DOUBLE": T.DoubleType(),
    "REAL": T.DoubleType(),
    "TEXT": T.StringType(),
    "BLOB": T.StringType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampType(),
}
# Spark type -> declared type of a written column.
DECLARED = {
    T.BooleanType(): "BOOLEAN",
    T.ByteType(): "SMALLINT",
    T.ShortType(): "SMALLINT",
    T.IntegerType(): "MEDIUMINT",
    T.LongType(): "INTEGER",
    T.FloatType(): "FLOAT",
    T.DoubleType(): "REAL",
    T.StringType(): "TEXT",
    T.DateType(): "DATE",
    T.TimestampType(): "DATETIME",
    T.TimestampNTZType(): "DATETIME",
    T.BinaryType(): "BLOB",
}


# --------------------------------------------------------------------------
# Containers


def local_path(path: str) -> str:
    """The path of a ``file:`` URI or plain path."""
    parsed = urlparse(path)
    if parsed.scheme == "file":
        return parsed.path
    if parsed.scheme and len(parsed.scheme) > 1:
        raise ValueError(f"{path}: GeoPackage files are read from a mounted path, not a {parsed.scheme} URI")
    return path


def find_containers(path: str) -> list[str]:
    """``*.gpkg`` and ``*.gpkg.zst`` files at a path, below a folder, or matching a glob; sorted.

    Names with a leading ``_`` or ``.`` are unfinished or hidden.
    """
    found: list[str] = []
    for entry in sorted(glob.glob(local_path(path), recursive=True)):
        if os.path.isfile(entry):
            found.append(entry)
            continue
        for folder, folders, names in os.walk(entry):
            folders[:] = sorted(f for f in folders if not f.startswith(("_", ".")))
            found += [os.path.join(folder, n) for n in sorted(names) if not n.startswith(("_", "."))]
    found = [name for name in dict.fromkeys(found) if name.endswith(SUFFIXES)]
    if not found:
        raise FileNotFoundError(f"no .gpkg file at {path}")
    return found


def department_of(path: str) -> str | None:
    """The last department code in a path."""
    codes = DEPARTMENT.findall(path)
    return codes[-1] if codes else None


def _connect(path: str) -> sqlite3.Connection:
    if path.endswith(COMPRESSED):
        connection = sqlite3.connect(":memory:")
        with pa.input_stream(path, compression="zstd") as file:
            connection.deserialize(file.read())
    else:
        connection = sqlite3.connect(f"file:{quote(path)}?mode=ro&immutable=1", uri=True)
    connection.text_factory = lambda raw: raw.decode("utf-8", "replace")
    return connection


def _name(identifier: str) -> str:
    return '"' + identifier.replace('"', '""') + '"'


@dataclass
class Layer:
    """What a container says about one of its layers."""

    path: str
    name: str
    kind: str | None
    srid: int
    crs: str
    key: str
    geometry: str | None
    columns: list[tuple[str, str]] = field(default_factory=list)
    extent: tuple | None = field(default=None, compare=False)

    def meets(self, window: tuple | None) -> bool:
        """False where the container says that the layer lies outside."""
        if window is None or not self.extent or None in self.extent:
            return True
        low_x, low_y, high_x, high_y = self.extent
        return low_x <= window[2] and high_x >= window[0] and low_y <= window[3] and high_y >= window[1]


def identified_code(definition: str) -> int:
    """The number of the first EPSG identifier in a definition text, else 0."""
    parts = re.sub(r"[\s\"]", "", definition).upper().split("[EPSG,")
    for before, rest in zip(parts, parts[1:]):
        number, closed, _ = rest.partition("]")
        if before.endswith(("AUTHORITY", "ID")) and closed and number.isdecimal() and len(number) < 10:
            return int(number)
    return 0


def _layer(connection: sqlite3.Connection, path: str, name: str) -> Layer:
    shape = connection.execute(
        "SELECT column_name, geometry_type_name, srs_id FROM gpkg_geometry_columns "
        "WHERE table_name = ?",
        (name,),
    ).fetchone()
    crs, srid = "", 0
    if shape:
        system = connection.execute(
            "SELECT organization, organization_coordsys_id, definition "
            "FROM gpkg_spatial_ref_sys WHERE srs_id = ?",
            (shape[2],),
        ).fetchone()
        if system and (system[0] or "").upper() == "EPSG":
            srid, crs = int(system[1]), f"EPSG:{system[1]}"
        elif system:
            crs = system[2] or ""
            srid = identified_code(crs)
    table = connection.execute(f"PRAGMA table_info({_name(name)})").fetchall()
    key = next((c[1] for c in table if c[5] and c[2].upper() == "INTEGER"), "rowid")
    geometry = shape[0] if shape else None
    columns = [(c[1], c[2]) for c in table if c[1] not in (key, geometry)]
    kind = shape[1] if shape else None
    return Layer(path, name, kind, srid, crs, key, geometry, columns, _extent(connection, name))


def _extent(connection: sqlite3.Connection, name: str) -> tuple | None:
    """What the container says of the box of a layer."""
    known = {row[1] for row in connection.execute("PRAGMA table_info(gpkg_contents)")}
    if not {"min_x", "min_y", "max_x", "max_y"} <= known:
        return None
    return connection.execute(
        "SELECT min_x, min_y, max_x, max_y FROM gpkg_contents WHERE table_name = ?", (name,)
    ).fetchone()


def spatial_index(connection: sqlite3.Connection, layer: Layer) -> str | None:
    """The name of a layer's spatial index, if it has one."""
    name = f"rtree_{layer.name}_{layer.geometry}"
    found = connection.execute("SELECT 1 FROM sqlite_master WHERE name = ?", (name,)).fetchone()
    return name if layer.geometry and found else None


def layer_names(connection: sqlite3.Connection) -> list[str]:
    rows = connection.execute(
        "SELECT table_name FROM gpkg_contents WHERE data_type IN ('features', 'attributes') "
        "ORDER BY table_name"
    )
    return [row[0] for row in rows]


def _feature_count(connection: sqlite3.Connection, name: str) -> int:
    """From the container's own statistics when it keeps them."""
    kept = connection.execute(
        "SELECT 1 FROM sqlite_master WHERE name = 'gpkg_ogr_contents'"
    ).fetchone()
    if kept:
        row = connection.execute(
            "SELECT feature_count FROM gpkg_ogr_contents WHERE table_name = ?", (name,)
        ).fetchone()
        if row and row[0] is not None:
            return int(row[0])
    return connection.execute(f"SELECT count(*) FROM {_name(name)}").fetchone()[0]


def open_layer(path: str, name: str) -> Layer | None:
    """The layer, or None when the container lacks it."""
    connection = _connect(path)
    try:
        return _layer(connection, path, name) if name in layer_names(connection) else None
    finally:
        connection.close()


def open_layers(
    path: str, name: str, departments: Iterable[str] = (), required: bool = True
) -> list[Layer]:
    """The layer in every container that has it; containers of other
    departments than the named ones are not opened."""
    wanted = set(departments)
    paths = [p for p in find_containers(path) if not wanted or department_of(p) in wanted]
    with ThreadPoolExecutor(METADATA_THREADS) as pool:
        found = pool.map(lambda container: open_layer(container, name), paths)
        layers = [layer for layer in found if layer is not None]
    if not layers and required:
        raise ValueError(f"no container at {path} has a layer {name}")
    return layers


def spark_type(declared: str) -> T.DataType:
    return TYPES.get(re.sub(r"\(.*", "", declared).strip().upper(), T.StringType())


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    numbers = [T.IntegerType(), T.LongType(), T.DoubleType()]
    if a in numbers and b in numbers:
        return max(a, b, key=numbers.index)
    return T.StringType()


def merged_schema(layers: list[Layer]) -> T.StructType:
    """Schema at rest: all columns of all containers, then ``geometry``."""
    types: dict[str, T.DataType] = {}
    for layer in layers:
        for name, declared in layer.columns:
            kind = spark_type(declared)
            types[name] = _wider(types[name], kind) if name in types else kind
    fields = [T.StructField(name, kind) for name, kind in types.items()]
    if any(layer.geometry for layer in layers):
        fields.append(T.StructField(GEOMETRY_COLUMN, T.StringType()))
    return T.StructType(fields)


def layer_schema(
    path: str,
    layer: str,
    extra: dict[str, T.DataType] | None = None,
    departments: Iterable[str] = (),
) -> T.StructType:
    """Schema at rest of a layer: source columns, ``geometry`` as text, extras.

    Reads metadata of the containers only.
    """
    return with_extra(merged_schema(open_layers(path, layer, departments)), extra or {})


def with_extra(schema: T.StructType, extra: dict[str, T.DataType]) -> T.StructType:
    """The schema, and the columns of ``extra`` that it lacks."""
    known = set(schema.names)
    return T.StructType(schema.fields + [T.StructField(n, t) for n, t in extra.items() if n not in known])


# --------------------------------------------------------------------------
# Ranges


@dataclass
class FeatureRange(InputPartition):
    """Features of a layer with ``start <= id < stop``."""

    path: str
    layer: str
    start: int
    stop: int

    def __init__(self, path: str, layer: str, start: int, stop: int):
        super().__init__(None)
        self.path, self.layer, self.start, self.stop = path, layer, start, stop


def range_cuts(connection: sqlite3.Connection, layer: Layer, size: int) -> tuple[list[int], int]:
    """Where ranges of about ``size`` features start, and the end of the last one.

    Ids count up from 1 as a rule, so the lowest and the highest, two seeks,
    are enough.  Where ids have wide gaps the cuts come from the ids.
    """
    table, key = _name(layer.name), layer.key if layer.key == "rowid" else _name(layer.key)
    low = connection.execute(f"SELECT min({key}) FROM {table}").fetchone()[0]
    if low is None:
        return [], 0
    high = connection.execute(f"SELECT max({key}) FROM {table}").fetchone()[0]
    cuts = list(range(low, high + 1, size)) if (high - low) // size < 64 else None
    if cuts is None:
        total = _feature_count(connection, layer.name)
        if high - low <= 4 * max(total, 1):
            cuts = list(range(low, high + 1, size))
        else:
            ids = connection.execute(f"SELECT {key} FROM {table} ORDER BY {key}")
            cuts = [row[0] for i, row in enumerate(ids) if i % size == 0]
    return cuts, high + 1


def _between(path: str, layer: str, cuts: list[int], stop: int) -> list[FeatureRange]:
    return [FeatureRange(path, layer, a, b) for a, b in zip(cuts, [*cuts[1:], stop], strict=True)] if cuts else []


def feature_ranges(layer: Layer, size: int) -> list[FeatureRange]:
    """A layer of one container in ranges of about ``size`` features."""
    connection = _connect(layer.path)
    try:
        return _between(layer.path, layer.name, *range_cuts(connection, layer, size))
    finally:
        connection.close()


def ranges_option(rows: Iterable) -> str:
    """The ``ranges`` option of a layer from its rows of an index."""
    return json.dumps([[r["path"], list(r["cuts"]), r["stop"]] for r in rows], separators=(",", ":"))


def indexed_layer(row) -> Layer:
    """What a row of an index says about a layer."""
    columns = [(c["name"], c["declared"]) for c in row["columns"]]
    return Layer(row["path"], row["layer"], row["kind"], row["srid"], row["crs"], row["key"], row["geometry"], columns)


# --------------------------------------------------------------------------
# Reading


def _as_text(value):
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bytes):
        return base64.b64encode(value).decode("ascii")
    return str(value)


def _number(value, kind):
    try:
        return None if value is None else kind(value)
    except (TypeError, ValueError, OverflowError):
        return None


def _column(values: tuple, kind: T.DataType) -> pa.Array:
    """Values of a column; SQLite does not enforce types, so what does not
    fit becomes NULL."""
    if isinstance(kind, T.StringType):
        return pa.array([_as_text(v) for v in values], pa.string())
    if isinstance(kind, T.BooleanType):
        flags = [_number(v, int) for v in values]
        return pa.array([None if n is None else n != 0 for n in flags], pa.bool_())
    convert, arrow = {
        T.IntegerType(): (int, pa.int32()),
        T.LongType(): (int, pa.int64()),
        T.DoubleType(): (float, pa.float64()),
    }[kind]
    try:
        return pa.array(values, arrow)
    except (pa.ArrowInvalid, pa.ArrowTypeError, OverflowError):
        limit = 1 << (arrow.bit_width - 1)
        numbers = [_number(v, convert) for v in values]
        if convert is int:
            numbers = [n if n is not None and -limit <= n < limit else None for n in numbers]
        return pa.array(numbers, arrow)


def _lost(name: str, values: tuple, found: pa.Array, kind: T.DataType) -> Iterator[tuple[int, dict]]:
    """Places of values that became NULL, with what they were."""
    if found.null_count == 0:
        return
    for i in np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False)):
        if values[i] is not None:
            geometry = name == GEOMETRY_COLUMN
            reason = wkb.fault_of(values[i]) if geometry else f"not a {kind.simpleString()}"
            yield int(i), {"column": name, "reason": reason, "raw": _as_text(values[i])}


def read_range(
    part: FeatureRange,
    schema: T.StructType,
    batch_size: int,
    conditions: list[tuple[str, list]],
    window: tuple | None = None,
) -> Iterator[pa.RecordBatch]:
    """Arrow batches of a range, in the columns of ``schema``; with ``window``, of features that touch it."""
    connection = _connect(part.path)
    try:
        layer = _layer(connection, part.path, part.layer)
        present = {name for name, _ in layer.columns}
        dept = department_of(part.path)
        constants = {"dept": dept, "layer": part.layer}
        tells = LOSSES_COLUMN in schema.names
        selected, slots = [], []
        for f in schema.fields:
            if f.name == GEOMETRY_COLUMN and layer.geometry:
                slots.append((f, len(selected), "geometry"))
                selected.append(_name(layer.geometry))
            elif f.name in present:
                slots.append((f, len(selected), "value"))
                selected.append(_name(f.name))
            else:
                slots.append((f, None, "constant"))
        key = layer.key if layer.key == "rowid" else _name(layer.key)
        where, values = f"{key} >= ? AND {key} < ?", [part.start, part.stop]
        index = spatial_index(connection, layer) if window else None
        if index:
            # Its boxes are rounded outwards, so it finds all that touch the window, and few more.
            within = f"{key} IN (SELECT id FROM {_name(index)} WHERE maxx >= ? AND minx <= ? AND maxy >= ? AND miny <= ?)"
            conditions = [*conditions, (within, [window[0], window[2], window[1], window[3]])]
        if window and layer.geometry:
            selected.append(_name(layer.geometry))
        for text, arguments in conditions:
            where += f" AND {text}"
            values += arguments
        rows = connection.execute(
            f"SELECT {', '.join(selected) or '1'} FROM {_name(layer.name)} "
            f"WHERE {where} ORDER BY {key}",
            values,
        )
        while chunk := rows.fetchmany(batch_size):
            if window:
                chunk = [row for row, near in zip(chunk, _near(chunk, layer, window), strict=True) if near]
                if not chunk:
                    continue
            columns = list(zip(*chunk))
            arrays: list[pa.Array | None] = []
            losses: dict[int, list[dict]] = {}
            for f, position, role in slots:
                if role == "geometry" and isinstance(f.dataType, T.StructType):
                    z = has_heights(f.dataType)
                    arrays.append(wkb.geometry_array(list(columns[position]), layer.srid, z))
                elif role == "geometry":
                    blobs = [None if b is None else wkb.split_header(b)[2] for b in columns[position]]
                    arrays.append(pa.array(blobs, pa.binary()))
                elif role == "value":
                    arrays.append(_column(columns[position], f.dataType))
                elif f.name == LOSSES_COLUMN:
                    arrays.append(None)
                elif f.name in constants:
                    arrays.append(pa.array([constants[f.name]] * len(chunk), pa.string()))
                else:
                    arrays.append(pa.nulls(len(chunk), to_arrow_type(f.dataType)))
                if position is not None and tells:
                    for i, loss in _lost(f.name, columns[position], arrays[-1], f.dataType):
                        losses.setdefault(i, []).append(loss)
            if tells:
                told = [losses.get(i) for i in range(len(chunk))]
                arrays[schema.names.index(LOSSES_COLUMN)] = pa.array(told, to_arrow_type(LOSSES_TYPE))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
    finally:
        connection.close()


def _near(chunk: list[tuple], layer: Layer, window: tuple) -> np.ndarray:
    """Which rows, whose last value is the geometry, have a box that touches the window."""
    if not layer.geometry:
        return np.zeros(len(chunk), bool)
    boxes = wkb.boxes(wkb.geometry_array([row[-1] for row in chunk], layer.srid))
    return (
        (boxes[:, 0] <= window[2]) & (boxes[:, 2] >= window[0]) & (boxes[:, 1] <= window[3]) & (boxes[:, 3] >= window[1])
    )


def window_of(options: dict[str, str]) -> tuple | None:
    numbers = tuple(float(n) for n in options.get("window", "").split(",") if n.strip())
    if numbers and len(numbers) != 4:
        raise ValueError("a window has four numbers: xmin, ymin, xmax, ymax")
    return numbers or None


def requested(options: dict[str, str]) -> list[str]:
    """The departments a scan is limited to; all when the option is absent."""
    return [code for code in options.get("departments", "").split(",") if code]


class GpkgReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"]
        self.layer = options["layer"]
        self.departments = requested(options)
        self.features_per_task = int(options.get("featurespertask", FEATURES_PER_TASK))
        self.batch_size = int(options.get("batchsize", BATCH_SIZE))
        self.ranges = options.get("ranges")
        self.window = window_of(options)
        self.filtered = False  # whether a filter has chosen the departments
        self.conditions: list[tuple[str, list]] = []

    def partitions(self) -> list[InputPartition]:
        if self.ranges is not None:
            known = json.loads(self.ranges)
            return [part for path, cuts, stop in known for part in _between(path, self.layer, cuts, stop)]
        layers = [
            layer
            for layer in open_layers(self.path, self.layer, self.departments, not self.filtered)
            if layer.meets(self.window)
        ]
        with ThreadPoolExecutor(METADATA_THREADS) as pool:
            ranges = pool.map(lambda layer: feature_ranges(layer, self.features_per_task), layers)
            return [part for parts in ranges for part in parts]

    def read(self, partition: FeatureRange | None) -> Iterator[pa.RecordBatch]:
        # Without any range Spark still runs one task, with no partition.
        if partition is not None:
            yield from read_range(partition, self.schema, self.batch_size, self.conditions, self.window)


class GpkgPushdownReader(GpkgReader):
    """Also takes filters on plain text and number columns.

    Spark calls ``pushFilters`` only with its own switch on, and refuses a
    reader that has the method with the switch off.
    """

    COMPARISONS = {
        EqualTo: "=",
        GreaterThan: ">",
        GreaterThanOrEqual: ">=",
        LessThan: "<",
        LessThanOrEqual: "<=",
    }

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        # A column can be tested in a container only if all of them have it
        # with one type.
        layers = open_layers(self.path, self.layer, self.departments)
        plain = {}
        for name, declared in layers[0].columns:
            kind = spark_type(declared)
            if isinstance(kind, (T.StringType, T.LongType, T.IntegerType, T.DoubleType)) and all(
                (name, declared) in layer.columns for layer in layers
            ):
                plain[name] = kind
        by_path = not any(name.lower() == "dept" for layer in layers for name, _ in layer.columns)
        for item in filters:
            codes = self._codes(item) if by_path else None
            if codes is not None:  # the department is the container's
                kept = [code for code in self.departments or codes if code in codes]
                self.departments, self.filtered = kept or [NO_DEPARTMENT], True
                continue
            condition = self._condition(item, plain)
            if condition is None:
                yield item
            else:
                self.conditions.append(condition)

    @staticmethod
    def _codes(item: Filter) -> list | None:
        """Departments that a filter on ``dept`` asks for."""
        if getattr(item, "attribute", ()) != ("dept",):
            return None
        if isinstance(item, EqualTo):
            return [item.value]
        return list(item.value) if isinstance(item, In) else None

    def _condition(self, item: Filter, plain: dict[str, T.DataType]) -> tuple[str, list] | None:
        attribute = getattr(item, "attribute", ())
        if len(attribute) != 1 or attribute[0] not in plain:
            return None
        name, text = _name(attribute[0]), isinstance(plain[attribute[0]], T.StringType)

        def fits(value) -> bool:
            good = str if text else (int, float)
            return isinstance(value, good) and not isinstance(value, bool)

        if isinstance(item, IsNotNull):
            return f"{name} IS NOT NULL", []
        if isinstance(item, IsNull):
            return f"{name} IS NULL", []
        if isinstance(item, In) and item.value and all(fits(v) for v in item.value):
            return f"{name} IN ({', '.join('?' * len(item.value))})", list(item.value)
        if isinstance(item, StringStartsWith) and text:
            return f"substr({name}, 1, ?) = ?", [len(item.value), item.value]
        sign = self.COMPARISONS.get(type(item))
        return (f"{name} {sign} ?", [item.value]) if sign and fits(item.value) else None


def _on(options: dict[str, str], name: str) -> bool:
    return str(options.get(name, "false")).lower() == "true"


def _indexed(connection: sqlite3.Connection, layer: Layer, size: int) -> tuple:
    """The further columns of an index: what planning needs to know of a layer."""
    z = connection.execute(
        "SELECT z FROM gpkg_geometry_columns WHERE table_name = ?", (layer.name,)
    ).fetchone()
    box = layer.extent or (None,) * 4
    cuts, stop = range_cuts(connection, layer, size)
    return layer.key, layer.geometry, layer.columns, z[0] if z else None, cuts, stop, *box


@dataclass
class Containers(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


class ListingReader(DataSourceReader):
    """Layers of containers; the containers are opened in the tasks."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.index = _on(options, "index")
        self.size = int(options.get("featurespertask", FEATURES_PER_TASK))

    def partitions(self) -> list[InputPartition]:
        paths = find_containers(self.path)
        # An index may have to walk the ids of a layer, so its tasks are smaller.
        step = 1 if self.index else FILES_PER_LISTING_TASK
        return [Containers(paths[i : i + step]) for i in range(0, len(paths), step)]

    def read(self, partition: Containers) -> Iterator[tuple]:
        for path in partition.paths:
            connection = _connect(path)
            try:
                for name in layer_names(connection):
                    layer = _layer(connection, path, name)
                    count = _feature_count(connection, name)
                    row = (path, name, layer.kind, layer.srid, layer.crs, count)
                    yield (*row, *_indexed(connection, layer, self.size)) if self.index else row
            finally:
                connection.close()


# --------------------------------------------------------------------------
# Writing


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: list[tuple[str, int]]


class _Container:
    """A container being filled in memory."""

    def __init__(
        self, layer: str, schema: T.StructType, srid: int, declared: dict[str, str], indexed: bool
    ):
        self.declared, self.indexed = declared, indexed
        self.extent = np.array([np.inf, np.inf, -np.inf, -np.inf])
        self.layer, self.srid, self.rows = layer, srid, 0
        self.fields = [f for f in schema.fields if f.name != GEOMETRY_COLUMN]
        self.has_geometry = GEOMETRY_COLUMN in schema.names
        self.high = False  # whether a geometry has heights
        self.db = sqlite3.connect(":memory:")
        self._create()

    def _create(self) -> None:
        system = "EPSG" if self.srid > 0 else "NONE"
        self.db.executescript(
            """
            PRAGMA application_id = 1196444487;
            PRAGMA user_version = 10300;
            CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL,
              srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL,
              organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL,
              description TEXT);
            CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL,
              identifier TEXT UNIQUE, description TEXT DEFAULT '',
              last_change DATETIME NOT NULL DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')),
              min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
            CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL,
              column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL,
              srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL,
              PRIMARY KEY (table_name, column_name));
            CREATE TABLE gpkg_ogr_contents (table_name TEXT PRIMARY KEY, feature_count INTEGER);
            INSERT INTO gpkg_spatial_ref_sys VALUES
              ('Undefined cartesian', -1, 'NONE', -1, 'undefined', NULL),
              ('Undefined geographic', 0, 'NONE', 0, 'undefined', NULL),
              ('WGS 84', 4326, 'EPSG', 4326, 'undefined', NULL);
            """
        )
        self.db.execute(
            "INSERT OR IGNORE INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, 'undefined', NULL)",
            (f"{system}:{self.srid}", self.srid, system, self.srid),
        )
        columns = ["fid INTEGER PRIMARY KEY AUTOINCREMENT NOT NULL"]
        columns += ["geom GEOMETRY"] * self.has_geometry
        columns += [f"{_name(f.name)} {self.declared.get(f.name) or DECLARED[f.dataType]}" for f in self.fields]
        self.db.execute(f"CREATE TABLE {_name(self.layer)} ({', '.join(columns)})")
        self.db.execute(
            "INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) "
            "VALUES (?, ?, ?, ?)",
            (self.layer, "features" if self.has_geometry else "attributes", self.layer, self.srid),
        )
        if self.has_geometry:
            self.db.execute(
                "INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', ?, 0, 0)",
                (self.layer, self.srid),
            )
        if self.has_geometry and self.indexed:
            self.db.execute(
                f"CREATE VIRTUAL TABLE {_name(f'rtree_{self.layer}_geom')} USING rtree(id, minx, maxx, miny, maxy)"
            )
            self.db.execute(
                "CREATE TABLE gpkg_extensions (table_name TEXT, column_name TEXT, extension_name TEXT NOT NULL,"
                " definition TEXT NOT NULL, scope TEXT NOT NULL)"
            )
            self.db.execute(
                "INSERT INTO gpkg_extensions VALUES (?, 'geom', 'gpkg_rtree_index',"
                " 'http://www.geopackage.org/spec120/#extension_rtree', 'write-only')",
                (self.layer,),
            )

    def add(self, batch: pa.RecordBatch) -> None:
        names = [f.name for f in self.fields]
        columns = [_sqlite_values(batch.column(f.name), f.dataType) for f in self.fields]
        if self.has_geometry:
            names.append("geom")
            shapes = batch.column(GEOMETRY_COLUMN)
            self._place(shapes)
            plain = pa.types.is_binary(shapes.type)
            columns.append(
                wkb.wrapped(shapes.to_pylist(), self.srid) if plain else wkb.gpkg_blobs(shapes, self.srid)
            )
            if not plain and shapes.type.get_field_index("heights") >= 0:
                self.high = self.high or shapes.field("heights").null_count < len(shapes)
        marks = ", ".join("?" * len(names))
        listed = ", ".join(_name(n) for n in names)
        self.db.executemany(
            f"INSERT INTO {_name(self.layer)} ({listed}) VALUES ({marks})", zip(*columns)
        )
        self.rows += batch.num_rows

    def _place(self, shapes: pa.Array) -> None:
        """Take note of where the next shapes are, and put them into the spatial index."""
        if pa.types.is_binary(shapes.type):
            shapes = wkb.geometry_array(wkb.wrapped(shapes.to_pylist(), self.srid))
        boxes = wkb.boxes(shapes)
        there = boxes[:, 0] <= boxes[:, 2]
        if not there.any():
            return
        low, high = boxes[there, :2].min(axis=0), boxes[there, 2:].max(axis=0)
        self.extent = np.concatenate([np.minimum(self.extent[:2], low), np.maximum(self.extent[2:], high)])
        if self.indexed:
            ids = np.flatnonzero(there) + self.rows + 1
            x0, y0, x1, y1 = boxes[there].T.tolist()
            self.db.executemany(
                f"INSERT INTO {_name(f'rtree_{self.layer}_geom')} VALUES (?, ?, ?, ?, ?)",
                zip(ids.tolist(), x0, x1, y0, y1, strict=True),
            )

    def size(self) -> int:
        pages = self.db.execute("PRAGMA page_count").fetchone()[0]
        return pages * self.db.execute("PRAGMA page_size").fetchone()[0]

    def save(self, path: str) -> None:
        self.db.execute("INSERT INTO gpkg_ogr_contents VALUES (?, ?)", (self.layer, self.rows))
        if np.isfinite(self.extent).all():
            self.db.execute(
                "UPDATE gpkg_contents SET min_x = ?, min_y = ?, max_x = ?, max_y = ?", self.extent.tolist()
            )
        if self.high:  # heights may be there
            self.db.execute("UPDATE gpkg_geometry_columns SET z = 2")
        self.db.commit()
        with pa.output_stream(path, compression="zstd") if path.endswith(COMPRESSED) else open(path, "wb") as file:
            file.write(self.db.serialize())
        self.db.close()


def _sqlite_values(column: pa.Array, kind: T.DataType) -> list:
    if isinstance(kind, T.DateType):
        return [None if v is None else v.isoformat() for v in column.to_pylist()]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        stamps = column.cast(pa.timestamp("us", getattr(column.type, "tz", None))).to_pylist()
        if isinstance(kind, T.TimestampNTZType):  # no zone is known, so none is told
            return [None if v is None else v.strftime("%Y-%m-%dT%H:%M:%S.%f") for v in stamps]
        utc = [None if v is None else v.astimezone(timezone.utc) for v in stamps]
        return [None if v is None else v.strftime("%Y-%m-%dT%H:%M:%S.%fZ") for v in utc]
    return column.to_pylist()


class GpkgWriter(DataSourceArrowWriter):
    """One container or more per task, published when the job commits.

    A task writes under ``_temporary``; only the files named by its commit
    message are moved to their place, so a task that was lost or ran twice
    leaves nothing behind in the result.
    """

    def __init__(self, schema: T.StructType, options: dict[str, str], overwrite: bool):
        unsupported = [
            f.name
            for f in schema.fields
            if f.name != GEOMETRY_COLUMN and f.dataType not in DECLARED
        ]
        if unsupported:
            raise ValueError(f"columns of unsupported type: {', '.join(unsupported)}")
        self.schema, self.overwrite = schema, overwrite
        self.path = local_path(options["path"])
        self.layer = options["layer"]
        self.srid = int(options.get("srid", 4326))
        pairs = [p.split("=", 1) for p in options.get("declared", "").split(",") if p]
        self.indexed = _on(options, "spatialindex")
        self.declared = {name.strip(): kind.strip() for name, kind in pairs}
        self.compressed = _on(options, "compressed")
        most = MAX_COMPRESSED_BYTES if self.compressed else MAX_FILE_BYTES
        self.max_bytes = int(options.get("maxfilebytes", most))
        self.job = uuid.uuid4().hex[:12]
        self.staging = os.path.join(self.path, "_temporary", self.job)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        files: list[tuple[str, int]] = []
        container = None
        for batch in iterator:
            for start in range(0, batch.num_rows, BATCH_SIZE):
                container = container or self._container()
                container.add(batch.slice(start, BATCH_SIZE))
                if container.size() >= self.max_bytes:
                    files.append(self._save(container))
                    container = None
        if container:
            files.append(self._save(container))
        return WrittenFiles(files)

    def _container(self) -> _Container:
        return _Container(self.layer, self.schema, self.srid, self.declared, self.indexed)

    def _save(self, container: _Container) -> tuple[str, int]:
        os.makedirs(self.staging, exist_ok=True)
        name = f"part-{uuid.uuid4().hex[:16]}{SUFFIXES[self.compressed]}"
        container.save(os.path.join(self.staging, name))
        return name, container.rows

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        os.makedirs(self.path, exist_ok=True)
        if self.overwrite:
            for name in os.listdir(self.path):
                if name.endswith(SUFFIXES):
                    os.remove(os.path.join(self.path, name))
        files = [file for message in messages if message for file in message.files]
        if not files:  # an empty layer still has its container
            os.makedirs(self.staging, exist_ok=True)
            files = [self._save(self._container())]
        for name, _ in files:
            os.replace(os.path.join(self.staging, name), os.path.join(self.path, name))
        self._discard()

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        self._discard()

    def _discard(self) -> None:
        if not os.path.isdir(self.staging):
            return
        for name in os.listdir(self.staging):
            os.remove(os.path.join(self.staging, name))
        os.rmdir(self.staging)
        if not os.listdir(os.path.dirname(self.staging)):
            os.rmdir(os.path.dirname(self.staging))


def scanned(at_rest: T.StructType, shape: T.DataType, losses: bool) -> T.StructType:
    """The columns of a scan: dates as text, geometries as ``shape``, and losses if asked for."""
    in_flight, _ = ingestion_schema(at_rest)
    fields = [T.StructField(f.name, shape if f.name == GEOMETRY_COLUMN else f.dataType) for f in in_flight]
    return T.StructType([*fields, *([T.StructField(LOSSES_COLUMN, LOSSES_TYPE)] if losses else [])])


class GpkgDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def _listing(self) -> bool:
        return _on(self.options, "listing")

    def schema(self) -> T.StructType | str:
        if self._listing():
            return INDEX_SCHEMA if _on(self.options, "index") else LISTING_SCHEMA
        extra = {"dept": T.StringType(), "layer": T.StringType()}
        at_rest = layer_schema(
            self.options["path"], self.options["layer"], extra, requested(self.options)
        )
        raw = self.options.get("geometry", "struct") == "wkb"
        high = _on(self.options, "altitudes")
        shape = T.BinaryType() if raw else GEOMETRY_Z_TYPE if high else GEOMETRY_TYPE
        return scanned(at_rest, shape, _on(self.options, "losses"))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        if self._listing():
            return ListingReader(self.options)
        return (GpkgPushdownReader if _on(self.options, "pushdown") else GpkgReader)(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> GpkgWriter:
        return GpkgWriter(schema, self.options, overwrite)
