"""The registered queries in plain SQL over the same tables.

Written independently of the DataFrame code: closed forms where shapes are
rectangles, the textbook projection formula, string building for texts.
"""

from __future__ import annotations

import math

from mapstrata import dictionary
from mapstrata.functions.codes import ARCHIVE_HOST
from mapstrata.operators.validate import LAT_BOUNDS, LON_BOUNDS
from mapstrata.plans import features, queries
from mapstrata.settings import PROJECTION, TABLE_PREFIX, VERSION, VERSION_DATE


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _projected(x: str, y: str) -> tuple[str, str]:
    """Longitude and latitude; the latitude from its series in multiples of
    the conformal latitude."""
    n, c, pole = 0.7256077650532682, 11754255.42609601, 12655612.049875995
    lon = f"degrees(atan2({x} - 700000e0, {pole!r}e0 - {y}) / {n!r}e0) + 3e0"
    radius = f"sqrt(({x} - 700000e0) * ({x} - 700000e0) + ({pole!r}e0 - {y}) * ({pole!r}e0 - {y}))"
    chi = f"(2e0 * atan(exp(-ln({radius} / {c!r}e0) / {n!r}e0)) - {math.pi / 2!r}e0)"
    terms = " + ".join(
        f"{value:.17e} * sin({k}e0 * {chi})"
        for k, value in (
            (2, 3.35655148535114268e-3),
            (4, 6.57187277529396252e-6),
            (6, 1.76456436467816398e-8),
            (8, 5.32847854905339864e-11),
        )
    )
    return lon, f"degrees({chi} + {terms})"


POINTS = f"""
points AS (
  SELECT 'FEAT' || lpad(c_custkey::VARCHAR, 16, '0') AS cleabs,
    'D' || lpad((c_nationkey + 1 + s.shift)::VARCHAR, 3, '0') AS dept,
    '{features.POINT_LAYER}' AS layer,
    (100000 + (c_custkey * 7919) % 1100000)::DOUBLE AS x,
    (6050000 + (c_custkey * 104729) % 1050000)::DOUBLE AS y,
    c_acctbal AS hauteur, c_acctbal < 0 AS construction_legere, c_mktsegment AS nature
  FROM customer, (VALUES (0), (1)) s(shift)
  WHERE s.shift = 0 OR c_acctbal < 0)"""

LINES = f"""
lines AS (
  SELECT 'LINE' || lpad(l_orderkey::VARCHAR, 14, '0') || lpad(l_linenumber::VARCHAR, 2, '0') AS cleabs,
    'D' || lpad((l_suppkey % 96 + 1)::VARCHAR, 3, '0') AS dept,
    '{features.LINE_LAYER}' AS layer,
    l_partkey AS part, l_suppkey AS supplier, l_quantity AS largeur, l_returnflag AS nature,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS date_creation,
    l_linenumber AS rang,
    100000 + (l_partkey * 7919) % 1000000 AS x0,
    6100000 + (l_suppkey * 104729 + l_orderkey) % 900000 AS y0,
    (l_quantity::INTEGER % 6) + 2 AS vertices
  FROM lineitem)"""


def _areas(scale: int = 10) -> str:
    return f"""
areas AS (
  SELECT *, x0 + w AS x1, y0 + h AS y1 FROM (
    SELECT 'BATI' || lpad(p_partkey::VARCHAR, 16, '0') AS cleabs,
      'D' || lpad((p_partkey % 96 + 1)::VARCHAR, 3, '0') AS dept,
      '{features.AREA_LAYER}' AS layer, p_type AS nature, p_retailprice AS hauteur,
      p_size AS nombre_d_etages,
      (100000 + (p_partkey * 7919) % 1000000)::DOUBLE AS x0,
      (6100000 + (p_partkey * 104729) % 900000)::DOUBLE AS y0,
      (p_size * {scale})::DOUBLE AS w, (p_size * {scale} / 2e0 + 5)::DOUBLE AS h,
      p_partkey % 97 = 0 AS tied, p_partkey % 97 <> 0 AND p_size % 5 = 0 AS holed
    FROM part))"""


AREAS = _areas()
LINKS = """
links AS (
  SELECT lpad(s_suppkey::VARCHAR, 12, '0') AS identifiant_rnb,
    'BATI' || lpad(s_suppkey::VARCHAR, 16, '0') AS cleabs_batiment
  FROM supplier)"""
LON, LAT = _projected("x", "y")
STAMPS = """
stamps AS (
  SELECT o_orderkey, CASE
    WHEN o_orderpriority = '1-URGENT' THEN day || ' ' || clock || '60'
    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN NULL
    WHEN o_orderpriority = '2-HIGH' THEN day || ' ' || clock || '07'
    WHEN o_orderpriority = '3-MEDIUM' THEN day || ' ' || clock || '08+00:00'
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN replace(day, '-', '/') || ' ' || clock || '09'
    WHEN o_orderstatus = 'P' THEN day || 'T' || clock || '61.5Z'
    ELSE substr(day, 1, 4) || '-13-01 ' || clock || '10' END AS raw
  FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day,
    lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':' || lpad((o_custkey % 60)::VARCHAR, 2, '0') || ':'
      AS clock FROM orders)),
typed AS (
  SELECT o_orderkey, raw, try_cast(replace(raw, '/', '-') AS TIMESTAMP) AS ts,
    try_cast(replace(substr(raw, 1, 10), '/', '-') AS DATE) AS d
  FROM stamps)"""
REQUESTS = """
requests AS (
  SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN NULL
    ELSE lpad((s_nationkey + 1)::VARCHAR, 3, '0') END AS first_code
  FROM supplier),
numbered AS (
  SELECT lpad(n::VARCHAR, 3, '0') AS code, n AS place FROM range(1, 96) r(n) WHERE n <> 20
  UNION ALL VALUES ('02A', 96), ('02B', 97)),
asked AS (
  SELECT s_suppkey, (row_number() OVER (PARTITION BY s_suppkey ORDER BY place) - 1)::INTEGER AS pos, code
  FROM (
    SELECT s_suppkey, place, code FROM requests, numbered WHERE first_code IS NULL
    UNION ALL SELECT s_suppkey, 0, first_code FROM requests WHERE first_code IS NOT NULL
    UNION ALL SELECT s_suppkey, 1, 'D075' FROM requests WHERE first_code IS NOT NULL
    UNION ALL SELECT s_suppkey, 2, '02A' FROM requests WHERE first_code IS NOT NULL)),
coded AS (
  SELECT s_suppkey, pos, CASE WHEN code LIKE 'D%' THEN code ELSE 'D' || code END AS dept FROM asked)"""
LANDED = """
landed AS (
  SELECT doc_id, CASE WHEN source = 'src7' THEN NULL WHEN lang = 'de' THEN md5(reverse(text))
      ELSE md5(text) END AS expected_md5,
    CASE WHEN source <> 'src3' AND length(text) > 0 THEN md5(text) END AS md5
  FROM documents),
verified AS (
  SELECT *, CASE WHEN md5 IS NULL THEN 'missing' WHEN expected_md5 IS NULL THEN 'no_checksum'
    WHEN md5 = expected_md5 THEN 'ok' ELSE 'mismatch' END AS status
  FROM landed)"""
LINE_LIST = "cleabs, dept, nature, part, supplier, largeur, date_creation"


def _ranked(source: str, columns: str, rest: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in ["dept", *rest.split(", ")])
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY cleabs ORDER BY {order})"
        f" AS rn FROM {source}) WHERE rn = 1"
    )


DEDUP_LINES = _ranked("lines", LINE_LIST, "nature, part, supplier, largeur, date_creation")
VERTICES = """
vertices AS (
  SELECT l.*, (x0 + i * 10)::DOUBLE AS x, (y0 + (i % 2) * rang)::DOUBLE AS y
  FROM (SELECT *, row_number() OVER () AS id FROM lines) l, range(0, 7) r(i) WHERE i < vertices)"""
CORNERS = """
corners AS (
  SELECT a.cleabs, a.dept, a.layer, a.tied, x, y FROM areas a,
    LATERAL (VALUES (x0, y0), (x1, y0), (x1, y1), (x0, y1)) c(x, y))"""


def _area_list(kind: str) -> str:
    """All features with their geometry kind and point counts."""
    return f"""
      SELECT cleabs, dept, 'ST_Point' AS kind, 1 AS n_points FROM points{kind}
      UNION ALL SELECT cleabs, dept, 'ST_LineString', vertices FROM lines
      UNION ALL SELECT cleabs, dept, 'ST_Polygon', CASE WHEN holed THEN 10 ELSE 5 END FROM areas"""


ALL_KINDS = f"all_kinds AS ({_area_list('')})"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _bounds(source: str, table: str) -> str:
    """Two results out of min_lon to max_lat."""

    def number(name: str) -> str:
        return f"round({name}, 4)::DECIMAL(12, 4)::VARCHAR"

    detail = (
        f"'lon=[' || {number('min_lon')} || ', ' || {number('max_lon')} || '], lat=['"
        f" || {number('min_lat')} || ', ' || {number('max_lat')} || ']'"
    )
    lon = f"min_lon > {LON_BOUNDS[0]} AND max_lon < {LON_BOUNDS[1]}"
    lat = f"min_lat > {LAT_BOUNDS[0]} AND max_lat < {LAT_BOUNDS[1]}"
    return f"""
      SELECT 'lon_range' AS "check", {_quoted(table)} AS "table", {lon} AS ok, {detail} AS detail FROM {source}
      UNION ALL SELECT 'lat_range', {_quoted(table)}, {lat}, {detail} FROM {source}"""


POINT_BOUNDS = f"""
point_bounds AS (
  SELECT min({LON}) AS min_lon, max({LON}) AS max_lon, min({LAT}) AS min_lat, max({LAT}) AS max_lat
  FROM points WHERE nature <> 'FURNITURE')"""
AREA_BOUNDS = f"""
area_bounds AS (
  SELECT min({LON}) AS min_lon, max({LON}) AS max_lon, min({LAT}) AS min_lat, max({LAT}) AS max_lat
  FROM corners)"""
FUNCTION_CHECKS = (
    "st_geometrytype",
    "st_npoints",
    "st_area",
    "st_centroid",
    "st_isvalid",
    "st_asgeojson",
)


def _functions(source: str, table: str, bad: str) -> str:
    """Function results: only the validity check can fail here."""
    rows = []
    for check in FUNCTION_CHECKS:
        failing = f"count(*) FILTER (WHERE {bad})" if check == "st_isvalid" else "count(*) * 0"
        rows.append(
            f"""SELECT '{check}' AS "check", {_quoted(table)} AS "table", {failing} = 0 AS ok,
            ({failing})::VARCHAR || ' rows fail' AS detail FROM {source}"""
        )
    return " UNION ALL ".join(rows)


def _dictionary() -> str:
    """The columns of each layer with their texts, from the data files."""

    def file(name: str) -> str:
        return f"read_csv('{dictionary.FOLDER}/{name}.csv', header = true, all_varchar = true)"

    return f"""
dictionary AS (
  SELECT DISTINCT l.layer, c.col, coalesce(own.en, shared.en, '') AS en, coalesce(own.fr, shared.fr) AS fr
  FROM {file("layers")} l JOIN {file("themes")} t ON t.theme = l.theme JOIN {file("themes")} k ON k.theme = 'common',
    unnest(string_split_regex(trim(coalesce(k.columns, '') || ' ' || coalesce(t.columns, '') || ' ' || coalesce(l.columns, '')), ' +')) c(col)
  LEFT JOIN {file("columns")} own ON own.layer = l.layer AND own."column" = c.col
  LEFT JOIN {file("columns")} shared ON shared.layer IS NULL AND shared."column" = c.col)"""


def _titles() -> str:
    values = ", ".join(
        f"({i}, {_quoted(name)}, {_quoted(t['en'])}, {_quoted(t['fr'])})"
        for i, (name, t) in enumerate(dictionary.layer_titles().items())
    )
    return f"titles(i, layer, en, fr) AS (VALUES {values})"


def _report() -> str:
    """The report on two layers, a link layer, and the twins of two."""
    pre = TABLE_PREFIX
    p, a, k = (pre + n for n in (features.POINT_LAYER, features.AREA_LAYER, features.LINK_LAYER))
    parts = []
    for table, rows, shapes, bounds, bad in (
        (p, "points", "points_with", "point_bounds", "FALSE"),
        (p + "_dedup", "points_once", "points_once_with", "point_once_bounds", "FALSE"),
        (a, "areas", "areas", "area_bounds", "tied"),
        (a + "_dedup", "areas", "areas", "area_bounds", "tied"),
    ):
        parts.append(
            f"""SELECT 'row_count' AS "check", '{table}' AS "table", count(*) > 0 AS ok,
              count(*)::VARCHAR || ' rows' AS detail FROM {rows}"""
        )
        parts.append(f"SELECT 'geometry_type', '{table}', TRUE, 'type=geometry'")
        parts.append(f"SELECT 'srid', '{table}', count(*) > 0, 'srid=4326' FROM {shapes}")
        parts.append(_bounds(bounds, table))
        parts.append(_functions(shapes, table, bad))
    parts.append(f"SELECT 'row_count', '{k}', count(*) > 0, count(*)::VARCHAR || ' rows' FROM links")
    for table, base, once in ((p, "points", "points_once"), (a, "areas", "areas")):
        parts.append(
            f"""SELECT 'dedup_size', '{table}_dedup', TRUE, (SELECT count(*) FROM {base})::VARCHAR
              || ' -> ' || (SELECT count(*) FROM {once})::VARCHAR"""
        )
        parts.append(f"SELECT 'dedup_keys', '{table}_dedup', TRUE, '0 keys repeat'")
    once = _ranked("points", "*", "layer, hauteur, construction_legere, nature")
    return (
        _with(
            POINTS,
            AREAS,
            LINKS,
            CORNERS,
            POINT_BOUNDS,
            AREA_BOUNDS,
            f"points_once AS ({once})",
            "points_with AS (SELECT * FROM points WHERE nature <> 'FURNITURE')",
            "points_once_with AS (SELECT * FROM points_once WHERE nature <> 'FURNITURE')",
            f"""point_once_bounds AS (
              SELECT min({LON}) AS min_lon, max({LON}) AS max_lon, min({LAT}) AS min_lat,
                max({LAT}) AS max_lat FROM points_once_with)""",
        )
        + " UNION ALL ".join(parts)
    )


def oracle_sql() -> dict[str, str]:
    point_layer, line_layer, area_layer, link_layer = (
        features.POINT_LAYER,
        features.LINE_LAYER,
        features.AREA_LAYER,
        features.LINK_LAYER,
    )
    sql: dict[str, str] = {}

    sql["gpkg_roundtrip"] = _with(POINTS) + (
        "SELECT cleabs, dept, layer, nature, hauteur, construction_legere, x, y, 2154 AS srid FROM points"
    )
    x0, y0, x1, y1 = queries.WINDOW
    sql["gpkg_window_scan"] = _with(POINTS, AREAS) + f"""
      SELECT layer, dept, cleabs, x AS xmin, y AS ymin, x AS xmax, y AS ymax FROM points
      WHERE x BETWEEN {x0} AND {x1} AND y BETWEEN {y0} AND {y1}
      UNION ALL SELECT layer, dept, cleabs, x0, y0, x1, y1 FROM areas
      WHERE x0 <= {x1} AND x1 >= {x0} AND y0 <= {y1} AND y1 >= {y0}"""
    sql["layer_listing"] = _with(POINTS) + f"""
      SELECT '{point_layer}' AS layer, 'GEOMETRY' AS kind, 2154 AS srid, 'EPSG:2154' AS crs,
        count(*) AS n_features FROM points
      UNION ALL SELECT '{area_layer}', 'GEOMETRY', 2154, 'EPSG:2154', count(*) FROM part
      UNION ALL SELECT '{link_layer}', NULL, 0, '', count(*) FROM supplier"""
    sql["layer_schema"] = """
      SELECT c.name AS "column", c.type AS "type", (SELECT count(*) FROM part) AS n_values
      FROM (VALUES ('cleabs', 'string'), ('dept', 'string'), ('nature', 'string'),
        ('hauteur', 'double'), ('nombre_d_etages', 'int'), ('date_creation', 'date'),
        ('date_modification', 'timestamp'), ('construction_legere', 'boolean'),
        ('geometry', 'string'), ('layer', 'string')) c(name, type)"""
    sql["layer_counts"] = _with(POINTS) + f"""
      SELECT layer, count(*) AS n_features FROM points GROUP BY layer
      UNION ALL SELECT '{line_layer}', count(*) FROM lineitem
      UNION ALL SELECT '{area_layer}', count(*) FROM part"""
    size = queries.RANGE_SIZE
    sql["batch_ranges"] = _with(
        LINES, "counts AS (SELECT dept, count(*) AS n FROM lines GROUP BY dept)"
    ) + f"""
      SELECT dept, n, idx, idx * {size} AS "offset", least({size}, n - idx * {size}) AS size
      FROM (SELECT dept, n, unnest(range(0, (n + {size} - 1) // {size})) AS idx FROM counts)"""
    sql["crs_code"] = """
      SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
        THEN c_nationkey + 2150 ELSE 0 END::INTEGER AS code FROM customer"""
    sql["layer_selection"] = _with(
        _titles(),
        """wanted AS (
          SELECT s_suppkey, 0 AS pos, layer FROM supplier JOIN titles ON i = (s_suppkey * 7) % 60
          UNION ALL
          SELECT s_suppkey, 1, layer FROM supplier JOIN titles ON i = (s_suppkey + 3) % 60
          UNION ALL SELECT s_suppkey, 2, 'unknown_' || (s_suppkey % 5)::VARCHAR FROM supplier)""",
        "listing AS (SELECT DISTINCT layer FROM part JOIN titles ON i = p_size % 60)",
    ) + """
      SELECT s_suppkey, pos, layer, layer IN (SELECT layer FROM listing) AS known FROM wanted"""
    sql["departments"] = _with(REQUESTS) + "SELECT s_suppkey, pos, dept FROM coded"
    base = f"'BDTOPO_{VERSION}_TOUSTHEMES_GPKG_{PROJECTION}_' || dept || '_{VERSION_DATE}'"
    sql["source_manifest"] = _with(REQUESTS) + f"""
      SELECT s_suppkey, pos, dept, {base} AS name,
        '{ARCHIVE_HOST}/' || {base} || '/' || {base} || '.7z' AS url,
        '{ARCHIVE_HOST}/' || {base} || '/' || {base} || '.md5' AS checksum_url
      FROM coded"""
    sql["checksum_verify"] = _with(LANDED) + "SELECT doc_id, md5, status FROM verified"
    sql["landed_checksums"] = """
      WITH lines AS (SELECT source, doc_id, md5(coalesce(text, '')) AS line FROM documents), files AS (
        SELECT source, k AS "round", string_agg(CASE WHEN k = 3 AND source = 'src3' THEN reverse(line) ELSE line END || chr(10), ''
          ORDER BY doc_id) AS content FROM lines, (VALUES (1), (2), (3)) r(k) GROUP BY ALL)
      SELECT source, strlen(content)::BIGINT AS length, md5(content) AS md5,
        CASE WHEN "round" = 1 OR "round" = 3 AND source = 'src3' THEN 1 ELSE 0 END AS hashed, "round" FROM files"""
    sql["stale_sources"] = _with(LANDED) + (
        "SELECT doc_id, expected_md5 FROM verified v WHERE NOT EXISTS ("
        "SELECT 1 FROM verified g WHERE g.doc_id = v.doc_id AND g.status IN ('ok', 'no_checksum'))"
    )

    sql["delete_dept"] = _with(LINES) + (
        "SELECT dept, count(*) AS n, sum(largeur) AS largeur FROM lines WHERE dept <> 'D007' GROUP BY dept"
    )
    sql["schema_merge"] = _with(LINES) + """
      SELECT dept, nature, count(*) AS n, sum(largeur) AS largeur FROM (
        SELECT dept, NULL AS nature, largeur FROM lines
        UNION ALL SELECT dept, nature, largeur FROM lines) GROUP BY dept, nature"""
    sql["schema_widen"] = """
      SELECT 'D' || lpad((l_suppkey % 96 + 1)::VARCHAR, 3, '0') AS dept, sum(l_partkey)::BIGINT AS rang,
        sum(l_orderkey + CASE WHEN l_suppkey % 96 = 2 THEN 0.5e0 ELSE 0e0 END) AS ordre,
        strftime(max(l_shipdate::DATE + CASE WHEN l_suppkey % 96 = 2 THEN 1 ELSE 0 END), '%Y-%m-%d') AS latest,
        'bigint,double,date' AS types
      FROM lineitem GROUP BY ALL"""
    sql["reload_recovered"] = _with(LINES) + """
      SELECT dept, nature, count(*) AS n, sum(largeur + CASE WHEN dept IN ('D003', 'D006') THEN 100 ELSE 0 END) AS largeur
      FROM lines WHERE dept <> 'D004' AND (dept <> 'D003' OR nature = 'A') GROUP BY dept, nature"""
    sql["reload_dept"] = _with(LINES) + """
      SELECT dept, nature, count(*) AS n, sum(largeur) AS largeur FROM (
        SELECT dept, nature, largeur FROM lines WHERE dept NOT IN ('D003', 'D004')
        UNION ALL
        SELECT dept, nature, largeur + 100 FROM lines WHERE dept = 'D003' AND nature = 'A')
      GROUP BY dept, nature"""
    french = dictionary.column_descriptions(area_layer, "fr")
    columns = ("cleabs", "dept", "layer", "nature", "hauteur", "nombre_d_etages")
    described = [("column", c, french[c]) for c in columns]
    described += [
        ("property", "crs", "EPSG:4326"),
        ("property", "bdtopo_version", VERSION),
        ("property", "bdtopo_version_date", VERSION_DATE),
        ("table", "comment", dictionary.table_description(area_layer, VERSION, VERSION_DATE, "fr")),
    ]
    values = ", ".join(f"({_quoted(a)}, {_quoted(b)}, {_quoted(c)})" for a, b, c in described)
    sql["table_metadata"] = f"""
      SELECT d.kind AS "of", d.item, d.label AS "text", (SELECT count(*) FROM part) AS n_values
      FROM (VALUES {values}) d(kind, item, label)"""
    sql["source_tables"] = f"""
      SELECT '{TABLE_PREFIX}{line_layer}' AS table_name, count(*) AS n_rows FROM lineitem
      UNION ALL SELECT '{TABLE_PREFIX}{area_layer}', count(*) FROM part"""
    sql["load_metrics"] = _with(POINTS, LINES) + """
      SELECT layer, dept, count(*) AS rows FROM (
        SELECT layer, dept FROM points UNION ALL SELECT layer, dept FROM lines)
      GROUP BY ROLLUP (layer, dept)"""

    sql["ingest_features"] = _with(POINTS) + f"""
      SELECT cleabs, dept, layer, CASE WHEN nature = 'MACHINERY' THEN '1612-01-01 00:00:00'
          WHEN nature IN ('BUILDING', 'FURNITURE') THEN NULL ELSE '2021-03-04 05:06:07' END AS date_creation,
        CASE WHEN nature <> 'HOUSEHOLD' THEN 4326 END AS srid,
        CASE WHEN nature <> 'HOUSEHOLD' THEN round({LON}, 6) END AS lon,
        CASE WHEN nature <> 'HOUSEHOLD' THEN round({LAT}, 6) END AS lat
      FROM points"""
    sql["frames_to_table"] = sql["ingest_features"]
    sql["tolerant_cast"] = _with(STAMPS) + """
      SELECT o_orderkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS as_timestamp,
        strftime(d, '%Y-%m-%d') AS as_date FROM typed"""
    sql["cast_losses"] = _with(STAMPS) + """
      SELECT 'date_creation' AS "column", count(raw) AS "values",
        count(*) FILTER (WHERE raw IS NOT NULL AND ts IS NULL) AS lost FROM typed
      UNION ALL SELECT 'date_de_confirmation', count(raw),
        count(*) FILTER (WHERE raw IS NOT NULL AND d IS NULL) FROM typed"""
    sql["bad_datetimes"] = _with(STAMPS) + """
      SELECT o_orderkey, concat_ws(',', CASE WHEN bad THEN 'date_creation' END,
          CASE WHEN o_orderkey % 3 = 0 OR bad THEN 'date_modification' END) AS bad_columns
      FROM (SELECT o_orderkey, coalesce(raw LIKE '%:60' OR raw LIKE '%:61.5Z', FALSE) AS bad FROM stamps)
      WHERE o_orderkey % 3 = 0 OR bad"""
    sql["geom_wkt_roundtrip"] = _with(LINES) + """
      SELECT cleabs, dept, 'LINESTRING (' || array_to_string([
          (x0 + i * 10)::VARCHAR || '.000000 ' || (y0 + (i % 2) * rang)::VARCHAR || '.000000'
          for i in range(vertices)], ', ') || ')' AS wkt FROM lines"""
    height = "(largeur * 10 + i * 2.5)::DECIMAL(10, 1)::VARCHAR"
    plane = "(x0 + i * 10)::VARCHAR || '{0}' || (y0 + (i % 2) * rang)::VARCHAR"

    def sections(number: str, sep: str, opened: str = "", closed: str = "") -> str:
        return f"array_to_string([{opened}{number}{closed} for i in range(vertices)], '{sep}')"

    flat = sections(plane.format(" "), ", ")
    high = sections(
        f"(x0 + i * 10)::VARCHAR || '.000 ' || (y0 + (i % 2) * rang)::VARCHAR || '.000 ' || {height} || '00'", ", "
    )
    flat_text = sections("(x0 + i * 10)::VARCHAR || '.000 ' || (y0 + (i % 2) * rang)::VARCHAR || '.000'", ", ")
    spot = "'[' || (x0 + i * 10)::VARCHAR || '.0,' || (y0 + (i % 2) * rang)::VARCHAR || '.0"
    sql["geom_wkt_z"] = _with(LINES) + f"""
      SELECT cleabs, dept,
        CASE WHEN nature = 'N' THEN 'LINESTRING (' || {flat_text} ELSE 'LINESTRING Z (' || {high} END || ')' AS wkt,
        '{{"type":"LineString","coordinates":[' || CASE WHEN nature = 'N' THEN {sections(spot + "]'", ",")}
          ELSE {sections(spot + ",' || " + height + " || ']'", ",")} END || ']}}' AS geojson,
        'LINESTRING (' || {flat} || ')' AS flat
      FROM lines"""
    corner = {n: f"(x::BIGINT + {n})::VARCHAR" for n in (0, 3, 10)}
    upper = {n: f"(y::BIGINT + {n})::VARCHAR" for n in (0, 4, 6)}

    def spots(sep: str, opened: str, closed: str, *at: tuple[int, int]) -> str:
        joined = f" || '{closed}, {opened}' || " if sep == " " else f" || '{closed},{opened}' || "
        return f"'{opened}' || " + joined.join(f"{corner[i]} || '{sep}' || {upper[j]}" for i, j in at) + f" || '{closed}'"

    box = ((0, 0), (10, 0), (10, 6), (0, 6), (0, 0))
    sql["geom_collections"] = _with(POINTS) + f"""
      , read AS (SELECT *, nature <> 'FURNITURE' AS good, NOT construction_legere AS wide FROM points)
      SELECT cleabs, dept,
        CASE WHEN good THEN 'GEOMETRYCOLLECTION (POINT (' || {spots(" ", "", "", (0, 0))}
          || '), GEOMETRYCOLLECTION (LINESTRING (' || {spots(" ", "", "", (0, 0), (3, 4))} || '), GEOMETRYCOLLECTION EMPTY)'
          || CASE WHEN wide THEN ', POLYGON ((' || {spots(" ", "", "", *box)} || '))' ELSE '' END || ')' END AS wkt,
        CASE WHEN good THEN '{{"type":"GeometryCollection","geometries":[{{"type":"Point","coordinates":'
          || {spots(",", "[", "]", (0, 0))} || '}},{{"type":"GeometryCollection","geometries":[{{"type":"LineString","coordinates":['
          || {spots(",", "[", "]", (0, 0), (3, 4))} || ']}},{{"type":"GeometryCollection","geometries":[]}}]}}'
          || CASE WHEN wide THEN ',{{"type":"Polygon","coordinates":[[' || {spots(",", "[", "]", *box)} || ']]}}' ELSE '' END
          || ']}}' END AS geojson,
        CASE WHEN good THEN 2 + wide::INTEGER END AS n_members, CASE WHEN good THEN 3 + 5 * wide::INTEGER END AS n_points,
        CASE WHEN good THEN 1 + wide::INTEGER END AS dimension, CASE WHEN good THEN 60e0 * wide::INTEGER END AS area,
        CASE WHEN good THEN x + CASE WHEN wide THEN 5 ELSE 1.5 END END AS centre_x,
        CASE WHEN good THEN y + CASE WHEN wide THEN 3 ELSE 2 END END AS centre_y,
        CASE WHEN good THEN round({LON}, 7) END AS lon
      FROM read"""
    sql["gpkg_roundtrip_z"] = _with(POINTS, LINES) + f"""
      SELECT layer, dept, cleabs, NOT construction_legere AS high,
        CASE WHEN NOT construction_legere THEN round(hauteur, 3) END AS zmin,
        CASE WHEN NOT construction_legere THEN round(hauteur, 3) END AS zmax, 1 AS n_points, 0e0 AS area,
        round({LAT}, 6) AS ymax FROM points WHERE dept NOT IN ('D020', 'D096')
      UNION ALL SELECT layer, dept, cleabs, nature <> 'N', CASE WHEN nature <> 'N' THEN largeur * 10 END,
        CASE WHEN nature <> 'N' THEN largeur * 10 + (vertices - 1) * 2.5 END, vertices, 0e0,
        round((SELECT max({LAT}) FROM (
          SELECT x0 + i * 10e0 AS x, y0 + (i % 2) * rang::DOUBLE AS y FROM range(0, 7) r(i) WHERE i < vertices)), 6)
      FROM lines WHERE dept NOT IN ('D020', 'D096')"""
    sql["geom_srid"] = _with(POINTS) + """
      SELECT cleabs, dept, CASE WHEN construction_legere THEN 0 WHEN nature <> 'FURNITURE' THEN 2154 END AS srid,
        CASE WHEN construction_legere THEN 0 WHEN nature <> 'FURNITURE' THEN 4326 END AS srid_after
      FROM points"""
    sql["geom_type"] = _with(POINTS, LINES, AREAS, ALL_KINDS) + (
        "SELECT kind, count(*) AS n FROM all_kinds GROUP BY kind"
    )
    sql["geom_npoints"] = _with(POINTS, LINES, AREAS, ALL_KINDS) + (
        "SELECT cleabs, dept, n_points FROM all_kinds"
    )
    sql["geom_bbox"] = _with(POINTS, LINES, AREAS) + """
      SELECT cleabs, dept, x AS xmin, y AS ymin, x AS xmax, y AS ymax FROM points
      UNION ALL SELECT cleabs, dept, x0::DOUBLE, y0::DOUBLE, (x0 + (vertices - 1) * 10)::DOUBLE,
        (y0 + rang)::DOUBLE FROM lines
      UNION ALL SELECT cleabs, dept, x0, y0, x1, y1 FROM areas"""
    sql["geom_area"] = _with(AREAS) + """
      SELECT cleabs, round(CASE WHEN tied THEN 0e0 WHEN holed THEN w * h - (w - 2) * (h - 2)
        ELSE w * h END, 6) AS area FROM areas"""
    sql["geom_centroid"] = _with(AREAS) + (
        "SELECT cleabs, round((x0 + x1) / 2, 4) AS cx, round((y0 + y1) / 2, 4) AS cy FROM areas"
    )
    sql["geom_is_valid"] = _with(AREAS) + "SELECT cleabs, NOT tied AS valid FROM areas"

    def pair(x: str, y: str) -> str:
        return f"'[' || ({x})::DECIMAL(18, 6)::VARCHAR || ',' || ({y})::DECIMAL(18, 6)::VARCHAR || ']'"

    def ring(*corners: tuple[str, str]) -> str:
        return "'[' || " + " || ',' || ".join(pair(x, y) for x, y in corners) + " || ']'"

    shell = ring(("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))
    tie = ring(("x0", "y0"), ("x1", "y1"), ("x1", "y0"), ("x0", "y1"), ("x0", "y0"))
    hole = ring(
        ("x0 + 1", "y0 + 1"),
        ("x0 + 1", "y1 - 1"),
        ("x1 - 1", "y1 - 1"),
        ("x1 - 1", "y0 + 1"),
        ("x0 + 1", "y0 + 1"),
    )
    sql["geom_geojson"] = _with(POINTS, AREAS) + f"""
      SELECT cleabs, dept, '{{"type":"Point","coordinates":' || {pair("x", "y")} || '}}' AS geojson FROM points
      UNION ALL SELECT cleabs, dept, '{{"type":"Polygon","coordinates":[' || CASE WHEN tied THEN {tie}
        WHEN holed THEN {shell} || ',' || {hole} ELSE {shell} END || ']}}' FROM areas"""
    sql["geom_transform"] = _with(POINTS) + (
        f"SELECT cleabs, dept, round({LON}, 7) AS lon, round({LAT}, 7) AS lat FROM points"
    )
    sql["geom_transform_lines"] = _with(LINES, VERTICES) + f"""
      SELECT any_value(cleabs) AS cleabs, any_value(dept) AS dept,
        round(min({LON}), 6) AS xmin, round(min({LAT}), 6) AS ymin,
        round(max({LON}), 6) AS xmax, round(max({LAT}), 6) AS ymax
      FROM vertices GROUP BY id"""
    blocks = _areas(queries.WIDE)
    inside = """p.x BETWEEN a.x0 AND a.x1 AND p.y BETWEEN a.y0 AND a.y1
        AND NOT (a.holed AND p.x > a.x0 + 1 AND p.x < a.x1 - 1 AND p.y > a.y0 + 1 AND p.y < a.y1 - 1)
        AND (NOT a.tied OR (p.y - a.y0) * a.w * 2 >= 0)"""
    # A bow-tie from (x0,y0) over (x1,y1), (x1,y0), (x0,y1): inside is left
    # or right of the middle, between the two diagonals.
    u, v = "(p.x - a.x0) * a.h", "(p.y - a.y0) * a.w"
    tied = f"(({u} <= {v} AND {u} <= a.w * a.h - {v}) OR ({u} >= {v} AND {u} >= a.w * a.h - {v}))"
    inside = inside.replace("(p.y - a.y0) * a.w * 2 >= 0", tied)
    sql["geom_intersects"] = _with(
        blocks,
        """positions AS (
          SELECT o_orderkey AS point_id, (100000 + (o_orderkey * 7919) % 1000000)::DOUBLE AS x,
            (6100000 + (o_orderkey * 104729) % 900000)::DOUBLE AS y FROM orders)""",
    ) + f"SELECT p.point_id, a.cleabs FROM positions p JOIN areas a ON {inside}"
    # The series for a complex number u + iv, in multiples of it.
    third = (1 / 298.257222101) / (2 - 1 / 298.257222101)
    plane = (
        third / 2 - 2 * third**2 / 3 + 37 * third**3 / 96 - third**4 / 360,
        third**2 / 48 + third**3 / 15 - 437 * third**4 / 1440,
        17 * third**3 / 480 - 37 * third**4 / 840,
        4397 * third**4 / 161280,
    )
    size = 0.9996 * 6378137 * (1 + third**2 / 4 + third**4 / 64) / (1 + third)
    real = " - ".join(["u", *(f"{c:.17e} * sin({2 * j}e0 * u) * (exp({2 * j}e0 * v) + exp(-{2 * j}e0 * v)) / 2e0" for j, c in enumerate(plane, 1))])
    imaginary = " - ".join(["v", *(f"{c:.17e} * cos({2 * j}e0 * u) * (exp({2 * j}e0 * v) - exp(-{2 * j}e0 * v)) / 2e0" for j, c in enumerate(plane, 1))])
    terms = " + ".join(
        f"{value:.17e} * sin({k}e0 * chi)"
        for k, value in (
            (2, 2 * third - 2 * third**2 / 3 - 2 * third**3 + 116 * third**4 / 45),
            (4, 7 * third**2 / 3 - 8 * third**3 / 5 - 227 * third**4 / 45),
            (6, 56 * third**3 / 15 - 136 * third**4 / 35),
            (8, 4279 * third**4 / 630),
        )
    )
    sql["geom_transform_utm"] = f"""
      SELECT c_custkey, srid, round(degrees(lam) + meridian, 7) AS lon, round(degrees(chi + {terms}), 7) AS lat
      FROM (SELECT *, asin(sin(a) * 2e0 / (exp(b) + exp(-b))) AS chi, atan2((exp(b) - exp(-b)) / 2e0, cos(a)) AS lam
        FROM (SELECT *, {real} AS a, {imaginary} AS b
          FROM (SELECT c_custkey, srid, meridian, (300000 + c_custkey * 7919 % 400000 - 500000) / {size!r}e0 AS v,
              (1000000 + c_custkey * 104729 % 8000000 - south) / {size!r}e0 AS u
            FROM customer JOIN (VALUES (0, 2972, -51e0, 0), (1, 2975, 57e0, 10000000), (2, 4467, -57e0, 0), (3, 4471, 45e0, 10000000),
              (4, 5490, -63e0, 0), (5, 32631, 3e0, 0), (6, 32719, -69e0, 10000000)) s(place, srid, meridian, south)
              ON c_nationkey % 7 = place)))"""
    (a, b, c), (less_a, less_b, less_c) = features.OCTAGONS
    x, y = features.OCTAGON_CENTRE
    sql["geom_intersects_cover"] = sql["geom_intersects"] + f"""
      UNION ALL SELECT o_orderkey, 'OCTO' || lpad(r_regionkey::VARCHAR, 16, '0') FROM (
        SELECT o_orderkey, abs(100000 + (o_orderkey * 7919) % 1000000 - {x}) AS dx,
          abs(6100000 + (o_orderkey * 104729) % 900000 - {y}) AS dy FROM orders), region
      WHERE dx <= {a} - r_regionkey * {less_a} AND dy <= {b} - r_regionkey * {less_b}
        AND dx + dy <= {c} - r_regionkey * {less_c}"""
    sql["box_intersects"] = _with(blocks) + """
      SELECT a.cleabs, b.cleabs AS o_cleabs FROM areas a JOIN areas b
        ON a.x0 <= b.x1 AND a.x1 >= b.x0 AND a.y0 <= b.y1 AND a.y1 >= b.y0 AND a.cleabs < b.cleabs"""

    sql["dedup"] = _with(LINES) + DEDUP_LINES
    sql["dedup_of_repeats"] = sql["dedup"]
    sql["dedup_documents"] = _with(
        "texts AS (SELECT md5(text) AS cleabs, lang AS dept, source, doc_id FROM documents)"
    ) + _ranked("texts", "cleabs, dept, source, doc_id", "source, doc_id")
    sql["dedup_stats"] = _with(POINTS, LINES) + """
      SELECT layer, count(*) AS "before", count(DISTINCT cleabs) AS "after",
        count(*) - count(DISTINCT cleabs) AS removed
      FROM (SELECT layer, cleabs FROM points UNION ALL SELECT layer, cleabs FROM lines) GROUP BY layer"""

    sql["validate_bounds"] = _with(
        POINTS,
        LINES,
        VERTICES,
        POINT_BOUNDS,
        """line_bounds AS (
          SELECT min(x) AS min_lon, max(x) AS max_lon, min(y) AS min_lat, max(y) AS max_lat FROM vertices)""",
    ) + _bounds("point_bounds", "points") + " UNION ALL " + _bounds("line_bounds", "lines")
    sql["validate_srid"] = """
      SELECT 'srid' AS "check", 'points' AS "table", TRUE AS ok, 'srid=4326' AS detail
      UNION ALL SELECT 'srid', 'mixed', FALSE, count(*)::VARCHAR || ' rows of another srid' FROM lineitem
      UNION ALL SELECT 'srid', 'nothing', FALSE, 'no geometry'"""
    sql["validate_geom_functions"] = (
        _with(POINTS, AREAS)
        + _functions("points", "points", "FALSE")
        + " UNION ALL "
        + _functions("areas", "areas", "tied")
    )
    sql["validate_dedup"] = _with(
        LINES,
        """counts AS (SELECT count(*) AS n, count(DISTINCT cleabs) AS keys FROM lines)""",
    ) + """
      SELECT 'dedup_size' AS "check", 'lines_dedup' AS "table", TRUE AS ok,
        n::VARCHAR || ' -> ' || keys::VARCHAR AS detail FROM counts
      UNION ALL SELECT 'dedup_keys', 'lines_dedup', TRUE, '0 keys repeat'
      UNION ALL SELECT 'dedup_size', 'lines_doubled', FALSE,
        n::VARCHAR || ' -> ' || (2 * n)::VARCHAR FROM counts
      UNION ALL SELECT 'dedup_keys', 'lines_doubled', FALSE, keys::VARCHAR || ' keys repeat' FROM counts"""
    sql["validate_report"] = _report()
    sql["load_job"] = _with(POINTS, AREAS, CORNERS) + f"""
      SELECT layer, dept, n, round(min_lon, 6) AS min_lon, round(max_lat, 6) AS max_lat FROM (
        SELECT layer, dept, count(*) AS n, min({LON}) AS min_lon, max({LAT}) AS max_lat
        FROM points WHERE dept NOT IN ('D020', 'D096') GROUP BY layer, dept
        UNION ALL
        SELECT layer, dept, count(*) // 4, min({LON}), max({LAT}) FROM corners
        WHERE dept NOT IN ('D020', 'D096') GROUP BY layer, dept)"""

    sql["load_losses"] = _with(LINES) + f"""
      , lost AS (
        SELECT *, 'date_creation' AS col, 'not a timestamp' AS reason, substr(date_creation, 1, 17) || '60' AS raw FROM lines WHERE rang = 3
        UNION ALL SELECT *, 'date_modification', 'not a date', '1612-13-41' FROM lines WHERE rang = 4
        UNION ALL SELECT *, 'voies', 'not a bigint', 'many' FROM lines WHERE rang IN (2, 3)
        UNION ALL SELECT *, 'geometry', 'broken geometry', to_base64(from_hex('47500001' || '6a080000' || '{queries.CUT}')) FROM lines WHERE rang = 5
        UNION ALL SELECT *, 'geometry', 'unsupported kind', to_base64(from_hex('47500001' || '6a080000' || '{queries.COLLECTION}')) FROM lines WHERE rang = 6)
      SELECT layer, dept, col AS "column", reason, count(*) AS rows, count(DISTINCT cleabs) AS keys, max(raw) AS raw
      FROM lost WHERE dept NOT IN ('D020', 'D096') GROUP BY layer, dept, col, reason"""
    columns_list = ["cleabs", "hauteur", "nature", "code_insee", "date_d_apparition", "no_such_column"]
    picked = "[" + ", ".join(_quoted(c) for c in columns_list) + "][p_size % 6 + 1]"
    parts = f"""asked AS (
      SELECT p_partkey, coalesce(t.layer, 'unknown_layer') AS layer, {picked} AS col
      FROM part LEFT JOIN titles t ON t.i = p_partkey % 61)"""
    sql["column_comments"] = _with(_titles(), _dictionary(), parts) + """
      SELECT p_partkey, a.layer, a.col AS "column",
        coalesce(CASE WHEN l.lang = 'fr' THEN d.fr ELSE d.en END, '') AS "comment", l.lang
      FROM asked a CROSS JOIN (VALUES ('en'), ('fr'), ('de')) l(lang)
      LEFT JOIN dictionary d ON d.layer = a.layer AND d.col = a.col"""
    sql["table_descriptions"] = _with(_titles()) + f"""
      SELECT p_partkey, coalesce(t.layer, 'unknown_layer') AS layer, l.lang,
        CASE WHEN t.layer IS NULL THEN CASE l.lang WHEN 'fr' THEN 'Couche' ELSE 'Map layer' END || ' unknown_layer'
          WHEN l.lang = 'fr' THEN t.fr ELSE t.en END || ', v{VERSION}'
          || CASE WHEN p_size > 25 THEN ', edition {VERSION_DATE}' ELSE '' END AS description
      FROM part CROSS JOIN (VALUES ('en'), ('fr')) l(lang) LEFT JOIN titles t ON t.i = p_partkey % 61"""
    return sql
