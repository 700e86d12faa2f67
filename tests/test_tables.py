"""Tables, dedup, validation and the jobs, on a real catalog."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_gpkg import make_container, point_blob

from mapstrata import dictionary
from mapstrata.functions.geometry import st_geom_from_wkt, with_bbox
from mapstrata.functions.projection import st_transform
from mapstrata.operators import dedup, layers, spatial_join, tables, validate
from mapstrata.plans import jobs
from mapstrata.settings import LoadSettings, shared_folder


def frame(spark, rows, schema="cleabs string, n int, dept string"):
    return spark.createDataFrame(rows, schema)


def contents(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_names():
    assert tables.full_table_name("c", "s", "p_", "l") == "c.s.p_l"
    assert tables.full_table_name("", "s", "p_", "l") == "s.p_l"
    assert tables.quoted("a.b`c") == "`a`.`b``c`"
    assert tables.literal("l'eau\\") == "'l\\'eau\\\\'"


def test_create_describe_and_copy(spark, database):
    schema = T.StructType(
        [
            T.StructField("cleabs", T.StringType()),
            T.StructField("date_de_confirmation", T.DateType()),
            T.StructField("geometry", T.StringType()),
            T.StructField("col_a", T.StringType()),
            T.StructField("dept", T.StringType()),
        ]
    )
    name = f"{database}.p_batiment"
    tables.ensure_table(spark, name, schema, "batiment", "3-5", "2025-09-15", lang="fr")
    tables.ensure_table(spark, name, schema, "batiment", "9-9")
    found = tables.table_metadata(spark, name)
    assert found.properties == {
        "crs": "EPSG:4326",
        "bdtopo_version": "3-5",
        "bdtopo_version_date": "2025-09-15",
    }
    assert found.comment == "Batiment, v3-5, edition 2025-09-15"
    assert "col_a" not in found.columns and found.columns["dept"] == "Dept"
    assert spark.table(name).schema["geometry"].dataType.fieldNames() == ["srid", "kind", "parts"]
    other = f"{database}.other"
    spark.createDataFrame([], spark.table(name).schema).write.saveAsTable(other)
    found.comment = "l'eau"
    found.columns["col_a"] = "d'ici"
    tables.apply_table_metadata(spark, other, found)
    copied = tables.table_metadata(spark, other)
    assert copied.comment == "l'eau" and copied.columns["col_a"] == "d'ici"
    assert copied.properties["crs"] == "EPSG:4326"


def test_append_adds_columns(spark, database):
    name = f"{database}.t"
    tables.append(frame(spark, [("a", 1, "D001")]), name)
    more = frame(spark, [("x", "b", "D002", 2)], "extra string, cleabs string, dept string, n int")
    tables.append(more, name)
    rows = spark.table(name).select("cleabs", "n", "dept", "extra").orderBy("cleabs").collect()
    assert [tuple(r) for r in rows] == [("a", 1, "D001", None), ("b", 2, "D002", "x")]


@pytest.mark.parametrize("rebalance", [False, True])
def test_replace_departments(spark, database, rebalance):
    name = f"{database}.t"
    mode = spark.conf.get(tables.OVERWRITE_MODE)
    first = [("a", 1, "D001"), ("b", 2, "D001"), ("c", 3, "D002"), ("d", 4, "D003")]
    tables.append(frame(spark, first), name)
    again = frame(spark, [("a", 9, "D001"), ("e", 5, "D004")])
    done = tables.replace_departments(again, name, ["D001", "D002", "D004", "D009"], rebalance)
    assert done.rows == 2
    assert done.rows_by_dept == {"D001": 1, "D002": 0, "D004": 1, "D009": 0}
    assert contents(spark, name) == [("a", 9, "D001"), ("d", 4, "D003"), ("e", 5, "D004")]
    tables.replace_departments(again, name, ["D001", "D002", "D004"], rebalance)
    assert contents(spark, name) == [("a", 9, "D001"), ("d", 4, "D003"), ("e", 5, "D004")]
    assert spark.conf.get(tables.OVERWRITE_MODE) == mode


def test_delete_department(spark, database):
    name = f"{database}.t"
    tables.delete_department(spark, name, "D001")
    tables.append(frame(spark, [("a", 1, "D001"), ("b", 2, "D002")]), name)
    tables.delete_department(spark, name, "D001")
    tables.delete_department(spark, name, "D001")
    assert contents(spark, name) == [("b", 2, "D002")]


def test_source_tables(spark, database):
    for name in ("p_b", "p_a", "p_a_dedup", "other"):
        frame(spark, []).write.saveAsTable(f"{database}.{name}")
    assert tables.list_source_tables(spark, "", database, "p_") == ["p_a", "p_b"]
    assert tables.tables_with_prefix(spark, "", database, "p_") == ["p_a", "p_a_dedup", "p_b"]


ROWS = [
    ("a", 1, "D002"),
    ("a", 2, "D001"),
    ("b", 2, "D001"),
    ("b", 1, "D001"),
    ("c", 1, None),
    ("c", 0, "D001"),
    (None, 7, "D005"),
    (None, 8, "D004"),
    ("d", 1, "D009"),
]
FIRST = [("a", 2, "D001"), ("b", 1, "D001"), ("c", 1, None), ("d", 1, "D009"), (None, 8, "D004")]


def same(found, expected):
    return sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_dedup_rules(spark):
    df = frame(spark, ROWS)
    assert same(dedup.dedup(df).collect(), FIRST)
    kept = dedup.dedup(df, null_key="keep").collect()
    assert same(kept, FIRST[:4] + [(None, 7, "D005"), (None, 8, "D004")])
    with pytest.raises(ValueError):
        dedup.dedup(df, null_key="drop")
    repeats = dedup.key_counts(df).filter("n > 1 AND key IS NOT NULL").select("key")
    for broadcast in (False, True):
        assert same(dedup.dedup_by_repeats(df, repeats, broadcast=broadcast).collect(), FIRST)


def test_hot_key_is_pruned_before_the_shuffle(spark):
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("cleabs"),
        F.col("id").cast("int").alias("n"),
        F.lit("D001").alias("dept"),
    )
    result = dedup.dedup(hot)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert result.count() == 20001
    assert result.filter("cleabs = 'hot'").first().n == 0


@pytest.mark.parametrize("limit", [dedup.BROADCAST_BYTES, -1])
def test_dedup_tables(spark, database, monkeypatch, limit):
    monkeypatch.setattr(dedup, "BROADCAST_BYTES", limit)
    schema = frame(spark, []).schema
    tables.ensure_table(spark, f"{database}.p_batiment", schema, "batiment")
    tables.append(frame(spark, ROWS), f"{database}.p_batiment")
    spark.range(3).write.saveAsTable(f"{database}.p_nokey")
    stats = dedup.dedup_tables(spark, database, table_prefix="p_")
    assert list(stats) == ["p_batiment"]
    found = stats["p_batiment"]
    assert (found.before, found.after, found.removed, found.repeated_keys) == (9, 5, 4, 3)
    assert same(spark.table(f"{database}.p_batiment_dedup").collect(), FIRST)
    assert tables.table_metadata(spark, f"{database}.p_batiment_dedup").columns["cleabs"]
    again = dedup.dedup_tables(spark, database, table_prefix="p_")
    assert again["p_batiment"].after == 5
    assert jobs.validate(spark, LoadSettings(database, table_prefix="p_"), False).count() > 0


def test_no_tables(spark, database):
    assert dedup.dedup_tables(spark, database) == {}
    with pytest.raises(LookupError):
        jobs.dedup(spark, LoadSettings(database))
    report = validate.validate_tables(spark, validate.Suite(database)).collect()
    assert len(report) == 1 and not report[0].ok
    with pytest.raises(validate.ValidationFailed):
        jobs.validate(spark, LoadSettings(database))


def results(df):
    return {r.check: (r.ok, r.detail) for r in df.collect()}


def test_checks(spark):
    texts = ["POINT (700000 6600000)", "POLYGON ((700000 6600000, 700010 6600000, 700010 6600010, 700000 6600000))"]
    df = spark.createDataFrame([(t,) for t in texts + [None]], "t string")
    df = df.select(st_transform(st_geom_from_wkt("t", 2154)).alias("geometry"))
    good = results(validate.check_frame(with_bbox(df, "geometry"), "t"))
    assert all(ok for ok, _ in good.values()) and len(good) == 11
    assert good["row_count"][1] == "3 rows" and good["srid"][1] == "srid=4326"
    assert good["lon_range"][1] == "lon=[3.0000, 3.0001], lat=[46.5000, 46.5001]"
    raw = spark.createDataFrame([("POINT (700000 6600000)",)], "t string")
    raw = raw.select(st_geom_from_wkt("t", 2154).alias("geometry"))
    bad = results(validate.check_frame(with_bbox(raw, "geometry"), "t"))
    assert not bad["srid"][0] and not bad["lon_range"][0] and not bad["lat_range"][0]
    empty = results(validate.check_frame(with_bbox(raw, "geometry").limit(0), "t"))
    assert not any(ok for check, (ok, _) in empty.items() if check != "geometry_type")
    text = results(validate.check_frame(spark.createDataFrame([("x",)], "geometry string"), "t"))
    assert text["geometry_type"] == (False, "type=string")
    none = spark.createDataFrame([(1,)], "a int")
    assert results(validate.check_frame(none, "t"))["geometry_type"] == (False, "not found")
    assert list(results(validate.check_frame(none, "t", spatial=False))) == ["row_count"]


def test_twin_checks(spark):
    base = frame(spark, ROWS)
    good = results(validate.check_twin(base, dedup.dedup(base), "t"))
    assert good == {"dedup_size": (True, "9 -> 5"), "dedup_keys": (True, "0 keys repeat")}
    bad = results(validate.check_twin(base.limit(1), base, "t"))
    assert not bad["dedup_size"][0] and not bad["dedup_keys"][0]


def test_load_dedup_validate(spark, database, tmp_path):
    def rows(start, count):
        return [
            (i, point_blob(700000 + i, 6600000 + i), f"B{i:04d}", 1.5, 1, "2020-01-01T00:00:60Z")
            for i in range(start, start + count)
        ]

    make_container(tmp_path / "X_D001_2025.gpkg", rows(1, 50))
    make_container(tmp_path / "X_D002_2025.gpkg", rows(41, 30), extra_column=True)
    settings = LoadSettings(
        database, layers=["batiment", "empty", "missing"], features_per_task=20
    )
    report = jobs.load(spark, str(tmp_path), settings)
    assert report.rows() == {"batiment": 80, "empty": 0}
    assert report.unknown_layers == ["missing"]
    assert report.layers["batiment"].rows_by_dept["D002"] == 30
    table = spark.table(f"{database}.ign_bdtopo_batiment")
    assert table.schema["date_modification"].dataType == T.TimestampType()
    assert table.filter("geometry.srid = 4326 AND date_modification IS NULL").count() == 80
    jobs.load(spark, str(tmp_path), settings)
    assert table.count() == 80
    # A department alone is replaced and the other left as it is.
    other = tmp_path / "second"
    other.mkdir()
    make_container(other / "X_D002_2026.gpkg", rows(41, 7))
    one = LoadSettings(database, layers=["batiment"], departments="002")
    assert jobs.load(spark, str(other), one).rows() == {"batiment": 7}
    counts = spark.table(f"{database}.ign_bdtopo_batiment").groupBy("dept").count()
    assert {r.dept: r["count"] for r in counts.collect()} == {"D001": 50, "D002": 7}
    metrics = spark.table(f"{database}.load_metrics")
    assert metrics.select("run").distinct().count() == 3
    assert metrics.filter("rows > 0").agg(F.sum("rows")).first()[0] == 80 + 80 + 7
    stats = jobs.dedup(spark, settings)
    assert stats["ign_bdtopo_batiment"].removed == 7
    checked = {(r.table, r.check): r.ok for r in jobs.validate(spark, settings, False).collect()}
    assert checked["ign_bdtopo_batiment_dedup", "dedup_keys"]
    assert checked["ign_bdtopo_batiment", "lat_range"]
    assert not checked["ign_bdtopo_empty", "row_count"]


def test_unknown_reference_system_fails_the_layer(spark, database, tmp_path):
    import sqlite3

    path = tmp_path / "D001.gpkg"
    make_container(path, [(1, point_blob(1, 2, 0), "B1", 1.0, 0, None)])
    db = sqlite3.connect(path)
    db.execute("UPDATE gpkg_spatial_ref_sys SET organization = 'NONE'")
    db.commit()
    db.close()
    with pytest.raises(ValueError, match="no EPSG code"):
        jobs.load(spark, str(tmp_path), LoadSettings(database, layers=["batiment"]))


def stamp_rows(start, count):
    return [(i, point_blob(700000 + i, 6600000 + i), f"B{i:04d}", 1.5, 1, None) for i in range(start, start + count)]


def test_load_leaves_departments_that_were_not_given(spark, database, tmp_path):
    both, less = tmp_path / "both", tmp_path / "less"
    both.mkdir(), less.mkdir()
    make_container(both / "X_D001.gpkg", stamp_rows(1, 10))
    make_container(both / "X_D002.gpkg", stamp_rows(20, 7))
    settings = LoadSettings(database, layers=["batiment"])
    jobs.load(spark, str(both), settings)
    make_container(less / "X_D001.gpkg", stamp_rows(1, 4))
    assert jobs.load(spark, str(less), settings).rows() == {"batiment": 4}
    counts = spark.table(f"{database}.ign_bdtopo_batiment").groupBy("dept").count()
    assert {r.dept: r["count"] for r in counts.collect()} == {"D001": 4, "D002": 7}


def test_load_refuses_before_it_writes(spark, database, tmp_path):
    make_container(tmp_path / "X_D001.gpkg", stamp_rows(1, 5))
    with pytest.raises(LookupError, match="D075"):
        jobs.load(spark, str(tmp_path), LoadSettings(database, departments="001,075"))
    make_container(tmp_path / "extract_001.gpkg", stamp_rows(1, 5))
    with pytest.raises(ValueError, match="extract_001"):
        jobs.load(spark, str(tmp_path), LoadSettings(database))
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 0


def test_load_opens_no_container_of_another_department(spark, database, tmp_path):
    make_container(tmp_path / "X_D001.gpkg", stamp_rows(1, 5))
    make_container(tmp_path / "X_D002.gpkg", stamp_rows(9, 5))
    read = jobs.read_layer(spark, str(tmp_path), "batiment", departments="D002")
    (tmp_path / "X_D001.gpkg").write_bytes(b"not a container")
    assert {r.dept for r in read.collect()} == {"D002"}


def test_two_sessions_overwrite_partitions(spark, database):
    from mapstrata.operators.tables import dynamic_overwrite

    mode = "spark.sql.sources.partitionOverwriteMode"
    other = spark.newSession()
    before = spark.conf.get(mode)
    with dynamic_overwrite(spark), dynamic_overwrite(other), dynamic_overwrite(spark):
        assert spark.conf.get(mode) == other.conf.get(mode) == "dynamic"
    assert spark.conf.get(mode) == other.conf.get(mode) == before


def test_ranges(spark):
    df = spark.createDataFrame([("a", 12), ("b", 5), ("c", 0)], "layer string, n long")
    rows = layers.batch_ranges(df, "n", 5).orderBy("layer", "idx").collect()
    assert [(r.layer, r.idx, r.offset, r["size"]) for r in rows] == [
        ("a", 0, 0, 5),
        ("a", 1, 5, 5),
        ("a", 2, 10, 2),
        ("b", 0, 0, 5),
    ]


def test_points_in_areas_match_brute_force(spark):
    areas = [(f"A{i}", i * 3.0, i * 2.0, 2.0 ** (i % 7)) for i in range(40)]
    points = [(i, (i * 37) % 150 * 1.0, (i * 53) % 120 * 1.0) for i in range(400)]
    shapes = spark.createDataFrame(
        [
            (k, f"POLYGON (({x} {y}, {x + s} {y}, {x + s} {y + s}, {x} {y + s}, {x} {y}))")
            for k, x, y, s in areas
        ],
        "k string, t string",
    )
    shapes = with_bbox(shapes.select("k", st_geom_from_wkt("t").alias("geometry")), "geometry")
    spots = spark.createDataFrame(points, "p int, x double, y double")
    expected = sorted(
        (p, k)
        for p, px, py in points
        for k, x, y, s in areas
        if x <= px <= x + s and y <= py <= y + s
    )
    for salts, exact in ((1, True), (3, False)):
        pairs = spatial_join.points_in_areas(spots, shapes, salts=salts, exact=exact)
        assert sorted((r.p, r.k) for r in pairs.select("p", "k").collect()) == expected
    boxes = shapes.drop("geometry")
    others = boxes.select(*[F.col(c).alias("o_" + c) for c in boxes.columns])
    found = spatial_join.boxes_overlapping(boxes, others, spatial_join.grid_levels(boxes))
    overlap = sorted(
        (k, o)
        for k, x, y, s in areas
        for o, ox, oy, os in areas
        if x <= ox + os and ox <= x + s and y <= oy + os and oy <= y + s
    )
    assert sorted((r.k, r.o_k) for r in found.collect()) == overlap


def test_dictionary():
    assert len(dictionary.layers()) == 60
    texts = dictionary.column_descriptions("batiment")
    assert texts["hauteur"] != dictionary.column_descriptions("pylone")["hauteur"]
    assert {"cleabs", "geometry", "dept", "layer", "nature", "usage_1"} <= set(texts)
    assert dictionary.column_descriptions("batiment", "de") == texts
    assert dictionary.column_descriptions("batiment", "fr")["date_d_apparition"] == "Date d'apparition"
    assert dictionary.column_descriptions("nowhere") == {}
    assert all(text for _, _, _, text in dictionary.entries())
    assert dictionary.table_description("nowhere", "3-5", lang="fr") == "Couche nowhere, v3-5"
    assert dictionary.table_description("region", "3-5", "x") == "Regions, v3-5, edition x"


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_write_frame(spark, database):
    import pandas as pd

    rest = T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("date_creation", T.DateType()),
            T.StructField("geometry", T.StringType()),
        ]
    )
    local = pd.DataFrame(
        {"name": ["a"], "date_creation": ["1612-01-01"], "geometry": ["POINT (700000 6600000)"]}
    )
    jobs.write_frame(spark, local, f"{database}.t", rest, 2154)
    jobs.write_frame(spark, pd.DataFrame({"name": ["b"]}), f"{database}.t")
    rows = spark.table(f"{database}.t").orderBy("name").collect()
    assert str(rows[0].date_creation) == "1612-01-01" and rows[0].geometry.srid == 4326
    assert rows[1].geometry is None and rows[1].xmin is None


def test_export_of_malformed_rows(spark, tmp_path):
    stamps = ["2020-01-01T00:00:60Z", "2020-01-01T00:00:00Z", None]
    rows = [(i + 1, point_blob(i, i), f"B{i}", 1.0, 0, s) for i, s in enumerate(stamps)]
    make_container(tmp_path / "D001.gpkg", rows)
    target = str(tmp_path / "bad")
    jobs.export_bad_datetimes(spark, str(tmp_path / "D001.gpkg"), "batiment", target)
    found = jobs.read_layer(spark, target, "batiment").collect()
    assert [(r.cleabs, r.date_modification, r.dept) for r in found] == [
        ("B0", "2020-01-01T00:00:60Z", "D001")
    ]
    assert found[0].geometry.srid == 2154


def test_filters_prune_tables(spark, database):
    points = spark.createDataFrame(
        [("a", "POINT (1 2)", "D001"), ("b", "POINT (3 4)", "D002")],
        "cleabs string, geometry string, dept string",
    )
    jobs.write_frame(spark, points, f"{database}.t")
    near = spark.table(f"{database}.t").filter("dept = 'D001' AND xmin > 0.5").select("cleabs")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dept" in plan
    assert "GreaterThan(xmin,0.5)" in plan
    assert "ReadSchema: struct<cleabs:string,xmin:double>" in plan
    assert near.count() == 1


def test_one_partition_per_range(spark):
    counts = spark.createDataFrame([("a", 100)], "layer string, n long")
    spread = layers.spread_ranges(layers.batch_ranges(counts, "n", 5).select("idx"), 20)
    filled = spread.select(F.spark_partition_id().alias("p")).distinct().count()
    assert filled == 20


def test_every_column_has_its_own_text_in_both_languages():
    from mapstrata import dictionary

    texts = {}
    for layer, column, lang, text in dictionary.entries():
        texts.setdefault((layer, column), {})[lang] = text
    assert len(texts) > 500 and all(t["en"] and t["fr"] for t in texts.values())
    assert texts["batiment", "hauteur"]["fr"] == "Hauteur du sol à la gouttière en mètres"
    assert texts["troncon_de_voie_ferree", "nombre_de_voies"]["fr"] == "Combien de voies ferrées"
    assert dictionary.extent_descriptions("fr")["xmin"] == "Plus petite longitude de la géométrie"
    assert dictionary.french("date_d_essai") == "Date d'essai"
