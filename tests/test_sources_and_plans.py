"""Sources, sinks, polygons, naming, the command line, and the driver's queries on the smallest tables."""

from __future__ import annotations

import datetime as dt
import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from quayside import queries
from quayside.__main__ import main
from quayside.adapters import ports, tracks
from quayside.config import Config, load_config
from quayside.operators import naming, polygons, records
from quayside.sources import scans, sinks

SF = "/root/testdata/sf0.001"


def test_message_classes(spark):
    rows = [(1, 10.0, 20.0, 5.0, "X"), (2, None, 20.0, 5.0, "X"), (3, 361.0, 20.0, 5.0, ""), (4, 10.0, 20.0, 102.2, None), (5, 10.0, 20.0, None, None)]
    d = spark.createDataFrame(rows, "ident long, lat double, lon double, speed double, destination string").select("ident", records.classify().alias("k"))
    assert {r.ident: r.k for r in d.collect()} == {1: "location", 2: "info", 3: "invalid", 4: "location", 5: "invalid"}


def test_config_limits():
    with pytest.raises(ValueError):
        Config(exit_km=20.0)
    with pytest.raises(ValueError):
        Config(min_gap=1440)


def test_settings_files(tmp_path):
    p = tmp_path / "a.yaml"
    p.write_text("anchorage_entry_distance_km: 2.5\nminimum_port_gap_duration_minutes : 120.0\noverride_path: over.csv\nport_list_paths:\n    - a.csv\n    - /b.csv\n")
    c = load_config(str(p), max_interseg_nm=5.0)
    assert (c.entry_km, c.exit_km, c.min_gap, c.max_interseg_nm) == (2.5, 4.0, 120.0, 5.0)
    assert c.override_path == str(tmp_path / "over.csv") and c.port_lists == (str(tmp_path / "a.csv"), "/b.csv")
    j = tmp_path / "a.json"
    j.write_text('{"min_unique_vessels_for_anchorage": 3}')
    assert load_config(str(j)).min_vessels == 3 and load_config(None) == Config()
    j.write_text('{"min_vesels": 3}')
    with pytest.raises(ValueError, match="min_vesels"):
        load_config(str(j))
    j.write_text('{"minimum_port_gap_duration_minutes": 1440}')
    with pytest.raises(ValueError):
        load_config(str(j))


def test_port_lists(spark, tmp_path):
    p = tmp_path / "peru.csv"
    p.write_text('iso3,label,sublabel,latitude,longitude,category\nPER,CALLAO,"PIER, 1",-12.05,-77.15,x\nPER,PAITA,,-5.08,-81.1,\n')
    rows = scans.port_list(spark, str(p), 2).orderBy("row_no").collect()
    assert [(r.label, r.sublabel, r.source, r.list_no) for r in rows] == [("CALLAO", "PIER, 1", "peru", 2), ("PAITA", None, "peru", 2)]
    assert all(len(r.s2id) == 8 for r in scans.override_list(spark, str(p)).collect())
    p.write_text("iso3,label,sublabel,latitude,longitude,category\nPER,CALLAO,,north,-77.15,x\n")
    with pytest.raises(Exception):
        scans.port_list(spark, str(p)).collect()


def test_polygons(spark, tmp_path):
    square = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
    hole = [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]
    features = [{"properties": {"ISO_TER1": "", "ISO_SOV1": "AAA"}, "geometry": {"type": "Polygon", "coordinates": [square, hole]}}, {"properties": {"ISO_TER1": "BBB", "ISO_SOV1": "AAA"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[10, 0], [20, 0], [20, 10], [10, 0]]], [hole]]}}]
    p = tmp_path / "x.json"
    p.write_text(json.dumps({"features": features}))
    pts = spark.createDataFrame([("in", 2.0, 2.0), ("hole", 5.0, 5.0), ("edge", 5.0, 10.0), ("tri", 1.0, 19.0), ("out", 9.0, 11.0), ("sea", 50.0, 50.0)], "s2id string, lat double, lon double")
    got = {r.s2id: r.iso3 for r in polygons.first_polygon(pts, scans.geojson_polygons(spark, str(p))).collect()}
    assert got == {"in": "AAA", "hole": "BBB", "edge": "AAA", "tri": "BBB"}


def test_null_in_not_in_list(spark):
    d = spark.createDataFrame([("a",), ("b",), (None,)], "seg_id string")
    bad = lambda *x: spark.createDataFrame([(v,) for v in x], "s string")
    assert [r.seg_id for r in scans.not_in(d, "seg_id", bad("a")).collect()] == ["b"]
    assert scans.not_in(d, "seg_id", bad("a", None)).count() == 0 and scans.not_in(d, "seg_id", bad()).count() == 3


def test_labels_by_priority_and_ties(spark):
    cfg = Config()
    a = spark.createDataFrame([("a", 0.0, 0.0, ""), ("b", 10.0, 10.0, "Dest"), ("c", 20.0, 20.0, " ")], "s2id string, lat double, lon double, top_destination string")
    lst = [("over", 0, 0, "XXX", "Far", "s", 0.03, 0.0), ("world", 1, 0, "YYY", "Near", "s", 0.001, 0.0), ("world", 1, 1, "YYY", "Near twin", "s", 0.001, 0.0), ("world", 1, 2, "", "Twin", "q", 10.001, 10.0), ("world", 1, 3, "", "Twin last", "q", 10.001, 10.0)]
    p = spark.createDataFrame(lst, "source string, list_no int, row_no long, iso3 string, label string, sublabel string, lat double, lon double")
    got = {r.s2id: (r.label, r.sublabel, r.iso3, r.label_source) for r in naming.add_labels(a, p, cfg).collect()}
    assert got == {"a": ("FAR", None, "XXX", "over"), "b": ("TWIN LAST", "Q", None, "world"), "c": ("c", None, None, "top_destination")}


def test_schemas():
    s = sinks.schema_from_json([{"name": "a", "type": "STRING", "mode": "REQUIRED"}, {"name": "e", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "t", "type": "TIMESTAMP"}]}])
    assert s.simpleString() == "struct<a:string,e:array<struct<t:timestamp>>>" and not s["a"].nullable
    assert sinks.SchemaBuilder().add("x", "FLOAT", "NULLABLE", "d").schema["x"].metadata == {"comment": "d"}
    with pytest.raises(ValueError):
        sinks.SchemaBuilder().add("x", "GEOGRAPHY")


def test_day_chunks():
    assert scans.day_chunks(dt.date(2012, 5, 1), dt.date(2017, 5, 15)) == [(dt.date(2012, 5, 1), dt.date(2015, 1, 25)), (dt.date(2015, 1, 26), dt.date(2017, 5, 15))]
    assert len(scans.day_chunks(dt.date(2020, 1, 1), dt.date(2020, 1, 1))) == 1


def test_only_the_written_days_are_replaced(spark, tmp_path):
    path = str(tmp_path / "thin")
    d = tracks(spark, SF).select(F.col("seg_id").alias("identifier"), "timestamp")
    sinks.write_thinned(d, path)
    day = F.to_date("timestamp") == F.lit(dt.date(2024, 1, 5))
    sinks.write_thinned(d.where(day).limit(1), path)
    back = spark.read.parquet(path)
    assert back.where(day).count() == 1 and back.count() == d.where(~day).count() + 1


def test_catalog_tables(spark):
    schema = sinks.SchemaBuilder().add("x", "INTEGER").add("day", "DATE").schema
    sinks.ensure_table(spark, "quay_t", schema, "it's a table", {"team": "a"}, "day")
    sinks.ensure_table(spark, "quay_t", schema, "again")
    sinks.query_into(spark, "SELECT 1L AS x, DATE'2024-01-01' AS day UNION ALL SELECT 2L, DATE'2024-01-03'", "quay_t")
    sinks.clear_days(spark, "quay_t", "day", "2024-01-02", "2024-01-03")
    assert [r.x for r in spark.table("quay_t").collect()] == [1]
    spark.sql("DROP TABLE quay_t")


def test_command_line(spark, tmp_path):
    t = str(tmp_path)
    tracks(spark, SF).write.parquet(f"{t}/pos")
    ports(spark).write.parquet(f"{t}/ports")
    tracks(spark, SF).select("seg_id", "ssvid", "vessel_id").distinct().write.parquet(f"{t}/ids")
    dates = ["--start_date", "2024-01-01", "--end_date", "2024-01-30"]
    main(["thin_port_messages", "--positions", f"{t}/pos", "--anchorages", f"{t}/ports", "--output", f"{t}/thin", *dates])
    main(["port_visits", "--thinned", f"{t}/thin", "--vessel_ids", f"{t}/ids", "--output", f"{t}/visits", *dates])
    main(["generate_confidence_voyages", "--input", f"{t}/visits", "-c", "3", "--output", f"{t}/voyages"])
    (tmp_path / "filter.sql").write_text(f"SELECT ssvid FROM parquet.`{t}/ids` WHERE ssvid < '3'")
    (tmp_path / "cfg.yaml").write_text("minimum_port_gap_duration_minutes: 600\n")
    main(["thin_port_messages", "--positions", f"{t}/pos", "--anchorages", f"{t}/ports", "--ssvid_filter", f"@{t}/filter.sql", "--config", f"{t}/cfg.yaml", "--output", f"{t}/some", *dates])
    some = {r.identifier.split("-")[0] for r in spark.read.parquet(f"{t}/some").select("identifier").distinct().collect()}
    assert some == {r.ssvid for r in spark.read.parquet(f"{t}/ids").where("ssvid < '3'").collect()}
    main(["port_visits", "--thinned", f"{t}/thin", "--vessel_ids", f"{t}/ids", "--bad_segs", f"SELECT seg_id FROM parquet.`{t}/ids` WHERE ssvid = '1'", "--output", f"{t}/good", *dates])
    assert {r.ssvid for r in spark.read.parquet(f"{t}/good").select("ssvid").distinct().collect()} == {r.ssvid for r in spark.read.parquet(f"{t}/visits").where("ssvid <> '1'").select("ssvid").distinct().collect()}
    assert spark.read.parquet(f"{t}/visits").count() > 50 and spark.read.parquet(f"{t}/voyages").count() > 50


def test_naming_from_the_command_line(spark, tmp_path):
    t = str(tmp_path)
    spark.createDataFrame([("0a", 1.0, 1.0, "X"), ("0b", 2.0, 2.0, "")], "s2id string, lat double, lon double, top_destination string").write.parquet(f"{t}/in")
    head = "iso3,label,sublabel,latitude,longitude,category\n"
    (tmp_path / "anchorage_overrides.csv").write_text(head + "PER,Callao,,50,50,\nPER,REMOVE,,60,60,\n")
    (tmp_path / "world.csv").write_text(head + ",Two,,2.001,2,\n")
    (tmp_path / "cfg.yaml").write_text("override_path: anchorage_overrides.csv\nport_list_paths: [world.csv]\n")
    ring = [[0, 0], [3, 0], [3, 3], [0, 3], [0, 0]]
    (tmp_path / "p.json").write_text(json.dumps({"features": [{"properties": {"ISO_TER1": "", "ISO_SOV1": "AAA"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    main(["name_anchorages", "--input", f"{t}/in", "--polygons", f"{t}/p.json", "--config", f"{t}/cfg.yaml", "--output", f"{t}/out"])
    got = {(r.label, r.iso3, r.label_source) for r in spark.read.parquet(f"{t}/out").collect()}
    assert got == {("X", "AAA", "top_destination"), ("TWO", "AAA", "world"), ("CALLAO", "PER", "anchorage_overrides")}
    with pytest.raises(SystemExit):
        main(["name_anchorages", "--input", f"{t}/in", "--polygons", f"{t}/p.json", "--output", f"{t}/out"])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    d = queries.QUERIES[name](spark, SF)
    cols = sorted(d.columns)
    mine = sorted((tuple(r[c] for c in cols) for r in d.collect()), key=repr)
    if name not in queries.SQL:
        assert mine
        return
    r = duck.execute(queries.SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert mine == sorted((tuple(row[i] for i in at) for row in r.fetchall()), key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
