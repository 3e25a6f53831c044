"""Scalar functions against known values."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quayside.functions import geo, ids, names, s2


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_haversine(spark):
    km = lambda a, b: geo.haversine_km(F.lit(33.4484), F.lit(-112.0740), F.lit(a), F.lit(b))
    r = one(spark, km(40.7128, -74.0059), km(33.4942, -111.9261), geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))
    assert abs(r[0] - 3443.706085594739) < 1e-6 and abs(r[1] - 14.633197815695059) < 1e-8
    assert abs(r[2] - np.pi * 6371) < 1e-6


def test_flat_distance_wraps_at_the_date_line(spark):
    assert abs(one(spark, geo.flat_nm(F.lit(0.0), F.lit(179.5), F.lit(0.0), F.lit(-179.5)))[0] - 60) < 1e-9


def test_s2_tokens(spark):
    points = [(29.9667462525, 122.4396281067, "345328af", "34532c"), (29.9407869352, 122.27906699, "3452d969", "3452dc"), (45.7285312075, 47.6336454619, "41abf04b", "41abf4"), (46.3122421582, 47.9769367751, "41a90e45", "41a90c"), (29.941832869, 122.2689838563, "3452d95f", "3452dc")]
    d = spark.createDataFrame(points, "lat double, lon double, l14 string, l9 string").select(s2.s2_token(F.col("lat"), F.col("lon"), 14).alias("a"), "l14", s2.s2_token(F.col("lat"), F.col("lon"), 9).alias("b"), "l9")
    assert all(r.a == r.l14 and r.b == r.l9 for r in d.collect())


def test_s2_columns_agree_with_numpy(spark):
    rng = np.random.default_rng(1)
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, 500))), rng.uniform(-180, 180, 500)
    d = spark.createDataFrame(list(zip(lat.tolist(), lon.tolist(), strict=True)), "lat double, lon double")
    for level in (3, 9, 14):
        got = [r[0] for r in d.select(s2.s2_token(F.col("lat"), F.col("lon"), level)).collect()]
        assert got == s2.tokens(*s2.cells(lat, lon, level), level)


def test_neighbours_touch_and_are_mutual():
    rng = np.random.default_rng(2)
    level = 4
    # All cells of a coarse level, so that edges and corners of the cube are met.
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, 40000))), rng.uniform(-180, 180, 40000)
    own = s2.tokens(*s2.cells(lat, lon, level), level)
    first = {t: i for i, t in reversed(list(enumerate(own)))}
    assert len(first) == 6 * 4**level
    at = list(first.values())
    around = dict(zip(first, map(set, s2.neighbourhood(lat[at], lon[at], level)), strict=True))
    sizes = sorted(len(v) for v in around.values())
    assert sizes[0] == 8 and sizes.count(8) == 24 and sizes[-1] == 9  # three cells at each of eight corners
    for t, ns in around.items():
        assert t in ns and all(t in around[n] for n in ns)


def test_names(spark):
    d = spark.createDataFrame([(x,) for x in ["ca&fé. 12", "  a ", "FISHING GROUND", "SHANGHAI", "b 12 & a", "xx 12 for order", "no destination"]], "x string")
    got = {r.x: (r.n, r.v) for r in d.select("x", names.normalize_name(F.col("x")).alias("n"), names.is_valid_name(names.normalize_name(F.col("x"))).alias("v")).collect()}
    assert got["ca&fé. 12"] == ("CA AND FÉ 12", True) and got["  a "] == ("A", False) and got["SHANGHAI"] == ("SHANGHAI", True)
    assert not got["FISHING GROUND"][1] and not got["xx 12 for order"][1] and not got["no destination"][1]
    assert got["b 12 & a"] == ("B 12 AND A", True)
    assert one(spark, names.normalized_valid_names(F.array(F.lit("tel 5"), F.lit("port  x"))))[0] == ["PORT X"]


def test_labels():
    assert names.to_ascii("Tromsø") == "TROMSO" and names.to_ascii("Спецморнефтепорт") == "SPETSMORNEFTEPORT"
    assert names.to_ascii(" ") is None and names.to_ascii(None) is None and names.to_ascii("A_b") == "A_B" and names.to_ascii("Straße Ñ") == "STRASSE N"


def test_ids(spark):
    ts = F.timestamp_seconds(F.lit(1476426402))
    r = one(spark, ids.visit_id(F.lit("None"), ts, F.lit(122.4396281067), F.lit(29.9667462525)), ids.trip_id(F.lit("1"), F.lit("v"), F.timestamp_seconds(F.lit(1500000000))), ids.trip_id(F.lit("1"), F.lit("v"), F.lit(None).cast("timestamp")), ids.iso_utc(F.timestamp_micros(F.lit(1476426402000050))))
    assert r[0] == "79028318cc7d067946432ff85274dc51" and r[1] == "1-v-015d3ef79800" and r[2] == "1-v" and r[3] == "2016-10-14T06:26:42.000050+00:00"


def test_mask(spark):
    bits = [False, True, True, False, True]
    row = ids.mask_row(F.array(*map(F.lit, bits)))
    assert one(spark, *[ids.mask_hit(row, F.lit(i)) for i in range(5)]) == tuple(bits)
    assert one(spark, ids.mask_lookup(row, F.lit(0.0), F.lit(-100.0), 10, 5), ids.mask_lookup(row, F.lit(91.0), F.lit(-100.0), 10, 5)) == (True, False)


def test_labels_of_other_scripts_are_not_lost(spark):
    """Transliterated by character; exact spellings are ICU's, only their being there and their repeatability matter for most."""
    want = {"上海": "SHANG HAI", "한국": "HANGUG", "Київ": "KIIV", "Спецморнефтепорт": "SPETSMORNEFTEPORT", "Tromsø": "TROMSO", " ": None, None: None}
    rows = [*want, "القاهرة", "กรุงเทพ", "חיפה"]
    d = spark.createDataFrame([(x,) for x in rows], "x string")
    got = {r.x: r.y for r in d.select("x", names.normalize_label(F.col("x")).alias("y")).collect()}
    assert {k: got[k] for k in want} == want
    assert all(got[x] and got[x].isascii() for x in rows[-3:])
