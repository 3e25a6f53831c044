"""One query for each operator over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.adapters import TRACKS_SQL, ports, tracks
from quayside.config import Config
from quayside.functions import geo, ids, names, s2
from quayside.functions.s2 import STEP
from quayside.operators import anchorages as anch
from quayside.operators import events, naming, polygons, records, stationary, thinning, visits
from quayside.operators.nearest import tag_nearest
from quayside.operators.state import with_states
from quayside.plans import pipelines
from quayside.sources import scans, sinks

CFG = Config()
#: Scaled to the sparse tracks of the driver's tables: about one record in seven hours.
SPARSE = Config(min_positions=20, min_vessels=5, stationary_km=1.0)
END = dt.date(2024, 1, 30)
START = dt.date(2024, 1, 1)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def r6(c: str) -> Column:
    return F.round(F.col(c), 6).alias(c)


def r9(c: str) -> Column:
    """For means of coordinates on a grid, which may lie half-way between two numbers of six decimals."""
    return F.round(F.col(c), 9).alias(c)


def us(c: str, name: str | None = None) -> Column:
    return F.unix_micros(c).alias(name or c)


# ---- SQL pieces -------------------------------------------------------------------------------------------------------------


def hav(a: str, b: str, c: str, d: str) -> str:
    return f"(2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))))"


def s2_sql(source: str, lat: str, lon: str, level: int, tag: str) -> str:
    """CTEs {tag}_ij (source's columns, {tag}_face, {tag}_i, {tag}_j) and {tag}_tok (and {tag}_token)."""
    st = lambda u: f"CASE WHEN {u} >= 0 THEN 0.5::DOUBLE * sqrt(1 + 3 * greatest({u}, 0)) ELSE 1 - 0.5::DOUBLE * sqrt(1 - 3 * least({u}, 0)) END"
    ctes = [
        f"{tag}_x AS (SELECT *, cos(radians({lat})) * cos(radians({lon})) AS {tag}_px, cos(radians({lat})) * sin(radians({lon})) AS {tag}_py, sin(radians({lat})) AS {tag}_pz FROM {source})",
        f"{tag}_f AS (SELECT *, CASE WHEN abs({tag}_px) > abs({tag}_py) THEN CASE WHEN abs({tag}_px) > abs({tag}_pz) THEN CASE WHEN {tag}_px < 0 THEN 3 ELSE 0 END ELSE CASE WHEN {tag}_pz < 0 THEN 5 ELSE 2 END END ELSE CASE WHEN abs({tag}_py) > abs({tag}_pz) THEN CASE WHEN {tag}_py < 0 THEN 4 ELSE 1 END ELSE CASE WHEN {tag}_pz < 0 THEN 5 ELSE 2 END END END AS {tag}_face FROM {tag}_x)",
        f"{tag}_u AS (SELECT *, CASE {tag}_face WHEN 0 THEN {tag}_py / {tag}_px WHEN 1 THEN -{tag}_px / {tag}_py WHEN 2 THEN -{tag}_px / {tag}_pz WHEN 3 THEN {tag}_pz / {tag}_px WHEN 4 THEN {tag}_pz / {tag}_py ELSE -{tag}_py / {tag}_pz END AS {tag}_pu, CASE {tag}_face WHEN 0 THEN {tag}_pz / {tag}_px WHEN 1 THEN {tag}_pz / {tag}_py WHEN 2 THEN -{tag}_py / {tag}_pz WHEN 3 THEN {tag}_py / {tag}_px WHEN 4 THEN -{tag}_px / {tag}_py ELSE -{tag}_px / {tag}_pz END AS {tag}_pv FROM {tag}_f)",
        f"{tag}_ij AS (SELECT * EXCLUDE ({tag}_px, {tag}_py, {tag}_pz, {tag}_pu, {tag}_pv), CAST(least({(1 << level) - 1}, greatest(0, floor({1 << level} * ({st(f'{tag}_pu')})))) AS BIGINT) AS {tag}_i, CAST(least({(1 << level) - 1}, greatest(0, floor({1 << level} * ({st(f'{tag}_pv')})))) AS BIGINT) AS {tag}_j FROM {tag}_u)",
    ]
    return ",\n".join(ctes) + ",\n" + s2_walk_sql(level, tag)


def s2_walk_sql(level: int, tag: str) -> str:
    """CTE {tag}_tok from {tag}_ij."""
    table = "[" + ", ".join(map(str, STEP)) + "]"
    pad = -(2 * level + 4) % 4
    steps, ctes = f"{tag}_face % 2", []
    prev, acc = f"{tag}_ij", f"CAST({steps} AS BIGINT)"
    for k in range(level - 1, -1, -1):
        ctes.append(f"{tag}_w{k} AS (SELECT * {'EXCLUDE (' + tag + '_acc)' if k < level - 1 else ''}, ({acc} // 4) * 16 + {table}[({acc} % 4) * 4 + 2 * (({tag}_i >> {k}) & 1) + (({tag}_j >> {k}) & 1) + 1] AS {tag}_acc FROM {prev})")
        prev, acc = f"{tag}_w{k}", f"{tag}_acc"
    ctes.append(f"{tag}_tok AS (SELECT * EXCLUDE ({tag}_acc), lpad(lower(to_hex(({tag}_face * {1 << (2 * level + 1)}::BIGINT + ({tag}_acc // 4) * 2 + 1) * {1 << pad})), {(2 * level + 4 + pad) // 4}, '0') AS {tag}_token FROM {prev})")
    return ",\n".join(ctes)


PORT_TOKENS = s2_sql("prt", "lat", "lon", 14, "p14")
#: nr: each position with its nearest port among touching level-9 cells. The ports lie far from the edges of the cube's faces.
NEAREST_SQL = f"""{TRACKS_SQL},
{s2_sql("trk", "lat", "lon", 9, "t9")},
{PORT_TOKENS},
{s2_sql("p14_tok", "lat", "lon", 9, "p9")},
nr0 AS (SELECT t.event_id, p.p14_token AS port_s2id, p.lat AS port_lat, p.lon AS port_lon, {hav("t.lat", "t.lon", "p.lat", "p.lon")} AS port_dist FROM t9_ij t JOIN p9_ij p ON t.t9_face = p.p9_face AND abs(t.t9_i - p.p9_i) <= 1 AND abs(t.t9_j - p.p9_j) <= 1),
nr1 AS (SELECT * FROM nr0 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY port_dist, port_s2id) = 1),
nr AS (SELECT t.*, n.port_s2id, n.port_lat, n.port_lon, n.port_dist FROM trk t LEFT JOIN nr1 n USING (event_id))"""


def state_sql(source: str, keys: str, order: str, tag: str) -> str:
    """CTE {tag}_state: source with in_port, stopped, state."""
    run = f"PARTITION BY {keys}, g ORDER BY {order}"
    return f"""{tag}_a AS (SELECT *, CASE WHEN port_dist <= 3 THEN true WHEN port_dist > 3 AND port_dist < 4 THEN NULL ELSE false END AS near, CASE WHEN speed <= 0.2 THEN true WHEN speed >= 0.5 THEN false END AS still FROM {source}),
{tag}_b AS (SELECT *, coalesce(last_value(near IGNORE NULLS) OVER w, false) AS in_port, count(still) OVER w AS g FROM {tag}_a WINDOW w AS (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING)),
{tag}_c AS (SELECT *, coalesce(first_value(still) OVER ({run} ROWS UNBOUNDED PRECEDING) AND (still IS NOT NULL OR bool_and(in_port) OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), false) AS stopped FROM {tag}_b),
{tag}_state AS (SELECT *, CASE WHEN NOT in_port THEN 'AT_SEA' WHEN stopped THEN 'STOPPED' ELSE 'IN_PORT' END AS state FROM {tag}_c)"""


ORDER5 = "ts, seg_id, speed, lat, lon"
#: The records of the event queries: every fourth is no possible gap end.
GAPS_SQL = f"{NEAREST_SQL},\nrec AS (SELECT *, c % 4 <> 0 AS is_possible_gap_end FROM nr),\n{state_sql('rec', 'vessel_id', ORDER5, 's')}"
_MOVES = "CASE last_state || '>' || state " + " ".join(f"WHEN '{a}>{b}' THEN {list(k)}" for (a, b), k in events.TRANSITIONS.items()) + " ELSE []::VARCHAR[] END"
EVENTS_SQL = f"""{GAPS_SQL},
ctx AS (SELECT *, lag(state) OVER w AS last_state, lag(ts) OVER w AS last_ts, lead(1) OVER w IS NULL AS is_last, row_number() OVER w AS at_row,
  last_value(CASE WHEN in_port THEN {{'s2id': port_s2id, 'lat': port_lat, 'lon': port_lon}} END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS active FROM s_state WINDOW w AS (PARTITION BY vessel_id ORDER BY {ORDER5})),
gapped AS (SELECT *, coalesce(last_state IN ('IN_PORT', 'STOPPED') AND is_possible_gap_end AND epoch_us(ts) - epoch_us(last_ts) >= 14400000000, false) AS gap FROM ctx),
ev AS (
  SELECT vessel_id, ssvid, seg_id, 'PORT_GAP_END' AS event_type, epoch_us(ts) AS ts_us, epoch_us(last_ts) AS last_us, active, lat AS vessel_lat, lon AS vessel_lon, at_row, 0 AS nth FROM gapped WHERE gap
  UNION ALL SELECT vessel_id, ssvid, seg_id, 'PORT_GAP_BEGIN', epoch_us(last_ts) + 14400000000, epoch_us(last_ts), active, NULL, NULL, at_row, 1 FROM gapped WHERE gap
  UNION ALL SELECT vessel_id, ssvid, seg_id, unnest({_MOVES}), epoch_us(ts), epoch_us(last_ts), active, lat, lon, at_row, 2 FROM gapped
  UNION ALL SELECT vessel_id, ssvid, seg_id, 'PORT_GAP_BEGIN', epoch_us(ts) + 14400000000, epoch_us(ts), active, NULL, NULL, at_row, 9 FROM gapped
    WHERE is_last AND state IN ('IN_PORT', 'STOPPED') AND epoch_us(TIMESTAMP '2024-01-31') - 1 - epoch_us(ts) >= 14400000000),
evt AS (SELECT vessel_id, ssvid, seg_id, event_type, ts_us, last_us, active.s2id AS anchorage_id, active.lat AS lat, active.lon AS lon, vessel_lat, vessel_lon FROM ev)"""
_TYPES = list(events.TYPE_ORDER)
_FLAT = "60 * sqrt(pow(lat - plat, 2) + pow(cos(radians((lat + plat) / 2)) * (lon - plon + 180 - floor((lon - plon + 180) / 360) * 360 - 180), 2))"
VISITS_SQL = f"""{EVENTS_SQL},
vo AS (SELECT *, list_position({_TYPES}, event_type) AS type_no FROM evt),
vl AS (SELECT *, row_number() OVER w AS seq, lag(event_type) OVER w AS ptype, lag(seg_id) OVER w AS pseg, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM vo
  WINDOW w AS (PARTITION BY vessel_id ORDER BY ts_us, type_no, anchorage_id NULLS FIRST, lat NULLS FIRST, lon NULLS FIRST, vessel_lat NULLS FIRST, vessel_lon NULLS FIRST, ssvid NULLS FIRST, seg_id NULLS FIRST)),
vn AS (SELECT *, sum(CASE WHEN seq = 1 OR event_type = 'PORT_ENTRY' OR ptype = 'PORT_EXIT' OR (pseg <> seg_id AND {_FLAT} > 60) THEN 1 ELSE 0 END) OVER (PARTITION BY vessel_id ORDER BY seq) AS visit_no FROM vl),
vis AS (SELECT vessel_id, min(ssvid) AS ssvid, visit_no, min(ts_us) AS start_us, max(ts_us) AS end_us, arg_min(lat, seq) AS start_lat, arg_min(lon, seq) AS start_lon, arg_min(anchorage_id, seq) AS start_anchorage_id,
  arg_max(lat, seq) AS end_lat, arg_max(lon, seq) AS end_lon, arg_max(anchorage_id, seq) AS end_anchorage_id, count(*) AS n_events,
  bool_or(event_type IN ('PORT_STOP_BEGIN', 'PORT_STOP_END', 'PORT_GAP_BEGIN', 'PORT_GAP_END')) AS still, bool_or(event_type = 'PORT_ENTRY') AS entry, bool_or(event_type = 'PORT_EXIT') AS exit FROM vn GROUP BY vessel_id, visit_no),
visits AS (SELECT *, CAST(CASE WHEN still AND entry AND exit THEN 4 WHEN still AND (entry OR exit) THEN 3 WHEN still THEN 2 ELSE 1 END AS BIGINT) AS confidence,
  md5(vessel_id || '-' || strftime(make_timestamp(start_us), '%Y-%m-%dT%H:%M:%S') || CASE WHEN start_us % 1000000 <> 0 THEN '.' || lpad(CAST(start_us % 1000000 AS VARCHAR), 6, '0') ELSE '' END || '+00:00-' || CAST(start_lon AS VARCHAR) || '-' || CAST(start_lat AS VARCHAR)) AS visit_id FROM vis)"""

# ---- records ----------------------------------------------------------------------------------------------------------------

MESSAGES_SQL = f"""{TRACKS_SQL},
msg AS (SELECT event_id, ssvid AS ident, ts, CASE c % 13 WHEN 3 THEN NULL WHEN 7 THEN 91.0 ELSE lat END AS lat, lon, CASE c % 13 WHEN 5 THEN NULL WHEN 9 THEN 103.0 ELSE speed END AS speed,
  CASE c % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE event_type END AS destination FROM trk),
cls AS (SELECT *, lat IS NOT NULL AND lon IS NOT NULL AND speed IS NOT NULL AS is_location, coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND speed BETWEEN 0 AND 102.2, false) AS is_valid FROM msg),
knd AS (SELECT *, CASE WHEN is_location AND is_valid THEN 'location' WHEN coalesce(destination, '') <> '' THEN 'info' ELSE 'invalid' END AS kind FROM cls)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks with holes: missing and impossible values at fixed places."""
    m = F.col("c") % 13
    return tracks(spark, sf_dir).select(
        "event_id", F.col("ssvid").alias("ident"), "timestamp", F.when(m == 3, None).when(m == 7, 91.0).otherwise(F.col("lat")).alias("lat"), "lon", F.when(m == 5, None).when(m == 9, 103.0).otherwise(F.col("speed")).alias("speed"),
        F.when(F.col("c") % 5 == 0, "").when(F.col("c") % 5 == 1, None).otherwise(F.col("event_type")).alias("destination"),
    )


@query("o13_valid_positions", f"WITH {MESSAGES_SQL} SELECT event_id, is_location, is_valid FROM cls")
def _(spark, sf_dir):
    return messages(spark, sf_dir).select("event_id", records.is_location_message().alias("is_location"), F.coalesce(records.has_valid_location(), F.lit(False)).alias("is_valid"))


@query("o16_classify", f"WITH {MESSAGES_SQL} SELECT event_id, kind FROM knd")
def _(spark, sf_dir):
    return messages(spark, sf_dir).select("event_id", records.classify().alias("kind"))


@query("o17_create_records", f"WITH {MESSAGES_SQL} SELECT ident, kind, count(*) AS n FROM knd WHERE kind <> 'invalid' GROUP BY ident, kind")
def _(spark, sf_dir):
    return records.create_records(messages(spark, sf_dir)).groupBy("ident", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("o18_only_locations", f"WITH {MESSAGES_SQL} SELECT event_id, ident FROM knd WHERE kind = 'location'")
def _(spark, sf_dir):
    return records.only_locations(records.create_records(messages(spark, sf_dir))).select("event_id", "ident")


@query(
    "o19_dedup",
    f"WITH {TRACKS_SQL} SELECT ssvid, epoch_us(CAST(day AS TIMESTAMP)) AS timestamp, round(speed, 6) AS speed, round(lat, 6) AS lat, round(lon, 6) AS lon FROM trk QUALIFY row_number() OVER (PARTITION BY ssvid, day ORDER BY speed, lat, lon) = 1",
)
def _(spark, sf_dir):
    d = tracks(spark, sf_dir).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    return records.dedup_by_timestamp(d, "ssvid").select("ssvid", us("timestamp"), r6("speed"), r6("lat"), r6("lon"))


@query("o19_min_positions", f"WITH {TRACKS_SQL} SELECT event_id, ssvid FROM trk WHERE ssvid IN (SELECT ssvid FROM trk GROUP BY ssvid HAVING count(*) >= 66)")
def _(spark, sf_dir):
    return records.long_enough(tracks(spark, sf_dir), 66, "ssvid").select("event_id", "ssvid")


@query(
    "o19_destination_ffill",
    f"""WITH {MESSAGES_SQL}, f AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'info' THEN destination END IGNORE NULLS) OVER (PARTITION BY ident ORDER BY ts, speed NULLS FIRST, lat NULLS FIRST, lon NULLS FIRST ROWS UNBOUNDED PRECEDING), '') AS dest FROM knd WHERE kind <> 'invalid')
SELECT event_id, dest AS destination FROM f WHERE kind = 'location'""",
)
def _(spark, sf_dir):
    return records.tag_records(records.create_records(messages(spark, sf_dir)), "ident").select("event_id", "destination")


@query(
    "o19_tagged_by_day",
    f"""WITH {MESSAGES_SQL}, k AS (SELECT *, CAST(ts AS DATE) AS day FROM knd WHERE kind <> 'invalid'), u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY ident, day, ts ORDER BY speed NULLS FIRST, lat NULLS FIRST, lon NULLS FIRST) = 1),
f AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'info' THEN destination END IGNORE NULLS) OVER (PARTITION BY ident, day ORDER BY ts, speed NULLS FIRST, lat NULLS FIRST, lon NULLS FIRST ROWS UNBOUNDED PRECEDING), '') AS dest FROM u)
SELECT event_id, dest AS destination FROM f WHERE kind = 'location'""",
)
def _(spark, sf_dir):
    return records.create_tagged_records_by_day(records.create_records(messages(spark, sf_dir))).select("event_id", "destination")


@query(
    "o12_greedy_thin",
    f"""WITH RECURSIVE {TRACKS_SQL}, o AS (SELECT event_id, ssvid, epoch_us(ts) AS t, row_number() OVER (PARTITION BY ssvid ORDER BY ts, speed, lat, lon) AS rn FROM trk),
f AS (SELECT event_id, ssvid, rn, t AS kept, true AS keep FROM o WHERE rn = 1 UNION ALL SELECT o.event_id, o.ssvid, o.rn, CASE WHEN o.t - f.kept >= 21600000000 THEN o.t ELSE f.kept END, o.t - f.kept >= 21600000000 FROM f JOIN o ON o.ssvid = f.ssvid AND o.rn = f.rn + 1)
SELECT event_id, ssvid FROM f WHERE keep""",
)
def _(spark, sf_dir):
    return thinning.greedy_thin(tracks(spark, sf_dir), "ssvid", 6 * 3600).select("event_id", "ssvid")


# ---- sources and joins ------------------------------------------------------------------------------------------------------


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = tracks(spark, sf_dir).where("c % 6 > 0").groupBy("seg_id", F.to_date("timestamp").alias("day"), F.col("event_type").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return n.groupBy("seg_id", "day").agg(F.collect_list(F.struct("value", "count")).alias("destinations"))


SEGMENTS_SQL = f"""{TRACKS_SQL}, sn AS (SELECT seg_id, day, event_type, count(*) AS n FROM trk WHERE c % 6 > 0 GROUP BY ALL),
seg AS (SELECT seg_id, day, event_type AS destination FROM sn QUALIFY row_number() OVER (PARTITION BY seg_id, day ORDER BY n DESC, event_type DESC) = 1)"""


@query("o26_segment_destination", f"WITH {SEGMENTS_SQL} SELECT seg_id, CAST(day AS VARCHAR) AS day, destination FROM seg")
def _(spark, sf_dir):
    return scans.segment_destinations(segments(spark, sf_dir)).select("seg_id", F.col("day").cast("string").alias("day"), "destination")


@query("j1_positions_destinations", f"WITH {SEGMENTS_SQL} SELECT ssvid AS ident, epoch_us(ts) AS timestamp, destination FROM trk JOIN seg USING (seg_id, day) WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'")
def _(spark, sf_dir):
    return scans.anchorage_positions(tracks(spark, sf_dir), segments(spark, sf_dir), dt.date(2024, 1, 3), dt.date(2024, 1, 20)).select("ident", us("timestamp"), "destination")


def _thinned_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks(spark, sf_dir).select(F.col("seg_id").alias("identifier"), "timestamp", "lat", "lon", "speed", "event_id")


def _vessel_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks(spark, sf_dir).where("d % 10 < 9").select("seg_id", "ssvid", "vessel_id").distinct()


@query("j2_vessel_ids", f"WITH {TRACKS_SQL}, ids AS (SELECT DISTINCT seg_id, ssvid, vessel_id FROM trk WHERE d % 10 < 9) SELECT t.event_id, i.vessel_id, i.ssvid FROM trk t JOIN ids i USING (seg_id) WHERE t.day BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'")
def _(spark, sf_dir):
    return scans.visit_messages(_thinned_like(spark, sf_dir), _vessel_ids(spark, sf_dir), dt.date(2024, 1, 5), dt.date(2024, 1, 25)).select("event_id", "vessel_id", "ssvid")


@query("j3_bad_segments", f"WITH {TRACKS_SQL} SELECT event_id, seg_id FROM trk WHERE seg_id NOT IN (SELECT seg_id FROM trk WHERE c % 50 = 0)")
def _(spark, sf_dir):
    t = tracks(spark, sf_dir)
    return scans.not_in(t, "seg_id", t.where("c % 50 = 0").select("seg_id").distinct()).select("event_id", "seg_id")


@query("j3_bad_segments_with_null", f"WITH {TRACKS_SQL} SELECT event_id, seg_id FROM trk WHERE seg_id NOT IN (SELECT CASE WHEN c % 100 > 0 THEN seg_id END FROM trk WHERE c % 50 = 0)")
def _(spark, sf_dir):
    t = tracks(spark, sf_dir)
    return scans.not_in(t, "seg_id", t.where("c % 50 = 0").select(F.when(F.col("c") % 100 > 0, F.col("seg_id")))).select("event_id", "seg_id")


@query("j4_ssvid_filter", f"WITH {TRACKS_SQL} SELECT seg_id AS ident, ssvid, epoch_us(ts) AS timestamp FROM trk WHERE ssvid IN (SELECT ssvid FROM trk WHERE c % 97 = 0)")
def _(spark, sf_dir):
    t = tracks(spark, sf_dir)
    return scans.thinning_positions(t, START, END, t.where("c % 97 = 0").select("ssvid")).select("ident", "ssvid", us("timestamp"))


@query("o5_anchorage_scan", f"WITH {TRACKS_SQL}, {PORT_TOKENS} SELECT p14_token AS s2id, lat, lon, 'PORT ' || k AS label FROM p14_tok")
def _(spark, sf_dir):
    return scans.anchorage_source(ports(spark).withColumn("label", F.concat(F.lit("PORT "), F.col("k").cast("string")))).select("s2id", "lat", "lon", "label")


@query("j7_nearest_port", f"WITH {NEAREST_SQL} SELECT event_id, port_s2id, round(port_dist, 6) AS port_dist, round(port_lat, 6) AS port_lat, round(port_lon, 6) AS port_lon FROM nr")
def _(spark, sf_dir):
    return nearest(spark, sf_dir).select("event_id", "port_s2id", r6("port_dist"), r6("port_lat"), r6("port_lon"))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_nearest(tracks(spark, sf_dir), ports(spark).select("s2id", "lat", "lon"))


@query("f1_distance", f"WITH {TRACKS_SQL} SELECT event_id, round({hav('lat', 'lon', '33.4484', '-112.074')}, 6) AS km FROM trk")
def _(spark, sf_dir):
    return tracks(spark, sf_dir).select("event_id", F.round(geo.haversine_km(F.col("lat"), F.col("lon"), F.lit(33.4484), F.lit(-112.074)), 6).alias("km"))


for _level in (14, 9):

    @query(f"f2_s2_level{_level}", f"WITH {TRACKS_SQL}, {s2_sql('trk', 'lat', 'lon', _level, 't')} SELECT event_id, t_token AS token FROM t_tok")
    def _(spark, sf_dir, level=_level):
        return tracks(spark, sf_dir).select("event_id", s2.s2_token(F.col("lat"), F.col("lon"), level).alias("token"))


@query(
    "f3_neighbour_cells",
    f"""WITH {TRACKS_SQL}, {PORT_TOKENS}, {s2_sql("p14_tok", "lat", "lon", 9, "p9")}, b_ij AS (SELECT p14_token, p9_face AS b_face, p9_i + a.x AS b_i, p9_j + b.x AS b_j FROM p9_ij, (VALUES (-1), (0), (1)) a(x), (VALUES (-1), (0), (1)) b(x)), {s2_walk_sql(9, "b")}
SELECT p14_token AS s2id, b_token AS cell FROM b_tok""",
)
def _(spark, sf_dir):
    return ports(spark).select("s2id", F.explode(s2.neighbour_tokens(F.col("lat"), F.col("lon"), 9)).alias("cell"))


# ---- states, events, visits, voyages ----------------------------------------------------------------------------------------


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, sf_dir).withColumn("is_possible_gap_end", F.col("c") % 4 != 0)


def vessel_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.port_events(event_records(spark, sf_dir), CFG, END)


def vessel_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.port_visits(vessel_events(spark, sf_dir), CFG)


@query("w3_state", f"WITH {GAPS_SQL} SELECT event_id, in_port, stopped, state FROM s_state")
def _(spark, sf_dir):
    return with_states(event_records(spark, sf_dir), CFG, ("vessel_id",), events.RECORD_ORDER).select("event_id", "in_port", "stopped", "state")


@query("w6_transitions", f"WITH {EVENTS_SQL} SELECT event_id, unnest({_MOVES}) AS event_type FROM ctx")
def _(spark, sf_dir):
    d = events.with_event_context(event_records(spark, sf_dir), CFG)
    return d.select("event_id", F.explode(events.transition_events(F.col("last_state"), F.col("state"))).alias("event_type"))


@query("w7_active_port", f"WITH {EVENTS_SQL} SELECT event_id, active.s2id AS anchorage_id FROM ctx")
def _(spark, sf_dir):
    return events.with_event_context(event_records(spark, sf_dir), CFG).select("event_id", F.col("active.port_s2id").alias("anchorage_id"))


@query("w8_gaps", f"WITH {EVENTS_SQL} SELECT event_id, epoch_us(last_ts) + 14400000000 AS gap_begin FROM gapped WHERE gap")
def _(spark, sf_dir):
    d = events.with_event_context(event_records(spark, sf_dir), CFG).where(events.gap_found(CFG))
    return d.select("event_id", (F.unix_micros("last_timestamp") + 240 * 60_000_000).alias("gap_begin"))


@query("w10_port_events", f"WITH {EVENTS_SQL} SELECT vessel_id, ssvid, seg_id, event_type, ts_us AS timestamp, last_us AS last_timestamp, anchorage_id, round(lat, 6) AS lat, round(lon, 6) AS lon, round(vessel_lat, 6) AS vessel_lat, round(vessel_lon, 6) AS vessel_lon FROM evt")
def _(spark, sf_dir):
    return vessel_events(spark, sf_dir).select("vessel_id", "ssvid", "seg_id", "event_type", us("timestamp"), us("last_timestamp"), "anchorage_id", r6("lat"), r6("lon"), r6("vessel_lat"), r6("vessel_lon"))


@query(
    "w11_smart_thin",
    f"""WITH {NEAREST_SQL}, {state_sql("nr", "seg_id, day", "ts, speed, lat, lon", "m")},
k AS (SELECT *, row_number() OVER w = 1 AS first, lead(1) OVER w IS NULL AS last, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 14400000000, false) AS gap, coalesce(lag(state) OVER w <> state, false) AS turn FROM m_state WINDOW w AS (PARTITION BY seg_id, day ORDER BY ts, speed, lat, lon)),
q AS (SELECT *, first OR last OR turn OR gap OR coalesce(lead(turn) OVER w, false) OR coalesce(lead(gap) OVER w, false) AS keep FROM k WINDOW w AS (PARTITION BY seg_id, day ORDER BY ts, speed, lat, lon))
SELECT event_id, first OR gap AS is_possible_gap_end, port_s2id, round(port_dist, 6) AS port_dist FROM q WHERE keep""",
)
def _(spark, sf_dir):
    return thinning.smart_thin(nearest(spark, sf_dir), CFG).select("event_id", "is_possible_gap_end", "port_s2id", r6("port_dist"))


@query("w13_sessions", f"WITH {VISITS_SQL} SELECT vessel_id, CAST(seq AS BIGINT) AS seq, event_type, ts_us AS timestamp, CAST(visit_no AS BIGINT) AS visit_no FROM vn")
def _(spark, sf_dir):
    return visits.sessionise(vessel_events(spark, sf_dir), 60.0).select("vessel_id", F.col("seq").cast("long").alias("seq"), "event_type", us("timestamp"), "visit_no")


@query(
    "w13_port_visits",
    f"WITH {VISITS_SQL} SELECT visit_id, ssvid, vessel_id, start_us AS start_timestamp, round(start_lat, 6) AS start_lat, round(start_lon, 6) AS start_lon, start_anchorage_id, end_us AS end_timestamp, round(end_lat, 6) AS end_lat, round(end_lon, 6) AS end_lon, end_anchorage_id, round((end_us - start_us) / 3.6e9::DOUBLE, 6) AS duration_hrs, n_events, least(n_events, 200) AS n_shown, confidence FROM visits",
)
def _(spark, sf_dir):
    v = vessel_visits(spark, sf_dir)
    ends = [c for s in ("start", "end") for c in (us(f"{s}_timestamp"), r6(f"{s}_lat"), r6(f"{s}_lon"), F.col(f"{s}_anchorage_id"))]
    return v.select("visit_id", "ssvid", "vessel_id", *ends, r6("duration_hrs"), "n_events", F.size("events").cast("long").alias("n_shown"), "confidence")


@query("o29_confidence", f"WITH {VISITS_SQL} SELECT confidence, count(*) AS n_visits, CAST(sum(n_events) AS BIGINT) AS n_events FROM visits GROUP BY confidence")
def _(spark, sf_dir):
    return vessel_visits(spark, sf_dir).groupBy("confidence").agg(F.count(F.lit(1)).alias("n_visits"), F.sum("n_events").alias("n_events"))


@query("o8_visits_since", f"WITH {VISITS_SQL} SELECT visit_id, confidence FROM visits WHERE CAST(make_timestamp(end_us) AS DATE) >= DATE '2024-01-15' AND confidence >= 2")
def _(spark, sf_dir):
    return visits.visits_ended_since(vessel_visits(spark, sf_dir), dt.date(2024, 1, 15)).select("visit_id", "confidence")


for _c in (2, 3, 4):

    @query(
        f"e5_voyages_c{_c}",
        f"""WITH {VISITS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY vessel_id ORDER BY start_us, end_us, visit_id) AS rn FROM visits WHERE confidence >= {_c} AND make_timestamp(end_us) <> TIMESTAMP '1979-01-01')
SELECT coalesce(b.ssvid, a.ssvid) AS ssvid, coalesce(b.vessel_id, a.vessel_id) AS vessel_id, a.end_us AS trip_start, b.start_us AS trip_end, a.end_anchorage_id AS trip_start_anchorage_id, b.start_anchorage_id AS trip_end_anchorage_id, a.visit_id AS trip_start_visit_id, b.visit_id AS trip_end_visit_id,
  a.confidence AS trip_start_confidence, b.confidence AS trip_end_confidence, coalesce(b.ssvid, a.ssvid) || '-' || coalesce(b.vessel_id, a.vessel_id) || CASE WHEN a.end_us IS NULL THEN '' ELSE '-' || lpad(lower(to_hex(a.end_us // 1000)), 12, '0') END AS trip_id
FROM n b FULL JOIN n a ON a.vessel_id = b.vessel_id AND b.rn = a.rn + 1""",
    )
    def _(spark, sf_dir, c=_c):
        return pipelines.generate_voyages(vessel_visits(spark, sf_dir), c).withColumns({"trip_start": F.unix_micros("trip_start"), "trip_end": F.unix_micros("trip_end")})


# ---- anchorages -------------------------------------------------------------------------------------------------------------

PERIODS_SQL = f"""{TRACKS_SQL}, o AS (SELECT ssvid, event_id, ts, lat, lon, speed, event_type, row_number() OVER (PARTITION BY ssvid ORDER BY ts, speed, lat, lon) AS rn FROM trk),
f AS (SELECT ssvid, rn, lat AS alat, lon AS alon, 0 AS period FROM o WHERE rn = 1
  UNION ALL SELECT o.ssvid, o.rn, CASE WHEN {hav("f.alat", "f.alon", "o.lat", "o.lon")} > 1.0 THEN o.lat ELSE f.alat END, CASE WHEN {hav("f.alat", "f.alon", "o.lat", "o.lon")} > 1.0 THEN o.lon ELSE f.alon END, f.period + CASE WHEN {hav("f.alat", "f.alon", "o.lat", "o.lon")} > 1.0 THEN 1 ELSE 0 END FROM f JOIN o ON o.ssvid = f.ssvid AND o.rn = f.rn + 1),
num AS (SELECT o.*, f.period FROM o JOIN f USING (ssvid, rn)),
agg AS (SELECT ssvid, period, avg(lat) AS mlat, avg(lon) AS mlon, min(ts) AS start_time, epoch_us(max(ts)) - epoch_us(min(ts)) AS duration_us, arg_min(event_type, rn) AS destination, count(*) AS n FROM num GROUP BY ssvid, period),
sta AS (SELECT *, max(period) OVER (PARTITION BY ssvid) AS last_period FROM agg QUALIFY duration_us > 720 * 60000000::BIGINT AND period < last_period),
still AS (SELECT s.ssvid, s.period, s.mlat AS lat, s.mlon AS lon, s.start_time, s.duration_us, s.destination, s.n, sqrt(avg(pow({hav("o.lat", "o.lon", "s.mlat", "s.mlon")}, 2))) AS rms FROM sta s JOIN num o ON o.ssvid = s.ssvid AND o.period = s.period GROUP BY ALL),
act AS (SELECT n.ssvid, n.event_id, n.ts, n.lat, n.lon, row_number() OVER w = 1 AS first, lead(1) OVER w IS NULL AS last, s.period IS NOT NULL AS inside FROM num n LEFT JOIN sta s ON s.ssvid = n.ssvid AND s.period = n.period WINDOW w AS (PARTITION BY n.ssvid, n.period ORDER BY n.rn)),
moving AS (SELECT * FROM act WHERE NOT inside OR first OR last)"""


def _periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks(spark, sf_dir).select(F.col("ssvid").alias("ident"), "event_id", "timestamp", "lat", "lon", "speed", F.col("event_type").alias("destination"))
    return stationary.number_and_measure(t, SPARSE)


@query("o20_stationary", f"WITH RECURSIVE {PERIODS_SQL} SELECT ssvid AS ident, CAST(period AS BIGINT) AS period, round(lat, 9) AS lat, round(lon, 9) AS lon, epoch_us(start_time) AS start_time, duration_us, destination, n, round(rms, 6) AS rms_drift_radius FROM still")
def _(spark, sf_dir):
    return stationary.stationary_periods(_periods(spark, sf_dir)).select("ident", "period", r9("lat"), r9("lon"), us("start_time"), "duration_us", "destination", "n", r6("rms_drift_radius"))


@query("o22_active", f"WITH RECURSIVE {PERIODS_SQL} SELECT event_id, ssvid AS ident FROM moving")
def _(spark, sf_dir):
    return stationary.active_records(_periods(spark, sf_dir)).select("event_id", "ident")


ANCHORAGES_SQL = f"""{PERIODS_SQL}, {s2_sql("still", "lat", "lon", 14, "c")}, {s2_sql("moving", "lat", "lon", 14, "m")},
fish AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS ssvid FROM events WHERE user_id % 3 = 0),
st AS (SELECT c_token AS s2id, c.*, f.ssvid IS NOT NULL AS fishing FROM c_tok c LEFT JOIN fish f ON f.ssvid = c.ssvid),
cells AS (SELECT s2id, count(*) AS total_visits, avg(lat) AS lat, avg(lon) AS lon, sqrt(sum(pow(rms, 2)) / count(*)) AS drift_radius, count(DISTINCT ssvid) AS ns, count(DISTINCT CASE WHEN fishing THEN ssvid END) AS nf, sum(duration_us) / 86400e6::DOUBLE AS ds, coalesce(sum(CASE WHEN fishing THEN duration_us END), 0) / 86400e6::DOUBLE AS df FROM st GROUP BY s2id HAVING count(DISTINCT ssvid) >= 5),
mv AS (SELECT m_token AS s2id, count(DISTINCT ssvid) AS na, CAST(count(DISTINCT (ssvid, CAST(ts AS DATE))) AS DOUBLE) AS da FROM m_tok GROUP BY 1),
un AS (SELECT s2id, count(DISTINCT ssvid) AS nt FROM (SELECT s2id, ssvid FROM st UNION ALL SELECT m_token, ssvid FROM m_tok) GROUP BY s2id),
top AS (SELECT s2id, upper(destination) AS name FROM (SELECT s2id, destination, count(*) AS n FROM st GROUP BY s2id, destination) QUALIFY row_number() OVER (PARTITION BY s2id ORDER BY n DESC, upper(destination)) = 1),
anc AS (SELECT c.s2id, round(lat, 9) AS lat, round(lon, 9) AS lon, total_visits, round(drift_radius, 6) AS drift_radius, coalesce(name, '') AS top_destination, ns, nf, coalesce(na, 0) AS na, nt, ds, df, coalesce(da, 0) AS da FROM cells c LEFT JOIN mv USING (s2id) JOIN un USING (s2id) LEFT JOIN top USING (s2id))"""


def _anchorages(spark: SparkSession, sf_dir: str) -> DataFrame:
    fishing = spark.read.parquet(f"{sf_dir}/events.parquet").where("user_id % 3 = 0").select(F.col("user_id").cast("string").alias("ssvid"))
    return anch.find_anchorages(stationary.cell_marks(_periods(spark, sf_dir)), fishing, SPARSE.min_vessels)


def _rounded(a: DataFrame) -> DataFrame:
    six = ("drift_radius", "stationary_ssvid_days", "stationary_fishing_ssvid_days")
    return a.select(*(r9(c) if c in ("lat", "lon") else r6(c) if c in six else F.col(c) for c in a.columns))


@query(
    "o23_anchorages",
    f"WITH RECURSIVE {ANCHORAGES_SQL} SELECT s2id, lat, lon, total_visits, drift_radius, top_destination, ns AS unique_stationary_ssvid, nf AS unique_stationary_fishing_ssvid, na AS unique_active_ssvid, nt AS unique_total_ssvid, round(ds, 6) AS stationary_ssvid_days, round(df, 6) AS stationary_fishing_ssvid_days, da AS active_ssvid_days FROM anc",
)
def _(spark, sf_dir):
    a = _anchorages(spark, sf_dir)
    return _rounded(a)


@query("o24_top_destination", f"WITH RECURSIVE {ANCHORAGES_SQL} SELECT s2id, name AS top_destination FROM top")
def _(spark, sf_dir):
    return anch.top_destinations(stationary.stationary_periods(_periods(spark, sf_dir)))


# ---- names ------------------------------------------------------------------------------------------------------------------

_NAMES_SQL = """raw AS (SELECT doc_id, trim(text) || CASE doc_id % 7 WHEN 0 THEN ' & sons 12' WHEN 1 THEN ' fishing' WHEN 2 THEN ' 99 for order' ELSE '' END AS name FROM documents
  UNION ALL SELECT -1 - n_nationkey, n_name FROM nation UNION ALL SELECT -100, 'B 12 & A' UNION ALL SELECT -101, 'sar boat' UNION ALL SELECT -102, 'a' UNION ALL SELECT -103, 'no destination'),
nrm AS (SELECT doc_id, trim(regexp_replace(replace(replace(upper(name), 'ẞ', 'SS'), '&', ' AND '), '[^\\p{L}\\p{N}_]+', ' ', 'g')) AS name FROM raw)"""
def _valid_sql(n: str) -> str:
    """Whether a normalised name, with # for its numbers, is a destination."""
    bad = (f"regexp_matches({n}, '^({'|'.join(names.BAD_PREFIXES)})')", f"regexp_matches({n}, '({'|'.join(dict.fromkeys(names.BAD_SUFFIXES))})$')")
    listed = ", ".join(f"'{x}'" for x in dict.fromkeys(names.BAD_NAMES))
    return f"length({n}) > 1 AND NOT {bad[0]} AND NOT {bad[1]} AND {n} NOT IN ({listed})"


def _raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("doc_id") % 7
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.concat(F.trim(F.col("text")), F.when(m == 0, " & sons 12").when(m == 1, " fishing").when(m == 2, " 99 for order").otherwise("")).alias("name"))
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select((-1 - F.col("n_nationkey")).cast("long").alias("doc_id"), F.col("n_name").alias("name"))
    own = spark.createDataFrame([(-100, "B 12 & A"), (-101, "sar boat"), (-102, "a"), (-103, "no destination")], "doc_id long, name string")
    return d.unionByName(n).unionByName(own)


@query("f4_name_normalize", f"WITH {_NAMES_SQL} SELECT doc_id, name FROM nrm")
def _(spark, sf_dir):
    return _raw_names(spark, sf_dir).select("doc_id", names.normalize_name(F.col("name")).alias("name"))


@query("f5_valid_names", f"WITH {_NAMES_SQL} SELECT doc_id, {_valid_sql('n')} AS valid FROM (SELECT doc_id, regexp_replace(name, '\\p{{Nd}}+', '#', 'g') AS n FROM nrm)")
def _(spark, sf_dir):
    return _raw_names(spark, sf_dir).select("doc_id", names.is_valid_name(names.normalize_name(F.col("name"))).alias("valid"))


@query("f7_normalize_label", f"WITH {_NAMES_SQL} SELECT doc_id, replace(upper(strip_accents(trim(name, ' ' || chr(9) || chr(10) || chr(13)))), 'ẞ', 'SS') AS label FROM raw")
def _(spark, sf_dir):
    return _raw_names(spark, sf_dir).select("doc_id", names.normalize_label(F.col("name")).alias("label"))


# ---- naming -----------------------------------------------------------------------------------------------------------------


def _port_lists(spark: SparkSession) -> DataFrame:
    """Two lists around the ports: near and far entries, ties, blanks."""
    p = ports(spark)
    k = F.col("k").cast("string")
    over = p.where("k % 4 = 0").select(F.lit("anchorage_overrides").alias("source"), F.lit(0).alias("list_no"), F.col("k").alias("row_no"), F.lit("AAA").alias("iso3"), F.concat(F.lit("over "), k).alias("label"), F.concat(F.lit("pier "), k).alias("sublabel"), (F.col("lat") + 0.005).alias("lat"), "lon")
    rest = p.where("k % 3 < 2").select(F.lit("world").alias("source"), F.lit(1).alias("list_no"), F.col("k").alias("row_no"), F.lit("").alias("iso3"), F.concat(F.lit("world "), k).alias("label"), F.lit("berth").alias("sublabel"), (F.col("lat") + 0.02).alias("lat"), "lon")
    twin = rest.where("row_no < 6").select("source", "list_no", (F.col("row_no") + 100).alias("row_no"), "iso3", F.concat(F.lit("twin "), F.col("row_no").cast("string")).alias("label"), "sublabel", "lat", "lon")
    return over.unionByName(rest).unionByName(twin)


PORTS_SQL = """lst AS (SELECT 'anchorage_overrides' AS source, 0 AS list_no, k AS row_no, 'AAA' AS iso3, 'over ' || k AS label, 'pier ' || k AS sublabel, lat + 0.005::DOUBLE AS lat, lon FROM prt WHERE k % 4 = 0
  UNION ALL SELECT 'world', 1, k, '', 'world ' || k, 'berth', lat + 0.02::DOUBLE, lon FROM prt WHERE k % 3 < 2 UNION ALL SELECT 'world', 1, k + 100, '', 'twin ' || k, 'berth', lat + 0.02::DOUBLE, lon FROM prt WHERE k % 3 < 2 AND k < 6)"""
NAMED_SQL = f"""{ANCHORAGES_SQL}, {PORTS_SQL}, ll AS (SELECT c.s2id, c.lat AS alat, c.lon AS alon, coalesce(t.name, '') AS top_destination FROM cells c LEFT JOIN top t USING (s2id)),
near AS (SELECT a.s2id, l.*, {hav("a.alat", "a.alon", "l.lat", "l.lon")} AS dist FROM ll a JOIN lst l ON {hav("a.alat", "a.alon", "l.lat", "l.lon")} <= 4.0),
best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY s2id ORDER BY list_no, dist, row_no DESC) = 1),
lab AS (SELECT a.s2id, a.alat AS lat, a.alon AS lon, coalesce(nullif(upper(CASE WHEN b.s2id IS NOT NULL THEN b.label ELSE a.top_destination END), ''), a.s2id) AS label, nullif(upper(CASE WHEN b.dist <= 1.0 THEN b.sublabel ELSE '' END), '') AS sublabel, nullif(b.iso3, '') AS iso3, coalesce(b.source, 'top_destination') AS label_source FROM ll a LEFT JOIN best b USING (s2id)),
pol AS (SELECT i AS file_order, CASE WHEN i % 4 = 0 THEN 'CHN' WHEN i % 4 = 3 THEN '-' ELSE 'C' || i END AS iso3, -124.5 + 20 * i AS x0, -104.5 + 20 * i AS x1, -40.0 AS y0, 40.0 AS y1 FROM range(10) t(i)),
cty AS (SELECT l.s2id, nullif(arg_min(p.iso3, p.file_order), '-') AS found FROM lab l JOIN pol p ON l.lon BETWEEN p.x0 AND p.x1 AND l.lat BETWEEN p.y0 AND p.y1 GROUP BY l.s2id),
ctr AS (SELECT l.* EXCLUDE (iso3), coalesce(l.iso3, c.found) AS iso3 FROM lab l LEFT JOIN cty c USING (s2id)),
chn AS (SELECT s2id, lat, lon, CASE WHEN coalesce(iso3 = 'CHN' AND label_source <> 'anchorage_overrides', false) THEN s2id ELSE label END AS label, sublabel, CASE WHEN coalesce(iso3 = 'CHN' AND label_source <> 'anchorage_overrides', false) THEN 'china_s2id_override' ELSE label_source END AS label_source, iso3 FROM ctr)"""


def _polygons(spark: SparkSession) -> DataFrame:
    """Ten rectangles side by side; neighbours share an edge."""
    p = spark.range(10).select(F.col("id").cast("int").alias("file_order"), (F.col("id") * 20 - 124.5).alias("x0"), (F.col("id") * 20 - 104.5).alias("x1"))
    point = lambda x, y: F.struct(x.alias("lon"), F.lit(y).alias("lat"))
    ring = F.array(point(F.col("x0"), -40.0), point(F.col("x1"), -40.0), point(F.col("x1"), 40.0), point(F.col("x0"), 40.0), point(F.col("x0"), -40.0))
    ter = F.when(F.col("file_order") % 4 == 3, "-").when(F.col("file_order") % 4 == 1, F.concat(F.lit("C"), F.col("file_order").cast("string"))).otherwise("")
    return p.select("file_order", ter.alias("iso_ter1"), F.when(F.col("file_order") % 4 == 0, "CHN").otherwise(F.concat(F.lit("C"), F.col("file_order").cast("string"))).alias("iso_sov1"), F.array(ring).alias("rings"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.add_labels(_anchorages(spark, sf_dir), _port_lists(spark), CFG)


@query("j8_priority_ports", f"WITH RECURSIVE {NAMED_SQL} SELECT s2id, label, sublabel, iso3, label_source FROM lab")
def _(spark, sf_dir):
    return _labelled(spark, sf_dir).select("s2id", "label", "sublabel", "iso3", "label_source")


@query("j9_country", f"WITH RECURSIVE {NAMED_SQL} SELECT s2id, label, iso3, label_source FROM chn")
def _(spark, sf_dir):
    return naming.add_countries(_labelled(spark, sf_dir), _polygons(spark), CFG).select("s2id", "label", "iso3", "label_source")


def _overrides(spark: SparkSession) -> DataFrame:
    """An override for every port: some on cells with anchorages, some to remove."""
    k = F.col("k")
    return ports(spark).select(F.lit("BBB").alias("iso3"), F.when(k % 4 == 0, "REMOVE").otherwise(F.concat(F.lit("new "), k.cast("string"))).alias("label"), F.lit("").alias("sublabel"), F.when(k % 2 == 0, F.col("lat")).otherwise(F.col("lat") + 1).alias("lat"), "lon")


@query("j12_at_dock", f"WITH RECURSIVE {NAMED_SQL} SELECT l.s2id, EXISTS (SELECT 1 FROM pol p WHERE p.file_order < 5 AND l.lon BETWEEN p.x0 AND p.x1 AND l.lat BETWEEN p.y0 AND p.y1) AS at_dock FROM lab l")
def _(spark, sf_dir):
    return polygons.at_dock(_anchorages(spark, sf_dir), _polygons(spark).where("file_order < 5")).select("s2id", "at_dock")


# ---- the rest ---------------------------------------------------------------------------------------------------------------


@query("f20_land_mask", f"WITH {TRACKS_SQL} SELECT event_id, len(list_filter([10 + d, 20 + d, 40, 60 + d % 5], lambda x: x <= c % 80)) % 2 = 1 AS land FROM trk")
def _(spark, sf_dir):
    t = tracks(spark, sf_dir)
    rows = F.array(F.lit(10) + F.col("d"), F.lit(20) + F.col("d"), F.lit(40).cast("long"), F.lit(60) + F.col("d") % 5)
    return t.select("event_id", ids.mask_hit(rows, F.col("c") % 80).alias("land"))


@query("f19_day_list", "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS day FROM generate_series(DATE '2024-01-01', DATE '2024-01-29', INTERVAL 1 DAY) t(d)")
def _(spark, sf_dir):
    return spark.range(1).select(F.explode(ids.day_list(F.lit(START), F.lit(END))).alias("day")).select(F.col("day").cast("string").alias("day"))


@query("w1_visit_rank", f"WITH {VISITS_SQL} SELECT visit_id, row_number() OVER (PARTITION BY vessel_id ORDER BY start_us, end_us, visit_id) AS rn FROM visits")
def _(spark, sf_dir):
    w = Window.partitionBy("vessel_id").orderBy("start_timestamp", "end_timestamp", "visit_id")
    return vessel_visits(spark, sf_dir).select("visit_id", F.row_number().over(w).cast("long").alias("rn"))


@query("k1_partitioned_roundtrip", f"WITH {TRACKS_SQL} SELECT seg_id AS identifier, epoch_us(ts) AS timestamp, CAST(day AS VARCHAR) AS date FROM trk")
def _(spark, sf_dir):
    path = _path(spark, "k1")
    sinks.write_thinned(_thinned_like(spark, sf_dir), path)
    return spark.read.parquet(path).select("identifier", us("timestamp"), F.col("date").cast("string").alias("date"))


def _thinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.thin_port_messages(tracks(spark, sf_dir), ports(spark), CFG, START, END)


THIN_SQL = f"""{NEAREST_SQL}, td AS (SELECT * FROM nr QUALIFY row_number() OVER (PARTITION BY seg_id, day, ts ORDER BY speed, lat, lon) = 1), {state_sql("td", "seg_id, day", "ts, speed, lat, lon", "m")},
k AS (SELECT *, row_number() OVER w = 1 AS first, lead(1) OVER w IS NULL AS last, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 14400000000, false) AS gap, coalesce(lag(state) OVER w <> state, false) AS turn FROM m_state WINDOW w AS (PARTITION BY seg_id, day ORDER BY ts, speed, lat, lon)),
q AS (SELECT *, first OR last OR turn OR gap OR coalesce(lead(turn) OVER w, false) OR coalesce(lead(gap) OVER w, false) AS keep FROM k WINDOW w AS (PARTITION BY seg_id, day ORDER BY ts, speed, lat, lon)),
thin AS (SELECT seg_id, ts, lat, lon, speed, first OR gap AS is_possible_gap_end, port_s2id, port_dist, port_lat, port_lon FROM q WHERE keep)"""
E4_SQL = (
    THIN_SQL
    + ",\nids AS (SELECT DISTINCT seg_id, ssvid, vessel_id FROM trk WHERE d % 10 < 9),\nrec AS (SELECT t.*, i.ssvid, i.vessel_id, 0 AS event_id FROM thin t JOIN ids i USING (seg_id)),\n"
    + state_sql("rec", "vessel_id", ORDER5, "s")
    + VISITS_SQL[len(GAPS_SQL) :]
)


@query("e3_thin_port_messages", f"WITH {THIN_SQL} SELECT seg_id AS identifier, epoch_us(ts) AS timestamp, round(lat, 6) AS lat, round(lon, 6) AS lon, is_possible_gap_end, port_s2id, round(port_dist, 6) AS port_dist FROM thin")
def _(spark, sf_dir):
    return _thinned(spark, sf_dir).select("identifier", us("timestamp"), r6("lat"), r6("lon"), "is_possible_gap_end", "port_s2id", r6("port_dist"))


@query("e4_port_visits", f"WITH {E4_SQL} SELECT visit_id, ssvid, vessel_id, start_us AS start_timestamp, end_us AS end_timestamp, n_events, confidence FROM visits")
def _(spark, sf_dir):
    v = pipelines.visits(_thinned(spark, sf_dir), _vessel_ids(spark, sf_dir), CFG, START, END)
    return v.select("visit_id", "ssvid", "vessel_id", us("start_timestamp"), us("end_timestamp"), "n_events", "confidence")


#: The whole entry point: the period and anchorage SQL over joined and thinned positions in place of the plain tracks.
E1_SQL = (
    SEGMENTS_SQL
    + """, jn AS (SELECT t.ssvid, t.event_id, t.ts, t.lat, t.lon, t.speed, s.destination AS event_type FROM trk t JOIN seg s USING (seg_id, day)),
jl AS (SELECT *, epoch_us(ts) AS t, row_number() OVER (PARTITION BY ssvid ORDER BY ts, speed, lat, lon) AS rn FROM jn WHERE ssvid IN (SELECT ssvid FROM jn GROUP BY ssvid HAVING count(*) >= 20)),
th AS (SELECT event_id, ssvid, rn, t AS kept, true AS keep FROM jl WHERE rn = 1 UNION ALL SELECT j.event_id, j.ssvid, j.rn, CASE WHEN j.t - th.kept >= 300000000 THEN j.t ELSE th.kept END, j.t - th.kept >= 300000000 FROM th JOIN jl j ON j.ssvid = th.ssvid AND j.rn = th.rn + 1),
kept AS (SELECT j.* EXCLUDE (rn) FROM jl j JOIN th USING (event_id) WHERE th.keep)"""
    + ANCHORAGES_SQL[len(TRACKS_SQL) :].replace("AS rn FROM trk)", "AS rn FROM kept)", 1)
)


@query(
    "e1_anchorages",
    f"WITH RECURSIVE {E1_SQL} SELECT s2id, lat, lon, total_visits, drift_radius, top_destination, ns AS unique_stationary_ssvid, nf AS unique_stationary_fishing_ssvid, na AS unique_active_ssvid, nt AS unique_total_ssvid, round(ds, 6) AS stationary_ssvid_days, round(df, 6) AS stationary_fishing_ssvid_days, da AS active_ssvid_days FROM anc",
)
def _(spark, sf_dir):
    fishing = spark.read.parquet(f"{sf_dir}/events.parquet").where("user_id % 3 = 0").select(F.col("user_id").cast("string").alias("ssvid"))
    a = pipelines.anchorages(tracks(spark, sf_dir), segments(spark, sf_dir), fishing, SPARSE, START, END)
    return _rounded(a)


# ---- whole naming, stored tables and files ----------------------------------------------------------------------------------


def _path(spark: SparkSession, name: str) -> str:
    """A new place in the folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/quayside-{name}-{uuid.uuid4().hex}"


def _stored_anchorages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that the first entry point leaves for the second one."""
    path = _path(spark, "anchorages")
    sinks.write_table(_anchorages(spark, sf_dir), path)
    return spark.read.parquet(path)


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.name_anchorages(_stored_anchorages(spark, sf_dir), _port_lists(spark), _overrides(spark), _polygons(spark), CFG)


OVERRIDES_SQL = f"""ov0 AS (SELECT CASE WHEN k % 4 = 0 THEN 'REMOVE' ELSE 'NEW ' || k END AS label, CASE WHEN k % 2 = 0 THEN lat ELSE lat + 1 END AS lat, lon FROM prt), {s2_sql("ov0", "lat", "lon", 14, "v")}"""


@query(
    "j10_overrides",
    f"""WITH RECURSIVE {NAMED_SQL}, {OVERRIDES_SQL}
SELECT s2id, label, iso3, label_source FROM chn WHERE NOT (label = 'REMOVE' AND label_source = 'anchorage_overrides') UNION ALL SELECT v_token, label, 'BBB', 'anchorage_overrides' FROM v_tok WHERE v_token NOT IN (SELECT s2id FROM chn) AND label <> 'REMOVE'""",
)
def _(spark, sf_dir):
    return _named(spark, sf_dir).select("s2id", "label", "iso3", "label_source")


@query(
    "e2_name_anchorages",
    f"""WITH RECURSIVE {NAMED_SQL}, {OVERRIDES_SQL}
SELECT s2id, a.lat, a.lon, c.label, c.sublabel, c.iso3, c.label_source, total_visits, a.drift_radius, a.top_destination, ns AS unique_stationary_ssvid, nf AS unique_stationary_fishing_ssvid, na AS unique_active_ssvid, nt AS unique_total_ssvid, da AS active_ssvid_days, round(ds, 6) AS stationary_ssvid_days, round(df, 6) AS stationary_fishing_ssvid_days
FROM chn c JOIN anc a USING (s2id) WHERE NOT (c.label = 'REMOVE' AND c.label_source = 'anchorage_overrides')
UNION ALL SELECT v_token, round(lat, 9), round(lon, 9), label, NULL, 'BBB', 'anchorage_overrides', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM v_tok WHERE v_token NOT IN (SELECT s2id FROM chn) AND label <> 'REMOVE'""",
)
def _(spark, sf_dir):
    return _rounded(_named(spark, sf_dir))


#: Two shapes on a grid of half degrees: a notched block with a hole, and two blocks of one polygon, one of them in the hole.
_RINGS = (
    (0, "AAA", ((-60.0, -40.0), (60.0, -40.0), (60.0, 40.0), (20.0, 40.0), (20.0, 0.0), (0.0, 10.0), (-20.0, 40.0), (-60.0, 40.0), (-60.0, -40.0))),
    (0, "AAA", ((-50.0, -30.0), (-30.0, -30.0), (-30.0, -10.0), (-50.0, -10.0), (-50.0, -30.0))),
    (1, "BBB", ((-45.0, -25.0), (-35.0, -25.0), (-35.0, -15.0), (-45.0, -15.0), (-45.0, -25.0))),
    (1, "BBB", ((50.0, 30.0), (120.0, 30.0), (85.0, 65.0), (50.0, 30.0))),
)
_EDGES_SQL = ", ".join(f"({n}, '{iso}', {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for n, iso, ring in _RINGS for a, b in zip(ring, ring[1:], strict=False))


@query(
    "j9_shapes",
    f"""WITH edge(file_order, iso3, x1, y1, x2, y2) AS (VALUES {_EDGES_SQL}),
pt AS (SELECT event_id, CAST(event_id * 7 % 720 AS DOUBLE) / 2 - 180 AS x, CAST(event_id * 13 % 360 AS DOUBLE) / 2 - 90 AS y FROM events),
uq AS (SELECT DISTINCT x, y FROM pt),
inn AS (SELECT x, y, file_order, iso3 FROM uq CROSS JOIN edge GROUP BY ALL
  HAVING bool_or((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2))
      OR sum(CASE WHEN (y1 > y) <> (y2 > y) THEN CASE WHEN x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END ELSE 0 END) % 2 = 1)
SELECT event_id, min(file_order) AS file_order, arg_min(iso3, file_order) AS iso3 FROM pt JOIN inn USING (x, y) GROUP BY event_id""",
)
def _(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("s2id"), (F.col("event_id") * 13 % 360 / 2 - 90).alias("lat"), (F.col("event_id") * 7 % 720 / 2 - 180).alias("lon"))
    shape = lambda n: [[{"lon": x, "lat": y} for x, y in ring] for m, _, ring in _RINGS if m == n]
    p = spark.createDataFrame([(0, "", "AAA", shape(0)), (1, "BBB", "CCC", shape(1))], "file_order int, iso_ter1 string, iso_sov1 string, rings array<array<struct<lon:double,lat:double>>>")
    return polygons.first_polygon(e, p).withColumnRenamed("s2id", "event_id")


@query("o7_table_scan", f"WITH RECURSIVE {ANCHORAGES_SQL} SELECT s2id, total_visits, nt AS unique_total_ssvid FROM anc")
def _(spark, sf_dir):
    return _stored_anchorages(spark, sf_dir).select("s2id", "total_visits", "unique_total_ssvid")


@query("o1_query_source", "SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE event_type <> 'click' GROUP BY user_id")
def _(spark, sf_dir):
    return scans.query_source(spark, f"SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM parquet.`{sf_dir}/events.parquet` WHERE event_type <> 'click' GROUP BY user_id")


@query("o4_filter_text", f"WITH {TRACKS_SQL} SELECT seg_id AS ident, ssvid, epoch_us(ts) AS timestamp FROM trk WHERE ssvid IN (SELECT DISTINCT CAST(user_id AS VARCHAR) FROM events WHERE value > 95)")
def _(spark, sf_dir):
    wanted = f"SELECT DISTINCT CAST(user_id AS STRING) FROM parquet.`{sf_dir}/events.parquet` WHERE value > 95"
    return scans.thinning_positions(tracks(spark, sf_dir), START, END, wanted).select("ident", "ssvid", us("timestamp"))


@query("o9_text_lines", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS ssvid FROM events")
def _(spark, sf_dir):
    path = _path(spark, "lines")
    spark.read.parquet(f"{sf_dir}/events.parquet").select(F.concat(F.lit("  "), F.col("user_id").cast("string"), F.lit(" ")).alias("value")).distinct().write.text(path)
    return scans.lines(spark, path)


@query("o10_port_list", f"WITH {TRACKS_SQL}, {PORTS_SQL} SELECT label, sublabel, nullif(iso3, '') AS iso3, round(lat, 6) AS lat, round(lon, 6) AS lon FROM lst")
def _(spark, sf_dir):
    path = _path(spark, "ports")
    _port_lists(spark).coalesce(1).select("iso3", "label", "sublabel", "lat", "lon", F.lit("x").alias("category")).write.csv(path, header=True)
    return scans.port_list(spark, path).select("label", "sublabel", "iso3", r6("lat"), r6("lon"))


@query("o10_override_list", f"WITH {TRACKS_SQL}, {OVERRIDES_SQL} SELECT v_token AS s2id, CASE WHEN label = 'REMOVE' THEN label ELSE lower(label) END AS label FROM v_tok")
def _(spark, sf_dir):
    path = _path(spark, "overrides")
    _overrides(spark).coalesce(1).select("iso3", "label", "sublabel", "lat", "lon", F.lit("").alias("category")).write.csv(path, header=True)
    return scans.override_list(spark, path).select("s2id", "label")


@query("o11_day_chunks", "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS first, CAST(CAST(least(d + INTERVAL 999 DAY, DATE '2023-12-31') AS DATE) AS VARCHAR) AS last FROM generate_series(DATE '2012-01-01', DATE '2023-12-31', INTERVAL 1000 DAY) t(d)")
def _(spark, sf_dir):
    return spark.createDataFrame([(str(a), str(b)) for a, b in scans.day_chunks(dt.date(2012, 1, 1), dt.date(2023, 12, 31))], "first string, last string")


@query("o27_mean_or_zero", f"WITH {TRACKS_SQL} SELECT ssvid, round(coalesce(avg(CASE WHEN c % 40 = 0 THEN lat END), 0), 6) AS mean_lat FROM trk GROUP BY ssvid")
def _(spark, sf_dir):
    return tracks(spark, sf_dir).groupBy("ssvid").agg(F.round(records.mean_or_zero(F.when(F.col("c") % 40 == 0, F.col("lat"))), 6).alias("mean_lat"))


#: Few events are shown, so that the middle of most visits is left out.
BRIEF = Config(max_events=4)


@query(
    "o30_visit_events",
    f"""WITH {VISITS_SQL}, sn AS (SELECT *, row_number() OVER (PARTITION BY vessel_id, visit_no ORDER BY seq) AS nth, count(*) OVER (PARTITION BY vessel_id, visit_no) AS n FROM vn)
SELECT visit_id, row_number() OVER (PARTITION BY s.vessel_id, s.visit_no ORDER BY seq) - 1 AS at, seg_id, ts_us AS timestamp, round(lat, 6) AS lat, round(lon, 6) AS lon, round(vessel_lat, 6) AS vessel_lat, round(vessel_lon, 6) AS vessel_lon, anchorage_id, event_type
FROM sn s JOIN visits v ON v.vessel_id = s.vessel_id AND v.visit_no = s.visit_no WHERE n <= 4 OR nth <= 2 OR nth > n - 2""",
)
def _(spark, sf_dir):
    v = visits.port_visits(vessel_events(spark, sf_dir), BRIEF).select("visit_id", F.posexplode("events").alias("at", "e")).select("visit_id", F.col("at").cast("long").alias("at"), "e.*")
    return v.select("visit_id", "at", "seg_id", us("timestamp"), r6("lat"), r6("lon"), r6("vessel_lat"), r6("vessel_lon"), "anchorage_id", "event_type")


_ENDS_SQL = "start_us AS start_timestamp, start_anchorage_id, end_us AS end_timestamp, end_anchorage_id"


@query("o19_old_fields", f"WITH {VISITS_SQL} SELECT visit_id, vessel_id, {_ENDS_SQL}, n_events, round(start_lat, 6) AS start_lat, round(start_lon, 6) AS start_lon, round(end_lat, 6) AS end_lat, round(end_lon, 6) AS end_lon FROM visits")
def _(spark, sf_dir):
    v = visits.drop_new_fields(vessel_visits(spark, sf_dir)).drop("events")
    return v.withColumns({c: F.unix_micros(c) if c.endswith("timestamp") else F.round(c, 6) for c in v.columns if c.endswith(("timestamp", "lat", "lon"))})


@query("k4_visits_by_month", f"WITH {VISITS_SQL} SELECT visit_id, vessel_id, {_ENDS_SQL}, confidence, strftime(make_timestamp(end_us), '%Y-%m') || '-01' AS month FROM visits")
def _(spark, sf_dir):
    path = _path(spark, "visits")
    sinks.write_visits(vessel_visits(spark, sf_dir), path)
    return spark.read.parquet(path).select("visit_id", "vessel_id", us("start_timestamp"), "start_anchorage_id", us("end_timestamp"), "end_anchorage_id", "confidence", F.col("month").cast("string").alias("month"))


@query("k7_voyages_replaced", SQL["e5_voyages_c4"].replace("SELECT coalesce(b.ssvid, a.ssvid) AS ssvid, ", "SELECT ", 1))
def _(spark, sf_dir):
    path = _path(spark, "voyages")
    for c in (2, 4):  # the second run replaces the first one's table
        sinks.write_table(pipelines.generate_voyages(vessel_visits(spark, sf_dir), c), path)
    return spark.read.parquet(path).drop("ssvid").withColumns({"trip_start": F.unix_micros("trip_start"), "trip_end": F.unix_micros("trip_end")})


_NORM_SQL = "trim(regexp_replace(replace(replace(upper(x), 'ẞ', 'SS'), '&', ' AND '), '[^\\p{L}\\p{N}_]+', ' ', 'g'))"


@query(
    "f6_valid_name_lists",
    f"WITH {_NAMES_SQL}, parts AS (SELECT doc_id, list_transform(string_split(name, '. '), lambda x: {_NORM_SQL}) AS l FROM raw) SELECT doc_id, array_to_string(list_filter(l, lambda y: {_valid_sql("regexp_replace(y, '[0-9]+', '#', 'g')")}), '|') AS names FROM parts",
)
def _(spark, sf_dir):
    return _raw_names(spark, sf_dir).select("doc_id", F.array_join(names.normalized_valid_names(F.split("name", r"\. ")), "|").alias("names"))


#: Names in other scripts with the labels that the public transliteration rules give.
_SCRIPTS = (("上海", "SHANG HAI"), ("한국", "HANGUG"), ("Київ", "KIIV"), ("Спецморнефтепорт", "SPETSMORNEFTEPORT"), ("Tromsø", "TROMSO"), ("Πάτρα", "PATRA"), ("Łódź", "LODZ"), ("İzmir", "IZMIR"), ("とうきょう", "TOUKIYOU"), (" ", None))


@query("f7_other_scripts", "SELECT name, label FROM (VALUES " + ", ".join(f"('{a}', {'NULL' if b is None else repr(b)})" for a, b in _SCRIPTS) + ") t(name, label)")
def _(spark, sf_dir):
    return spark.createDataFrame([(a,) for a, _ in _SCRIPTS], "name string").select("name", names.normalize_label(F.col("name")).alias("label"))


@query(
    "f20_mask_lookup",
    "WITH pt AS (SELECT event_id, CAST(event_id * 7 % 760 AS DOUBLE) / 2 - 190 AS lon, CAST(event_id * 13 % 400 AS DOUBLE) / 2 - 100 AS lat FROM events), ix AS (SELECT *, least(35, floor((90 - lat) / 5)) AS r, least(71, floor((lon + 180) / 5)) AS c FROM pt) SELECT event_id, abs(lat) <= 90 AND abs(lon) <= 180 AND CAST(r * 5 + c AS BIGINT) // 7 % 3 = 0 AS land FROM ix",
)
def _(spark, sf_dir):
    bits = F.transform(F.sequence(F.lit(0), F.lit(71)), lambda c: F.floor((F.col("id") * 5 + c) / 7) % 3 == 0)
    mask = spark.range(36).select(F.col("id").cast("int").alias("row"), ids.mask_row(bits).alias("changes"))
    lat, lon = F.col("event_id") * 13 % 400 / 2 - 100, F.col("event_id") * 7 % 760 / 2 - 190
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", lat.alias("lat"), lon.alias("lon"))
    d = e.withColumn("row", ids.mask_row_index(F.col("lat"), 36)).join(mask, "row", "left")
    return d.select("event_id", F.coalesce(ids.mask_lookup(F.col("changes"), F.col("lat"), F.col("lon"), 36, 72), F.lit(False)).alias("land"))
