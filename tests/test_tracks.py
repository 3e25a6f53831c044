"""Window formulations against plain sequential state machines on random tracks with ties and band values."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from quayside.config import Config
from quayside.operators import events, stationary, thinning, visits
from quayside.operators.state import with_states

CFG = Config()
T0 = dt.datetime(2020, 1, 1, tzinfo=dt.UTC)
END = dt.date(2020, 1, 8)
SCHEMA = "vessel_id string, ssvid string, seg_id string, timestamp timestamp, lat double, lon double, speed double, port_s2id string, port_dist double, port_lat double, port_lon double, is_possible_gap_end boolean"


def track(rng, vessel, n):
    at, rows = T0, []
    for _ in range(n):
        at += dt.timedelta(minutes=rng.choice([0, 5, 30, 239, 240, 600]))
        near = rng.random() < 0.8
        k = rng.randint(0, 2)
        rows.append((vessel, f"s{rng.randint(0, 1)}", f"{vessel}-{rng.randint(0, 2)}", at, rng.uniform(-1, 1), rng.choice([179.9, -179.9, 0.0]) + rng.uniform(-0.05, 0.05), rng.choice([0.1, 0.2, 0.3, 0.49, 0.5, 5.0]), f"p{k}" if near else None, rng.choice([1.0, 3.0, 3.5, 3.99, 4.0, 9.0]) if near else None, float(k) if near else None, [179.9, -179.9, 50.0][k] if near else None, rng.random() < 0.7))
    return rows


def states(rows):
    out, last = [], None
    for r in rows:
        dist = math.inf if r[8] is None else r[8]
        in_port = True if dist <= 3 else False if dist >= 4 else last in ("IN_PORT", "STOPPED")
        stopped = True if r[6] <= 0.2 else False if r[6] >= 0.5 else last == "STOPPED"
        last = "AT_SEA" if not in_port else "STOPPED" if stopped else "IN_PORT"
        out.append(last)
    return out


def machine(rows):
    """(event_type, timestamp, anchorage, vessel_lat, seg_id, ssvid, port lat, port lon) in order of emission."""
    out, last, port, before = [], None, None, None
    gap = dt.timedelta(minutes=240)
    for r, s in zip(rows, states(rows), strict=True):
        port = r[7:11:2] and (r[7], r[9], r[10]) if s != "AT_SEA" else port
        if before is not None and last in ("IN_PORT", "STOPPED") and r[11] and r[3] - before >= gap:
            out.append(("PORT_GAP_END", r[3], port, r[4], r[2], r[1]))
            out.append(("PORT_GAP_BEGIN", before + gap, port, None, r[2], r[1]))
        moves = events.TRANSITIONS.get((last, s), ()) if last else ()
        out += [(m, r[3], port, r[4], r[2], r[1]) for m in moves]
        last, before = s, r[3]
    if last in ("IN_PORT", "STOPPED") and dt.datetime(2020, 1, 9, tzinfo=dt.UTC) - dt.timedelta(microseconds=1) - before >= gap:
        out.append(("PORT_GAP_BEGIN", before + gap, port, None, rows[-1][2], rows[-1][1]))
    return out


@pytest.fixture(scope="module")
def tracks():
    rng = random.Random(9)
    return {f"v{i}": track(rng, f"v{i}", rng.choice([1, 2, 40, 60])) for i in range(40)}


@pytest.fixture(scope="module")
def frame(spark, tracks):
    return spark.createDataFrame([r for rows in tracks.values() for r in rows], SCHEMA)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[3], r[2], r[6], r[4], r[5]))


def test_states(frame, tracks):
    got = {}
    for r in with_states(frame, CFG, ("vessel_id",), events.RECORD_ORDER).collect():
        got.setdefault(r.vessel_id, []).append(((r.timestamp.astimezone(dt.UTC), r.seg_id, r.speed, r.lat, r.lon), r.state))
    for v, rows in tracks.items():
        assert [s for _, s in sorted(got[v])] == states(ordered(rows))


def test_events(frame, tracks):
    got = {}
    for r in events.port_events(frame, CFG, END).collect():
        port = (r.anchorage_id, r.lat, r.lon)
        got.setdefault(r.vessel_id, []).append((r.event_type, r.timestamp.astimezone(dt.UTC), port, r.vessel_lat, r.seg_id, r.ssvid))
    key = lambda e: tuple(map(str, e))
    n = 0
    for v, rows in tracks.items():
        want = machine(ordered(rows))
        assert sorted(got.get(v, []), key=key) == sorted(want, key=key)
        n += len(want)
    assert n > 500


def test_visits_and_voyages(frame, tracks):
    v = visits.port_visits(events.port_events(frame, CFG, END), CFG)
    rows = v.collect()
    order = {k: i for i, k in enumerate(events.TYPE_ORDER)}
    want = []
    for vessel, recs in tracks.items():
        evs = machine(ordered(recs))
        if not evs:
            continue
        ssvid = evs[0][5]
        low = lambda x: (x is not None, x or 0)
        evs.sort(key=lambda e: (e[1], order[e[0]], e[2][0], e[2][1], e[2][2], low(e[3]), e[5], e[4]))
        open_: list = []
        for e in evs:
            far = False
            if open_ and open_[-1][4] != e[4]:
                p, q = open_[-1][2], e[2]
                dlon = (q[2] - p[2] + 180) % 360 - 180
                far = math.hypot(q[1] - p[1], math.cos(math.radians((p[1] + q[1]) / 2)) * dlon) * 60 > 60
            if (e[0] == "PORT_ENTRY" or far) and open_:
                want.append((vessel, ssvid, open_))
                open_ = []
            open_ = [*open_, e]
            if e[0] == "PORT_EXIT":
                want.append((vessel, ssvid, open_))
                open_ = []
        if open_:
            want.append((vessel, ssvid, open_))

    def conf(es):
        k = {e[0] for e in es}
        still = bool(k & {"PORT_STOP_BEGIN", "PORT_STOP_END", "PORT_GAP_BEGIN", "PORT_GAP_END"})
        ends = ("PORT_ENTRY" in k) + ("PORT_EXIT" in k)
        return 2 + ends if still else 1

    mine = sorted((vessel, s, es[0][1], es[-1][1], es[0][2][0], es[-1][2][0], len(es), conf(es)) for vessel, s, es in want)
    assert mine == sorted((r.vessel_id, r.ssvid, r.start_timestamp.astimezone(dt.UTC), r.end_timestamp.astimezone(dt.UTC), r.start_anchorage_id, r.end_anchorage_id, r.n_events, r.confidence) for r in rows)
    for r in rows:
        assert [e.timestamp for e in r.events] == sorted(e.timestamp for e in r.events)
    per = {}
    for r in rows:
        if r.confidence >= 2:
            per[r.vessel_id] = per.get(r.vessel_id, 0) + 1
    trips = {}
    for r in visits.voyages(v, 2).collect():
        trips.setdefault(r.vessel_id, []).append(r)
    assert {k: len(x) for k, x in trips.items()} == {k: n + 1 for k, n in per.items()}
    for x in trips.values():
        assert sum(t.trip_start is None for t in x) == 1 and sum(t.trip_end is None for t in x) == 1


def test_null_vessels_never_join(spark):
    ts = dt.datetime(2020, 1, 1)
    rows = [(None, None, f"i{i}", ts + dt.timedelta(days=i), "a", ts + dt.timedelta(days=i, hours=1), "a", 4) for i in range(2)]
    v = spark.createDataFrame(rows, "ssvid string, vessel_id string, visit_id string, start_timestamp timestamp, start_anchorage_id string, end_timestamp timestamp, end_anchorage_id string, confidence long")
    got = visits.voyages(v, 2).collect()
    assert len(got) == 4 and all((r.trip_start is None) != (r.trip_end is None) and r.trip_id is None for r in got)


def test_many_events_are_pruned_but_all_counted(spark):
    rows = [("v", "s", "s", "g", "PORT_ENTRY" if i == 0 else "PORT_STOP_BEGIN" if i == 150 else "PORT_GAP_END", T0 + dt.timedelta(minutes=i), T0, "p", 0.0, 0.0, 0.0, 0.0) for i in range(300)]
    e = spark.createDataFrame(rows, "vessel_id string, ssvid string, visit_ssvid string, seg_id string, event_type string, timestamp timestamp, last_timestamp timestamp, anchorage_id string, lat double, lon double, vessel_lat double, vessel_lon double")
    r = visits.port_visits(e, CFG).first()
    assert len(r.events) == 200 and r.n_events == 300 and r.confidence == 3
    assert r.events[99].timestamp.minute == 39 and r.events[100].timestamp.astimezone(dt.UTC) == T0 + dt.timedelta(minutes=200)


def test_unknown_event_types_stop_the_job(spark, frame):
    bad = events.port_events(frame, CFG, END).withColumn("event_type", F.lit("PORT_PARTY"))
    with pytest.raises(Exception, match="unknown event type"):
        visits.port_visits(bad, CFG).collect()


def test_greedy_thinning(spark):
    rng = random.Random(4)
    rows = [(f"k{k}", T0 + dt.timedelta(seconds=rng.randint(0, 5000)), rng.random(), 0.0, 0.0) for k in range(5) for _ in range(60)]
    d = spark.createDataFrame(rows, "ident string, timestamp timestamp, speed double, lat double, lon double")
    want = []
    for k in range(5):
        last = None
        for r in sorted(r for r in rows if r[0] == f"k{k}"):
            if last is None or r[1] - last >= dt.timedelta(minutes=5):
                want.append((r[0], r[1]))
                last = r[1]
    assert sorted((r.ident, r.timestamp.astimezone(dt.UTC)) for r in thinning.greedy_thin(d).collect()) == sorted(want)


def test_smart_thinning(spark, frame, tracks):
    got = sorted((r.seg_id, r.timestamp.astimezone(dt.UTC), r.speed, r.lat, r.is_possible_gap_end) for r in thinning.smart_thin(frame.drop("is_possible_gap_end"), CFG).collect())
    groups, want = {}, []
    for rows in tracks.values():
        for r in rows:
            groups.setdefault((r[2], r[3].date()), []).append(r)
    for rows in groups.values():
        rows.sort(key=lambda r: (r[3], r[6], r[4], r[5]))
        keep, gap_end = set(), {0}
        for i, s in enumerate(st := states(rows)):
            if i and rows[i][3] - rows[i - 1][3] >= dt.timedelta(minutes=240):
                keep |= {i - 1, i}
                gap_end.add(i)
            if i in (0, len(rows) - 1):
                keep.add(i)
            if i and s != st[i - 1]:
                keep |= {i - 1, i}
        want += [(rows[i][2], rows[i][3], rows[i][6], rows[i][4], i in gap_end) for i in keep]
    assert got == sorted(want)


def test_stationary_split(spark):
    rng = random.Random(6)
    rows, lat = [], 0.0
    for i in range(400):
        lat += rng.choice([0, 0, 0, 0, 0.02])
        rows.append(("a" if i < 250 else "b", T0 + dt.timedelta(hours=i), lat + rng.uniform(0, 0.001), 10.0, 0.1, rng.choice(["X", "Y"])))
    d = spark.createDataFrame(rows, "ident string, timestamp timestamp, lat double, lon double, speed double, destination string")
    still, moving = stationary.split_on_movement(d, Config())
    want_still, n_moving = [], 0
    for k in "ab":
        periods: list[list] = []
        for r in (r for r in rows if r[0] == k):
            if not periods or math.radians(abs(r[2] - periods[-1][0][2])) * 6371 > 0.5:
                periods.append([])
            periods[-1].append(r)
        for i, p in enumerate(periods):
            if i < len(periods) - 1 and p[-1][1] - p[0][1] > dt.timedelta(hours=12):
                want_still.append((k, p[0][1], len(p), p[0][5]))
                n_moving += 2
            else:
                n_moving += len(p)
    assert sorted((r.ident, r.start_time.astimezone(dt.UTC), r.n, r.destination) for r in still.collect()) == sorted(want_still)
    assert moving.count() == n_moving and len(want_still) > 3
