"""python -m quayside {anchorages,name_anchorages,thin_port_messages,port_visits,generate_confidence_voyages} ..."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from quayside.config import load_config
from quayside.plans import pipelines
from quayside.shipping import ship
from quayside.sources import scans, sinks


def main(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="quayside")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str, dates: bool = False) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for x in paths:
            p.add_argument(f"--{x}", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--config", help="settings in YAML or JSON")
        if dates:
            p.add_argument("--start_date", type=dt.date.fromisoformat, required=True)
            p.add_argument("--end_date", type=dt.date.fromisoformat, required=True)
        return p

    command("anchorages", "positions", "segments", "fishing_ssvid_list", dates=True)
    p = command("name_anchorages", "input", "polygons")
    p.add_argument("--override_list")
    p.add_argument("--port_list", action="append", default=[])
    p = command("thin_port_messages", "positions", "anchorages", dates=True)
    p.add_argument("--ssvid_list")
    p.add_argument("--ssvid_filter", help="a SQL list or subquery of ids; @path reads it from a file")
    p = command("port_visits", "thinned", "vessel_ids", dates=True)
    p.add_argument("--bad_segments")
    p.add_argument("--bad_segs", help="a SQL query of bad segments' ids")
    p.add_argument("--max_inter_seg_dist_nm", type=float, default=60.0)
    p = command("generate_confidence_voyages", "input")
    p.add_argument("-c", "--min_confidence", type=int, choices=(2, 3, 4), default=2)
    a = top.parse_args(argv)
    spark = SparkSession.builder.appName(f"quayside {a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    read = spark.read.parquet
    config = load_config(a.config, **({"max_interseg_nm": a.max_inter_seg_dist_nm} if a.command == "port_visits" else {}))
    if a.command == "anchorages":
        sinks.write_table(pipelines.anchorages(read(a.positions), read(a.segments), scans.lines(spark, a.fishing_ssvid_list), config, a.start_date, a.end_date), a.output)
    elif a.command == "name_anchorages":
        own = a.override_list or config.override_path
        if own is None:
            top.error("name_anchorages needs --override_list, or override_path in --config")
        ports = scans.port_list(spark, own, 0)
        for i, path in enumerate(a.port_list or config.port_lists, 1):
            ports = ports.unionByName(scans.port_list(spark, path, i))
        polygons = (scans.geojson_polygons if a.polygons.endswith("json") else scans.polygons)(spark, a.polygons)
        sinks.write_table(pipelines.name_anchorages(read(a.input), ports, scans.override_list(spark, own), polygons, config), a.output)
    elif a.command == "thin_port_messages":
        ids = scans.filter_text(spark, a.ssvid_filter) if a.ssvid_filter else scans.lines(spark, a.ssvid_list) if a.ssvid_list else None
        sinks.write_thinned(pipelines.thin_port_messages(read(a.positions), read(a.anchorages), config, a.start_date, a.end_date, ids), a.output)
    elif a.command == "port_visits":
        bad = scans.query_source(spark, a.bad_segs) if a.bad_segs else read(a.bad_segments) if a.bad_segments else None
        sinks.write_visits(pipelines.visits(read(a.thinned), read(a.vessel_ids), config, a.start_date, a.end_date, bad), a.output)
    else:
        sinks.write_table(pipelines.generate_voyages(read(a.input), a.min_confidence), a.output)


if __name__ == "__main__":
    main()
