from __future__ import annotations

from pyspark.sql import functions as F

from quayside.adapters import ports, tracks
from quayside.operators.nearest import tag_nearest
from quayside.streaming.live import tag_live, write_live


def test_a_stream_is_tagged_as_the_batch_is(spark, tmp_path):
    t = tracks(spark, "/root/testdata/sf0.001").select(F.col("ssvid").alias("ident"), "timestamp", "lat", "lon", "speed")
    t.unionByName(t.limit(50)).write.parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema(t.schema).parquet(str(tmp_path / "in"))
    anchors = ports(spark).select("s2id", "lat", "lon")
    q = write_live(tag_live(feed, anchors), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert q.awaitTermination(120)
    cols = ["ident", "timestamp", "port_s2id", "port_dist"]
    got = sorted(map(repr, spark.read.parquet(str(tmp_path / "out")).select(*cols).collect()))
    assert got == sorted(map(repr, tag_nearest(t, anchors).select(*cols).collect()))
