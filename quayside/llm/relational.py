"""The piece lattice as a Spark plan: substrings exploded, equi-joined to the piece table, grouped by word, folded by `aggregate`.

It gives the same ids as `pieces` (tests compare them). Use it on tables of distinct words. Over whole documents the
occurrences of words must be exchanged twice, which outgrows the disk that the check tool allows (README has the figures), so
op7 encodes with `pieces`.

Defined cases are those of `pieces`; null words are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.pieces import SPACE, PieceModel, space_run

_EDGE = "start int, len int, id int, rank long, right array<struct<len:int,rank:long,until:long>>, left array<struct<len:int,rank:long,until:long>>"


def piece_table(spark: SparkSession, m: PieceModel) -> DataFrame:
    """piece, id, rank, and what lies at its right and left end while it is built. One row for each piece: bounded."""

    def ends(table: tuple, i: int) -> list[tuple[int, int, int]]:
        return [(int(m.length[x]), int(m.rank[x]), int(u)) for x, u in zip(table[0][i], table[1][i], strict=True) if x >= 0]

    rows = [(t, i, int(m.rank[i]), ends(m.right, i), ends(m.left, i)) for i, t in enumerate(m.text) if t is not None]
    return spark.createDataFrame(rows, "piece string, id int, rank long, right array<struct<len:int,rank:long,until:long>>, left array<struct<len:int,rank:long,until:long>>")


def _conflict(edges: Column, p: Column, q: Column) -> Column:
    """Whether p, ending where q starts, would have merged with it: some piece across the cut merges before both sides are taken up."""

    def across(c: Column) -> Column:
        meets = lambda a, b: (b["len"] == c["start"] + c["len"] - q["start"]) & (c["rank"] < a["until"]) & (c["rank"] <= b["until"]) & (a["rank"] < b["until"]) & (b["rank"] < a["until"])
        return (c["start"] < q["start"]) & (c["start"] + c["len"] > q["start"]) & F.exists(p["right"], lambda a: (a["len"] == q["start"] - c["start"]) & F.exists(q["left"], lambda b: meets(a, b)))

    return F.exists(edges, across)


def encode_words(words: DataFrame, pieces: DataFrame, longest: int, bytes_at: int, partitions: int) -> DataFrame:
    """word -> (word, ids). words: distinct non-empty words."""
    # The grouping below finds its rows together already: explode and broadcast join keep this partitioning.
    w = words.select("word").where(F.col("word") != "").repartition(partitions, "word")
    e = w.withColumn("start", F.explode(F.sequence(F.lit(0), F.char_length("word") - 1)))
    e = e.withColumn("len", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.char_length("word") - F.col("start")))))
    e = e.withColumn("sub", F.substring("word", F.col("start") + 1, F.col("len")))
    e = e.join(F.broadcast(pieces), e.sub == pieces.piece, "left").where(F.col("id").isNotNull() | (F.col("len") == 1))
    alone = F.array(F.struct(F.lit(1).alias("len"), F.lit(-1).cast("long").alias("rank"), F.lit(1 << 30).cast("long").alias("until")))
    edge = F.struct("start", "len", F.coalesce("id", F.lit(-1)).alias("id"), F.coalesce("rank", F.lit(-1)).cast("long").alias("rank"), F.coalesce("right", alone).alias("right"), F.coalesce("left", alone).alias("left"))
    g = e.groupBy("word").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    begin = F.transform(F.sequence(F.lit(0), F.char_length("word")), lambda j: F.when(j == 0, F.lit(-2)).otherwise(F.lit(-1)))
    at = F.sequence(F.lit(0), F.size("edges") - 1)

    def step(last: Column, k: Column) -> Column:
        q = F.get(F.col("edges"), k)
        here = F.get(last, q["start"])
        ok = (here == -2) | ((here >= 0) & ~_conflict(F.col("edges"), F.get(F.col("edges"), here), q))
        return F.when(ok, F.transform(last, lambda x, j: F.when(j == q["start"] + q["len"], k).otherwise(x))).otherwise(last)

    g = g.withColumn("last", F.aggregate(at, begin, step))

    def back(s: Column, _: Column) -> Column:
        e = F.get(F.col("edges"), F.get(F.col("last"), s["pos"]))
        return F.when(s["pos"] == 0, s).otherwise(F.struct((s["pos"] - e["len"]).alias("pos"), F.concat(F.array(F.struct(e["id"].alias("id"), e["start"].alias("start"))), s["path"]).alias("path")))

    none = F.array().cast("array<struct<id:int,start:int>>")
    path = F.aggregate(F.sequence(F.lit(1), F.char_length("word")), F.struct(F.char_length("word").alias("pos"), none.alias("path")), back)["path"]

    def ids(x: Column) -> Column:
        code = F.hex(F.encode(F.substring("word", x["start"] + 1, F.lit(1)), "UTF-8"))
        as_bytes = F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")), lambda i: (F.conv(F.substring(code, 2 * i + 1, F.lit(2)), 16, 10).cast("int") + bytes_at))
        return F.when(x["id"] >= 0, F.array(x["id"])).otherwise(as_bytes)

    return g.select("word", F.flatten(F.transform(path, ids)).alias("ids"))


def encode_documents(docs: DataFrame, m: PieceModel, *keep: str) -> DataFrame:
    """The columns in keep, n_pieces and ids."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    units = F.when(text != "", F.regexp_extract_all(F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE))), F.lit(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"), F.lit(0)))
    d = docs.select(*keep, units.alias("_units"), F.monotonically_increasing_id().alias("_row")).select(*keep, "_row", F.posexplode_outer("_units").alias("_at", "_unit"))
    bare = F.regexp_replace("_unit", f"^{SPACE}+", "")
    spaces = F.char_length("_unit") - F.char_length(bare)
    word = F.when(bare == "", "").when(spaces > 0, F.concat(F.lit(SPACE), bare)).otherwise(bare)
    d = d.withColumns({"word": word, "_k": F.when(bare == "", spaces).otherwise(F.greatest(F.lit(0), spaces - 1))})
    coded = encode_words(d.select("word").distinct(), piece_table(spark, m), m.longest, m.bytes_at, 8 * n)
    lone = m.by_text[SPACE]
    runs = F.array(*[F.array(*map(F.lit, space_run(m, k))) if k else F.array().cast("array<int>") for k in range(16)])
    run = lambda k: F.concat(F.flatten(F.array_repeat(F.array(*map(F.lit, m.full_run)), (k / 16).cast("int"))), F.get(runs, (k % 16).cast("int")))
    own = F.coalesce("ids", F.array().cast("array<int>"))
    joins = (F.col("_k") > 0) & F.coalesce(F.get(own, F.lit(0)) == lone, F.lit(False))
    whole = F.when(joins, F.concat(run(F.col("_k") + 1), F.slice(own, 2, F.greatest(F.lit(0), F.size(own) - 1)))).otherwise(F.concat(run(F.coalesce("_k", F.lit(0))), own))
    j = d.join(coded, "word", "left").withColumn("_ids", whole)
    out = j.groupBy("_row", *keep).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_ids"))), lambda x: x["_ids"])).alias("ids"))
    return out.select(*keep, F.size("ids").cast("long").alias("n_pieces"), "ids")
