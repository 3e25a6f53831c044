"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words from its weight; targets above `max_repeats` times the source are cut there and the excess
goes to the others by weight. With r = target / source size, every document of the source is taken floor(r) times for certain.
The words still wanted are a sample of fixed size, measured in words, with unequal probabilities by size:
    p = min(1, size / T),   T so that the source's sum of p * size is what is wanted.
Documents of T words or more are taken for certain; so only smaller ones are left to chance, and the sample's words vary little.
Those are ranked by (u / (1 - u)) / (p / (1 - p)), u uniform from a hash of the id, the text and the seed, and taken by ascending rank
until the wanted words are reached; the document at the cut is taken if that comes nearer. So a source misses its target by at
most half a document of under T words. Nothing is filled up afterwards, so the rank alone decides.

No source is gathered in one task: T comes from a histogram of sizes, ranks are cut into equal bins, bins are summed by one
small aggregate, and only the bin that holds a source's cut is ordered. Pareto ranks gather about 1 at the cut; their odds
q / (1 + q), in which the bins are equal, spread evenly.

Defined cases: a null text has no words; a source of size 0 has target 0 and takes nothing; a null source is a source of its own, last
in order; a document without words gets the whole copies only; rows equal in id and text share a rank and are taken together; an
empty table gives an empty result; other columns are ignored (mix_documents keeps them, whatever their names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import WORD, stage

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BINS = 4096
SEED = "mix-1"
_UNIT = 1 << 52


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> with weight and target. One row for each source.

    Sharing by weight with a cap is a water level: sorted by cap / weight, sources under the level are full, the
    others share what is left. It equals resharing the excess again and again."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("nth", F.row_number().over(by_name) - 1)
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    s = s.select("source", "source_size", pick.cast("long").alias("weight"), (F.col("source_size") * max_repeats).alias("cap"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(
        "*",
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
        F.sum("weight").over(Window.partitionBy()).alias("all_weight"),
        F.coalesce(F.sum("cap").over(upto), F.lit(0)).alias("full"),
        F.coalesce(F.sum("weight").over(upto), F.lit(0)).alias("full_weight"),
    )
    level = (F.col("total") - F.col("full")).cast("double") / (F.col("all_weight") - F.col("full_weight"))
    s = s.withColumn("level", F.when(level * F.col("weight") < F.col("cap"), level))
    s = s.withColumn("level", F.max("level").over(Window.partitionBy()))
    share = F.col("level") * F.col("weight")
    return s.select("source", "source_size", "weight", F.when(share < F.col("cap"), share).otherwise(F.col("cap").cast("double")).alias("target"))


def _keyed(docs: DataFrame, seed: str) -> DataFrame:
    """docs with _size and _bits: 52 hash bits of seed, id and text, so only rows equal in both tie."""
    null = F.lit("\x00")
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), null), F.md5(F.coalesce(F.col("text"), null)))
    return docs.withColumns({"_size": word_count(), "_bits": F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")})


def _rank() -> Column:
    """The odds q / (1 + q) of the Pareto rank q of a document under the source's bound T (column level); null where nothing is left to chance."""
    u = (F.col("_bits") + F.lit(0.5)) / F.lit(float(_UNIT))
    size = F.col("_size").cast("double")
    up, down = u * (F.col("level") - size), (1 - u) * size
    return F.when((size > 0) & (size < F.col("level")), up / (up + down))


def _on_source(d: DataFrame, goals: DataFrame) -> DataFrame:
    # No hint: Spark broadcasts the table of sources while it is small, else splits the skewed side.
    g = goals.withColumnRenamed("source", "g_source")
    return d.join(g, d.source.eqNullSafe(g.g_source), "inner").drop("g_source")


def _levels(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """goals (source, source_size, left) with level, the bound T, and chance, the words wanted of documents under it.

    For sizes s in order the words of a sample with T = s are a falling step sum; T lies between the neighbours that enclose `left`."""
    hist = rows.where(F.col("_size") > 0).groupBy("source", "_size").agg(F.count(F.lit(1)).alias("n"))
    hist = _on_source(hist, goals.select("source", "source_size", "left")).where(F.col("left") > 0)
    before = Window.partitionBy("source").orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)
    square = (F.col("n") * F.col("_size")).cast("decimal(38,0)") * F.col("_size").cast("decimal(19,0)")
    hist = hist.select(
        "source", "left", "_size", square.cast("decimal(38,0)").alias("square"),
        (F.col("source_size") - F.coalesce(F.sum(F.col("n") * F.col("_size")).over(before), F.lit(0))).alias("sure"),
    )
    hist = hist.withColumn("squares", F.coalesce(F.sum("square").over(before), F.lit(0)).cast("double"))
    sure = F.col("sure").cast("double")
    on = (F.col("squares") / F.col("_size") + sure) <= F.col("left")
    # The first size that holds: T = squares / (left - sure); if none holds, all documents are left to chance.
    first = hist.where(on).groupBy("source").agg(F.min_by(F.struct("squares", sure.alias("sure")), "_size").alias("at"))
    every = hist.groupBy("source").agg(F.sum("square").cast("double").alias("all_squares"))
    found = every.alias("e").join(first.alias("f"), F.col("e.source").eqNullSafe(F.col("f.source")), "left").select("e.source", "all_squares", "at")
    g = goals.alias("g").join(found.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source")), "left").select("g.*", "all_squares", "at")
    g = g.withColumn("chance", F.when(F.col("all_squares").isNotNull(), F.col("left") - F.coalesce(F.col("at.sure"), F.lit(0.0))))
    return g.withColumn("level", F.coalesce(F.col("at.squares"), F.col("all_squares")) / F.col("chance")).drop("all_squares", "at")


def _cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """goals with upto, the largest rank that is taken. Bins of the rank are summed first; only the bin that holds the cut is ordered."""
    ranked = _on_source(rows.select("source", "_size", "_bits"), goals.select("source", "level", "chance")).withColumn("_rank", _rank()).where(F.col("_rank").isNotNull())
    ranked = ranked.select("source", "_size", "_rank", "chance", F.least(F.lit(BINS - 1), F.floor(F.col("_rank") * BINS)).cast("int").alias("_bin"))
    bins = ranked.groupBy("source", "_bin", "chance").agg(F.sum("_size").alias("bin_size"), F.max("_rank").alias("bin_rank"))
    upto = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("bin_upto", F.sum("bin_size").over(upto))
    under = bins.where(F.col("bin_upto") <= F.col("chance")).groupBy("source").agg(F.max("bin_rank").alias("whole"))
    over = bins.where(F.col("bin_upto") > F.col("chance")).groupBy("source").agg(F.min(F.struct("_bin", (F.col("bin_upto") - F.col("bin_size")).alias("before"))).alias("cut"))
    cut = over.select("source", F.col("cut._bin").alias("cut_bin"), F.col("cut.before").alias("before"))
    at = _on_source(ranked, cut).where(F.col("_bin") == F.col("cut_bin"))
    inside = Window.partitionBy("source").orderBy("_rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    at = at.withColumn("after", F.col("before") + F.sum("_size").over(inside)).groupBy("source", "_rank", "after", "chance").agg(F.sum("_size").alias("own"))
    part = at.where((F.col("after") - F.col("own") < F.col("chance")) & (F.col("after") - F.col("chance") < F.col("chance") - (F.col("after") - F.col("own"))))
    got = part.groupBy("source").agg(F.max("_rank").alias("upto")).unionByName(under.select("source", F.col("whole").alias("upto"))).groupBy("source").agg(F.max("upto").alias("upto"))
    return goals.alias("g").join(got.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source")), "left").select("g.*", "upto")


def _copies(max_repeats: int) -> Column:
    """The whole copies, one more for documents of the bound or more and for those whose rank is up to the cut."""
    more = (F.col("_size") >= F.col("level")) | (_rank() <= F.col("upto"))
    return F.least(F.col("whole") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0), F.lit(max_repeats)).cast("int")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, goals): each document's source, size and hash, and each source's target, whole copies, bound and cut."""
    rows = stage(_keyed(docs.select("doc_id", "source", "text"), seed).select("doc_id", "source", "_size", "_bits"), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("_size").alias("source_size"))
    g = source_targets(sizes, weights, max_repeats)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    g = g.withColumn("whole", F.least(F.floor(ratio).cast("long"), F.lit(max_repeats)))
    g = g.withColumn("left", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    g = stage(_levels(rows, stage(g, "mix-goals")), "mix-levels")
    return rows, stage(_cuts(rows, g), "mix-cuts")


def mix_ledger(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken; and source, copies, inclusion (the probability of the copy left to chance)."""
    rows, goals = plan(docs, weights, max_repeats, seed)
    d = _on_source(rows, goals).withColumn("_copies", _copies(max_repeats))
    inclusion = F.coalesce(F.least(F.lit(1.0), F.col("_size") / F.col("level")), F.lit(0.0))
    return d.select("doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_copies") * F.col("_size")).alias("taken"), "source", F.col("_copies").alias("copies"), inclusion.alias("inclusion"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of docs. No text is shuffled."""
    _, goals = plan(docs, weights, max_repeats, seed)
    own = [F.col(c).alias(f"_d_{i}") for i, c in enumerate(docs.columns)]
    d = _keyed(docs.select("doc_id", "source", "text", *own), seed).drop("doc_id", "text")
    d = _on_source(d, goals.select("source", "whole", "level", "upto")).withColumn("_copies", _copies(max_repeats))
    d = d.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return d.select(*[F.col(f"_d_{i}").alias(c) for i, c in enumerate(docs.columns)])
