"""Canonical exact digests: texts that differ only in Unicode form, case or white space get one fingerprint.

The canonical form is compatibility composition (NFKC), full case folding, NFKC again, and runs of white space as one space,
trimmed. Both Unicode steps are static methods of the ICU library inside Spark, called by the SQL function `reflect`:
no Python runs. Its 128-bit xxhash (two seeds) names the bucket. Rows of a bucket are compared byte by byte: the
distinct canonical forms are counted with map-side combination, so a group of copies shrinks before it moves; should a bucket
hold more than one form, the forms after the smallest get a suffix.

Likeness of two digests is 1 if the canonical forms are equal byte by byte, else 0.

Defined cases: a null text counts as empty; null ids come first and rows with equal ids are in order of text; an empty
table gives an empty result; a single row is followed by itself; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import shuffle_partitions, stage

_WHITE = r"[\p{IsWhite_Space}\x1C-\x1F]+"


def _icu(cls: str, method: str, text: Column, flag: bool) -> Column:
    return F.reflect(F.lit(f"com.ibm.icu.{cls}"), F.lit(method), text, F.lit(flag))


def canonical(text: Column) -> Column:
    nfkc = lambda t: _icu("text.Normalizer", "compose", t, True)
    folded = nfkc(_icu("lang.UCharacter", "foldCase", nfkc(F.coalesce(text, F.lit(""))), True))
    return F.trim(F.regexp_replace(folded, _WHITE, " "))


def wide_hash(form: Column) -> Column:
    """128 bits of xxhash64 under two seeds, as 32 hexadecimal digits."""
    digits = lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")
    return F.concat(digits(F.xxhash64(form)), digits(F.xxhash64(F.lit(1), form)))


def collisions(forms: DataFrame) -> DataFrame:
    """form -> rows (hash, form, nth) of every bucket with more than one distinct form, nth > 0. Empty unless xxhash collides."""
    distinct = forms.withColumn("hash", wide_hash(F.col("form"))).groupBy("hash", "form").agg(F.count(F.lit(1)).alias("n"))
    crowded = distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("forms"), F.collect_set(F.lit(0)).alias("_")).where("forms > 1").select("hash")
    nth = F.row_number().over(Window.partitionBy("hash").orderBy("form")) - 1
    return distinct.join(crowded, "hash").withColumn("nth", nth).where("nth > 0").select("hash", "form", "nth")


def with_fingerprint(df: DataFrame, form: str, out: str, clashes: DataFrame | None) -> DataFrame:
    """Adds the fingerprint of the canonical form. clashes: what collisions() found, None if it found nothing."""
    df = df.withColumn(out, wide_hash(F.col(form)))
    if clashes is None:
        return df
    c = clashes.select(F.col("hash").alias("_hash"), F.col("form").alias("_form"), F.col("nth").alias("_nth"))
    df = df.join(c, (df[out] == c._hash) & (df[form] == c._form), "left")
    return df.withColumn(out, F.when(F.col("_nth").isNull(), F.col(out)).otherwise(F.concat(F.col(out), F.lit("-"), F.col("_nth").cast("string")))).drop("_hash", "_form", "_nth")


def _bucket_of(value: Column, edges: list[int]) -> Column:
    """How many of the ascending edges are at most value. Two levels, so that a row looks at about twice the root of their number."""
    if not edges:
        return F.lit(0)
    step = math.isqrt(len(edges)) + 1
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    upto = lambda xs: F.size(F.filter(xs, lambda e: e <= value))
    coarse = upto(longs(edges[::step]))
    fine = F.get(F.array(*[longs(edges[i : i + step]) for i in range(0, len(edges), step)]), coarse - 1)
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + upto(fine))


def next_text(docs: DataFrame) -> DataFrame:
    """doc_id, text, next: each row's text and that of the row after it by ascending id; the first follows the last.

    Ranges of ids become buckets, each ordered on its own; the first row of a bucket is also sent to the bucket before it
    (that of the first to the last), so every row finds its successor without one global window."""
    spark = docs.sparkSession
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = 2 * shuffle_partitions(spark)
    ids = d.where("doc_id is not null").select("doc_id")
    at = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 10 * n)).alias("p"), F.min("doc_id").alias("least")).first()
    edges = sorted({int(x) for x in (at["p"] or [])} - {at["least"]})
    bucket = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(_bucket_of(F.col("doc_id"), edges))
    d = d.withColumn("bucket", bucket.cast("int"))
    # Edges are ids of rows, so a bucket's first row is the least text with that id; the table's first row is found apart.
    heads = d.where(F.col("doc_id").isin(edges) if edges else F.lit(False)).groupBy("bucket").agg(F.min("text").alias("text"))
    start = d.where(F.col("doc_id").isNull()).agg(F.min("text").alias("t"), F.count(F.lit(1)).alias("n"))
    if at["least"] is not None and start.first()["n"] == 0:
        start = d.where(F.col("doc_id") == F.lit(at["least"])).agg(F.min("text").alias("t"))
    start = start.where("t is not null").select(F.lit(0).alias("bucket"), F.col("t").alias("text"))
    last = len(edges)
    tail = heads.unionByName(start).select(F.lit(None).cast("long").alias("doc_id"), "text", F.when(F.col("bucket") == 0, F.lit(last)).otherwise(F.col("bucket") - 1).cast("int").alias("bucket"), F.lit(True).alias("tail"))
    rows = d.withColumn("tail", F.lit(False)).unionByName(tail)
    order = Window.partitionBy("bucket").orderBy("tail", F.col("doc_id").asc_nulls_first(), "text")
    return rows.withColumn("next", F.lead("text").over(order)).where(~F.col("tail")).select("doc_id", "text", "next")


def digest_query(docs: DataFrame) -> DataFrame:
    forms = docs.select(canonical(F.col("text")).alias("form"))
    found = stage(collisions(forms), "digest-clashes")
    clashes = None if found.isEmpty() else found
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = next_text(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next", F.lit(1), half))
    d = d.withColumn("edited", edited)
    d = d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), canonical(F.col("text")).alias("form"), canonical(F.col("edited")).alias("edited_form"), canonical(F.col("next")).alias("next_form"))
    same = lambda c: (F.col("form") == F.col(c)).cast("double")
    d = d.withColumns({"near_edited": same("edited_form"), "near_next": same("next_form")}).drop("next_form")
    d = with_fingerprint(d, "form", "fingerprint", clashes)
    d = with_fingerprint(d, "edited_form", "edited_fingerprint", clashes)
    return d.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
