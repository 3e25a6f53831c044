"""SimHash near-copies: 64-bit fingerprints of word shingles, exact linking within a Hamming distance, components.

Fingerprints are made in Arrow batches. Equal ones are one node, so a group of copies is a single row from there on. Links within the
radius come from vantage-point trees (`vantage`); components from star rounds over the links (`components`). A node is
named by the least doc_id of its rows before its fingerprint, so a component's least name holds the least doc_id reachable and no join
on a component is needed.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; null ids never become a
component's id unless all its ids are null; repeated rows are copies; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import stage
from quayside.llm.components import components
from quayside.llm.vantage import SHARD_BOUND, links

BITS = 64
SEED = 42
RADIUS = 4


def shingle_hashes(text: bytes, shingle: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every word shingle of a text in order; of the whole sequence if it is shorter. A-Z are lower-cased."""
    import xxhash

    found = text.lower().split()
    n = len(found)
    if n == 0:
        return np.empty(0, np.uint64)
    joined = memoryview(b" ".join(found))
    if n <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    starts = [0, *accumulate(len(w) + 1 for w in found)]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, starts[shingle:], strict=False)
    return np.fromiter((digest(joined[a : b - 1], seed) for a, b in spans), np.uint64, n - shingle + 1)


def simhash(hashes: np.ndarray) -> int:
    """The 64 majority bits, as a signed integer; zero without hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096].view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.int64)[0])


def fingerprint(text: bytes, shingle: int, seed: int = SEED) -> int:
    return simhash(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, *keep: str, shingle: int = 4) -> DataFrame:
    """The columns named in keep and fp, the fingerprint as a long."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t.as_py() or b"", shingle) for t in b.column(len(names))], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], fp], [*names, "fp"])

    src = docs.select(*names, F.col("text").cast("binary").alias("_bytes"))
    schema = docs.select(*names).schema.add("fp", "long")
    return src.mapInArrow(run, schema)


#: Ids are shifted to be positive, so that their digits sort as they do.
_ID, _OFFSET = 20, str(1 << 63)


def _name(doc_id: Column, fp: Column) -> Column:
    """Text that sorts by doc_id, null last, then by fp."""
    digits = F.lpad((doc_id.cast("decimal(20,0)") + F.lit(_OFFSET).cast("decimal(20,0)")).cast("string"), _ID, "0")
    return F.concat(F.coalesce(digits, F.lit("z" * _ID)), F.hex(fp))


def _id_of(name: Column) -> Column:
    digits = F.substring(name, 1, _ID)
    return F.when(digits != "z" * _ID, (digits.cast("decimal(20,0)") - F.lit(_OFFSET).cast("decimal(20,0)")).cast("long"))


def near_components(fps: DataFrame, radius: int = RADIUS, shard_bound: int = SHARD_BOUND) -> DataFrame:
    """fps, staged: distinct fp and least, its least doc_id -> (fp, component_id): the least id in the fingerprint's component."""
    named = fps.select("fp", "least", _name(F.col("least"), F.col("fp")).alias("name"))
    e = links(fps.select("fp"), radius, shard_bound)
    e = e.join(named.select(F.col("fp").alias("u"), F.col("name").alias("un")), "u").join(named.select(F.col("fp").alias("v"), F.col("name").alias("vn")), "v")
    found = components(e.select(F.col("un").alias("u"), F.col("vn").alias("v")))
    return named.join(found, named.name == found.node, "left").select("fp", F.when(F.col("label").isNull(), F.col("least")).otherwise(_id_of(F.col("label"))).alias("component_id"))


def simhash_query(docs: DataFrame, shingle: int = 4, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (the least doc_id reachable)."""
    rows = stage(fingerprints(docs, "doc_id", shingle=shingle), "simhash-rows")
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    return rows.join(near_components(fps, radius), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
