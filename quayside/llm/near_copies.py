"""Near-copies in the everyday sense: texts whose sets of word shingles are alike by 0.8 or more, all of them.

The search goes by op4's method first: every text has its SimHash fingerprint, vantage-point trees whose shards overlap at their boundaries
link fingerprints within `RADIUS` bits, star rounds make groups of the links, and in each group whole shingle sets decide which texts are
near-copies. On the check tool's 0.1 GB table such groups hold 1,554 of the 1,838 links that join all near-copies there.

The others lie farther apart, where no search by distance is selective, and a repeated line moves a fingerprint far without changing the
set. For these the sets themselves are searched, without loss. Under any order of all
shingles, two sets alike by s share one of the first n - ceil(s n) + 1 shingles of each, n being its size; with rare shingles first, such
heads meet few others. The order comes from a count of all shingles, held in two tables of fixed size: whether a shingle may be in
a second text, and about how often. It is the same for every set, so what the tables mix up costs comparisons, never pairs. A
text whose head has only shingles of its own is done. Texts whose heads share a shingle are a shard, equal shards are one, and
whole shingle sets decide in it.

Shards whose texts are all linked by the trees have nothing to add and are left out, as are those whose texts all met in one group. A group of
copies shares many shingles, hence many shards. So what is left is compared in two rounds: in the first each text goes to one shard
only, its largest, and again only shards that may add a link go on. What stays overlaps much: shards that lead to the same large one are
compared as one wherever that ships fewer shingles than each by itself. A shard above a bound of shingles is dealt into chunks, and each pair of
chunks is one task's work. Texts are one node if their sets are equal; nodes are named by 128 bits of the set's hash.

Defined cases: null and empty texts have the empty set and are copies of each other; null ids come last; repeated rows are copies; an
empty table gives an empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import shuffle_partitions, stage, unstage
from quayside.llm.components import components
from quayside.llm.simhash import fingerprint, shingle_hashes
from quayside.llm.vantage import links, split_large

SIMILARITY = 0.8
#: op4's fingerprints, of its own shingles; the trees link them within a wider radius than op4's, as whole sets decide after them.
FP_SHINGLE, RADIUS = 4, 8
#: Shingles are counted by the first 40 bits of their hashes or more, in 2^8 buckets or more, into 2^28 bits and 2^22 bytes.
SHARED_BITS, OFTEN_BITS, OFTEN = 28, 22, 4
PACKED = 1_000_000
#: Shingles in a chunk of a shard.
SHARD_BOUND = 1_000_000


def _node(shingles: bytes) -> str:
    import xxhash

    return xxhash.xxh3_128_hexdigest(shingles)


def _sets(b: pa.RecordBatch, shingle: int) -> Iterator[tuple[str, bytes]]:
    """Node and shingle set of each row, from columns node and shingles, or from the text in _bytes."""
    if "_bytes" in b.schema.names:
        for t in b.column("_bytes"):
            u = np.unique(shingle_hashes(t.as_py() or b"", shingle)).tobytes()
            yield _node(u), u
    else:
        for k, x in zip(b.column("node"), b.column("shingles"), strict=True):
            yield k.as_py(), x.as_py()


def sketches(docs: DataFrame, *keep: str, shingle: int, whole: bool = True) -> DataFrame:
    """The columns in keep; node, one for each set of shingles; fp, the fingerprint as a long; and, if whole, shingles, the set in order, 8 bytes each."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, sets = [], []
            for k, u in _sets(b, shingle):
                node.append(k)
                if whole:
                    sets.append(u)
            fp = [fingerprint(t.as_py() or b"", FP_SHINGLE) for t in b.column("_bytes")]
            more = {"node": pa.array(node, pa.string()), "fp": pa.array(fp, pa.int64())} | ({"shingles": pa.array(sets, pa.binary())} if whole else {})
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *more.values()], [*names, *more])

    src = docs.select(*names, F.col("text").cast("binary").alias("_bytes"))
    schema = docs.select(*names).schema.add("node", "string").add("fp", "long")
    return src.mapInArrow(run, schema.add("shingles", "binary") if whole else schema)


def _pack(batches: Iterator[pa.RecordBatch], shingle: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of _sets() -> for each bucket the next 32 bits of its hashes, once for each text, in order."""
    held: list[np.ndarray] = []
    seen: set[str] = set()

    def out() -> pa.RecordBatch:
        h = np.sort(np.concatenate(held))
        edges = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        low = (h >> np.uint64(32 - bits)).astype(np.uint32)
        full = np.flatnonzero(np.diff(edges))
        held.clear()
        seen.clear()
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([low[edges[i] : edges[i + 1]].tobytes() for i in full], pa.binary())], ["bucket", "hashes"])

    n = 0
    for b in batches:
        for node, x in _sets(b, shingle):
            if node not in seen and (u := np.frombuffer(x, np.uint64)).size:
                seen.add(node)
                held.append(u)
                n += len(u)
            if n > PACKED:
                yield out()
                n = 0
    if held:
        yield out()


def _tally(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """_pack() rows in order of bucket -> each bucket's part of the two tables."""

    def solve(bucket: int, parts: list[bytes]) -> pa.RecordBatch:
        x = np.sort(np.frombuffer(b"".join(parts), np.uint32))
        first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        times = np.diff(np.r_[first, len(x)])
        x = x[first]
        shared = np.zeros(1 << (SHARED_BITS - bits), bool)
        shared[x[times > 1] >> np.uint32(32 + bits - SHARED_BITS)] = True
        often = np.zeros(1 << (OFTEN_BITS - bits), np.uint8)
        on = times >= OFTEN
        np.maximum.at(often, x[on] >> np.uint32(32 + bits - OFTEN_BITS), np.frexp(times[on])[1].astype(np.uint8))
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([np.packbits(shared, bitorder="little").tobytes()], pa.binary()), pa.array([often.tobytes()], pa.binary())], ["bucket", "shared", "often"])

    bucket, parts = None, []
    for b in batches:
        for k, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if k != bucket:
                if parts:
                    yield solve(bucket, parts)
                bucket, parts = k, []
            parts.append(x.as_py())
    if parts:
        yield solve(bucket, parts)


def _heads(rows: DataFrame, least: Fraction, shingle: int) -> tuple[DataFrame, Broadcast]:
    """(node, size, head, shingles) of rows that may have a near-copy, and the tables that their making reads; head: the first shingles
    of the common order that may be shared."""
    spark = rows.sparkSession
    n = shuffle_partitions(spark)
    bits = min(20, max(8, (4 * n - 1).bit_length()))  # buckets follow the partitions, so that none outgrows a task
    # From texts: hashed in each pass, as the sets are larger, and one Python worker a task is enough.
    rows = rows.select("node", "shingles") if "shingles" in rows.columns else rows.select(F.col("text").cast("binary").alias("_bytes"))
    packed = rows.mapInArrow(lambda batches: _pack(batches, shingle, bits), "bucket int, hashes binary")
    packed = packed.repartition(n, "bucket").sortWithinPartitions("bucket")
    shared, often = np.zeros(1 << (SHARED_BITS - 3), np.uint8), np.zeros(1 << OFTEN_BITS, np.uint8)
    for r in packed.mapInArrow(lambda batches: _tally(batches, bits), "bucket int, shared binary, often binary").collect():  # 37 MB, whatever the table
        for table, part in ((shared, r["shared"]), (often, r["often"])):
            table[r["bucket"] * len(part) : (r["bucket"] + 1) * len(part)] = np.frombuffer(bytes(part), np.uint8)
    sent = spark.sparkContext.broadcast((shared, often))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, classes = sent.value
        seen: set[str] = set()  # copies in the same task are sent once
        for b in batches:
            node, size, head, sets = [], [], [], []
            for k, x in _sets(b, shingle):
                u = np.frombuffer(x, np.uint64)
                at = u >> np.uint64(64 - SHARED_BITS)
                mine = u[shared[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0]
                # A near-copy shares `must` shingles or more; those of this text alone come first in the order.
                must = -(-len(u) * least.numerator // least.denominator)
                if len(mine) < max(1, must) or k in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(k)
                order = np.lexsort((mine, classes[mine >> np.uint64(64 - OFTEN_BITS)]))
                node.append(k)
                size.append(len(u))
                head.append(mine[order[: len(mine) - max(1, must) + 1]].view(np.int64))
                sets.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.string()), pa.array(size, pa.int64()), pa.array(head, pa.list_(pa.int64())), pa.array(sets, pa.binary())], ["node", "size", "head", "shingles"])

    return rows.mapInArrow(run, "node string, size long, head array<long>, shingles binary"), sent


class SetIndex:
    """Which of some shingle sets contain each shingle; a set meets only those with which it shares one."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.size = np.array([len(x) for x in sets], np.int64)
        self.end = np.cumsum(self.size)
        _, self.word, self.count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), self.size)
        self.owners = owner[np.argsort(self.word, kind="stable")]
        self.first = np.cumsum(self.count) - self.count

    def alike(self, i: int, least: Fraction) -> np.ndarray:
        """For each set whether its Jaccard similarity to set i is `least` or more, in whole numbers."""
        w = self.word[self.end[i] - self.size[i] : self.end[i]]
        n = self.count[w]
        at = np.repeat(self.first[w] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(self.owners[at], minlength=len(self.size))
        return (both > 0) & (both * least.denominator >= (self.size + self.size[i] - both) * least.numerator)


def _link_similar(similarity: float):
    """Rows (shard, node, shingles) in order of shard -> links of a spanning forest in each."""
    least = Fraction(repr(similarity))

    def solve(nodes: list[str], sets: list[np.ndarray]) -> list[tuple[str, str]]:
        index = SetIndex(sets)
        out, rest = [], np.arange(1, len(nodes))
        start = 0
        while True:
            todo = [start]
            while todo and len(rest):
                x = todo.pop()
                hit = index.alike(x, least)[rest]
                out += [(nodes[x], nodes[i]) for i in rest[hit]]
                todo.extend(rest[hit].tolist())
                rest = rest[~hit]
            if not len(rest):
                return out
            start, rest = int(rest[0]), rest[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, nodes, sets = None, [], []

        def out() -> pa.RecordBatch:
            found = solve(nodes, sets) if len(nodes) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())], ["u", "v"])

        for b in batches:
            for k, n, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if k != shard:
                    if len(nodes) > 1:
                        yield out()
                    shard, nodes, sets = k, [], []
                nodes.append(n)
                sets.append(np.frombuffer(s.as_py(), np.uint64))
        yield out()

    return run


def _spread(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the corpus: joined by exchange at every size, so that a small table's plan is a large one's."""
    return side.hint("merge")


def tree_groups(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """nodes (node, fp) -> (node, shard): the same shard for nodes whose fingerprints are connected by steps of at most radius bits.

    A node with several fingerprints (texts of one set that repeat differently) goes by the one whose group has the least name."""
    fps = stage(nodes.select("fp").distinct(), "near-fps")
    found = components(links(fps, radius)).select(F.col("node").alias("fp"), "label")
    named = nodes.select("node", "fp").distinct().join(_spread(found), "fp", "left")
    groups = stage(named.groupBy("node").agg(F.min(F.coalesce("label", "fp")).alias("shard")), "near-groups")
    unstage(fps)
    return groups


def _linked(dealt: DataFrame, sets: DataFrame, similarity: float, bound: int, name: str) -> DataFrame:
    """dealt (node, size, shard) -> links (u, v) that connect what is alike inside shards. Staged."""
    n = shuffle_partitions(dealt.sparkSession)
    dealt = split_large(dealt, "node", bound, "size").select("shard", "node")
    rows = sets.select("node", "shingles").join(_spread(dealt), "node").select("shard", "node", "shingles")
    rows = rows.repartition(n, "shard").sortWithinPartitions("shard", "node")
    return stage(rows.mapInArrow(_link_similar(similarity), "u string, v string"), name)


def _together(dealt: DataFrame, name: str) -> DataFrame:
    """The rows of dealt (node, size, shard) whose shard has a second node. Staged."""
    met = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("here")).where("here > 1").select("shard")
    return stage(dealt.join(_spread(met), "shard").select("node", "size", "shard"), name)


def _open(dealt: DataFrame, before: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of dealt whose shard holds texts that aren't linked yet and did not all meet in the round before, in one of its shards."""
    met = before.select("node", F.col("shard").cast("string").alias("met"))
    d = dealt.join(_spread(found), "node", "left").join(_spread(met), "node", "left").select("shard", F.coalesce("label", "node").alias("label"), F.coalesce("met", "node").alias("met"))
    d = d.groupBy("shard").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.min("met").alias("c"), F.max("met").alias("d"))
    return dealt.join(_spread(d.where("a != b and c != d").select("shard")), "shard", "left_semi")


def _merged(open_: DataFrame, bound: int) -> DataFrame:
    """(node, size, shard): shards with the same leader, the largest shard of any of their texts, as one, if that ships less."""
    best = open_.groupBy("node").agg(F.max(F.struct("n", "shard")).alias("best"))
    lead = open_.join(_spread(best), "node").groupBy("shard").agg(F.max("best").alias("best")).select("shard", F.col("best.shard").alias("lead"))
    rows = open_.join(_spread(lead), "shard").select("node", "size", "shard", "lead")
    one = rows.select("node", "size", "lead").distinct()
    total = one.groupBy("lead").agg(F.sum("size").alias("together")).join(rows.groupBy("lead").agg(F.sum("size").alias("apart")), "lead")
    pays = total.where(F.col("together") * F.ceil(F.col("together") / bound) <= F.col("apart")).select("lead")
    whole = one.join(pays, "lead", "left_semi").select("node", "size", F.col("lead").alias("shard"))
    return whole.unionByName(rows.join(pays, "lead", "left_anti").select("node", "size", "shard"))


def similar_components(rows: DataFrame, similarity: float = SIMILARITY, shard_bound: int = SHARD_BOUND, nodes: DataFrame | None = None, shingle: int = 5) -> DataFrame:
    """sketches() rows -> (node, label): the same label for all nodes that are linked by similarity. With nodes, staged, rows may be texts."""
    named = rows if nodes is None else nodes
    groups = tree_groups(named)
    heads, sent = _heads(rows, Fraction(repr(similarity)), shingle)
    sets = stage(heads.dropDuplicates(["node"]), "near-sets")
    sent.unpersist()  # the executors need it no more
    near = _together(sets.select("node", "size").join(_spread(groups), "node"), "near-trees")
    by_tree = _linked(near, sets, similarity, shard_bound, "near-links")
    # Shingles held by the same nodes make the same shard.
    held = sets.select("node", "size", F.explode("head").alias("word"))
    own = F.xxhash64("node")
    who = held.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(own).alias("x"), F.min(own).alias("m")).where("n > 1")
    dealt = stage(held.join(_spread(who), "word").select("node", "size", "n", F.xxhash64("n", "x", "m").alias("shard")).distinct(), "near-dealt")
    left = stage(_open(dealt, near, components(by_tree)), "near-left")
    first = left.groupBy("node", "size").agg(F.max(F.struct("n", "shard")).alias("b")).select("node", "size", "b.shard")
    first = _together(first, "near-first")
    by_head = _linked(first, sets, similarity, shard_bound, "near-links")
    open_ = stage(_open(left, first, components(by_tree.unionByName(by_head))), "near-open")
    rest = stage(_merged(open_, shard_bound), "near-rest")
    more = _linked(rest, sets, similarity, shard_bound, "near-links")
    found = components(by_tree.unionByName(by_head).unionByName(more))
    unstage(sets, groups, near, dealt, left, first, open_, rest, by_tree, by_head, more)
    all_nodes = named.select(F.col("node").alias("_n")).distinct()
    return all_nodes.join(found, all_nodes._n == found.node, "left").select(F.col("_n").alias("node"), F.coalesce("label", "_n").alias("label"))


def one_of_each(docs: DataFrame, shingle: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs, one of each group of near-copies: the least doc_id, of equal ids the least hash of the text, once.

    Two texts are near-copies if their sets of word shingles are alike by `similarity` or more; groups are what such links connect."""
    own = docs.columns
    keyed = docs.withColumns({"_h1": F.xxhash64("text"), "_h2": F.xxhash64(F.lit(1), "text")})
    rows = stage(sketches(keyed, "doc_id", "_h1", "_h2", shingle=shingle, whole=False), "near-nodes")
    key = F.struct(F.col("doc_id").isNull().alias("null_last"), "doc_id", "_h1", "_h2")
    per_node = rows.groupBy("node").agg(F.min(key).alias("k"))
    stay = similar_components(docs.select("text"), similarity, nodes=rows, shingle=shingle).join(per_node, "node").groupBy("label").agg(F.min("k").alias("k"))
    stay = stay.select(F.col("k.doc_id").alias("_id"), F.col("k._h1").alias("_t1"), F.col("k._h2").alias("_t2"))
    # Those that go are fewer than those that stay, so the join is with them.
    gone = rows.alias("r").join(_spread(stay), F.col("r.doc_id").eqNullSafe(F.col("_id")) & (F.col("r._h1") == F.col("_t1")) & (F.col("r._h2") == F.col("_t2")), "left_anti")
    gone = _spread(stage(gone.select(F.col("doc_id").alias("_id"), F.col("_h1").alias("_t1"), F.col("_h2").alias("_t2")).distinct(), "near-gone"))
    d = keyed.join(gone, keyed.doc_id.eqNullSafe(gone._id) & (keyed._h1 == gone._t1) & (keyed._h2 == gone._t2), "left_anti")
    repeated = rows.groupBy("doc_id", "_h1", "_h2").count().where("count > 1")
    if not repeated.isEmpty():
        d = d.dropDuplicates(["doc_id", "_h1", "_h2"])
    return d.select(*own)
