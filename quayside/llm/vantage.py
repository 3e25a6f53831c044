"""Links between 64-bit fingerprints within a Hamming distance, by vantage-point trees.

A node of a tree has a vantage point v and a bound m, about the median distance to v. By the triangle inequality two points within r
have distances to v that differ by at most r, so every such pair lies wholly among d <= m or wholly among d > m - r. The points in
both, m - r < d <= m, are the boundary's overlap: both sides take them, and no pair is ever looked for across.

Over all 64 bits at radius 4 that prunes little: distances gather within 4 of 32, each side takes 0.70 of its node, and halving
a shard costs 1.4 times its points; 256,000 fingerprints would be copied some 3,000 times to reach leaves of 48. So the trees stand in parts
of the bits. The radius is dealt to parts so that (r_i + 1) sum to radius + 1: then a pair within the radius is within r_i in at
least one part. Radius 4 takes two parts of 24 bits with r_i = 1, where each side takes 0.58 and the copies grow 1.16-fold a level, and one
of 16 bits with r_i = 0, without overlap. Each part has its own tree, all find their links by whole distances, and every link is found.

The upper levels are grown on a bounded sample of fingerprints (`SAMPLE`) and sent to all tasks; every fingerprint is then routed
to all leaves that its distances reach. A leaf is a shard; in its task the tree goes on to leaves of `LEAF` points. A bad sample
costs balance, never links. A shard emits a spanning forest of its links, not its pairs. A shard above a size bound (points too close to
part) is dealt into chunks, and each pair of chunks is one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import shuffle_partitions, stage

BITS = 64
LEAF = 48
#: Fingerprints wanted in a shard, and the bound above which it is dealt into chunks.
SHARD, SHARD_BOUND = 4_096, 50_000
SAMPLE = 1 << 16
_ROUTE = 1 << 17


@dataclass(frozen=True)
class Part:
    """Some of the bits, and how far apart a pair may be in them."""

    mask: int
    radius: int


def parts(radius: int) -> list[Part]:
    """Parts of the 64 bits such that a pair within the radius is within a part's own radius in at least one of them."""
    own = [1] * ((radius + 1) // 2) + [0] * ((radius + 1) % 2)
    share = np.cumsum([0, *(r + 2 for r in own)])
    edges = [int(round(BITS * x / share[-1])) for x in share]
    return [Part(((1 << b) - 1) ^ ((1 << a) - 1), r) for a, b, r in zip(edges[:-1], edges[1:], own, strict=True)]


def _apart(x: np.ndarray, y: np.ndarray, mask: int = (1 << BITS) - 1) -> np.ndarray:
    """Differing bits; x and y unsigned."""
    return np.bitwise_count((x ^ y) & np.uint64(mask))


def split(p: np.ndarray, part: Part) -> tuple[np.uint64, int, np.ndarray, np.ndarray] | None:
    """Vantage point, bound, and which of the points go below and above; None if no split saves comparisons.

    Several vantage points are tried only where the first one does badly."""
    n, best = len(p), None
    for at in dict.fromkeys((n // 2, 0, n - 1, n // 4, 3 * n // 4)):
        d = _apart(p, p[at], part.mask).astype(np.int64)
        upto = np.cumsum(np.bincount(d, minlength=BITS + 1))
        for m in {int(np.searchsorted(upto, n / 2)), int(np.searchsorted(upto, n / 2)) - 1}:
            low = int(upto[m]) if m >= 0 else 0
            high = n - (int(upto[m - part.radius]) if m >= part.radius else 0)
            if low and max(low, high) < n and (best is None or low * low + high * high < best[0]):
                best = (low * low + high * high, p[at], m, d)
        if best is not None and best[0] <= 0.7 * n * n:
            break
    if best is None or best[0] > 0.9 * n * n:
        return None
    _, v, m, d = best
    return v, m, d <= m, d > m - part.radius


@dataclass
class Tree:
    """Vantage point, bound and children of each inner node; a child below 0 is leaf -1 - child."""

    part: Part
    vantage: list[np.uint64] = field(default_factory=list)
    bound: list[int] = field(default_factory=list)
    child: list[list[int]] = field(default_factory=list)
    leaves: int = 0

    @classmethod
    def grow(cls, sample: np.ndarray, part: Part, leaf: int) -> Tree:
        """Splits until no more than `leaf` points of the sample are left."""
        tree = cls(part)
        todo: list[tuple[np.ndarray, int, int]] = [(sample, -1, 0)]
        while todo:
            p, above, side = todo.pop()
            found = split(p, part) if len(p) > leaf else None
            if found is None:
                at, tree.leaves = -1 - tree.leaves, tree.leaves + 1
            else:
                v, m, low, high = found
                at = len(tree.vantage)
                tree.vantage.append(v)
                tree.bound.append(m)
                tree.child.append([0, 0])
                todo += [(p[low], at, 0), (p[high], at, 1)]
            if above >= 0:
                tree.child[above][side] = at
        return tree

    def route(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into p, leaf) for every leaf that a point reaches."""
        if not self.vantage:
            return np.arange(len(p)), np.zeros(len(p), np.int64)
        who, where, todo = [], [], [(0, np.arange(len(p)))]
        while todo:
            at, idx = todo.pop()
            if not len(idx):
                continue
            if at < 0:
                who.append(idx)
                where.append(np.full(len(idx), -1 - at))
                continue
            d = _apart(p[idx], self.vantage[at], self.part.mask).astype(np.int64)
            low, high = self.child[at]
            todo += [(low, idx[d <= self.bound[at]]), (high, idx[d > self.bound[at] - self.part.radius])]
        return np.concatenate(who), np.concatenate(where)


def _scan(p: np.ndarray, r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of a leaf: of a small one all at once; else a spanning forest, where from each reached point the points
    not reached yet and close to it are taken off."""
    if len(p) <= LEAF:
        a, b = np.nonzero(np.triu(_apart(p[:, None], p[None, :]) <= r, 1))
        return [(p[a], p[b])] if len(a) else []
    out, rest = [], p
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            hit = _apart(rest, x) <= r
            if hit.any():
                got = rest[hit]
                out.append((np.full(len(got), x), got))
                todo.extend(got)
                rest = rest[~hit]
    return out


def tree_links(p: np.ndarray, part: Part, radius: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """(links, number of splits): links that connect whatever is connected among the distinct p by steps that the part finds."""
    out, splits, todo = [], 0, [p]
    while todo:
        p = todo.pop()
        found = split(p, part) if len(p) > LEAF else None
        if found is None:
            out += _scan(p, radius)
        else:
            splits += 1
            todo += [p[found[2]], p[found[3]]]
    return out, splits


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs -> each point with the least point of its component."""
    pts, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    lab = np.arange(len(pts))
    while True:
        new = lab.copy()
        np.minimum.at(new, x, lab[y])
        np.minimum.at(new, y, lab[x])
        new = new[new]
        if (new == lab).all():
            break
        lab = new
    off = lab != np.arange(len(pts))
    return pts[off], pts[lab[off]]


def _route(trees: list[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> Iterator[pa.RecordBatch]:
            p = np.concatenate(held)
            held.clear()
            for i, tree in enumerate(trees):
                who, where = tree.route(p)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), i, np.int32)), pa.array((i << 32) + where.astype(np.int64)), pa.array(p[who].view(np.int64))], ["part", "shard", "fp"])

        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            if sum(map(len, held)) >= _ROUTE:
                yield from out()
        if held:
            yield from out()

    return run


def _link_shards(found: list[Part], radius: int):
    """Rows (part, shard, fp) in order of shard -> links."""

    def solve(part: int, held: list[np.ndarray]) -> pa.RecordBatch:
        got, _ = tree_links(np.unique(np.concatenate(held)), found[part], radius)
        u, v = _forest(np.concatenate([x for x, _ in got]), np.concatenate([y for _, y in got])) if got else (np.empty(0, np.uint64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, held = None, 0, []
        for b in batches:
            if not len(b):
                continue
            part_, shard_, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cut = np.flatnonzero(np.r_[True, shard_[1:] != shard_[:-1]])
            for a, z in zip(cut, [*cut[1:], len(shard_)], strict=True):
                if shard_[a] != shard:  # else the shard goes on from the batch before
                    if held:
                        yield solve(part, held)
                    shard, part, held = shard_[a], int(part_[a]), []
                held.append(fp[a:z].astype(np.int64).view(np.uint64))
        if held:
            yield solve(part, held)

    return run


def split_large(dealt: DataFrame, node: str, bound: int, weight: str | None = None) -> DataFrame:
    """dealt (node, shard, ...) with shards above the bound, in rows or in weight, dealt into chunks: each pair of chunks becomes a shard of its own."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    big = stage(dealt.groupBy("shard").agg(size.alias("_n")).where(F.col("_n") > bound), "large-shards")
    if big.isEmpty():
        return dealt
    j = dealt.join(big, "shard", "left").withColumn("_g", F.coalesce(F.ceil(F.col("_n") / bound), F.lit(1)).cast("int"))
    mine = F.pmod(F.xxhash64(node), F.col("_g")).cast("int")
    cell = F.explode(F.transform(F.sequence(F.lit(0), F.col("_g") - 1), lambda o: F.struct(F.least(o, mine).alias("a"), F.greatest(o, mine).alias("b"))))
    cells = j.withColumn("_cell", cell)
    shard = F.when(F.col("_cell.a") + F.col("_cell.b") == 0, F.col("shard")).otherwise(F.xxhash64("shard", "_cell"))
    return cells.withColumn("shard", shard).select(*dealt.columns)


def grow_trees(fps: DataFrame, radius: int, shard: int = SHARD, sample: int = SAMPLE) -> list[Tree]:
    """One tree for each part, down to shards of about `shard` of the distinct fps, by a sample of about `sample` of them."""
    n = fps.count()
    every = max(1, -(-n // sample))
    some = fps.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).collect()  # fits the trees only; all fps are routed
    p = np.sort(np.array([r["fp"] for r in some], np.int64).view(np.uint64))
    return [Tree.grow(p, part, max(16, shard * len(p) // max(1, n))) for part in parts(radius)]


def links(fps: DataFrame, radius: int, shard_bound: int = SHARD_BOUND, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """fps: distinct fp -> edges (u, v) that connect whatever is connected by steps of at most radius bits."""
    trees = grow_trees(fps, radius, shard, sample)
    dealt = split_large(fps.select("fp").mapInArrow(_route(trees), "part int, shard long, fp long"), "fp", shard_bound)
    dealt = dealt.repartition(shuffle_partitions(fps.sparkSession), "shard").sortWithinPartitions("shard", "fp")
    return dealt.select("part", "shard", "fp").mapInArrow(_link_shards(parts(radius), radius), "u long, v long")
