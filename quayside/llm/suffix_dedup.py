"""Removal of every byte under a string of `LENGTH` bytes that starts twice anywhere in the corpus, by a sparse suffix array.

Which suffixes. Every string of 200 bytes holds, among its 151 grams of 50 bytes, the one of least hash; equal strings choose the
same one. Only suffixes at such anchors (about 1 position in 76) are needed: a string that repeats shows as two
anchors with equal grams, equal to the left over o bytes and to the right over 200 - o. Anchors whose gram is alone in
the corpus are dropped by an exchange of hashes; a task sends one row for each gram it holds, so hot grams shrink first.

Sorting. The texts' own partitions sort their candidates' suffixes (gram hash, then the 200 bytes to the right) into
runs. Suffixes equal over their whole context (150 bytes left, 200 right) are one entry, their spans already known. Runs are
cut at equal ranges of the hash, front-coded (length of the prefix shared with the entry before, and the rest) and exchanged.
Each range is merged by a loser tree that carries for every entry the prefix it shares with the last winner: entries
that differ there are told apart without touching bytes, and equal ones are compared only beyond it. The merge gives the order
and the lengths of common prefixes at once.

Answers. Within a gram's stretch of the order, prefixes of length 200 - o form classes by the common-prefix lengths; sorting the
reversed left contexts gives the same for o. An anchor's string at offset o repeats if another entry shares both
classes, so all of it is exact integer work. The least and greatest such o give the anchor's span; spans of a document are united.

Defined cases: null and empty texts have no bytes; texts under 200 bytes keep all; repeated rows are occurrences like any other; null
ids are ordinary; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import shuffle_partitions

LENGTH, GRAM = 200, 50
LEFT = LENGTH - GRAM
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20
_POS_BITS = 22
FLUSH = 2_000_000


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Positions and gram hashes of anchors; scratch tables are made once."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE, _PIECE + LENGTH), _powers(_INVERSE, _PIECE + LENGTH)

    def of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of one text's bytes."""
        n = len(data)
        if n < LENGTH:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        if n <= _PIECE:
            return self._piece(data)
        parts = []
        for at in range(0, n - LENGTH + 1, _PIECE - LENGTH + 1):
            pos, h = self._piece(data[at : at + _PIECE])
            parts.append((pos + at, h))
            if at + _PIECE >= n:
                break
        pos, where = np.unique(np.concatenate([p for p, _ in parts]), return_index=True)
        return pos, np.concatenate([h for _, h in parts])[where]

    def _piece(self, data: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=total[1:])
        h = (total[GRAM:] - total[:-GRAM]) * self.down[: n - GRAM + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        m = (h >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)) | np.arange(len(h), dtype=np.uint64)
        width, need = 1, LENGTH - GRAM + 1
        while 2 * width <= need:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        m = np.minimum(m[: n - LENGTH + 1], m[need - width : need - width + n - LENGTH + 1])
        pos = (m & np.uint64((1 << _POS_BITS) - 1)).astype(np.int64)
        if starts is not None:
            pos = pos[starts]
        pos = pos[np.flatnonzero(np.r_[True, pos[1:] != pos[:-1]])]
        # Least of their windows, these hashes are all small; a one-to-one mix spreads them evenly over the ranges.
        g = h[pos] * np.uint64(0x94D049BB133111EB)
        g ^= g >> np.uint64(31)
        return pos, g * np.uint64(0xD6E8FEB86659FD93)

    def of_many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, position, hash) of all anchors; short texts are run through together."""
        who, where, what = [], [], []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= _PIECE):
                size += len(texts[end])
                end += 1
            if end == at + 1:
                p, h = self.of(np.frombuffer(texts[at], np.uint8))
                w = np.full(len(p), at, np.int64)
            else:
                lens = np.array([len(t) for t in texts[at:end]])
                ends = np.cumsum(lens)
                w, p, h = (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
                if size >= LENGTH:
                    # Windows that cross from one text into the next are left out.
                    inside = np.concatenate([np.arange(a, b - LENGTH + 1) for a, b in zip(ends - lens, ends, strict=True)])
                    if len(inside):
                        p, h = self._piece(np.frombuffer(b"".join(texts[at:end]), np.uint8), inside)
                        w = np.searchsorted(ends, p, side="right")
                        p = p - (ends - lens)[w]
                        w = w + at
            who.append(w)
            where.append(p)
            what.append(h)
            at = end
        return np.concatenate(who or [np.empty(0, np.int64)]), np.concatenate(where or [np.empty(0, np.int64)]), np.concatenate(what or [np.empty(0, np.uint64)])


def _groups(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs of equal values."""
    cut = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.empty(0, np.int64)
    return cut, np.diff(np.r_[cut, len(sorted_values)])


_ANCHOR_SCHEMA = "part long, hash long, key long, pos int, known boolean, many boolean"


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each gram that a task holds, and rows for anchors that are known to repeat within the task."""
    finder = Anchors()
    keys, poss, hashes, held = [], [], [], 0

    def out() -> pa.RecordBatch:
        h, k, p = np.concatenate(hashes), np.concatenate(keys), np.concatenate(poss)
        order = np.lexsort((p, k, h))
        h, k, p = h[order], k[order], p[order]
        cut, size = _groups(h)
        many = size > 1
        every = np.repeat(many, size)
        part = np.concatenate([h[cut].view(np.int64), (k[every] + p[every]) * 2654435761])
        n_rep, n_known = len(cut), int(every.sum())
        known = np.r_[np.zeros(n_rep, bool), np.ones(n_known, bool)]
        return pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(np.r_[h[cut], h[every]].view(np.int64)), pa.array(np.r_[k[cut], k[every]]), pa.array(np.r_[p[cut], p[every]].astype(np.int32)), pa.array(known), pa.array(np.r_[many, np.zeros(n_known, bool)])],
            ["part", "hash", "key", "pos", "known", "many"],
        )

    for b in batches:
        key = b.column(0).to_numpy()
        raw = b.column(1)
        for at in range(0, len(raw), 512):
            who, where, what = finder.of_many([t or b"" for t in raw.slice(at, 512).to_pylist()])
            keys.append(key[at + who])
            poss.append(where)
            hashes.append(what)
            held += len(who)
        if held > FLUSH:
            yield out()
            keys, poss, hashes, held = [], [], [], 0
    if held:
        yield out()


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition of grams: the anchors whose gram is there more than once; those known before pass."""
    tables = [b for b in batches if len(b)]
    if not tables:
        return
    t = pa.Table.from_batches(tables)
    known = t.column("known").to_numpy()
    h, k, p = t.column("hash").to_numpy(), t.column("key").to_numpy(), t.column("pos").to_numpy()
    many = t.column("many").to_numpy()
    rest = np.flatnonzero(~known)
    order = rest[np.argsort(h[rest], kind="stable")]
    _, size = _groups(h[order])
    hit = order[(np.repeat(size, size) > 1) & ~many[order]]  # those with `many` are among the known ones
    keep = np.concatenate([np.flatnonzero(known), hit])
    yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array(p[keep].astype(np.int32)), pa.array(h[keep])], ["key", "pos", "hash"])


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix, of which `known` bytes need no look."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8


def _neighbour_prefixes(strings: list[bytes], width: int) -> np.ndarray:
    """Common prefix of each sorted string with the one before it."""
    n = len(strings)
    out = np.zeros(n, np.int64)
    size = np.array([len(s) for s in strings])
    for at in range(1, n, 20_000):
        part = strings[at - 1 : at + 20_000]
        m = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in part), np.uint8).reshape(len(part), width)
        diff = m[1:] != m[:-1]
        first = np.where(diff.any(1), diff.argmax(1), width)
        out[at : at + len(first)] = np.minimum(first, np.minimum(size[at - 1 : at - 1 + len(first)], size[at : at + len(first)]))
    return out


def pack_run(entries: list[tuple[bytes, bytes, int, int, bool]]) -> bytes:
    """Front-codes sorted entries (suffix, reversed left context, key, position, done)."""
    shared = _neighbour_prefixes([e[0] for e in entries], LENGTH + 8)
    tails = [e[0][s:] for e, s in zip(entries, shared.tolist(), strict=True)]
    parts = [
        shared.astype(np.uint8).tobytes(),
        np.array([len(t) for t in tails], np.uint8).tobytes(),
        np.array([len(e[1]) for e in entries], np.uint8).tobytes(),
        np.array([e[4] for e in entries], np.uint8).tobytes(),
        np.array([e[2] for e in entries], np.int64).tobytes(),
        np.array([e[3] for e in entries], np.int32).tobytes(),
    ]
    body = struct.pack("<i", len(entries)) + b"".join(parts) + b"".join(tails) + b"".join(e[1] for e in entries)
    return zstandard.ZstdCompressor(level=3).compress(body)


class Run:
    """A front-coded run, read entry by entry: `suffix`, and `shared` with the entry before."""

    def __init__(self, blob: bytes) -> None:
        blob = zstandard.ZstdDecompressor().decompress(blob)
        n = self.n = struct.unpack_from("<i", blob)[0]
        at = 4
        cols = []
        for width in (1, 1, 1, 1, 8, 4):
            cols.append(blob[at : at + n * width])
            at += n * width
        self.shares, self.tail, self.left, self.done = cols[:4]
        self.keys, self.poss = np.frombuffer(cols[4], np.int64), np.frombuffer(cols[5], np.int32)
        self.blob, self.at = blob, at
        self.left_at = at + sum(self.tail)
        self.i, self.suffix, self.shared = -1, b"", 0

    def step(self) -> bool:
        self.i += 1
        i = self.i
        if i >= self.n:
            return False
        self.shared = self.shares[i]
        end = self.at + self.tail[i]
        self.suffix = self.suffix[: self.shared] + self.blob[self.at : end]
        self.at = end
        return True

    def context(self) -> bytes:
        a = self.left_at
        self.left_at += self.left[self.i]
        return self.blob[a : self.left_at]


def merge_runs(runs: list[Run]) -> Iterator[tuple[Run, int]]:
    """Runs in merged order: before each yield the run stands on the next entry; the number is the prefix it shares with
    the entry yielded before.

    A loser tree. Every waiting entry knows the prefix it shares with the last winner that it lost to. Of two entries the one
    that shares more with the last winner is less; only at equal shares are bytes compared, and only beyond that prefix."""
    live = [r for r in runs if r.step()]
    k = len(live)
    if not k:
        return
    share = [0] * k
    if k == 1:
        r = live[0]
        yield r, 0
        while r.step():
            yield r, r.shared
        return
    size = 1
    while size < k:
        size *= 2
    over = [i >= k for i in range(size)]
    share += [0] * (size - k)

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's share is then with the winner."""
        if over[a] or over[b]:
            return (b, a) if over[a] else (a, b)
        if share[a] != share[b]:
            return (a, b) if share[a] > share[b] else (b, a)
        x, y = live[a].suffix, live[b].suffix
        n = common_prefix(x, y, share[a])
        if x[n : n + 1] <= y[n : n + 1]:
            share[b] = n
            return a, b
        share[a] = n
        return b, a

    loser = [0] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size
        w, loser[node] = play(build(2 * node), build(2 * node + 1))
        return w

    win = build(1)
    while not over[win]:
        r = live[win]
        yield r, share[win]
        if r.step():
            share[win] = r.shared
        else:
            over[win] = True
        node, w = (win + size) >> 1, win
        while node:
            w, loser[node] = play(w, loser[node])
            node >>= 1
        win = w


def offsets(shared: np.ndarray, lefts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For sorted suffixes (shared: prefix in bytes of text with the one before; under GRAM starts a new gram) and their
    reversed left contexts: the least and greatest o at which left o and right 200 - o bytes are those of another entry; -1 if none."""
    n = len(lefts)
    least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    if n < 2:
        return least, most
    start = shared < GRAM
    start[0] = True
    gram = np.cumsum(start) - 1
    tags = [int(g).to_bytes(4, "big") + s for g, s in zip(gram.tolist(), lefts, strict=True)]
    order = sorted(range(n), key=tags.__getitem__)
    left_shared = _neighbour_prefixes([tags[i] for i in order], LEFT + 4) - 4
    left_shared[0] = -1
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    for o in range(LEFT + 1):
        right = np.cumsum(start | (shared < LENGTH - o))
        left = np.cumsum(left_shared < o)[back]
        both = right * (n + 1) + left
        by = np.argsort(both)
        s = both[by]
        twin = s[1:] == s[:-1]
        hit = np.zeros(n, bool)
        hit[by[1:][twin]] = True
        hit[by[:-1][twin]] = True
        most[hit] = o
        least[hit & (least < 0)] = o
    return least, most


_RUN_SCHEMA = "part long, key long, start int, end int, blob binary"


def _sort_runs(range_bits: int):
    """Rows (key, doc_id, bytes, anchors) -> known spans, and front-coded runs by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans: list[tuple[int, int, int]] = []
        entries: dict[tuple[bytes, bytes], list] = {}

        def out() -> pa.RecordBatch:
            part, key, start, end, blob = [], [], [], [], []
            for k, a, b in spans:
                part.append((k + a) % (1 << range_bits))
                key.append(k)
                start.append(a)
                end.append(b)
                blob.append(None)
            rows = sorted((s, left, k, p, done) for (s, left), (k, p, done) in entries.items())
            at = 0
            while at < len(rows):
                piece = int.from_bytes(rows[at][0][:8], "big") >> (64 - range_bits)
                to = at
                while to < len(rows) and int.from_bytes(rows[to][0][:8], "big") >> (64 - range_bits) == piece:
                    to += 1
                part.append(piece)
                key.append(None)
                start.append(None)
                end.append(None)
                blob.append(pack_run(rows[at:to]))
                at = to
            spans.clear()
            entries.clear()
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(key, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(blob, pa.binary())], ["part", "key", "start", "end", "blob"])

        for b in batches:
            for key, text, anchors in zip(b.column("key").to_pylist(), b.column("bytes"), b.column("anchors").to_pylist(), strict=True):
                t = text.as_py()
                for a in anchors:
                    p = a["pos"]
                    right = t[p : p + LENGTH]
                    left = t[max(0, p - LEFT) : p][::-1]
                    suffix = (a["hash"] & _MASK).to_bytes(8, "big") + right
                    old = entries.get((suffix, left))
                    if old is None:
                        entries[suffix, left] = [key, p, False]
                        continue
                    if len(left) + len(right) >= LENGTH:  # equal as far as any string through the anchor reaches
                        if not old[2]:
                            spans.append((old[0], old[1] - len(left), old[1] + len(right)))
                        spans.append((key, p - len(left), p + len(right)))
                    old[2] = True
                if len(entries) > 200_000 or len(spans) > 500_000:
                    yield out()
        if entries or spans:
            yield out()

    return run


def _solve(runs: list[Run]) -> list[tuple[int, int, int]]:
    """Spans (key, start, end) of the entries of one hash range."""
    shared, lefts, keys, poss, done = [], [], [], [], []
    for r, s in merge_runs(runs):
        i = r.i
        shared.append(max(0, s - 8))
        lefts.append(r.context())
        keys.append(r.keys[i])
        poss.append(r.poss[i])
        done.append(r.done[i])
    sh = np.array(shared)
    linked = sh >= GRAM
    linked[:1] = False
    inside = linked | np.r_[linked[1:], False]  # in a stretch of at least two entries
    pick = np.flatnonzero(inside)
    least, most = offsets(np.where(linked, sh, 0)[pick], [lefts[i] for i in pick])
    return [(int(keys[i]), int(poss[i]) - hi, int(poss[i]) - lo + LENGTH) for i, lo, hi in zip(pick.tolist(), least.tolist(), most.tolist(), strict=True) if hi >= 0 and not done[i]]


def _merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of part: spans pass, each range's runs are merged and answered."""
    part, runs = None, []

    def out(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
        k, a, b = (np.array(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32())], ["key", "start", "end"])

    for b in batches:
        is_run = b.column("blob").is_valid().to_numpy(zero_copy_only=False)
        passing = pa.Table.from_batches([b]).filter(pa.array(~is_run)).select(["key", "start", "end"])
        yield from passing.to_batches()
        for i in np.flatnonzero(is_run).tolist():
            now = b.column("part")[i].as_py()
            if now != part:
                if runs and (found := _solve(runs)):
                    yield out(found)
                part, runs = now, []
            runs.append(Run(b.column("blob")[i].as_py()))
    if runs and (found := _solve(runs)):
        yield out(found)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, doc_id, bytes, spans) -> the result columns and the text that is left."""
    for b in batches:
        n_bytes, removed, n_spans, sha, kept = [], [], [], [], []
        for text, spans in zip(b.column("bytes"), b.column("spans"), strict=True):
            t = text.as_py() or b""
            runs: list[list[int]] = []
            for s in sorted((x["start"], x["end"]) for x in (spans.as_py() or ())):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append([*s])
            if runs:
                edges = [0, *(x for r in runs for x in r), len(t)]
                t_kept = b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
            else:
                t_kept = t
            n_bytes.append(len(t))
            removed.append(len(t) - len(t_kept))
            n_spans.append(len(runs))
            sha.append(hashlib.sha256(t_kept).hexdigest())
            kept.append(t_kept)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept: the bytes that are left."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    bits = max(4, (4 * n - 1).bit_length())
    d = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"))
    grams = d.select("key", "bytes").mapInArrow(_find_anchors, _ANCHOR_SCHEMA)
    anchors = grams.repartition(n, "part").mapInArrow(_repeated, "key long, pos int, hash long")
    anchors = anchors.groupBy("key").agg(F.collect_set(F.struct("pos", "hash")).alias("anchors"))
    # Both joins deal the texts by key, so the second one reuses the first one's exchange.
    runs = d.join(anchors, "key").select("key", "doc_id", "bytes", "anchors").mapInArrow(_sort_runs(bits), _RUN_SCHEMA)
    spans = runs.repartition(n, "part").sortWithinPartitions("part").mapInArrow(_merge_ranges, "key long, start int, end int")
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return d.join(spans, "key", "left").select("key", "doc_id", "bytes", "spans").mapInArrow(_cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def suffix_query(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs).drop("kept")
