"""SentencePiece encoding and decoding with a public BPE model, as a lattice that is folded word by word.

The lattice of a word is relational: its substrings up to the longest piece, equi-joined to the piece table, grouped by word. A
Viterbi fold from left to right keeps the best way to reach each position. In a BPE model the scores are merge ranks, so the best
sum of scores is not what the model encodes; instead an edge may follow another only if the two pieces, side by side, would not
have merged differently. Under that transition rule at most one edge reaches a position, the fold is exact, and the ids
equal those of the model's own encoder (tests hold it against the library).

Whether pieces p, q may stand side by side: a runs over what lies at p's right end while p is built (p, its right half, ...), b
over the same at q's left end. If a and b are there at the same time and a + b is a piece that merges before either is
taken up by its own parent, p and q are never neighbours.

The join and the fold run over Arrow batches, vectorised over all new words of a batch; a bounded cache keeps words that
return. The same lattice as a Spark plan is in `relational`; README has the figures of both.

Spaces are written as U+2581 with one in front of the text. White-space-only pieces share one score, so runs of spaces follow the
leftmost-first rule apart from the lattice. Characters that no piece covers become byte pieces.

Defined cases: null and empty texts have no ids and decode to the empty text; any length (words over `LONG` characters are folded one
by one, in linear time); null ids and repeated rows stay as they are; an empty table gives an empty result; other columns are
ignored. A text that contains U+2581 itself decodes to a space there, as in the library.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
LONG = 64
CHUNK = 20_000
CACHE = 300_000
_BIG = 1 << 30
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_UNIT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


class _Table:
    """An open-addressing hash table from 64-bit keys to integers, probed for whole arrays at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(len(keys)).bit_length() + 3)
        self.shift = np.uint64(64 - bits)
        size = 1 << bits
        self.mask = size - 1
        self.keys, self.values = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        slots = ((keys * _MIX) >> self.shift).astype(np.int64)
        for k, v, s in zip(keys.tolist(), values.tolist(), slots.tolist(), strict=True):
            while self.values[s] >= 0:
                if int(self.keys[s]) == k:
                    raise ValueError("two entries share a key")
                s = (s + 1) & self.mask
            self.keys[s], self.values[s] = k, v

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = ((keys * _MIX) >> self.shift).astype(np.int64)
        out = self.values[slot]
        off = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(off):
            slot[off] = (slot[off] + 1) & self.mask
            out[off] = self.values[slot[off]]
            off = off[(out[off] >= 0) & (self.keys[slot[off]] != keys[off])]
        return out


def _hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


@dataclass
class PieceModel:
    """Arrays over piece ids. Bounded by the vocabulary, so it may be broadcast."""

    n: int
    surface: list[bytes]  # what an id decodes to
    text: list[str | None]  # of lattice pieces
    rank: np.ndarray  # merge rank, -1 for single characters
    length: np.ndarray
    right: tuple[np.ndarray, np.ndarray]  # ids at the right end while a piece is built, and when each is taken up
    left: tuple[np.ndarray, np.ndarray]
    edges: _Table  # hash of a substring -> id
    pairs: _Table  # a * n + b -> rank of their merge
    chars: np.ndarray  # code point -> id, n (the unknown) otherwise
    bytes_at: int  # id of the piece for byte 0
    runs: list[list[int]]  # ids of 0..15 spaces
    full_run: list[int]  # ids of 16

    def __post_init__(self) -> None:
        self.scalar_ok: dict[tuple[int, int], bool] = {}
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)
        self.size = np.array([len(s) for s in self.surface], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.by_text = {t: i for i, t in enumerate(self.text) if t is not None}
        self.longest = int(self.length.max())


def _merge(symbols: list[str], rank: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Byte-pair merges: lowest rank first, leftmost of equal ones; and the last pair merged."""
    last = None
    while len(symbols) > 1:
        best = min(((r, i) for i in range(len(symbols) - 1) if (r := rank.get(symbols[i] + symbols[i + 1])) is not None), default=None)
        if best is None:
            break
        i = best[1]
        last = (symbols[i], symbols[i + 1])
        symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]
    return symbols, last


def load_model(path: str = DEFAULT_MODEL) -> PieceModel:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
    is_byte = [sp.is_byte(i) for i in range(n)]
    surface = [b"" if special[i] else bytes([int(names[i][3:-1], 16)]) if is_byte[i] else names[i].replace(SPACE, " ").encode() for i in range(n)]
    blank = {t for t in names if len(t) > 1 and not t.strip(SPACE)}
    usable = {t: i for i, t in enumerate(names) if not special[i] and not is_byte[i] and t not in blank}
    order = {t: r for r, t in enumerate(sorted((t for t in usable if len(t) > 1), key=lambda t: -sp.get_score(usable[t])))}
    split = {}
    for t in list(order):
        whole, last = _merge(list(t), order)
        if whole == [t]:
            split[t] = last
        else:  # never produced by merges, so not an edge
            del usable[t]
    rank, length = np.full(n + 1, -1, np.int64), np.ones(n + 1, np.int64)
    for t, i in usable.items():
        rank[i], length[i] = order.get(t, -1), len(t)

    def ends(side: int) -> tuple[np.ndarray, np.ndarray]:
        chains = {}
        for t, i in usable.items():
            chain, until = [], _BIG
            while True:
                chain.append((usable[t], until))
                if len(t) == 1:
                    break
                until, t = order[t], split[t][side]
            chains[i] = chain
        depth = max(map(len, chains.values()), default=1)
        ids, untils = np.full((n + 1, depth), -1, np.int32), np.full((n + 1, depth), _BIG, np.int64)
        ids[n, 0] = n
        for i, chain in chains.items():
            for k, (x, u) in enumerate(chain):
                ids[i, k], untils[i, k] = x, u
        return ids, untils

    pair_keys, pair_ranks = [], []
    for t in split:
        for k in range(1, len(t)):
            if t[:k] in usable and t[k:] in usable:
                pair_keys.append(usable[t[:k]] * n + usable[t[k:]])
                pair_ranks.append(order[t])
    chars = np.full(0x110000, n, np.int32)
    for t, i in usable.items():
        if len(t) == 1:
            chars[ord(t)] = i
    blanks = {t: 0 for t in blank}
    ids = {t: i for i, t in enumerate(names)}
    runs = [[ids[s] for s in _merge([SPACE] * k, blanks)[0]] for k in range(17)]
    text: list[str | None] = [None] * n
    for t, i in usable.items():
        text[i] = t
    return PieceModel(
        n, surface, text, rank, length, ends(1), ends(0),
        _Table(np.array([_hash(t) for t in split], np.uint64), np.array([usable[t] for t in split], np.int32)),
        _Table(np.array(pair_keys, np.uint64), np.array(pair_ranks, np.int32)),
        chars, names.index("<0x00>"), runs[:16], runs[16],
    )


def _conflict(m: PieceModel, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether pieces p and q, side by side, would have merged differently."""
    bad = np.zeros(len(p), bool)
    at = np.arange(len(p))
    for i in range(m.right[0].shape[1]):
        a = m.right[0][p[at], i]
        at = at[(a >= 0) & ~bad[at]]
        if not len(at):
            break
        sub = at
        for j in range(m.left[0].shape[1]):
            b = m.left[0][q[sub], j]
            sub = sub[(b >= 0) & ~bad[sub]]
            if not len(sub):
                break
            a, b = m.right[0][p[sub], i], m.left[0][q[sub], j]
            ua, ub = m.right[1][p[sub], i], m.left[1][q[sub], j]
            both = np.flatnonzero((m.rank[a] < ub) & (m.rank[b] < ua) & (a < m.n) & (b < m.n))
            if len(both):
                r = m.pairs.find(a[both].astype(np.uint64) * np.uint64(m.n) + b[both].astype(np.uint64))
                hit = both[(r >= 0) & (r < ua[both]) & (r <= ub[both])]
                bad[sub[hit]] = True
    return bad


def _fold(m: PieceModel, words: list[str]) -> list[bytes]:
    """Lattice and fold of many words at once: the ids of each as packed 32-bit integers."""
    lens = np.array([len(w) for w in words])
    count, width = len(words), int(lens.max())
    codes = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(count, width)
    hashed = codes.astype(np.uint64) + np.uint64(1)
    upto = np.zeros((count, width + 1), np.uint64)
    for k in range(width):
        upto[:, k + 1] = upto[:, k] * _BASE + hashed[:, k]
    single = m.chars[codes]
    powers = np.multiply.accumulate(np.full(m.longest + 1, _BASE, np.uint64))  # powers[k] = base ** (k + 1)
    # last[w, j] is the piece that ends at j on the one way there.
    last = np.full((count, width + 1), -1, np.int32)
    for i in range(width):
        rows = np.flatnonzero((lens > i) & ((last[:, i] >= 0) | (i == 0)))
        if not len(rows):
            continue
        # Explode and equi-join: all substrings from here, against the piece table.
        most = min(m.longest, width - i)
        e = np.full((len(rows), most), -1, np.int32)
        e[:, 0] = single[rows, i]
        if most > 1:
            at = upto[rows, i]
            h = upto[rows, i + 2 : i + most + 1] - at[:, None] * powers[1:most]
            e[:, 1:] = m.edges.find(h.ravel()).reshape(h.shape)
        # Fold: of the edges from here, those that may follow the piece that ends here.
        r, k = np.nonzero(e >= 0)
        q, w = e[r, k], rows[r]
        if i:
            ok = ~_conflict(m, last[w, i], q)
            k, q, w = k[ok], q[ok], w[ok]
        inside = i + 1 + k <= lens[w]
        last[w[inside], i + 1 + k[inside]] = q[inside]
    pos, live, steps, sizes = lens.copy(), np.arange(count), [], np.zeros(count, np.int64)
    while len(live):
        t = last[live, pos[live]]
        steps.append((live, t))
        sizes[live] += 1
        pos[live] -= m.length[t]
        live = live[pos[live] > 0]
    ends = np.cumsum(sizes)
    flat = np.empty(int(ends[-1]), np.int32)
    for k, (live, t) in enumerate(steps):
        flat[ends[live] - 1 - k] = t
    unknown = np.maximum.reduceat(flat, ends - sizes) == m.n
    packed = flat.tobytes()
    cuts = (4 * ends).tolist()
    out = [packed[x:y] for x, y in zip([0, *cuts], cuts, strict=False)]
    for i in np.flatnonzero(unknown).tolist():
        out[i] = _with_bytes(m, words[i], np.frombuffer(out[i], np.int32).tolist())
    return out


def _fold_one(m: PieceModel, word: str) -> list[int]:
    """The same fold for one long word, in time linear in its length."""
    n = len(word)
    last = [-1] * (n + 1)
    for i in range(n):
        if i and last[i] < 0:
            continue
        for k in range(1, min(m.longest, n - i) + 1):
            q = m.by_text.get(word[i : i + k], m.n if k == 1 else -1)
            if q < 0:
                continue
            if i:
                pair = (last[i], q)
                ok = m.scalar_ok.get(pair)
                if ok is None:
                    ok = m.scalar_ok[pair] = not _conflict(m, np.array([pair[0]]), np.array([pair[1]]))[0]
                if not ok:
                    continue
            last[i + k] = q
    out, i = [], n
    while i > 0:
        out.append(last[i])
        i -= int(m.length[last[i]])
    return out[::-1]


def encode_words(m: PieceModel, words: list[str]) -> dict[str, bytes]:
    """Packed ids of distinct words (runs of characters without inner spaces)."""
    found: dict[str, bytes] = {}
    order = sorted((w for w in words if len(w) <= LONG and "\x00" not in w), key=len)
    for at in range(0, len(order), CHUNK):
        part = order[at : at + CHUNK]
        found.update(zip(part, _fold(m, part), strict=True))
    if len(order) < len(words):
        for w in words:
            if w not in found:
                found[w] = _with_bytes(m, w, _fold_one(m, w))
    return found


def _with_bytes(m: PieceModel, word: str, ids: list[int]) -> bytes:
    """Packs ids, with byte pieces in place of unknown characters."""
    out, at = [], 0
    for i in ids:
        if i == m.n:
            out += [m.bytes_at + b for b in word[at].encode("utf-8", "replace")]
        else:
            out.append(i)
        at += int(m.length[i])
    return np.array(out, np.int32).tobytes()


def space_run(m: PieceModel, k: int) -> list[int]:
    return m.full_run * (k // 16) + m.runs[k % 16]


_ENCODERS: dict[int, "Encoder"] = {}


class Encoder:
    """Texts -> ids, with a bounded cache of words."""

    def __init__(self, model: PieceModel) -> None:
        self.m = model
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.lone = model.by_text.get(SPACE, -1)

    def _runs(self, unit: str) -> tuple[int, str]:
        k = len(unit) - len(unit.lstrip(SPACE))
        return (k, "") if k == len(unit) else (max(0, k - 1), unit[max(0, k - 1) :])

    def _learn(self, units: set[str]) -> None:
        if len(self.cache) > CACHE // 2:  # words in use move on to the new half, the others go with the old one
            self.cache, self.old = {}, self.cache
        new = units.difference(self.cache)
        back = new.intersection(self.old)
        self.cache.update((u, self.old[u]) for u in back)
        new -= back
        runs = {u: self._runs(u) for u in new if u.startswith(SPACE + SPACE) or u == SPACE}
        plain = [u for u in new if u not in runs] if runs else list(new)
        self.cache.update(encode_words(self.m, plain))
        words = encode_words(self.m, list({w for _, w in runs.values() if w}))
        for u, (k, w) in runs.items():
            got = np.frombuffer(words[w], np.int32) if w else np.empty(0, np.int32)
            if k and len(got) and got[0] == self.lone:  # the last space stayed alone, so it belongs to the run
                k, got = k + 1, got[1:]
            self.cache[u] = np.concatenate([space_run(self.m, k), got]).astype(np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= 1_000_000):
                size += len(texts[end])
                end += 1
            cut = [_UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts[at:end]]
            self._learn(set().union(*cut))
            get = self.cache.__getitem__
            out += [np.frombuffer(b"".join(map(get, u)), np.int32) for u in cut]
            at = end
        return out


def decode(m: PieceModel, ids: np.ndarray) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD."""
    ids = np.asarray(ids, np.int64)
    if not len(ids):
        return ""
    size = m.size[ids]
    ends = np.cumsum(size)
    flat = m.flat[np.repeat(m.start[ids] - ends + size, size) + np.arange(int(ends[-1]))]
    text = flat.tobytes().decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode_documents(docs: DataFrame, *keep: str, model_path: str = DEFAULT_MODEL) -> DataFrame:
    """The columns in keep, n_pieces, ids, and round_trip: whether decoding gives the text back."""
    model = load_model(model_path)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quayside.llm import pieces  # the worker's own copy, so the words it has met outlive a task

        model_key = id(sent.value)
        if model_key not in pieces._ENCODERS:
            pieces._ENCODERS.clear()
            pieces._ENCODERS[model_key] = Encoder(sent.value)
        enc = pieces._ENCODERS[model_key]
        for b in batches:
            texts = [t or "" for t in b.column(len(names)).to_pylist()]
            ids = enc.encode(texts)
            back = [decode(enc.m, x) == t for x, t in zip(ids, texts, strict=True)]
            sizes = np.array([len(x) for x in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            arrays = [*b.columns[: len(names)], pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())), pa.array(back)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "n_pieces", "ids", "round_trip"])

    src = docs.select(*names, F.col("text").alias("_text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[: len(names)])
    return src.mapInArrow(run, f"{kept}n_pieces long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, *keep: str, model_path: str = DEFAULT_MODEL) -> DataFrame:
    """The columns in keep and text, from ids."""
    model = load_model(model_path)
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [decode(sent.value, np.array(x or [], np.int64)) for x in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(texts, pa.string())], [*names, "text"])

    src = encoded.select(*names, "ids")
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[: len(names)])
    return src.mapInArrow(run, f"{kept}text string")
