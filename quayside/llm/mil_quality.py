"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words; all of it is read. A passage's input is the mean of fixed random vectors hashed
from its words and measures of their shape. A learned layer encodes it, gated attention weighs it,
    a_k = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k))),
and the score is a logistic of the weighted passage representation. Only document labels train it.

Executors make the passage inputs, of the training sample too, so the driver gets numbers, never texts. The sample is the
`SAMPLE` labelled rows of least hash (rows whose crc32(doc_id) mod 4 is 2 are never learnt from), one for each doc_id, with all their
passages. Samples of any size are learnt from in the same `STEPS` batches. Scoring reads every document.

Defined cases: null and empty texts are a bag of one blank passage and are scored like any other; null ids are not held out and
not learnt from; a row of labels with a null or unknown quality is skipped, of several for an id the least counts; without labelled
rows every score is 0.5; repeated rows score alike, and an id is learnt from once; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 64
WORD_DIM, SHAPE_DIM, EXTRA = 16, 9, 3
INPUT = WORD_DIM + SHAPE_DIM + EXTRA
CODE, GATE = 24, 12
BUCKETS = 1 << 14
SAMPLE = 6000
STEPS, BATCH, RATE, DECAY, SEED = 2000, 64, 0.005, 1e-5, 7
THRESHOLD = 0.7

_SYMBOLS = frozenset("#*$%&|<>@=_{}[]\\^~/+")
_VECTORS = np.random.default_rng(SEED).normal(0, 1, (BUCKETS, WORD_DIM)).astype(np.float32)


def held_out(doc_id: Column | str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4 == 2, F.lit(False))


def _shape(w: str) -> tuple[float, ...]:
    n = len(w)
    upper = sum(c.isupper() for c in w)
    letters = sum(c.isalpha() for c in w)
    digits = sum(c.isdigit() for c in w)
    symbols = sum(c in _SYMBOLS for c in w)
    return (min(n, 30) / 10, upper / n, letters / n, digits / n, symbols / n, float(upper > 1 and upper == letters), float(symbols > 0), float(w[-1] in ".!?,;:"), float(n > 20))


class Words:
    """Rows of word inputs, kept for words that return; bounded."""

    def __init__(self, most: int = 300_000) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((4096, WORD_DIM + SHAPE_DIM), np.float32)

    def index(self, ws: list[str]) -> np.ndarray:
        try:
            return np.fromiter(map(self.at.__getitem__, ws), np.int64, len(ws))
        except KeyError:
            pass
        new = [w for w in set(ws) if w not in self.at]
        if len(self.at) + len(new) > self.most:
            self.clear()
            new = list(set(ws))
        need = len(self.at) + len(new)
        if need > len(self.rows):
            grown = np.zeros((max(2 * len(self.rows), need), WORD_DIM + SHAPE_DIM), np.float32)
            grown[: len(self.rows)] = self.rows
            self.rows = grown
        start = len(self.at)
        self.rows[start:need, :WORD_DIM] = _VECTORS[[zlib.crc32(w.encode("utf-8", "replace")) % BUCKETS for w in new]]
        self.rows[start:need, WORD_DIM:] = [_shape(w) for w in new] if new else np.zeros((0, SHAPE_DIM))
        self.at.update(zip(new, range(start, need), strict=True))
        return np.fromiter(map(self.at.__getitem__, ws), np.int64, len(ws))


def passages(text: str, known: Words) -> np.ndarray:
    """The inputs of a text's passages, one row each."""
    ws = text.split()
    n = len(ws)
    if not n:
        return np.zeros((1, INPUT), np.float32)
    idx = known.index(ws)
    starts = np.arange(0, n, PASSAGE)
    sizes = np.diff(np.r_[starts, n]).astype(np.float32)
    out = np.empty((len(starts), INPUT), np.float32)
    for at in range(0, len(starts), 1024):  # a long text a slice at a time
        a, b = at * PASSAGE, min(n, (at + 1024) * PASSAGE)
        rows = known.rows[idx[a:b]]
        part = slice(at, at + 1024)
        out[part, : WORD_DIM + SHAPE_DIM] = np.add.reduceat(rows, starts[part] - a, axis=0) / sizes[part, None]
    ordered = idx + (np.arange(n) // PASSAGE) * (len(known.at) + 1)
    fresh = np.unique(ordered)
    distinct = np.bincount(fresh // (len(known.at) + 1), minlength=len(starts))
    out[:, -3] = distinct / sizes
    out[:, -2] = sizes / PASSAGE
    out[:, -1] = len(set(ws)) / n
    return out


def _softmax(s: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    e = np.exp(s - np.maximum.reduceat(s, starts)[owner])
    return e / np.add.reduceat(e, starts)[owner]


class Model:
    """w: scale and shift of inputs, we/be, v/bv, u/bu, a, c, d."""

    def __init__(self, w: dict[str, np.ndarray]) -> None:
        self.w = w

    def forward(self, x: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
        w = self.w
        h = np.tanh(((x - w["shift"]) / w["scale"]) @ w["we"] + w["be"])
        tv, su = np.tanh(h @ w["v"] + w["bv"]), 1 / (1 + np.exp(-(h @ w["u"] + w["bu"])))
        att = _softmax((tv * su) @ w["a"], starts, owner)
        z = np.add.reduceat(att[:, None] * h, starts, axis=0)
        return 1 / (1 + np.exp(-(z @ w["c"] + w["d"]))), h, tv, su, att, z

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        out, at = np.empty(len(bags)), 0
        while at < len(bags):
            end, rows = at, 0
            while end < len(bags) and (end == at or rows + len(bags[end]) <= 8192):
                rows += len(bags[end])
                end += 1
            sizes = np.array([len(b) for b in bags[at:end]])
            starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(end - at), sizes)
            out[at:end] = self.forward(np.concatenate(bags[at:end]).astype(float), starts, owner)[0]
            at = end
        return out


def start(x: np.ndarray) -> dict[str, np.ndarray]:
    """Weights before learning, scaled to the inputs x."""
    rng = np.random.default_rng(SEED)
    return {
        "we": rng.normal(0, INPUT**-0.5, (INPUT, CODE)), "be": np.zeros(CODE),
        "v": rng.normal(0, CODE**-0.5, (CODE, GATE)), "bv": np.zeros(GATE),
        "u": rng.normal(0, CODE**-0.5, (CODE, GATE)), "bu": np.zeros(GATE),
        "a": rng.normal(0, GATE**-0.5, GATE), "c": np.zeros(CODE), "d": np.zeros(()),
        "shift": x.mean(0), "scale": x.std(0) + 1e-3,
    }


def gradients(model: Model, bags: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss over the bags, by each learnt weight."""
    w = model.w
    sizes = np.array([len(b) for b in bags])
    starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(bags)), sizes)
    x = np.concatenate(bags).astype(float)
    p, h, tv, su, att, z = model.forward(x, starts, owner)
    do = (p - labels) / len(bags)
    g = {"c": z.T @ do, "d": do.sum()}
    dz = do[:, None] * w["c"]
    datt = (dz[owner] * h).sum(1)
    ds = att * (datt - np.add.reduceat(att * datt, starts)[owner])
    g["a"] = (tv * su).T @ ds
    dv, du = ds[:, None] * w["a"] * su * (1 - tv**2), ds[:, None] * w["a"] * tv * su * (1 - su)
    g["v"], g["bv"], g["u"], g["bu"] = h.T @ dv, dv.sum(0), h.T @ du, du.sum(0)
    dh = (att[:, None] * dz[owner] + dv @ w["v"].T + du @ w["u"].T) * (1 - h**2)
    g["we"], g["be"] = ((x - w["shift"]) / w["scale"]).T @ dh, dh.sum(0)
    return g


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """Adam on the documents' log loss, in STEPS batches; the same bags in the same order give the same model."""
    rng = np.random.default_rng(SEED)
    model = Model(start(np.concatenate(bags).astype(float) if bags else np.zeros((1, INPUT))))
    w = model.w
    learnt = [k for k in w if k not in ("shift", "scale")]
    m1, m2 = {k: np.zeros_like(w[k]) for k in learnt}, {k: np.zeros_like(w[k]) for k in learnt}
    order = np.empty(0, np.int64)
    for step in range(1, STEPS + 1 if bags else 1):
        while len(order) < BATCH:  # a new pass through the bags, in a new order
            order = np.r_[order, rng.permutation(len(bags))]
        pick, order = order[:BATCH], order[BATCH:]
        g = gradients(model, [bags[i] for i in pick], labels[pick])
        rate = RATE * (1 - 0.9 * step / STEPS)
        for k in learnt:
            gk = g[k] + DECAY * w[k]
            m1[k] = 0.9 * m1[k] + 0.1 * gk
            m2[k] = 0.999 * m2[k] + 0.001 * gk**2
            w[k] -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return model


def training_bags(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Passage inputs and labels of the sample, in order of hash."""
    marks = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumn("h", F.xxhash64("doc_id"))
    chosen = marks.orderBy("h", "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by the sample
    # A doc_id may stand on several rows: the text of least hash counts, so that no more than the sample comes back.
    rows = rows.withColumn("t", F.xxhash64("text"))
    one = rows.groupBy("doc_id").agg(F.min("t").alias("t"))
    rows = rows.join(F.broadcast(one), ["doc_id", "t"]).dropDuplicates(["doc_id", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for b in batches:
            bags = []
            for t in b.column(0):
                bags.append(passages(t.as_py() or "", known).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(bags, pa.binary()), b.column(1), b.column(2)], ["bag", "quality", "h"])

    got = rows.select("text", F.col("quality").cast("int").alias("quality"), "h").mapInArrow(run, "bag binary, quality int, h long").collect()
    got.sort(key=lambda r: (r["h"], bytes(r["bag"])))
    return [np.frombuffer(bytes(r["bag"]), np.float32).reshape(-1, INPUT) for r in got], np.array([r["quality"] for r in got], float)


def score_documents(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns in keep and score."""
    sent = docs.sparkSession.sparkContext.broadcast(model.w)
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, net = Words(), Model(sent.value)
        for b in batches:
            scores: list[np.ndarray] = []
            col = b.column(len(names))
            for at in range(0, len(col), 256):
                scores.append(net.score([passages(t.as_py() or "", known) for t in col.slice(at, 256)]))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(np.concatenate(scores) if scores else np.empty(0))], [*names, "score"])

    src = docs.select(*names, F.col("text").alias("_text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[: len(names)])
    return src.mapInArrow(run, f"{kept}score double")


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(*training_bags(docs, labels))
    d = score_documents(docs, model, "doc_id")
    return d.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
