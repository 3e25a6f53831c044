"""Personal data: fixed patterns, and terms that give protected values away by what the corpus says about them.

The base finds e-mail addresses, IP addresses, card and phone numbers. The rest is information-theoretic: a protected value
e has information IC(e) = log(N / n_e) over the N documents. A term t, wherever it stands, discloses
PMI(e; t) = log(P(e | t) N / n_e), with P(e | t) from n_et of n_t documents: whole documents that hold both, and that hold t.
A few documents may agree by chance, so the lower end of P's 95 % interval (Wilson's) is used. A term whose share
PMI / IC reaches `generalise` is replaced by its class; from `remove` on, it nearly determines the value and is taken out. That
holds in every text, with the value or without it. Counts are over all documents, but a pair also needs `support` different texts.

Three passes read the texts. The first keeps values and terms of documents with values, once for each text. The second counts the
terms that stand beside supported values in at least `support` texts. Pairs are formed within documents only, after terms too
common to reach the share have been left out by a bound that loses none. The third finds told terms, beside the base spans. A
fixed-size bit table (4 MB at most) tells a task which words may count; what passes it by chance is dropped by an exact join.
No text is shuffled by the query; sanitising joins findings to texts once, on the id and two hashes of the text.

Defined cases: a null text counts as empty; null ids are ordinary; repeated rows count as documents each; an empty table gives an
empty result; other columns are ignored (sanitise keeps them, whatever their names).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import WORD, stage

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95
#: Square of the normal quantile of a 95 % interval.
_Z2 = 1.96**2
_BITS = 1 << 25

# Possessive runs and the look-behinds keep each scan linear; they match what the plain patterns match.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(WORD)
_DIGIT = re.compile(r"[0-9]")
_EDGE = re.compile(r"^\W+|\W+$")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(t: str) -> Iterator[tuple[int, int]]:
    """An address starts where the run of local characters before its @ starts, but not before the last one's end."""
    end, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > end and t[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = t.find("@", max(at + 1, end))


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(t)] if "@" in t else []
    if _DIGIT.search(t):
        if "." in t:
            out += [("ip", m.start(), m.end()) for m in _IP.finditer(t) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in t:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(t) if 9 <= len(_digits(m.group())) <= 15]
    return out


def term(word: str) -> str | None:
    """The form in which a word is counted: lower case, without marks at its ends; None if too short to tell anything."""
    w = _EDGE.sub("", word).lower()
    return w if len(w) >= 3 and not w.isdigit() else None


def protected(t: str, spans: list[tuple[str, int, int]]) -> list[str]:
    """The distinct protected values (kind and text) of base spans."""
    value = {"email": str.lower, "ip": str, "card": _digits, "phone": _digits}
    return sorted({f"{k}:{value[k](t[a:b])}" for k, a, b in spans})


def beside(t: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with base spans blanked: what is left of words keeps its place."""
    if not spans:
        return t
    out, at = [], 0
    for a, b in sorted((a, b) for _, a, b in spans):  # spans of two kinds may overlap
        out += [t[at:a], " " * (b - max(a, at))]
        at = max(at, b)
    return "".join([*out, t[at:]])


class Terms:
    """Words to the terms whose bit is on, kept for words that return; bounded."""

    def __init__(self, bits: bytes, most: int = 500_000) -> None:
        self.bits, self.most = bits, most
        self.known: dict[str, str | None] = {}

    def of(self, word: str) -> str | None:
        import xxhash

        k = self.known.get(word, "")
        if k == "":
            if len(self.known) > self.most:
                self.known.clear()
            k = term(word)
            if k is not None:
                h = xxhash.xxh64_intdigest(k.encode("utf-8", "replace"), 42)
                h = (h - (1 << 64) if h >> 63 else h) % _BITS
                k = k if self.bits[h >> 3] >> (h & 7) & 1 else None
            self.known[word] = k
        return k


_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, near array<struct<term:string,start:int,end:int>>"
_NEAR = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_spans(docs: DataFrame, told: DataFrame, *keep: str) -> DataFrame:
    """The columns in keep, counts by kind, the base spans as text and their digest, and the words that may be told terms."""
    names = list(keep)
    sent = docs.sparkSession.sparkContext.broadcast(_bit_table(told))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty, terms = hashlib.sha256(b"").hexdigest(), Terms(sent.value)
        for b in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            base, sha, near = [], [], []
            for cell in b.column(len(names)):
                t = cell.as_py() or ""
                spans = base_spans(t)
                c = Counter(k for k, _, _ in spans)
                for k in KINDS:
                    counts[k].append(c[k])
                base.append(text := ",".join(f"{k}:{x}:{y}" for k, x, y in spans))
                sha.append(hashlib.sha256(text.encode()).hexdigest() if spans else empty)
                rest = beside(t, spans)
                hits = {w: k for w in set(_WORD.findall(rest)) if (k := terms.of(w))}
                near.append([{"term": hits[m.group()], "start": m.start(), "end": m.end()} for m in _WORD.finditer(rest) if m.group() in hits] if hits else [])
            arrays = [*b.columns[: len(names)], *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(base, pa.string()), pa.array(sha, pa.string()), pa.array(near, _NEAR)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *(f"n_{k}" for k in KINDS), "base", "base_sha256", "near"])

    src = docs.select(*names, F.col("text").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[: len(names)])
    return src.mapInArrow(run, f"{kept}, {_FOUND}" if names else _FOUND)


def _holders(docs: DataFrame) -> DataFrame:
    """(h1, h2, values, terms) of each row that holds a value: hashes of the text, its distinct values and terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, values, terms = [], [], []
            for i, cell in enumerate(b.column(2)):
                t = cell.as_py() or ""
                if spans := base_spans(t):
                    at.append(i)
                    values.append(protected(t, spans))
                    terms.append(sorted({k for w in set(_WORD.findall(beside(t, spans))) if (k := term(w))}))
            pick = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), pa.array(values, pa.list_(pa.string())), pa.array(terms, pa.list_(pa.string()))], ["h1", "h2", "values", "terms"])

    src = docs.select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), F.col("text").alias("_text"))
    return src.mapInArrow(run, "h1 long, h2 long, values array<string>, terms array<string>")


def _bit(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(_BITS)).cast("long")


def _bit_table(terms: DataFrame) -> bytes:
    """One bit for each term of the column term; at most _BITS of them, however many terms there are."""
    bit = _bit(F.col("term")) + 1  # Spark counts bits from 1
    parts = terms.groupBy(F.bitmap_bucket_number(bit).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("b")).collect()
    table = np.zeros(_BITS // 8 + 8192, np.uint8)
    for r in parts:
        at = (r["k"] - 1) * 4096
        table[at : at + 4096] |= np.frombuffer(bytes(r["b"]), np.uint8)
    return table.tobytes()


def _term_counts(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(term, n_t): in how many documents each candidate term stands. candidates: distinct terms."""
    sent = docs.sparkSession.sparkContext.broadcast(_bit_table(candidates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = Terms(sent.value), Counter()

        def out() -> pa.RecordBatch:
            rb = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
            counts.clear()
            return rb

        for b in batches:
            for cell in b.column(0):
                t = cell.as_py() or ""
                counts.update({k for w in set(_WORD.findall(beside(t, base_spans(t)))) if (k := terms.of(w))})
                if len(counts) > 200_000:
                    yield out()
        if counts:
            yield out()

    found = docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_t"))
    return found.join(candidates, "term")


def disclosures(docs: DataFrame, support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """(value, term, share): terms that disclose a protected value by at least that share of its information."""
    n = float(docs.count())
    src = stage(_holders(docs), "pii-holders")
    src = src.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("m"), F.first("values").alias("values"), F.first("terms").alias("terms"))
    src = stage(src.withColumn("_row", F.monotonically_increasing_id()), "pii-texts")
    held = src.select("_row", "m", F.explode("values").alias("value"))
    values = held.groupBy("value").agg(F.sum("m").alias("n_e"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= support).drop("texts")
    held = stage(held.join(values, "value"), "pii-values")
    terms = src.join(held.select("_row").distinct(), "_row", "left_semi").select("_row", F.explode("terms").alias("term"))
    few = terms.groupBy("term").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= support).select("term")
    n_t = stage(_term_counts(docs, stage(few, "pii-candidates")), "pii-counts")
    # P(e | t) is at most n_e / n_t, so a share of `least` needs log(N / n_t) >= least * log(N / n_e).
    info = lambda c: F.log(F.lit(n) / F.col(c))
    terms = terms.join(n_t.withColumn("info_t", info("n_t") + 1e-9), "term")
    held = held.withColumn("need", info("n_e") * least)
    pairs = held.join(terms, (held._row == terms._row) & (terms.info_t >= held.need), "inner")
    pairs = pairs.groupBy("value", "n_e", "term", "n_t").agg(F.sum("m").alias("n_et"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= support)
    p = F.col("n_et") / F.col("n_t")
    low = (p + _Z2 / (2 * F.col("n_t")) - F.sqrt(_Z2 * (p * (1 - p) + _Z2 / (4 * F.col("n_t"))) / F.col("n_t"))) / (1 + _Z2 / F.col("n_t"))
    share = F.when(info("n_e") > 0, F.log(low * F.lit(n) / F.col("n_e")) / info("n_e"))
    return pairs.withColumn("share", share).where(F.col("share") >= least).select("value", "term", "share")


def term_spans(found: DataFrame, told: DataFrame) -> DataFrame:
    """(_row, extra): the spans of told terms of each row that has any, by start. told: (term, share)."""
    at = found.select("_row", F.explode("near").alias("t")).select("_row", "t.term", "t.start", "t.end").join(told, "term")
    return at.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("extra"))


def _scan(docs: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Findings of each row, numbered by _row, and the spans of terms told of any value, with the largest share."""
    told = stage(disclosures(docs).groupBy("term").agg(F.max("share").alias("share")), "pii-told")
    found = stage(find_spans(docs, told, *keep).withColumn("_row", F.monotonically_increasing_id()), "pii-found")
    return found, stage(term_spans(found, told), "pii-terms")


def pii_query(docs: DataFrame) -> DataFrame:
    found, extra = _scan(docs, "doc_id")
    more = F.array_join(F.transform("extra", lambda s: F.concat(F.lit("term:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
    d = found.drop("near").join(extra, "_row", "left")
    spans = F.concat_ws(",", F.nullif(F.col("base"), F.lit("")), more)
    return d.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"))


def _rewrite(t: str, base: str, extra: list[tuple[int, int, float]]) -> str:
    """The text with values replaced by their kind and disclosing terms by their class, or nothing from REMOVE on."""
    cuts = [(int(x), int(y), f"[{k.upper()}]") for k, x, y in (s.split(":") for s in base.split(",") if s)]
    for x, y, share in extra:
        w = t[x:y]
        cuts.append((x, y, "" if share >= REMOVE else "[NUMBER]" if any(c.isdigit() for c in w) else "[NAME]" if w[:1].isupper() else "[TERM]"))
    out, at = [], 0
    for x, y, label in sorted(cuts):
        if x < at:  # values may overlap: the first one's label stands for both
            at = max(at, y)
            continue
        out += [t[at:x], label]
        at = y
    return "".join([*out, t[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """docs with its columns; texts with findings are rewritten and n_chars, where there is one, follows."""
    keyed = docs.withColumns({"_h1": F.xxhash64("text"), "_h2": F.xxhash64(F.lit(1), "text")})
    found, extra = _scan(keyed, "doc_id", "_h1", "_h2")
    d = found.drop("near").join(extra, "_row", "left").where((F.col("base") != "") | F.col("extra").isNotNull())
    # Rows equal in id and text have equal findings: one row for each key.
    d = d.groupBy(F.col("doc_id").alias("_id"), F.col("_h1").alias("_t1"), F.col("_h2").alias("_t2")).agg(F.min("base").alias("_base"), F.min("extra").alias("_extra"))
    d = stage(d, "pii-edits").hint("merge")  # it grows with the corpus: joined by exchange at every size
    j = keyed.join(d, keyed.doc_id.eqNullSafe(d._id) & (keyed._h1 == d._t1) & (keyed._h2 == d._t2), "left")

    @F.pandas_udf("string")
    def rewrite(text, base, extra):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([None if b is None else _rewrite(t or "", b, [(e["start"], e["end"], e["share"]) for e in (x if x is not None else ())]) for t, b, x in zip(text, base, extra, strict=True)], dtype=object)

    hit = F.col("_base").isNotNull()
    j = j.withColumn("_new", rewrite(F.when(hit, F.col("text")), "_base", "_extra"))  # other texts don't travel to Python
    out = {"text": F.when(hit, F.col("_new")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(hit, F.char_length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return j.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])
