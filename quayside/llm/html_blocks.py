"""Main text of HTML pages by a recurrent block labeller.

A page is cut into its leaf blocks in document order: runs of text between block-level tags, with the path of open elements above
each. A block's input is a sum of vectors hashed from its path (tag, class and id words, with and without depth), the mean of
vectors hashed from all of its words, and a few measures. A bidirectional LSTM reads a page's whole sequence, so each label
draws on everything before and after the block. Blocks labelled as main text are joined in page order.

The network is plain numpy, forward here and backward in `html_training`, which made the weights beside this file from
generated pages. Pages of similar block counts are padded together and run as one batch.

Defined cases: null and empty pages give the empty text; unclosed tags, comments and scripts reach to the end of the
page; any length; null ids and repeated rows stay as they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEIGHTS = Path(__file__).with_name("html_weights.npz")
PATH_BUCKETS, WORD_BUCKETS = 2048, 1024
PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 24, 8, 4, 16
INPUT = PATH_DIM + WORD_DIM + MEASURES

#: What may stand in a tag after its name: a quoted value may hold a closing bracket.
_IN_TAG = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
#: What may stand in a tag after its name: a quoted value may hold a closing bracket.
_IN_TAG = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe)\b{_IN_TAG}(?:>.*?(?:</\1\s*>|\Z)|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_IN_TAG})(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-zA-Z]+")
#: Elements that never hold text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a block.
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var wbr img input".split())
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


@cache
def _bucket(key: str, size: int) -> int:
    return zlib.crc32(key.encode()) % size


def _word_bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % WORD_BUCKETS


def _path_keys(path: tuple[tuple[str, ...], ...]) -> tuple[int, ...]:
    keys = set()
    for depth, names in enumerate(reversed(path)):
        for n in names:
            keys.add(_bucket(n, PATH_BUCKETS))
            if depth < 3:
                keys.add(_bucket(f"{depth}:{n}", PATH_BUCKETS))
    return tuple(sorted(keys))


def blocks(page: str) -> list[tuple[tuple[tuple[str, ...], ...], str, int]]:
    """(path, text, characters inside links) of each leaf block in page order; white space is one space."""
    out: list[tuple[tuple[tuple[str, ...], ...], str, int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = 0
    links = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((tuple(names for _, names in stack), text, min(linked, len(text))))
        parts.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            parts.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(2):
            if tag not in INLINE:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    links -= sum(t == "a" for t, _ in stack[i:])
                    del stack[i:]
                    break
            continue
        if tag not in INLINE:
            flush()
        if tag in _CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    links -= sum(t == "a" for t, _ in stack[i:])
                    del stack[i:]
                    break
                if stack[i][0] in ("article", "section", "div", "td", "li", "body", "main"):
                    break
        elif tag == "li":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "li":
                    links -= sum(t == "a" for t, _ in stack[i:])
                    del stack[i:]
                    break
                if stack[i][0] in ("ul", "ol", "menu"):
                    break
        if tag in VOID or m.group(4).endswith("/"):
            continue
        attrs = [w.lower() for a in _ATTR.finditer(m.group(4)) for w in _NAME.findall(a.group(1) or a.group(2) or a.group(3) or "")] if m.group(4) else []
        stack.append((tag, (tag, *(f".{w}" for w in attrs))))
        if tag == "a":
            links += 1
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


class Labeller:
    """Forward pass. weights: path, word, and for each direction wx, wh, b; out, bias."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights
        self.paths: dict[tuple, np.ndarray] = {}

    def _path(self, path: tuple) -> np.ndarray:
        v = self.paths.get(path)
        if v is None:
            if len(self.paths) > 50_000:
                self.paths.clear()
            keys = list(_path_keys(path))
            v = self.paths[path] = self.w["path"][keys].sum(0) if keys else np.zeros(PATH_DIM, np.float32)
        return v

    def inputs(self, page_blocks: list) -> np.ndarray:
        """One row for each block of a page."""
        n = len(page_blocks)
        x = np.zeros((n, INPUT), np.float32)
        found, sizes = [], []
        for i, (path, text, linked) in enumerate(page_blocks):
            x[i, :PATH_DIM] = self._path(path)
            ws = text.lower().split()
            found += map(_word_bucket, ws)
            sizes.append(len(ws))
            x[i, PATH_DIM + WORD_DIM :] = (np.log1p(len(text)) / 8, linked / len(text), i / n, text[-1] in ".!?…")
        if found:
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            x[:, PATH_DIM : PATH_DIM + WORD_DIM] = np.add.reduceat(self.w["word"][found], starts, axis=0) / np.array(sizes, np.float32)[:, None]
        return x

    def _direction(self, name: str, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        wx, wh, b = (self.w[f"{name}_{k}"] for k in ("wx", "wh", "b"))
        pages, steps, _ = x.shape
        z = x @ wx + b
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.empty((pages, steps, HIDDEN), np.float32)
        for t in range(steps) if name == "f" else range(steps - 1, -1, -1):
            g = z[:, t] + h @ wh
            ifo = 1 / (1 + np.exp(-g[:, : 3 * HIDDEN]))
            new_c = ifo[:, HIDDEN : 2 * HIDDEN] * c + ifo[:, :HIDDEN] * np.tanh(g[:, 3 * HIDDEN :])
            new_h = ifo[:, 2 * HIDDEN :] * np.tanh(new_c)
            on = mask[:, t, None]
            c, h = np.where(on, new_c, c), np.where(on, new_h, h)
            out[:, t] = h
        return out

    def score(self, pages: list[list]) -> list[np.ndarray]:
        """The probability of being main text for each block of each page."""
        out: list[np.ndarray] = [np.empty(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at
            while end < len(order) and end - at < 256 and (end == at or (end - at + 1) * len(pages[order[end]]) <= 50_000):
                end += 1
            group = order[at:end]
            steps = len(pages[group[-1]])
            x, mask = np.zeros((len(group), steps, INPUT), np.float32), np.zeros((len(group), steps), bool)
            for r, i in enumerate(group):
                x[r, : len(pages[i])] = self.inputs(pages[i])
                mask[r, : len(pages[i])] = True
            h = np.concatenate([self._direction("f", x, mask), self._direction("b", x, mask)], axis=2)
            p = 1 / (1 + np.exp(-(h @ self.w["out"] + self.w["bias"])))
            for r, i in enumerate(group):
                out[i] = p[r, : len(pages[i])]
            at = end
        return out

    def main_text(self, pages: list[str]) -> list[str]:
        cut = [blocks(p) for p in pages]
        return [" ".join(b[1] for b, p in zip(bs, ps, strict=True) if p >= 0.5) for bs, ps in zip(cut, self.score(cut), strict=True)]


def load_labeller() -> Labeller:
    with np.load(WEIGHTS) as f:
        return Labeller({k: f[k].astype(np.float32) for k in f.files})


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(load_labeller().w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller(sent.value)
        for b in batches:
            raw = b.column(2)
            texts: list[str] = []
            for at in range(0, len(raw), 512):
                texts += model.main_text([t or "" for t in raw.slice(at, 512).to_pylist()])
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    src = pages.select("page_id", "url", F.col("html").alias("_html"))
    return src.mapInArrow(run, f"page_id {src.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
