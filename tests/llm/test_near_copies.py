"""The near-copy stage decides by whole shingle sets and misses no pair: cases that samples, sieves and chance would lose."""

from __future__ import annotations

import random

import numpy as np

from quayside.llm import near_copies, simhash
from quayside.llm.vantage import links


def words(rng, n):
    return ["".join(rng.choice("abcdefghijkl") for _ in range(8)) for _ in range(n)]


def jaccard(a, b):
    x, y = (set(zip(*[t[i:] for i in range(5)], strict=False)) for t in (a, b))
    return len(x & y) / len(x | y)


def kept(spark, texts):
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id for r in near_copies.one_of_each(d).collect()}


def edited(rng, base, above):
    """base with words replaced at the end: the last version at or above a similarity of 0.8, or the first below it."""
    own = words(rng, len(base))
    cut = lambda k: base[: len(base) - k] + own[len(base) - k :]
    k = next(k for k in range(len(base)) if jaccard(base, cut(k)) < 0.8)
    return cut(k - 1 if above else k)


def test_long_texts_are_decided_at_the_threshold(spark):
    rng = random.Random(5)
    texts, want = [], set()
    for i in range(60):
        base = words(rng, 1000)
        texts += [base, edited(rng, base, i % 2 == 0)]
        assert (jaccard(*texts[-2:]) >= 0.8) == (i % 2 == 0)
        want |= {2 * i} if i % 2 == 0 else {2 * i, 2 * i + 1}
    assert kept(spark, texts) == want


def test_set_index_counts_in_whole_numbers():
    from fractions import Fraction

    sets = [np.arange(a, b, dtype=np.uint64) for a, b in ((0, 1000), (0, 800), (0, 799), (200, 1000), (5000, 5004), (0, 0))]
    index = near_copies.SetIndex(sets)
    assert index.alike(0, Fraction("0.8")).tolist() == [True, True, False, True, False, False]


def test_a_repeated_line_parts_no_copies(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(20):
        base = words(rng, 800)
        texts += [base, base + words(rng, 10) * 20]
        assert jaccard(*texts[-2:]) > 0.95
    assert kept(spark, texts) == set(range(0, 40, 2))


def test_no_pair_is_left_to_chance(spark):
    """Pairs at 0.806 that share none of ten MinHash shards."""
    texts = []
    for seed in (308, 472, 895, 935, 1193, 1346, 1765, 1833):
        rng = random.Random(seed)
        base, own = words(rng, 60), words(rng, 60)
        texts += [base, base[:54] + own[54:]]
        assert 0.8 <= jaccard(*texts[-2:]) < 0.81
    assert kept(spark, texts) == set(range(0, 16, 2))


def test_empty_tables_and_texts(spark):
    assert kept(spark, []) == set()
    d = spark.createDataFrame([(3, None), (1, ""), (2, " \n"), (None, "a b"), (7, "a b"), (7, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in near_copies.one_of_each(d).collect()) == [(1, ""), (7, "a b")]


def test_a_long_group_splits_into_chunks_and_rounds(spark):
    """A chain of edits whose ends share little, cut into chunks of two or three texts."""
    rng = random.Random(13)
    text, texts = words(rng, 100), []
    for i in range(40):
        text = [*text[:i], *words(rng, 1), *text[i + 1 :]]
        texts.append(text)
    assert jaccard(texts[0], texts[-1]) < 0.5
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = near_copies.sketches(d, "doc_id", shingle=5).persist()
    for bound in (250, 1_000_000):
        assert len({r.label for r in near_copies.similar_components(rows, shard_bound=bound).collect()}) == 1


def test_whole_table_by_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, set(simhash.shingle_hashes((r.text or "").encode(), 5).tolist())) for r in d.collect())
    label = list(range(len(rows)))
    holders: dict[int, list[int]] = {}
    for i, (_, s) in enumerate(rows):
        for h in s:
            holders.setdefault(h, []).append(i)
    for i, (_, s) in enumerate(rows):
        both: dict[int, int] = {}
        for h in s:
            for j in holders[h]:
                both[j] = both.get(j, 0) + 1
        alike = [j for j, n in both.items() if 5 * n >= 4 * (len(s) + len(rows[j][1]) - n)] if s else [j for j, r in enumerate(rows) if not r[1]]
        to = min(label[j] for j in alike)
        old = {label[j] for j in alike}
        label = [to if x in old else x for x in label]
    got = sorted(r.doc_id for r in near_copies.one_of_each(d).collect())
    assert got == [rows[i][0] for i in sorted(set(label))]
    assert len(got) < len(rows)


def bits_apart(a, b):
    x, y = (simhash.fingerprint(" ".join(t).encode(), 4) for t in (a, b))
    return ((x ^ y) & (1 << 64) - 1).bit_count()


def test_tree_groups_by_brute_force(spark):
    """Every text's fingerprint is op4's, goes through the trees, and no link within the radius is missed."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.node: r.shard for r in near_copies.tree_groups(near_copies.sketches(d, shingle=5, whole=False)).collect()}
    fps, of = set(), {}
    for r in d.collect():
        text = (r.text or "").encode()
        fp = simhash.fingerprint(text, 4)
        fps.add(fp)
        of.setdefault(near_copies._node(np.unique(simhash.shingle_hashes(text, 5)).tobytes()), set()).add(fp)
    p = np.array(sorted(fps), np.int64)
    label = dict.fromkeys(fps)
    for x in sorted(fps):
        todo = [x] if label[x] is None else []
        while todo:
            if label[y := todo.pop()] is None:
                label[y] = x
                todo += p[np.bitwise_count((p ^ y).view(np.uint64)) <= near_copies.RADIUS].tolist()
    assert got == {k: min(label[x] for x in v) for k, v in of.items()}
    assert len(set(got.values())) < len(fps)


def test_trees_link_what_is_near_and_heads_the_rest(spark, monkeypatch):
    rng = random.Random(21)
    near, far, unlike = [], [], []
    while min(len(near), len(far)) < 10:
        base = words(rng, 300)
        other = edited(rng, base, True) if len(near) >= 10 else [*base[:-2], *words(rng, 2)]
        assert jaccard(base, other) >= 0.8
        to = near if bits_apart(base, other) <= near_copies.RADIUS else far
        if len(to) < 10:
            to.append((base, other))
    while len(unlike) < 5:  # one line repeated makes the fingerprint; the sets share little else
        line = words(rng, 7)
        pair = (line * 60 + words(rng, 20), line * 60 + words(rng, 20))
        if bits_apart(*pair) <= near_copies.RADIUS:
            assert jaccard(*pair) < 0.8
            unlike.append(pair)
    texts = [t for pair in near + far + unlike for t in pair]
    want = {2 * i for i in range(20)} | set(range(40, 50))
    seen = []
    monkeypatch.setattr(near_copies, "links", lambda fps, *more: seen.extend(r.fp for r in fps.collect()) or links(fps, *more))
    assert kept(spark, texts) == want
    assert set(seen) == {simhash.fingerprint(" ".join(t).encode(), 4) for t in texts}
    monkeypatch.setattr(near_copies, "_open", lambda dealt, *_: dealt.where("false"))  # the trees alone
    assert kept(spark, texts) == want | {2 * i + 1 for i in range(10, 20)}
