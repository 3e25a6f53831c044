"""The dealt operators against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quayside.llm import digest, html_blocks, mil_quality, mixing, near_copies, pieces, pii, quality_rules, queries, sharding, simhash, suffix_dedup, vantage

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that the operators use inside.
CLASH = ("size", "key", "fp", "h", "t", "w", "p", "shard", "part", "base", "copies", "form", "_row", "failed", "ids", "near", "target")


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passage = " ".join(word() for _ in range(70))
    rows = []
    for i in range(60):
        t = " ".join(word() for _ in range(rng.choice([1, 3, 8, 40, 120])))
        if i % 7 == 0:
            t = f"{t}\n{passage}\n{t[:50]}"
        if i % 9 == 0:
            t += " mail bob.x@mail.example.com, +1 (555) 010-9999 4111 1111 1111 1111 and 10.20.30.40"
        rows.append((i, t, "en", f"s{i % 4}"))
    base = " ".join(word() for _ in range(300))
    for i in range(60, 70):  # near copies
        w = base.split()
        w[i] = "zz"
        rows.append((i, " ".join(w), "en", "s0"))
    rows += [(70 + i, rows[3][1], "en", "s0") for i in range(5)] + [rows[5], rows[5]]
    rows += [(90, None, None, None), (91, "", "en", "s1"), (None, "nobody's text " * 20, "en", None), (None, None, None, None), (92, "x" * 5000, "en", "s2"), (93, ("long words " * 30000), "en", "s2"), (94, " \t\n ", "en", "s3")]
    return [(a, b, c, d, None if b is None else len(b)) for a, b, c, d in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA)
    return d.withColumns({c: F.lit(f"own {c}") for c in CLASH})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = -1")


def order(x):
    return (x is not None, x if x is not None else 0)


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_op1_removes_what_starts_twice(docs, rows, none):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen: dict[bytes, int] = {}
    for _, b in texts:
        for p in range(len(b) - 199):
            k = hashlib.blake2b(b[p : p + 200], digest_size=12).digest()
            seen[k] = seen.get(k, 0) + 1
    want = []
    for i, b in texts:
        cover = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 199):
            if seen[hashlib.blake2b(b[p : p + 200], digest_size=12).digest()] > 1:
                cover[p] += 1
                cover[p + 200] -= 1
        on = np.cumsum(cover)[: len(b)] > 0
        spans = int((np.diff(np.r_[0, on.astype(int)]) == 1).sum())
        want.append((i, len(b), int(on.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~on])).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.suffix_query(docs).collect()]
    same(got, want)
    assert sum(r[2] for r in got) > 10_000
    assert suffix_dedup.suffix_query(none).count() == 0


def test_op1_runs_merge_in_order():
    rng = random.Random(1)
    pool = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(400)]
    runs, all_ = [], []
    for i in range(13):
        part = sorted(pool[i::13])
        all_ += part
        runs.append(suffix_dedup.Run(suffix_dedup.pack_run([(s, s[::-1][:5], i, k, k % 2 == 0) for k, s in enumerate(part)])))
    got, before = [], b""
    for r, shared in suffix_dedup.merge_runs(runs):
        assert shared == suffix_dedup.common_prefix(before, r.suffix, 0)
        assert r.context() == r.suffix[::-1][:5]
        before = r.suffix
        got.append(before)
    assert got == sorted(all_)


def test_op1_long_texts_are_cut_without_a_seam():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 3 * suffix_dedup._PIECE // 2, dtype=np.uint8)
    finder = suffix_dedup.Anchors()
    pos, h = finder.of(data)
    at = 12345
    p2, h2 = finder.of(data[at : at + 5000])
    inside = (pos >= at + 200) & (pos < at + 4700)
    assert set(pos[inside] - at) <= set(p2) and np.diff(pos).max() <= 151
    assert dict(zip((pos - at).tolist(), h.tolist(), strict=True)).items() >= {k: v for k, v in zip(p2.tolist(), h2.tolist(), strict=True) if 200 <= k < 4700}.items()


def test_op2_shards(docs, rows, none):
    got = [tuple(r) for r in sharding.shard_by_bytes(docs, 7).collect()]
    want, total = [], sum(len((r[1] or "").encode()) + 16 for r in rows)
    at, slots = 0, {}
    for r in sorted(rows, key=lambda r: (order(r[0]), zlib.crc32((r[1] or "").encode()))):
        b = (r[1] or "").encode()
        size = len(b) + 16
        shard = min(6, (2 * at + size) * 7 // (2 * total))
        want.append((r[0], size, zlib.crc32(b), "bytes", shard, slots.get(shard, 0), None))
        slots[shard] = slots.get(shard, 0) + 1
        at += size
    same(got, want)
    assert sharding.shard_by_bytes(none).count() == 0


def test_op3_learns_and_scores(spark, docs, none):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    real = spark.read.parquet(f"{SF}/documents.parquet")
    r = mil_quality.quality_query(real, labels).join(labels, "doc_id").collect()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in r)
    held = [x for x in r if x.held_out]
    assert sum(x.predicted == x.quality for x in held) / len(held) >= 0.85
    bags, y = mil_quality.training_bags(real, labels)
    model = mil_quality.fit(bags, y)
    assert model.score(bags).tolist() == mil_quality.fit(*mil_quality.training_bags(real, labels)).score(bags).tolist()
    odd = mil_quality.quality_query(docs, labels.where("false")).collect()
    assert len(odd) == docs.count() and all(x.score == 0.5 and x.predicted == 0 for x in odd)
    marks = spark.createDataFrame([(None, 1, 0), (90, None, 0), (91, 1, 0), (91, 0, 0), (1, 7, 0)], "doc_id long, quality int, toxic int")
    assert mil_quality.quality_query(docs, marks).count() == docs.count()
    assert mil_quality.quality_query(none, labels).count() == 0


def plain_score(w, bag):
    """The model's formula with loops."""
    from math import exp, tanh

    line = lambda m, b, x: [sum(x[i] * m[i][j] for i in range(len(x))) + b[j] for j in range(len(b))]
    logistic = lambda t: 1 / (1 + exp(-t))
    hs = [[tanh(t) for t in line(w["we"], w["be"], [(v - s) / c for v, s, c in zip(x, w["shift"], w["scale"], strict=True)])] for x in bag]
    marks = [sum(a * tanh(tv) * logistic(tu) for a, tv, tu in zip(w["a"], line(w["v"], w["bv"], h), line(w["u"], w["bu"], h), strict=True)) for h in hs]
    total = sum(exp(m) for m in marks)
    z = [sum(exp(m) / total * h[j] for m, h in zip(marks, hs, strict=True)) for j in range(len(w["c"]))]
    return logistic(sum(a * b for a, b in zip(z, w["c"], strict=True)) + float(w["d"]))


def test_op3_forward_and_gradients():
    rng = np.random.default_rng(4)
    bags = [rng.normal(0, 1, (n, mil_quality.INPUT)) for n in (1, 3, 7, 2)]
    y = np.array([1.0, 0, 1, 0])
    w = mil_quality.start(np.concatenate(bags))
    w |= {k: rng.normal(0, 0.5, w[k].shape) for k in ("be", "bv", "bu", "c", "d", "a")}
    model = mil_quality.Model(w)
    assert np.allclose(model.score(bags), [plain_score(w, b) for b in bags], atol=1e-12)
    g = mil_quality.gradients(model, bags, y)

    def loss():
        p = model.score(bags)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for k in g:
        flat = np.atleast_1d(w[k]).reshape(-1)
        for i in rng.choice(len(flat), min(5, len(flat)), replace=False):
            old, eps, out = w[k], 1e-5, []
            for side in (eps, -eps):
                moved = np.atleast_1d(old).astype(float).copy().reshape(-1)
                moved[i] += side
                w[k] = moved.reshape(np.shape(old))
                out.append(loss())
            w[k] = old
            assert abs((out[0] - out[1]) / (2 * eps) - np.atleast_1d(g[k]).reshape(-1)[i]) < 1e-7, k


def test_op3_repeated_ids_send_one_text_each(spark):
    rows = [(i % 8, f"text {i} " * (200 * (i % 5) + 1)) for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    bags, y = mil_quality.training_bags(d, marks)
    assert len(bags) == len(y) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(8))
    long = spark.createDataFrame([(1, "word " * 64 * 300)], "doc_id long, text string")
    assert [len(b) for b in mil_quality.training_bags(long, marks)[0]] == [300]


def test_op3_passages_cover_the_whole_text():
    k = mil_quality.Words(most=50)
    x = mil_quality.passages(" ".join(f"w{i}" for i in range(200)), k)
    y = mil_quality.passages(" ".join(f"w{i}" for i in range(64, 128)), mil_quality.Words())
    assert len(x) == 4 and np.allclose(x[1, :25], y[0, :25], atol=1e-5) and x[3, -2] == 8 / 64
    assert (mil_quality.passages("", k) == 0).all()


def brute_fingerprint(text, shingle):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + shingle]) for i in range(len(ws) - shingle + 1)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_op4_fingerprints_and_components(docs, rows, none):
    fps = [brute_fingerprint(r[1], 4) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least: dict[int, int | None] = {}
    for i, r in enumerate(rows):
        k = root(i)
        least[k] = min((x for x in (least.get(k), r[0]) if x is not None), default=None)
    want = [(r[0], f"{fps[i]:016x}", least[root(i)]) for i, r in enumerate(rows)]
    same([tuple(r) for r in simhash.simhash_query(docs).collect()], want)
    assert simhash.simhash_query(none).count() == 0


def test_op4_every_tree_and_chunk_gives_the_same_links(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(-(1 << 62), 1 << 62, 150)
    pts = set(centres.tolist())
    for c in centres[:60]:
        x = int(c)
        for _ in range(6):  # chains of steps of up to five bits
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(b)
            pts.add(x)
    pts = [((p & (1 << 64) - 1) ^ (1 << 63)) - (1 << 63) for p in pts]
    fps = spark.createDataFrame([(int(p), int(p)) for p in set(pts)], "fp long, least long").persist()
    u = np.array(sorted(set(pts)), np.int64).view(np.uint64)
    comp = list(range(len(u)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[:i] ^ u[i]) <= 4):
            comp[root(i)] = root(int(j))
    want = sorted(sorted(u[i].item() for i in range(len(u)) if root(i) == k) for k in {root(i) for i in range(len(u))})
    for bound in (50_000, 2):
        got: dict[int, list[int]] = {}
        for r in simhash.near_components(fps, shard_bound=bound).collect():
            got.setdefault(r.component_id, []).append(r.fp & (1 << 64) - 1)
        assert sorted(map(sorted, got.values())) == want
        assert all(least == min(x - (x >> 63 << 64) for x in xs) for least, xs in got.items())
    # Trees of small shards on a small sample, so that points are routed across many boundaries.
    e = vantage.links(fps.select("fp"), 4, shard=20, sample=150).collect()
    comp = {x: x for x in u.tolist()}
    for r in e:
        a, b = (root_of(comp, x & (1 << 64) - 1) for x in (r.u, r.v))
        comp[a] = b
    again: dict[int, list[int]] = {}
    for x in u.tolist():
        again.setdefault(root_of(comp, x), []).append(x)
    assert sorted(map(sorted, again.values())) == want


def root_of(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_op4_parts_see_every_pair():
    rng = np.random.default_rng(6)
    for radius in range(7):
        found = vantage.parts(radius)
        assert sum(p.radius + 1 for p in found) == radius + 1 and sum(p.mask for p in found) == (1 << 64) - 1
        for _ in range(300):
            x = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
            assert any((x & p.mask).bit_count() <= p.radius for p in found)


def test_op4_routing_keeps_each_pair_in_some_leaf():
    rng = np.random.default_rng(9)
    p = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    near = np.array([int(x) ^ sum(1 << int(b) for b in rng.choice(64, 4, replace=False)) for x in p], np.uint64)
    both = np.concatenate([p, near])
    met = np.zeros(len(p), bool)
    for part in vantage.parts(4):
        tree = vantage.Tree.grow(np.sort(p[:500]), part, 16)
        assert tree.leaves > 30
        who, where = tree.route(both)
        assert set(who.tolist()) == set(range(len(both)))
        leaves: dict[int, set[int]] = {}
        for i, leaf in zip(who.tolist(), where.tolist(), strict=True):
            leaves.setdefault(i, set()).add(leaf)
        met |= np.array([bool(leaves[i] & leaves[i + len(p)]) for i in range(len(p))])
    assert met.all()


def test_op4_trees_split_on_the_given_tables(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    p = np.unique(np.array([r.fp for r in simhash.fingerprints(d).collect()], np.int64).view(np.uint64))
    want = vantage._scan(p, 4)
    found = []
    for part in vantage.parts(4):
        got, splits = vantage.tree_links(p, part, 4)
        assert splits > len(p) / vantage.LEAF / 2
        found += got
    u, v = (vantage._forest(np.concatenate([x for x, _ in f]), np.concatenate([y for _, y in f])) for f in (found, want))
    assert (u[0] == v[0]).all() and (u[1] == v[1]).all() and len(u[0])


def test_op4_one_of_each_keeps_one(docs):
    kept = near_copies.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and sum(60 <= (i or 0) < 70 for i in ids) == 1 and 3 in ids and not {70, 71, 72} & set(ids)


def test_op4_near_copies_by_similarity(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    hot = [word() for _ in range(60)]
    rows, group = [], []
    for g in range(40):
        base = [word() for _ in range(rng.choice([30, 120, 500]))]
        for _ in range(rng.randint(1, 5)):
            t = list(base)
            for _ in range(len(t) // 60 and rng.randint(0, len(t) // 60)):
                t[rng.randrange(len(t))] = word()
            rows.append((len(rows), " ".join(t)))
            group.append(g)
    for _ in range(60):  # clean texts that share a passage
        rows.append((len(rows), " ".join([word() for _ in range(100)] + hot + [word() for _ in range(100)])))
        group.append(len(rows) + 1000)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [set(zip(*[t.split()[i:] for i in range(5)], strict=False)) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    unsure = set()
    for i in range(len(rows)):
        for j in range(i):
            a = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if a >= 0.8:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
            if 0.74 < a < 0.86:
                unsure |= {group[i]}
    for bound in (1_000_000, 900):
        staged = near_copies.sketches(d, "doc_id", shingle=5).persist()
        label = {r.node: r.label for r in near_copies.similar_components(staged, shard_bound=bound).collect()}
        got = {r.doc_id: label[r.node] for r in staged.collect()}
        for i in range(len(rows)):
            for j in range(i):
                if group[i] not in unsure and group[j] not in unsure:
                    assert (got[i] == got[j]) == (root(i) == root(j))
    assert len(unsure) < 30


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a="</p><article>x</article>";</script></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>A&amp;B  title</h1><p>First <b>bold</b>part.<p>Second&nbsp;one<br>here.</p><div class="ad">Buy now</div></article>
<aside class="sidebar"><p>Related things</p></aside><form><label>Name</label></form><div id="comments"><p>Nice text, thanks</p></div><!-- c <p>no</p> --><footer>&copy; me</footer></body></html>"""


def test_op5_main_text(spark):
    d = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<p>a<"), (5, "x", "<article><p>" + "word " * 50_000)], "page_id long, url string, html string").withColumn("text", F.lit("own")).withColumn("n_chars", F.lit("own"))
    got = {r.url: r for r in html_blocks.extract_pages(d).collect()}
    assert got["u"].text == "A&B title First boldpart. Second one here."
    assert got[None].text == "" and got["v"].n_chars == 0 and len(got) == 5
    assert got["x"].text == "word " * 49_999 + "word" and all(r.n_chars == len(r.text) for r in got.values())
    assert html_blocks.extract_pages(d.where("false")).count() == 0


def test_op5_real_pages_hold_their_articles(spark):
    import html

    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = {r.page_id: r.text for r in queries.op5_html_text(spark, SF).collect()}
    for i, raw in pages:
        body = re.search(r"<article>(.*?)(</article>|\Z)", raw, re.S)[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", body))
        assert got[i] == " ".join(html.unescape(body).split())


def test_op5_pages_without_telling_names():
    """Articles, menus and comments known by their words, shapes and places only; a closing bracket inside quotes."""
    p = "The river rose slowly through the night and by the morning the fields beyond the village were under water. People carried what they could to the church on the hill, where the doors had been opened to everyone who came."
    q = "Nobody had seen a flood of this size since the old bridge was built, and the council met in the school to decide what should be done first. Boats were sent for from the harbour, and the road to the north was closed until the end of the week."
    m = html_blocks.load_labeller()
    pages = {
        f"<html><body><div><p>{p}</p><p>{q}</p></div></body></html>": f"{p} {q}",
        f'<html><body><article><p title="a > b">{p}</p></article></body></html>': p,
        f'<html><body><article><h1>Flood</h1><p>{p}</p><p>{q}</p><section class="zzq"><h3>Comments</h3><p>Bob: Great article, thanks</p><p>Ann: I agree with this post</p></section></article></body></html>': f"Flood {p} {q}",
    }
    assert m.main_text(list(pages)) == list(pages.values())
    for tag, rest in (('<p title="a > b" x=\'>\' y=c>', "t"), ("<p title=it's>", "t"), ('<p a="b>', "t"), ("<p =>", "t")):
        assert [b[1] for b in html_blocks.blocks(f"{tag}{rest}</p>")] == [rest]


@pytest.mark.xfail(reason="a row of plain links alone in a table cell scores 0.57 and is kept")
def test_op5_menu_in_a_bare_table_cell():
    p = "The river rose slowly through the night and by the morning the fields beyond the village were under water. People carried what they could to the church on the hill, where the doors had been opened to everyone who came."
    page = f'<html><body><table><tr><td><a href="/">Home</a> <a href="/n">News</a></td></tr><tr><td><p>{p}</p><p>{p}</p></td></tr></table></body></html>'
    assert html_blocks.load_labeller().main_text([page]) == [f"{p} {p}"]


def test_op5_weights_come_from_the_training_code():
    from quayside.llm import html_training

    assert html_training.accuracy(html_blocks.load_labeller().w, 99, 150) > 0.97
    small = html_training.train(pages=150, epochs=3)
    assert html_training.accuracy(small, 98, 60) > 0.8


def canonical(t):
    import unicodedata

    n = lambda x: unicodedata.normalize("NFKC", x)
    return re.sub(r"\s+", " ", n(n(t).casefold())).strip(" ")


def test_op6_digests(spark, docs, rows, none):
    more = [(200, "ＡＢ  Straße É", 1), (201, "ab strasse é", 1), (202, " AB\tSTRASSE é\n", 1), (203, "ab strasse e", 1)]
    d = docs.select("doc_id", "text", "n_chars").unionByName(spark.createDataFrame(more, "doc_id long, text string, n_chars long"))
    all_ = sorted([(r[0], r[1] or "") for r in rows] + [m[:2] for m in more], key=lambda r: (order(r[0]), r[1]))
    got = sorted(digest.digest_query(d).collect(), key=lambda r: (order(r.doc_id), r.edited_sha256))
    want, prints = [], {}
    for i, (k, t) in enumerate(all_):
        nxt = all_[(i + 1) % len(all_)][1]
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        want.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), float(canonical(t) == canonical(e)), float(canonical(t) == canonical(nxt))))
    same([(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got], want)
    forms = {r.doc_id: r.fingerprint for r in got}
    assert forms[200] == forms[201] == forms[202] != forms[203]
    for k, t in all_:
        if k is not None:
            assert prints.setdefault(canonical(t), forms[k]) == forms[k]
    assert len(set(prints.values())) == len(prints)
    assert digest.digest_query(none).count() == 0
    assert digest.digest_query(d.where("doc_id = 200")).first().near_next == 1.0


def test_op6_forms_that_collide_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(digest, "wide_hash", lambda form: F.lpad(F.char_length(form).cast("string"), 32, "0"))
    d = spark.createDataFrame([(1, "abc"), (2, "abd"), (3, "ABC"), (4, "abcd")], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in digest.digest_query(d).collect()}
    assert got[1] == got[3] != got[2] and got[2].endswith("-1") and len(set(got.values())) == 3


def test_op7_equals_the_library(docs, rows, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    got = pieces.encode_documents(docs, "doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == sp.encode(r.text or "") and r.n_pieces == len(r.ids) and r.round_trip
    back = pieces.decode_documents(pieces.encode_documents(docs, "doc_id", "text"), "doc_id").collect()
    same([tuple(r) for r in back], [(r[0], r[1] or "") for r in rows])
    assert pieces.encode_documents(none, "doc_id").count() == 0


def test_op7_odd_texts():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    m = pieces.load_model()
    enc, rng = pieces.Encoder(m), random.Random(7)
    pool = "abc the  \n\t é日本😀▁\x00" + "   "
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [" " * k + "x" * j for k in range(40) for j in (0, 1, 70)] + ["ab" * 2000, "日" * 300]
    for t, x in zip(texts, enc.encode(texts), strict=True):
        assert x.tolist() == sp.encode(t)
        assert pieces.decode(m, x) == sp.decode(x.tolist())


def test_op8_rules_equal_their_sql_and_edge_cases(docs, rows, none):
    got = {}
    for r in quality_rules.quality_query(docs).collect():
        got.setdefault(r.doc_id, r)
    for r in rows:
        ws, text = WORD.findall(r[1] or ""), r[1] or ""
        grams = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
        count: dict[tuple, int] = {}
        for g in grams:
            count[g] = count.get(g, 0) + 1
        hit = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        if r[0] is not None:
            x = got[r[0]]
            assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))
            assert x.base_failed == (len(ws) < 10 or 100 * len(hit) > 20 * len(ws)) and (not x.kept or not x.base_failed)
    assert quality_rules.quality_query(none).count() == 0
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in quality_rules.quality_query(docs).collect())


def test_op8_ablations(docs):
    led = quality_rules.ledger(docs)
    failed = [r.failed for r in led.collect()]
    for r in quality_rules.ablations(led, quality_rules.V1).collect():
        bit = quality_rules.BIT[r.rule]
        assert (r.failing, r.failing_alone, r.kept_without) == (sum(f & bit > 0 for f in failed), sum(f == bit for f in failed), sum(f & ~bit == 0 for f in failed))
    both = quality_rules.compare_policies(led, {"base": quality_rules.BASE, "v1": quality_rules.V1}).first()
    assert both.base >= both.v1 and both.n == len(failed)


def test_op9_mix(docs, rows, none):
    got = mixing.mix_ledger(docs).collect()
    sizes: dict = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, left, full = {s: i % 3 + 1 for i, s in enumerate(names)}, set(names), {}
    while True:
        spare, w = sum(sizes.values()) - sum(full.values()), sum(weight[s] for s in left)
        over = [s for s in left if spare * weight[s] / w > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            full[s] = 3 * sizes[s]
            left.discard(s)
    want = {s: full.get(s, spare * weight[s] / w) for s in names}
    taken: dict = {}
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in names:
        left_to_chance = [r.size for r in got if r.source == s and 0 < r.inclusion < 1]
        assert abs(taken[s] - want[s]) <= max(left_to_chance, default=0) / 2 + 1e-6
    same([tuple(r) for r in got], [tuple(r) for r in mixing.mix_ledger(docs).collect()])
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mix_ledger(none).count() == 0 and mixing.mix_documents(none).count() == 0


def test_op9_inclusion_follows_the_odds(spark):
    """600 sources alike but for their ids are 600 draws: each size is taken about as often as its probability by size says."""
    sizes = [*range(5, 200, 5), 400, 900]
    text = {n: " ".join(["w"] * n) for n in sizes}
    d = spark.createDataFrame([(i * 100 + j, text[n], f"{i:04d}") for i in range(1200) for j, n in enumerate(sizes)], "doc_id long, text string, source string")
    got = mixing.mix_ledger(d, weights=(1, 3)).where("source_size > target").groupBy("size").agg(F.avg("copies").alias("rate"), F.avg("inclusion").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    p = {r["size"]: r["p"] for r in got}
    assert len(got) == len(sizes) and all(r.n == 600 for r in got)
    words = sum(sizes)
    assert abs(sum(n * p[n] for n in sizes) - words / 2) < 1e-6 and p[900] == 1 and abs(p[100] / p[50] - 2) < 1e-9
    for r in got:
        assert abs(r.rate - r.p) < 4 * (r.p * (1 - r.p) / r.n) ** 0.5 + 0.02, r


E1 = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
I1 = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
C1 = re.compile(r"[0-9]([\x20-]?[0-9])+")
P1 = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    n = lambda m: len(re.sub("[^0-9]", "", m.group()))
    out = [("email", m.start(), m.end()) for m in E1.finditer(t)]
    out += [("ip", m.start(), m.end()) for m in I1.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in C1.finditer(t) if 13 <= n(m) <= 19 and pii.luhn(re.sub("[^0-9]", "", m.group()))]
    return out + [("phone", m.start(), m.end()) for m in P1.finditer(t) if 9 <= n(m) <= 15]


def test_op10_base_spans():
    rng = random.Random(5)
    for _ in range(20_000):
        t = "".join(rng.choice("0123456789+-. ()@@..abZ%-_é00+1") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == brute_spans(t)
    for n in (40, 400):  # the runs of a long text in small, where the plain patterns end in time
        t = "a" * n + "@" + "1." * n
        assert pii.base_spans(t) == brute_spans(t)
    long = pii.base_spans("a" * 200_000 + "@" + "1." * 50_000)
    assert long[0] == ("email", 0, 200_000 + 1 + 99_999) and len(long) == 1 + 12_500


def test_op10_query(docs, rows, none):
    want = []
    for r in rows:
        s = brute_spans(r[1] or "")
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        want.append((r[0], *(sum(k == x for k, _, _ in s) for x in pii.KINDS), hashlib.sha256(base.encode()).hexdigest(), base))
    got = pii.pii_query(docs).collect()
    same([tuple(r)[:6] for r in got], [w[:6] for w in want])
    starts = {w[0]: w[6] for w in want}
    for r in got:
        if r.doc_id is not None:
            assert r.spans.startswith(starts[r.doc_id])
    assert pii.pii_query(none).count() == 0


def test_op10_terms_that_disclose(spark):
    rng = random.Random(2)
    filler = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(n))
    rows = [(i, f"{filler(20)} Zanzibar {filler(30)} jo@mail.example.com beta {filler(10)}" if i < 9 else filler(30) + (" Zanzi" if i % 2 else ""), 9) for i in range(3000)]
    rows[2000] = (2000, f"{filler(5)} zanzibar, {filler(5)}", 9)  # a told term in a text without the value
    d = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = {r.doc_id: r.spans for r in pii.pii_query(d).collect()}
    for i, t, _ in rows[:9]:
        a = t.index("Zanzibar")
        assert out[i].split(",")[1:] == [f"term:{a}:{a + 8}"]  # beta is everywhere, so it tells nothing
    a = rows[2000][1].index("zanzibar")
    assert out[2000] == f"term:{a}:{a + 9}"
    assert all(out[i] == "" for i in range(9, 3000) if i != 2000)
    clean = {r.doc_id: r for r in pii.sanitise(d).collect()}
    assert "Zanzibar" not in clean[0].text and "[EMAIL]" in clean[0].text and clean[0].n_chars == len(clean[0].text)
    assert "zanzibar" not in clean[2000].text
    assert clean[11].text == rows[11][1] and clean[11].n_chars == 9


def test_op10_shares_by_brute_force(spark):
    """Every value and term of a random corpus with repeats, values that share texts, and words joined to values."""
    from math import log, sqrt

    rng = random.Random(8)
    vocab = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    people = ["ann@x.example.org", "bob@x.example.org", "10.1.2.3", "+1 555 010 7788", "4111 1111 1111 1111"]
    texts = []
    for _ in range(400):
        who = rng.choice([None, None, *range(5)])
        ws = [rng.choice(vocab) for _ in range(rng.randint(1, 25))]
        if who is not None:
            ws += [people[who]] + [vocab[who]] * (rng.random() < 0.9) + [vocab[10 + who] + "," + people[0]] * (rng.random() < 0.2)
        rng.shuffle(ws)
        texts.append(" ".join(ws).replace("w", "W" if rng.random() < 0.1 else "w"))
    texts += texts[:60] + ["", None]
    for i in range(5):
        vocab_i = vocab[i]
        texts = [t if t is None or people[i] in t or rng.random() < 0.03 else " ".join(w for w in t.split() if w.lower() != vocab_i) for t in texts]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    held = []
    for t in texts:
        t = t or ""
        spans = brute_spans(t)
        rest = "".join(" " if any(a <= i < b for _, a, b in spans) else c for i, c in enumerate(t))
        terms = {w.strip(",.").lower() for w in rest.split()}
        held.append((t, {f"{k}:{t[a:b].lower() if k in ('email', 'ip') else re.sub('[^0-9]', '', t[a:b])}" for k, a, b in spans}, {w for w in terms if len(w) >= 3}))
    n, want = len(held), {}
    for e in {e for _, es, _ in held for e in es}:
        for w in {w for _, es, ws in held if e in es for w in ws}:
            n_e, n_t = sum(e in es for _, es, _ in held), sum(w in ws for _, _, ws in held)
            both = [t for t, es, ws in held if e in es and w in ws]
            z, p = 1.96**2, len(both) / n_t
            low = (p + z / (2 * n_t) - sqrt(z * (p * (1 - p) + z / (4 * n_t)) / n_t)) / (1 + z / n_t)
            share = log(low * n / n_e) / log(n / n_e) if low > 0 else 0
            if len(set(both)) >= 3 and share >= 0.5:
                want[e, w] = share
    got = {(r.value, r.term): r.share for r in pii.disclosures(d, least=0.5).collect()}
    assert got.keys() == want.keys() and len(want) >= 4
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_op10_sanitise_keeps_rows_and_columns(docs, none):
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert all("@mail.example.com" not in (r.text or "") for r in out.collect())
    assert pii.sanitise(none).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    d = queries.queries()[name](spark, SF)
    cols = sorted(d.columns)
    r = con.execute(queries.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    same([tuple(x[c] for c in cols) for x in d.collect()], [tuple(x[i] for i in at) for x in r.fetchall()])


def test_ten_queries():
    assert [int(k[2:].split("_")[0]) for k in queries.queries()] == list(range(1, 11))


def test_op7_relational_lattice_equals_the_arrays(spark, docs):
    from quayside.llm import relational

    m = pieces.load_model()
    more = spark.createDataFrame([(300, "a  b   c\n\n  日本😀 x ", None, None, None), (301, " " * 35, None, None, None), (302, "  \n ", None, None, None)], SCHEMA)
    d = docs.where("doc_id is null or doc_id not in (92, 93)").select("doc_id", "text").unionByName(more.select("doc_id", "text"))
    got = [(r.doc_id, r.ids) for r in relational.encode_documents(d, m, "doc_id").collect()]
    same(got, [(r.doc_id, r.ids) for r in pieces.encode_documents(d, "doc_id").collect()])
