"""The pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import corpus_pipeline
import pytest
import sentencepiece

from quayside.llm import pieces, pii, quality_rules
from tests.llm.test_contracts import WORD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    from quayside.llm.common import stage

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        out.append(stage(f(spark, out[-1], SF), name))
    return out


def test_columns_stay(steps):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(d.columns == steps[0].columns for d in steps[1:-1])


def test_rules_drop_what_fails(steps):
    kept = {r.doc_id for r in quality_rules.quality_query(steps[0]).collect() if r.kept}
    assert {r.doc_id for r in steps[1].collect()} == kept


def shingles(text):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}


def test_one_of_each_group_stays(steps):
    rows = {r.doc_id: shingles(r.text) for r in steps[1].collect()}
    kept = {r.doc_id for r in steps[2].collect()}
    alike = lambda a, b: len(rows[a] & rows[b]) / len(rows[a] | rows[b])
    most = {a: max((alike(a, b), b) for b in rows if b != a) for a in rows}
    assert all(most[a][0] >= 0.8 for a in rows.keys() - kept)
    assert all(alike(a, b) < 0.8 for a in kept for b in kept if a < b)
    assert len(rows) - len(kept) > 5


def test_no_base_value_is_left(steps):
    before = {r.doc_id: r.text for r in steps[2].collect()}
    after = {r.doc_id: r.text for r in steps[3].collect()}
    assert before.keys() == after.keys()
    for i, t in before.items():
        for _, a, b in pii.base_spans(t):
            assert t[a:b] not in after[i] or len(t[a:b]) < 8
        if not pii.base_spans(t):
            assert after[i] == t


def test_ids_decode_to_the_mix(steps):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    mixed = sorted((r.doc_id, r.text) for r in steps[4].collect())
    got = steps[5].collect()
    assert all(r.round_trip for r in got)
    assert sorted((r.doc_id, sp.decode(r.ids)) for r in got) == mixed


def test_run_equals_the_stages(spark, steps):
    key = lambda r: (r.doc_id, tuple(r.ids))
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, steps[5].collect()))
