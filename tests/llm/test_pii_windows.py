"""Terms of a document are whole words, however long and wherever they stand."""

from __future__ import annotations

from quayside.llm import pii


def test_long_words_and_far_ones_are_whole_terms(spark):
    long = [c * 300 for c in "abcdef"]
    text = " ".join([*long[:3], "jo@mail.example.com", *long[3:], *["and"] * 5000, "far"])
    spans = pii.base_spans(text)
    rest = pii.beside(text, spans)
    assert len(rest) == len(text) and rest.split() == [*long, *["and"] * 5000, "far"]
    d = spark.createDataFrame([(text,)], "text string")
    got = pii._holders(d).collect()
    assert [(r["values"], r.terms) for r in got] == [(["email:jo@mail.example.com"], sorted([*long, "and", "far"]))]
