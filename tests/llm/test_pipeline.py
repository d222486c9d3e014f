"""The pipeline against a brute-force version of each stage on a small table."""

from __future__ import annotations

import corpus_pipeline
from conftest import SF_SMALL
from odd_rows import no_docs, odd_docs  # noqa: F401 - fixtures
from test_pairs import jaccard_brute
from test_text import base_brute

from meterwise.llm import winnowing
from meterwise.llm.common import table


def test_stages_on_a_small_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    told = stages["language_id"](spark, docs, SF_SMALL)
    before = docs.collect()
    assert sorted(r["doc_id"] for r in told.collect()) == sorted(r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or ""))
    kept = stages["near_duplicates"](spark, told, SF_SMALL)
    rows = sorted(told.collect(), key=lambda r: r["doc_id"])
    _, at = jaccard_brute([r["text"] for r in rows])
    assert sorted(r["doc_id"] for r in kept.collect()) == [r["doc_id"] for i, r in enumerate(rows) if at[i] == i]
    clean = stages["decontamination"](spark, kept, SF_SMALL)
    windows = {tuple(w[i:i + 10]) for r in table(spark, SF_SMALL, "benchmark").collect() for w in [winnowing.words_of(r["text"])]
               for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}

    def shares(text):
        w = winnowing.words_of(text)
        return any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(r["doc_id"] for r in kept.collect() if not shares(r["text"]))
    private = stages["personal_data"](spark, clean, SF_SMALL)
    for r in private.collect():
        assert not base_brute(r["text"] or "") and (r["text"] is None or r["n_chars"] == len(r["text"]))
    for frame in (told, kept, clean, private):
        assert frame.columns == columns
    packed = corpus_pipeline.run(spark, SF_SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in private.collect()}


def test_stages_keep_extra_columns_and_odd_rows(spark, odd_docs, no_docs):
    for frame in (odd_docs, no_docs):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_SMALL)
            assert docs.columns == frame.columns
        ids = sorted((r["doc_id"] for r in docs.select("doc_id").collect()), key=str)
        assert ids == ([10, 5, 8, 9, None] if frame is odd_docs else [])
