"""The pipeline's stages, one after the other, on the smallest tables."""

from __future__ import annotations

import re

import corpus_pipeline
from conftest import SMALL
from reelstat.llm.scratch import save


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = save(stage(spark, docs, SMALL))
        rows = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns and rows.keys() <= seen.keys()
        if name != "substring_dedup":
            assert all(rows[i].text == seen[i] for i in rows)
        else:
            assert all(len(r.text) == r.n_chars and set(r.text.split()) <= set(seen[i].split()) for i, r in rows.items())
        assert len(rows) > 0.7 * len(seen), name
        if name == "quality_rules":  # only what a rule speaks against goes
            gone = [t for i, t in seen.items() if i not in rows]
            odd = [t for t in gone if len(t.split()) >= 20 and not re.search(r"[#*$%&|<>]{2}|(?:\b(\S+)\b.*){4}", t, re.S)]
            assert len(odd) <= 2
        seen = {i: r.text for i, r in rows.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == seen.keys()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
