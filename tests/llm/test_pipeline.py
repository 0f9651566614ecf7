"""The pipeline against plain versions of its stages, and on defined cases."""

from __future__ import annotations

import pytest

import corpus_pipeline
from loanmart.llm import queries as llm
from loanmart.llm.license_scan import _parsed
from tests.llm import data
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = llm.table(spark, SF, "documents")
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality"](spark, docs, SF)
    labels = {r.doc_id: r.quality for r in llm.table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert sum((i in kept) != (q == 1) for i, q in labels.items()) <= 4 and good.columns == docs.columns
    lines = stage["line_dedup"](spark, good, SF)
    plain = {i: t for i, _, _, t in data.kept_lines([(r.doc_id, r.text) for r in good.collect()])}
    rows = lines.collect()
    assert {r.doc_id: r.text for r in rows} == plain and all(r.n_chars == len(r.text) for r in rows) and lines.columns == docs.columns
    fp = {i: data.fingerprint(t) for i, t in plain.items()}
    root = data.linked(sorted(fp), [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3])
    single = stage["simhash"](spark, lines, SF)
    assert {r.doc_id for r in single.collect()} == set(root.values()) and single.columns == docs.columns
    items = [" " + " ".join(w.lower() for w in _parsed(r.text)) + " " for r in llm.table(spark, SF, "benchmark").collect()]
    leaks = {i for i in set(root.values()) if any(x in " " + " ".join(w.lower() for w in _parsed(plain[i])) + " " for x in items)}
    clean = stage["decontaminate"](spark, single, SF)
    assert {r.doc_id for r in clean.collect()} == set(root.values()) - leaks and clean.columns == docs.columns
    mixed = stage["mixing"](spark, clean, SF)
    assert {r.doc_id for r in mixed.collect()} <= set(root.values()) - leaks and mixed.count() > 100
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == {r.doc_id for r in mixed.collect()}


@pytest.mark.parametrize("empty", [False, True])
def test_defined_cases(spark, empty):
    docs = data.documents(spark)
    docs = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= docs.count() and (name == "mixing" or out.columns == docs.columns)


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_sql(spark, name):
    assert not compare(spark, connect(SF), SF, llm.QUERIES[name], llm.ORACLES[name])[1]
