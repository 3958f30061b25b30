"""The pipeline against its stages in plain Python."""

from __future__ import annotations

import corpus_pipeline
from shelfgate.llm import quality
from test_operators import brute_bpe, brute_components, brute_lines, brute_stats

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = quality.fit_rules(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    verdict = {r.doc_id: r.kept for r in quality.apply_rules(docs, rules).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for i, text in rows:
        n, _, _, _, repeated = brute_stats(text)
        assert not (verdict[i] and (n < 20 or 100 * repeated > 30 * n))
    rows = [(i, t) for i, t in rows if verdict[i]]
    gone = brute_lines(rows)
    rows = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)) for i, t in rows]
    rows = [r for r, (i, _, c) in zip(rows, brute_components(rows)) if i == c]
    state = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, SF)
        assert state.columns == docs.columns and state.dtypes == docs.dtypes, name
    redacted = {r.doc_id: r for r in state.collect()}
    assert sorted(redacted) == sorted(i for i, _ in rows)
    assert all(r.text == dict(rows)[i] or "[" in r.text for i, r in redacted.items())
    assert all(r.n_chars == len(r.text) for r in redacted.values())
    pieces = corpus_pipeline.run(spark, SF).collect()
    tokens = {}
    for p in pieces:
        tokens[p.doc_id] = tokens.get(p.doc_id, 0) + p.length
    assert tokens == {i: len(b) // 4 + 1 for i, b, _ in brute_bpe([(i, r.text) for i, r in redacted.items()])}


def test_pipeline_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
