from odd_rows import no_docs, odd_docs
from test_llm_join import brute as classes
from test_llm_lines import brute as lines

import corpus_pipeline as cp
from talkmeter.llm.catalog import QUERIES


def test_stages_in_order():
    names = [name for name, _ in cp.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_join", "source_mix", "packing"]


def test_each_stage_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = cp.reject_toxic(spark, docs, sf_dir).cache()
    toxic = {r.doc_id for r in QUERIES["op2_toxicity"](spark, sf_dir).collect() if r.toxic}
    rows = {r.doc_id: r for r in docs.collect()}
    assert {r.doc_id: r for r in first.collect()} == {i: r for i, r in rows.items() if i not in toxic}

    second = cp.drop_common_lines(spark, first, sf_dir).cache()
    want = {int(i): text for i, _, _, text in lines([(r.doc_id, r.text) for r in first.collect()], 10)}
    got = second.collect()
    assert {r.doc_id: r.text for r in got} == want and second.columns == docs.columns
    assert all(r.n_chars == len(r.text) and r.source == rows[r.doc_id].source for r in got)

    third = cp.drop_near_copies(spark, second, sf_dir).cache()
    groups = {c for _, c, _ in classes([(r.doc_id, r.text) for r in got])}
    assert sorted(r.doc_id for r in third.collect()) == sorted(groups)
    assert third.columns == docs.columns

    fourth = cp.mix_sources(spark, third, sf_dir)
    kept = {tuple(r) for r in third.collect()}
    assert {tuple(r) for r in fourth.collect()} <= kept and fourth.columns == docs.columns
    assert fourth.count() > third.count()


def test_odd_and_no_documents_pass_all_stages(spark, sf_dir):
    for docs in (odd_docs(spark), no_docs(spark)):
        columns, n = docs.columns, docs.count()
        for _, stage in cp.STAGES:
            last, docs = docs, stage(spark, docs, sf_dir)
            assert (docs.count() > 0) == (n > 0)
        assert last.columns == columns


def test_run(spark, sf_dir):
    pieces = cp.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(pieces.columns)
    assert pieces.count() > 0
