import hashlib

import pytest
from odd_rows import no_docs, odd_docs, row

from talkmeter.llm import line_dedup as ld

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least):
    keys = [[line.strip(WHITE).translate(LOWER) for line in (t or "").split("\n")] for _, t in rows]
    seen = {}
    for own in keys:
        for key in set(own):
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (doc_id, text), own in zip(rows, keys):
        lines = (text or "").split("\n")
        stay = [line for line, key in zip(lines, own) if not key or seen[key] < least]
        out.append((str(doc_id), len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def result(docs, **options):
    rows = ld.drop_common_lines(docs, **options).select("__row.doc_id", "n_lines", "n_dropped", "kept")
    return sorted((str(r[0]), *r[1:]) for r in rows.collect())


@pytest.mark.parametrize("least", [2, 3, 10])
def test_odd_rows_equal_brute_force(spark, least):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs, min_docs=least) == brute(rows, least)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (7, 3)])
def test_batches_and_levels_do_not_matter(spark, batches, fanout):
    texts = [f"line {i % 7}\nown {i}\n LINE {i % 3} \n\n{'hot'}" for i in range(40)]
    docs = odd_docs(spark, [row(i, t) for i, t in enumerate(texts)])
    got = result(docs, min_docs=10, batches=batches, fanout=fanout)
    assert got == brute(list(enumerate(texts)), 10)


def test_hot_line_in_a_third_of_the_documents(spark):
    texts = ["same boiler\n" * 3 + f"text {i}" if i % 3 == 0 else f"text {i}" for i in range(300)]
    docs = odd_docs(spark, [row(i, t) for i, t in enumerate(texts)])
    assert result(docs) == brute(list(enumerate(texts)), 10)


def test_runs_anti_join_what_they_hold(spark):
    runs = ld.LineRuns(spark, enough=3, fanout=2)
    rows = lambda *keys: spark.createDataFrame([(k, k, 1) for k in keys], "h1 long, h2 long, n long")
    for batch in ((1, 2), (1, 3), (1, 4), (5,)):
        runs.add(rows(*batch))
    assert sorted(r.h1 for r in runs.unseen(rows(1, 4, 9)).collect()) == [9]
    assert [r.h1 for r in runs.common().collect()] == [1]
    assert [len(level) for level in runs.levels] == [0, 0, 1]


def test_no_rows(spark):
    assert ld.drop_common_lines(no_docs(spark)).count() == 0


def test_no_python_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = ld.drop_common_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_digest_of_the_kept_text(spark, sf_dir):
    from talkmeter.llm.catalog import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = [(a, b, c, hashlib.sha256(d.encode()).hexdigest())
            for a, b, c, d in brute([(r.doc_id, r.text) for r in docs], 10)]
    got = sorted((str(r[0]), *r[1:]) for r in QUERIES["op5_line_dedup"](spark, sf_dir).collect())
    assert got == want
