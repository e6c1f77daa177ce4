import numpy as np
from odd_rows import no_docs, odd_docs

from talkmeter.llm import toxicity as tox
from talkmeter.llm.catalog import QUERIES


def test_labelled_toxic_texts_are_found_and_clean_ones_left(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    found = QUERIES["op2_toxicity"](spark, base).toPandas()
    labels = spark.read.parquet(f"{base}/labels.parquet").toPandas()
    rows = found.merge(labels, on="doc_id", suffixes=("", "_label"))
    assert len(found) == spark.read.parquet(f"{base}/documents.parquet").count()
    clean = rows[rows.toxic_label == 0]
    assert clean.toxic.mean() < 0.02
    good = rows[(rows.toxic_label == 1) & (rows.quality == 1)]
    assert good.toxic.mean() > 0.9


def test_held_out_accuracy_and_out_of_fold_feedback():
    rng = np.random.default_rng(3)
    n, width = 1200, 40
    cells = rng.random((n, width)) < 0.2
    first = (cells[:, 0] | cells[:, 1]).astype(int)
    second = (first & cells[:, 2]).astype(int)
    rows, columns = np.nonzero(cells[:800])
    labels = np.column_stack([first, second])[:800]
    weights = tox.fit(rows, columns, labels, np.arange(800) % 4, width, 0.3)
    chain = tox.Chain(("a", "b"), {f"w{i}": i for i in range(width)}, weights)
    texts = [" ".join(f"w{i}" for i in np.flatnonzero(row)) for row in cells[800:]]
    p = chain.predict(texts)
    assert ((p[:, 0] > 0.5) == first[800:]).mean() > 0.97
    assert ((p[:, 1] > 0.5) == second[800:]).mean() > 0.95
    # The second model has a weight for the first one's probability.
    assert len(weights[1]) == width + 2


def newton(x, y, penalty):
    """A logistic model fitted by plain Newton steps; the last column is the constant."""
    held = np.diag([penalty] * (x.shape[1] - 1) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) + held @ w
        w = w - np.linalg.solve((x.T * (p * (1 - p))) @ x + held, slope)
    return w


def test_chain_equals_a_plain_dense_chain():
    rng = np.random.default_rng(9)
    n, width, penalty = 400, 12, 0.7
    cells = rng.random((n, width)) < 0.3
    labels = np.column_stack([
        cells @ rng.normal(0, 2, width) + rng.normal(0, 1, n) > 0.5 for _ in range(3)
    ]).astype(int)
    fold = np.arange(n) % 4
    ones, earlier, plain = np.ones((n, 1)), np.zeros((n, 0)), []
    for j in range(3):
        x, y = np.column_stack([cells, earlier, ones]), labels[:, j]
        plain.append(newton(x, y, penalty))
        out = np.zeros(n)
        for part in range(4):
            w = newton(x[fold != part], y[fold != part], penalty)
            out[fold == part] = 1 / (1 + np.exp(-x[fold == part] @ w))
        earlier = np.column_stack([earlier, out])
    rows, columns = np.nonzero(cells)
    got = tox.fit(rows, columns, labels, fold, width, penalty)
    # The fit ends at a relative gain of 1e-7, which leaves weights of size 1 to 5 this near.
    assert all(np.allclose(a, b, atol=2e-2) for a, b in zip(got, plain))
    texts = [" ".join(f"w{i}" for i in np.flatnonzero(row)) for row in cells]
    found = np.zeros((n, 0))
    for w in got:  # at prediction time a model sees the earlier ones' own probabilities
        p = 1 / (1 + np.exp(-np.column_stack([cells, found, ones]) @ w))
        found = np.column_stack([found, p])
    chain = tox.Chain("abc", {f"w{i}": i for i in range(width)}, got)
    assert np.allclose(chain.predict(texts), found)


def test_vocabulary_is_all_that_goes_with_a_category(spark):
    """5,000 words that stand in toxic texts only: none is cut off."""
    bad = [f"b{i}q" for i in range(5000)]
    rows = [(i, " ".join(bad), i) for i in range(30)] + [(100 + i, "plain words here", 0) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < 30)) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    assert set(bad) <= tox.train(docs, labels).words.keys()


def test_odd_rows_and_labels(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = tox.classified(docs, none)
    assert rows.count() == docs.count() and rows.filter("p_toxic > 0 or toxic = 1").count() == 0
    assert rows.select("__row.*").schema == docs.schema
    some = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (None, 1, 1), (7, None, 1), (6, 1, 1), (99, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    same = [r.p_toxic for r in tox.classified(docs, some, keep_row=False).collect() if r.doc_id in (1, 6)]
    assert len(same) == 2 and same[0] == same[1]
    assert tox.classified(no_docs(spark), some).count() == 0
