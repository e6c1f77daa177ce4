import itertools

import numpy as np
from odd_rows import no_docs, odd_docs

from talkmeter.llm import quality as q


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    per_text = np.array([1, 4, 3, 6])
    scores, moves = rng.normal(0, 2, per_text.sum()), rng.normal(0, 1, (2, 2))
    good, normal, pairs = q.chain_sums(scores, moves, per_text)
    want, total, both, at = [], 0.0, np.zeros((2, 2)), 0
    for n in per_text:
        own = scores[at : at + n]
        weights = {}
        for y in itertools.product((0, 1), repeat=int(n)):
            s = sum(v for v, label in zip(own, y) if label) + sum(moves[a, b] for a, b in zip(y, y[1:]))
            weights[y] = np.exp(s)
        z = sum(weights.values())
        total += np.log(z)
        want += [sum(w for y, w in weights.items() if y[t]) / z for t in range(n)]
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                both[a, b] += w / z
        at += n
    assert np.allclose(good, want) and np.isclose(normal, total) and np.allclose(pairs, both)


def test_line_descriptions():
    own, points, per_text = q.described(["ABC DEF\nnormal words here.", "", "a a a a a a a a a"])
    assert per_text.tolist() == [2, 1, 1] and points.tolist() == [7, 18, 0, 17]
    assert own[0, 0] == 1 and own[1, 0] == 0 and own[2, 15] == 1 and own[3, 11] == 1
    alone = q.described(["normal words here."])[0][0]
    assert np.array_equal(alone, own[1])


def test_scores_equal_plain_forward_backward():
    rng = np.random.default_rng(12)
    field = q.Field(rng.normal(0, 1, q.WIDTH), rng.normal(0, 1, (2, 2)), (1.3, -0.4))
    texts = ["One line, that's all.", "", "A b\n\nCDE 77\n" + "word " * 30 + "\nend", "x\n" * 9]
    want = []
    for text in texts:
        lines = [q.described([line])[0][0] for line in text.split("\n")]
        sizes = [len(line) for line in text.split("\n")]
        n, none = len(lines), np.zeros(q.OWN)
        score = []
        for t in range(n):
            row = np.concatenate([
                lines[t], lines[t - 1] if t else none, lines[t + 1] if t + 1 < n else none,
                [t == 0, t + 1 == n, 1.0],
            ])
            score.append(np.array([0.0, row @ field.weights]))
        pair = np.exp(field.moves)
        ahead, behind = [np.exp(score[0])], [np.ones(2)]
        for t in range(1, n):
            ahead.append(np.exp(score[t]) * (ahead[-1] @ pair))
            behind.append(pair @ (np.exp(score[n - t]) * behind[-1]))
        good = []
        for a, b in zip(ahead, behind[::-1]):
            both = a * b
            good.append(both[1] / both.sum())
        weight = np.array(sizes) + 1.0
        mean = (np.array(good) * weight).sum() / weight.sum()
        want.append(1 / (1 + np.exp(-(1.3 * np.log(mean / (1 - mean)) - 0.4))))
    assert np.allclose(field.predict(texts), want)


def test_sampled_lines_are_a_stretch_from_anywhere():
    text = "\n".join(map(str, range(50)))
    got = [[int(x) for x in q.stretch(text, mark, 10).split("\n")] for mark in range(-30, 60)]
    assert all(g == list(range(g[0], g[0] + 10)) for g in got) and {g[0] for g in got} == set(range(41))
    assert q.stretch("a\nb", 7, 10) == "a\nb" and q.stretch("", 7, 10) == ""


def test_held_out_accuracy(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    found = q.scored(docs, labels).toPandas()
    rows = found.merge(labels.toPandas(), on="doc_id")
    held = rows[rows.held_out]
    assert len(found) == docs.count() and 0.1 < found.held_out.mean() < 0.3
    assert (held.predicted == held.quality).mean() > 0.95


def test_held_out_labels_are_not_learnt_from(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    import zlib

    turned = spark.createDataFrame(
        [(r.doc_id, 1 - r.quality if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.quality, 0)
         for r in labels.collect()], "doc_id long, quality int, toxic int",
    )
    one, two = (
        [tuple(r) for r in q.scored(docs, some).orderBy("doc_id").collect()] for some in (labels, turned)
    )
    assert one == two


def test_odd_rows(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = q.scored(docs, none).collect()
    assert len(rows) == docs.count() and {r.score for r in rows} == {0.5}
    labels = spark.createDataFrame(
        [(1, 1, 0), (3, 0, 0), (4, 0, 0), (5, 1, 0), (7, 0, 0), (8, None, 0), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = q.scored(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert q.scored(no_docs(spark), labels).count() == 0
