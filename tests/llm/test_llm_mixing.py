import re

import pytest
from odd_rows import no_docs, odd_docs, row

from talkmeter.llm import mixing


def targets(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Excess is shared again by weight until no source is above its stop."""
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, open_, found = share * sum(sizes.values()), set(names), {}
    while open_:
        level = rest / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            found.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            found[s] = most * sizes[s]
            rest -= found[s]
            open_.remove(s)
    return found


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("counts", [
    {"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 1000, "c": 1, None: 30}, {"x": 0, "y": 7},
    {None: 10}, {"a": 1, "b": 2, "c": 3, "d": 4, "e": 500, "f": 6, "g": 0},
])
def test_targets_equal_repeated_sharing(spark, counts):
    sizes = spark.createDataFrame(list(counts.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes, 1.5, 2.0, (3, 1, 2)).collect()}
    assert got == pytest.approx(targets(counts))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    want = targets(sizes)
    mixed = mixing.mixed(docs).select("__row.source", "__row.text", "size", "source_size", "target", "copies")
    found = mixed.collect()
    assert len(found) == len(rows)
    for r in found:
        assert r[2] == size(r[1]) and r[3] == sizes[r[0]] and r[4] == pytest.approx(want[r[0]])
        assert 0 <= r[5] <= 2
    out = mixing.repeated(docs)
    assert out.schema == docs.schema and out.count() == sum(r[5] for r in found)


def test_sources_come_near_their_targets_in_every_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    runs = []
    for parts in (2, 5):
        rows = mixing.mixed(docs.repartition(parts), keep_row=False).collect()
        runs.append(sorted((r.doc_id, r.copies) for r in rows))
    assert runs[0] == runs[1]
    taken, wanted = {}, {}
    for r in rows:
        taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.copies * r["size"]
        wanted[r.source_size, r.target] = r.target
    assert sum(taken.values()) == pytest.approx(sum(wanted.values()), rel=0.05)


def test_hot_source(spark):
    docs = odd_docs(spark, [row(i, "w " * (i % 9), "hot" if i % 3 else f"s{i % 4}") for i in range(600)])
    rows = mixing.mixed(docs).select("__row.source", "target", "copies", "size").collect()
    for source, target in {(r[0], r[1]) for r in rows}:
        got = sum(r[2] * r[3] for r in rows if r[0] == source)
        assert got == pytest.approx(target, rel=0.05)


def test_no_rows(spark):
    assert mixing.mixed(no_docs(spark)).count() == 0 and mixing.repeated(no_docs(spark)).count() == 0
