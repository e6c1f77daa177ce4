import hashlib
import random

import numpy as np
import pytest
from odd_rows import no_docs, odd_docs, row

from talkmeter.llm import fingerprint as fp


def test_order_of_paragraphs_does_not_matter_and_edits_add_up():
    a, b, extra = "first paragraph here\nsecond one", "second one\nfirst paragraph here", "a third"
    one, two = fp.vectors([a]), fp.vectors([b])
    assert fp.printed(*one) == fp.printed(*two) and fp.likeness(one, two)[0] == 1
    grown = fp.combine(one, fp.vectors([extra]))
    assert fp.printed(*grown) == fp.printed(*fp.vectors([a + "\n" + extra]))
    assert fp.printed(*fp.combine(grown, fp.vectors([extra]), -1)) == fp.printed(*one)
    assert fp.printed(*fp.vectors(["a"])) != fp.printed(*fp.vectors(["a\na"]))


def test_likeness_follows_the_shared_part():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(4000)]
    whole = "\n".join(" ".join(words[i : i + 20]) for i in range(0, 2000, 20))
    other = "\n".join(" ".join(words[i : i + 20]) for i in range(2000, 4000, 20))
    half = whole[: len(whole) // 2] + other[: len(whole) // 2]
    vectors = fp.vectors([whole, half, other])
    pick = lambda i: tuple(v[i : i + 1] for v in vectors)
    assert 0.35 < fp.likeness(pick(0), pick(1))[0] < 0.65
    assert fp.likeness(pick(0), pick(2))[0] < 0.2


@pytest.mark.parametrize("text", ["\n".join(["-" * 80] * 600), "x" * 50_000])
def test_likeness_of_long_repetitive_texts(text):
    half = text[: len(text) - len(text) // 2]
    one, two = fp.vectors([text]), fp.vectors([half])
    # Half as many of the same windows: 2ab / (aa + bb) with b = a / 2.
    assert fp.likeness(one, two)[0] == pytest.approx(0.8, abs=0.01)
    back = fp.combine(fp.combine(two, one), one, -1)
    assert fp.printed(*back) == fp.printed(*two)


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in rows]
    own = fp.vectors(texts)
    out = []
    for i, text in enumerate(texts):
        j = (i + 1) % len(texts)
        changed = fp.edited(text, texts[j])
        other = fp.vectors([changed])
        mine, following = (tuple(v[k : k + 1] for v in own) for k in (i, j))
        out.append((
            rows[i][0], len(text), hashlib.sha256(changed.encode()).hexdigest(),
            fp.printed(*mine)[0], fp.printed(*other)[0],
            float(fp.likeness(mine, other)[0]), float(fp.likeness(mine, following)[0]),
        ))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[2])


def test_odd_rows_equal_brute_force(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in fp.fingerprints(docs).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in fp.fingerprints(docs).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_single_and_no_rows(spark):
    only = fp.fingerprints(odd_docs(spark, [row(4, "abcdef")])).collect()
    assert [(r.doc_id, r.near_next) for r in only] == [(4, 1.0)]
    assert only[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert fp.fingerprints(no_docs(spark)).count() == 0


def test_pieces_by_points(spark):
    points = [3, 8, 8, 20] + list(range(21, 300))
    points = sorted(set(points))
    values = [None, -5, 3, 4, 8, 9, 20, 21, 150, 298, 299, 1000]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r[0] for r in df.select(fp.piece_of(df["v"], points)).collect()]
    assert got == [0 if v is None else int(np.searchsorted(points, v)) for v in values]


@pytest.mark.parametrize("text", ["", "\n", "é\n\n日本", "x" * 15, "x" * 16, "x" * 17])
def test_texts_of_any_size_have_a_vector(text):
    assert fp.vectors([text, "pad"])[1].shape == (2, fp.NEAR_LANES)
