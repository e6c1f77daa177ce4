import random
import re
from collections import Counter

import pytest
from odd_rows import no_docs, odd_docs, row

from talkmeter.llm import divergence as dv


def terms(text):
    found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return Counter("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found)


def brute(rows, min_df, top=50):
    docs = [(lang or "", source or "", terms(text)) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(w for d in own for w in d[2])
        kept = sorted(w for w in df if df[w] >= min_df)
        sums = {}
        for _, source, found in own:
            sums.setdefault(source, Counter()).update({w: n for w, n in found.items() if df[w] >= min_df})
        everything = sum(sums.values(), Counter())

        def share(counts, w):
            return 1 + 10**9 * (counts[w] + 5) // (sum(counts.values()) + 5 * len(kept))

        for s, mine in sums.items():
            pairs = [(-sum(abs(share(mine, w) - share(other, w)) for w in kept), t)
                     for t, other in sums.items() if t != s]
            over = [(share(everything, w) - share(mine, w), w) for w in kept if mine[w]]
            over = [(v, w) for v, w in over if v < 0]
            for part, found in (("pair", pairs), ("term", over)):
                found.sort(key=lambda f: (f[0], f[1].encode()))
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(found)
                        if part == "pair" or i < top]
    return sorted(out)


def got(docs, **options):
    rows = dv.audited(docs, **options).select("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("blocks", [{}, {"term_block": 3, "source_block": 2}])
def test_sources_equal_brute_force_in_any_blocks(spark, blocks):
    rng = random.Random(5)
    words = [f"w{c}é" for c in "abcdefghijklmnopqrst"] + ["Straße", "STRASSE", "x1y", "ÄB", "äb", "日本"]
    rows = []
    for i in range(160):
        text = " ".join(rng.choices(words, k=rng.randint(0, 25), weights=range(1, len(words) + 1)))
        rows.append((text, rng.choice(["en", "de", None]), rng.choice("pqrstuv") if i % 9 else None))
    rows += [("only one", "xx", "alone"), (None, "en", "silent"), ("12 34 ,;", "en", "silent")]
    rows += [("the same " * 50, "yy", s) for s in ("a", "b")] * 4
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    for min_df in (3, 500):
        assert got(docs, min_df=min_df, **blocks) == brute(rows, min_df)


def test_odd_rows_and_ranks_of_terms(spark):
    docs = odd_docs(spark)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert got(docs, min_df=1, top=3) == brute(rows, 1, 3)
    assert got(no_docs(spark)) == []


def test_indexed_vectors_are_those_of_a_count_vectorizer(spark):
    from pyspark.ml.feature import CountVectorizer

    rng = random.Random(3)
    rows = [row(i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 30), weights=range(1, 9))))
            for i in range(60)]
    docs = odd_docs(spark, rows)
    ours = {r.doc_id: (r.size, dict(zip(r.indices, r["values"])))
            for r in dv.indexed_vectors(docs, min_df=4).collect()}
    tokens = spark.createDataFrame([(r[0], list(terms(r[1]).elements())) for r in rows], "id long, t array<string>")
    model = CountVectorizer(inputCol="t", outputCol="v", minDF=4, vocabSize=dv.LARGEST).fit(tokens)
    theirs = {r.id: (r.v.size, dict(zip(r.v.indices.tolist(), r.v.values.tolist())))
              for r in model.transform(tokens).collect()}
    assert len(ours) == 60 and ours == theirs


def test_vectors_leave_in_pieces_without_changing(spark):
    docs = odd_docs(spark)
    whole, pieces = (sorted(map(tuple, dv.document_vectors(docs, n).collect()), key=str) for n in (10**6, 3))
    assert whole == pieces and len(whole) == docs.count()


def test_limited_vocabulary_keeps_the_most_frequent(spark):
    rows = [("a a a b b c", "en", "s")] * 2 + [("a d", "en", "t")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    found = {r.item for r in dv.audited(docs, min_df=1, vocab_size=2).collect() if r.part == "term"}
    assert found <= {"a", "b"} and found


def test_shares_of_very_large_counts_are_exact(spark):
    n, size, v = 9_000_000_000_000_000_000, 9_200_000_000_000_000_000, 1_000_000
    df = spark.createDataFrame([(n, size, v)], "n long, s long, v long")
    assert df.select(dv.share(df.n, df.s, df.v)).first()[0] == 1 + 10**9 * (n + 5) // (size + 5 * v)
