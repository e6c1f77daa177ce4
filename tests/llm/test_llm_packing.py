import random
import zlib

import numpy as np
import pytest
from odd_rows import no_docs, odd_docs, row

from talkmeter.llm import packing as pk


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(pk.public_file("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, docs, tokenizer, window):
    """Pieces rebuild every document; sequences have no gap; only one sequence is short."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    short = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end <= window
        short += end < window
    assert short <= 1
    want = {}
    for doc_id, text in docs:
        ids = ids_of(tokenizer, text)
        want.setdefault((doc_id, len(ids)), []).append(ids)
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    assert got.keys() == want.keys()
    for key, texts in want.items():
        covered = np.zeros(key[1], dtype=int)
        sums = {}
        for start, length, crc in got[key]:
            covered[start : start + length] += 1
            assert any(
                zlib.crc32(np.array(ids[start : start + length], dtype="<u4").tobytes()) == crc
                for ids in texts
            )
        assert (covered == len(texts)).all()


def test_whole_table(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(pk.sequences(docs).collect(), rows, tokenizer, 1024)


@pytest.mark.parametrize("window", [16, 1024])
def test_odd_rows(spark, tokenizer, window):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(pk.sequences(docs, window=window, salts=4).collect(), rows, tokenizer, window)


def test_one_length_for_all(spark, tokenizer):
    docs = odd_docs(spark, [row(i, "word " * 9) for i in range(500)])
    rows = [(i, "word " * 9) for i in range(500)]
    check(pk.sequences(docs, window=32, salts=4).collect(), rows, tokenizer, 32)


def test_no_rows(spark):
    assert pk.sequences(no_docs(spark)).count() == 0


@pytest.mark.parametrize("n", [1, 7, 300, 20_000])
def test_plan_places_every_piece_once(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(3, 1, n).astype(int) % 64, 1, 63)
    histogram = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True))))
    plan, filled = pk.Plan(histogram, 64), {}
    for length, count in histogram.items():
        for rank in range(count):
            pieces = plan.pieces(length, rank)
            assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1]]
            assert sum(p[1] for p in pieces) == length
            for _, size, sequence, offset in pieces:
                filled.setdefault(sequence, []).append((offset, size))
    assert sorted(filled) == list(range(plan.sequences))
    assert plan.sequences == -(-int(lengths.sum()) // 64)
    for pieces in filled.values():
        end = 0
        for offset, size in sorted(pieces):
            assert offset == end
            end += size
        assert end <= 64


def test_fit_is_non_negative_least_squares():
    histogram = {a: n for a, n in zip(range(1, 16), [9, 3, 7, 0, 5, 5, 8, 2, 4, 4, 1, 6, 3, 2, 8]) if n}
    combos = pk.combinations(list(histogram), 16)
    assert all(sum(c) == 16 for c in combos) and (15, 1) in combos and (8, 7, 1) in combos
    x = np.array(pk.fitted(combos, histogram, 5000))
    lengths = sorted(histogram)
    a = np.array([[c.count(l) for c in combos] for l in lengths], dtype=float)
    h = np.array([histogram[l] for l in lengths], dtype=float)
    slope = a.T @ (a @ x - h)
    # Where the fit stops, no count can still move by half a sequence to its gain.
    weight = (a * a).sum(0)
    assert (x >= 0).all() and (slope / weight > -0.51).all()
    assert (np.abs(slope / weight)[x > 1] < 0.51).all()


def test_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(3)
    letters = "ab é\n\t  's'llÄß日本😀123.,!  \r\x0b\x1c _-"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(2000)]
    texts += ["<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "a" * 3000, " " * 500, "x  y\n\n z "]
    encoder = pk.Encoder(pk.public_file("byte_bpe_50k.json"))
    assert encoder.fast is not None
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
    lower = pk.Encoder(pk.public_file("word_bpe_49k.json"))
    assert lower.fast is None and len(lower.encode("Some words")) >= 8
