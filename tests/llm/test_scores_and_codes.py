"""SentencePiece encoding, whitening and ranked search against the library and plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aspectflow.llm import lexical, pieces, queries, whitening, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


# ---- op11 -------------------------------------------------------------------------------------------------------

def test_merge_rounds_equal_the_library_on_odd_texts(library):
    m, rnd = pieces.piece_model(pieces.model_path()), random.Random(5)
    names = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    alone = [names[i - 259] for i in np.flatnonzero(m.alone) if i >= 259]
    texts = ["", None, " ", "  a  b ", "\0x", "▁a", "　x", "<s></s>", "<0x41>", "😀▁▁ b", "̀x", "ab" * 400, "aba" * 300, " " * 99]
    texts += ["".join(rnd.choice("abcABC  ▁\n\t.,<>é中😀") for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(rnd.choice(names) for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    texts += [(rnd.choice(alone) * rnd.randint(1, 5) + rnd.choice(alone)) * rnd.randint(1, 3) for _ in range(2000)]
    texts.append("".join(rnd.choice("abcdefghij") for _ in range(5000)))
    ids, lengths = m.encode(pa.array(texts, pa.string()))
    back = m.decode(ids, lengths)
    for text, end, n, decoded in zip(texts, np.cumsum(lengths), lengths, back):
        want = library.encode(text or "", add_bos=True, add_eos=True)
        assert ids[end - n:end].tolist() == want, text
        assert decoded.decode() == library.decode(want)


def test_decode_equals_the_library_on_any_ids(library):
    m, rnd = pieces.piece_model(pieces.model_path()), random.Random(6)
    for _ in range(1500):
        ids = [rnd.randrange(0, 259) if rnd.random() < 0.6 else rnd.randrange(32000) for _ in range(rnd.randint(0, 9))]
        assert m.decode(np.array(ids, np.int64), np.array([len(ids)]))[0].decode() == library.decode(ids), ids


def test_equal_hashes_of_unlike_words_are_told_apart(library, monkeypatch):
    monkeypatch.setattr(words, "mix64", lambda x: x * np.uint64(0))
    m = pieces.PieceModel(pieces.model_path())
    for texts in (["one two one", "three one two", "six"], ["six two", "ten"], ["one one"], ["ten six a"]):
        ids, lengths = m.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in library.encode(t, add_bos=True, add_eos=True)]


def test_known_words_are_bounded_and_exact(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 40)
    m, rnd = pieces.PieceModel(pieces.model_path()), random.Random(8)
    for _ in range(60):
        texts = [" ".join(rnd.choice("abc") * rnd.randint(1, 12) + rnd.choice("xyz😀") for _ in range(rnd.randint(0, 20))) for _ in range(5)]
        ids, lengths = m.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in library.encode(t, add_bos=True, add_eos=True)]
        assert (np.diff(m.known.hash.astype(float)) > 0).all()


def test_encoded_tables(spark, corpus, no_docs, library):
    extra = corpus.withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("x")).union(
        corpus.withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("x")))
    rows = pieces.decoded(pieces.encoded(extra, batch_bytes=1 << 12)).collect()
    texts = [r["text"] for r in corpus.collect()] * 2
    assert len(rows) == len(texts)
    want = Counter((np.array(library.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes(), library.decode(library.encode(t or "")))
                   for t in texts)
    assert Counter((bytes(r["ids"]), r["text"]) for r in rows) == want
    assert all(4 * r["n_tokens"] == len(r["ids"]) for r in rows)
    again = pieces.encoded(corpus, batch_bytes=1 << 12, decode=True).unionAll(pieces.encoded(corpus, decode=True))
    assert Counter((bytes(r["ids"]), r["text"]) for r in again.collect()) == want
    assert pieces.decoded(pieces.encoded(no_docs)).count() == 0
    big = spark.createDataFrame([((1 << 60) + 1, "a"), (None, None), ((1 << 60) + 3, "b")], "doc_id long, text string")
    assert {r["doc_id"] for r in pieces.encoded(big).collect()} == {(1 << 60) + 1, None, (1 << 60) + 3}


def test_op11_query(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_piece_merge_rounds(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# ---- op12 -------------------------------------------------------------------------------------------------------

def plain_whitening(x, k=4):
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    z = (n * fit.astype(object) - sums)
    cov = np.array([[float(sum(a * b for a, b in zip(z[:, i], z[:, j])) / n**3) for j in range(x.shape[1])] for i in range(x.shape[1])])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    every = n * x.astype(object) - sums
    white = (every.astype(float) / n) @ vectors[:, :k] / np.sqrt(values[:k])
    return n, [sum(int(v) ** 2 for v in row) for row in every], white, values[:k] / values.sum(), cov


@pytest.mark.parametrize("size", [1.0, 3e7, 1e14])       # 64-bit squares, halves of 26 bits, integers of any size
def test_whitening_is_exact_at_any_magnitude(spark, size):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(300, 6)) * size * [5, 4, 3, 2, 1, 1]
    data[40:60] = data[3]
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(data)], "vec_id long, embedding array<double>").repartition(5)
    got = whitening.whitened(rows).toPandas().sort_values(["vec_id", "component"])
    x = np.floor(256 * data).astype(np.int64)
    n, deviation, white, share, cov = plain_whitening(x)
    first = got[got.component == 1]
    assert set(got.n) == {n} and first.deviation_exact.tolist() == [str(d) for d in deviation]
    assert all((a is None or math.isnan(a)) if d > 2**63 - 1 else int(a) == d or abs(int(a) / d - 1) < 1e-15
               for a, d in zip(first.deviation, deviation))
    mine = got.whitened.to_numpy(float).reshape(-1, 4)
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-8
    assert np.allclose(first.explained.iloc[0], share[0], rtol=1e-9)
    assert got.identity_error.max() < 1e-9
    fitted, _ = whitening.fit(whitening.integer_vectors(rows))
    assert np.allclose(fitted.covariance, cov, rtol=1e-12, atol=0)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (2, [0.0, 2.0]), (None, [-1.0, -0.5]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0]), (9, [1e300, 1.0]), (10, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, "a", 5) for r in rows], "vec_id long, embedding array<double>, x string, whitened int")
    got = whitening.whitened(df).collect()
    assert Counter(r["vec_id"] for r in got) == {1: 2, 2: 4, None: 2, 10: 2}          # two dimensions, two components
    assert {r["n"] for r in got} == {4} and {r["component"] for r in got} == {1, 2}
    assert whitening.whitened(df.where("vec_id > 99")).collect() == []
    one = whitening.whitened(df.where("vec_id = 1")).collect()                      # nothing varies
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(0, None, None, None)] * 2
    line = spark.createDataFrame([(i, [float(i), float(2 * i)]) for i in range(5)], "vec_id long, embedding array<double>")
    flat = {r["component"]: r["whitened"] for r in whitening.whitened(line).collect()}
    assert flat[1] is not None and flat[2] is None
    copies = df.where("vec_id = 2").limit(1).crossJoin(spark.range(3000)).drop("id").union(df.where("vec_id in (1, 10)"))
    assert whitening.whitened(copies).agg(F.max("n"), F.count("*")).first()[:] == (3, 6004)


def test_op12_query(spark):
    rows = queries.op12_polarised_whitening(spark, SF).toPandas().sort_values(["vec_id", "component"])
    src = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.floor(256 * np.stack(src.embedding).astype(float)).astype(np.int64)
    n, deviation, white, share, _ = plain_whitening(x)
    assert set(rows.n) == {n} and rows[rows.component == 1].deviation.tolist() == deviation
    mine = rows.whitened.to_numpy().reshape(-1, 4)
    assert np.abs(mine * np.sign((mine * white).sum(axis=0)) - white).max() < 1e-8
    assert np.allclose(rows.explained.to_numpy().reshape(-1, 4), share) and rows.identity_error.max() < 1e-8


# ---- op13 -------------------------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, top=10):
    """All documents scored for every item: list of (item, rank, doc_id, score)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    bags = [(i, Counter(TERM.findall((t or "").translate(lower)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, length, df = len(bags), sum(sum(b.values()) for _, b in bags), Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                    for t in set(TERM.findall((text or "").translate(lower))) if t in bag)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return out


@pytest.mark.parametrize("settings", [{}, {"block_postings": 50}, {"slice_bytes": 200}])
def test_search_equals_scoring_every_document(spark, corpus, settings):
    docs = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    rnd = random.Random(9)
    longest = max((t or "" for _, t in docs), key=len).split()
    items = [(k, " ".join(rnd.choice(longest) for _ in range(rnd.randint(1, 30)))) for k in range(25)]
    items += [(25, docs[7][1]), (26, None), (27, ""), (28, "!!"), (29, "ÉÀ nowhere"), (None, "one two"), (3, "ONE"), (3, "ONE"), (30, "absent")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("clash"))
    got = lexical.search(corpus.withColumn("score", F.lit(1)), table, **settings).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_search(docs, items))


def test_search_of_ties_copies_and_empty_tables(spark, no_docs):
    docs = [(i % 500 if i % 3 else None, "common words here" if i % 2 else "common") for i in range(3000)] + [(9000 + i, f"t{i} common") for i in range(50)]
    items = [(1, "common here"), (2, "common"), (3, "t7 common words")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    q = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(df, q).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_search(docs, items))
    assert lexical.search(no_docs, q).collect() == [] and lexical.search(df, q.where("false")).collect() == []


def test_no_new_accumulators_beyond_the_bound():
    """A later term's documents get no accumulator once its bound lies below the k-th partial score; others stay exact."""
    n, ones = 100, lambda k: np.ones(k, np.int64)
    term = np.concatenate([np.zeros(5, np.int64), ones(n)])
    owner = np.concatenate([np.arange(5), np.arange(n)])
    order = np.argsort(owner, kind="stable")
    block = lexical.Block(np.arange(n), np.arange(n), np.zeros(n, bool), ones(n) * 10, np.bincount(owner), term[order],
                          ones(n + 5), 2, n, 10 * n)
    gain = int(block.impact[0])
    docs, scores = block.best([(0, 100), (1, 1)], [101 * gain, gain], 3, 0)
    assert docs.tolist() == [0, 1, 2, 3, 4] and scores.tolist() == [101 * gain] * 5
    assert not block.score.any()


def test_op13_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op13_limited_accumulators(spark, SF).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_search(docs, items))
