
from aspectflow.operators import vocab as V
from tests import pyref

TEXTS = ["b a c a", "c b", "d", "", "a e e e"]


def _docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, clean_text string")


def _vocab_dict(df):
    return {r.token: r.id for r in df.collect()}


def test_vocab_first_seen_breaks_ties(spark):
    # a:3 e:3 -> a first (seen earlier); b:2 c:2 -> b first; d:1
    got = _vocab_dict(V.build_vocab(_docs(spark, TEXTS), max_vocab=10))
    assert got == pyref.vocab(TEXTS, 10)
    assert got["a"] == 2 and got["e"] == 3 and got["b"] == 4 and got["c"] == 5 and got["d"] == 6


def test_vocab_cap_smaller_than_distinct(spark):
    got = _vocab_dict(V.build_vocab(_docs(spark, TEXTS), max_vocab=3))
    assert got == pyref.vocab(TEXTS, 3)
    assert len(got) == 5


def test_vocab_ids_bijection(spark):
    got = V.build_vocab(_docs(spark, TEXTS), max_vocab=100).collect()
    ids = sorted(r.id for r in got)
    assert ids == list(range(len(ids)))


def test_vocab_sizes(spark):
    counts = V.token_counts(V.token_positions(_docs(spark, TEXTS)), with_first=False)
    row = V.vocab_sizes(counts, 3).first()
    assert row.n_distinct == 5 and row.vocab_size == 5


def test_encode_unknown_and_empty(spark):
    docs = _docs(spark, TEXTS)
    voc = V.build_vocab(docs, max_vocab=2)  # a, e
    ref = pyref.vocab(TEXTS, 2)
    got = {r.doc_id: list(r.ids) for r in V.encode(docs, voc).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == [ref.get(w, 1) for w in t.split()]
    assert got[3] == []


def test_encode_join_path_agrees(spark):
    docs = _docs(spark, TEXTS)
    voc = V.build_vocab(docs, max_vocab=2)
    a = {r.doc_id: list(r.ids) for r in V.encode(docs, voc).collect()}
    b = {r.doc_id: list(r.ids) for r in V.encode_by_join(docs, voc).collect()}
    assert a == b


def test_pad_global_and_group(spark):
    df = spark.createDataFrame([(0, [5, 6, 7], 0), (1, [], 0), (2, [9], 1)],
                               "doc_id long, ids array<int>, batch int")
    g = {r.doc_id: list(r.padded) for r in V.pad(df).collect()}
    assert g == {0: [5, 6, 7], 1: [0, 0, 0], 2: [9, 0, 0]}
    b = {r.doc_id: list(r.padded) for r in V.pad(df, group="batch").collect()}
    assert b == {0: [5, 6, 7], 1: [0, 0, 0], 2: [9]}
    assert {len(v) for k, v in g.items()} == {3}


def test_longest_sequence(spark):
    assert V.longest_sequence(_docs(spark, TEXTS)) == 4


def test_vocab_on_driver_table_matches_python(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    clean = V.cleaned(docs)
    rows = clean.orderBy("doc_id").collect()
    ref = pyref.vocab([r.clean_text for r in rows], 50)
    got = _vocab_dict(V.build_vocab(clean, max_vocab=50))
    assert got == ref
    enc = {r.doc_id: list(r.ids) for r in V.encode(clean, V.build_vocab(clean, 50)).collect()}
    for r in rows[:50]:
        assert enc[r.doc_id] == [ref.get(w, 1) for w in r.clean_text.split()]


def test_vocab_sizes_approx_close_to_exact(spark, sf001):
    docs = V.cleaned(spark.read.parquet(f"{sf001}/documents.parquet"))
    toks = V.token_positions(docs)
    exact = V.vocab_sizes(V.token_counts(toks, with_first=False)).first().n_distinct
    approx = V.vocab_sizes_approx(toks).first().n_distinct
    assert abs(approx - exact) <= 0.05 * exact
