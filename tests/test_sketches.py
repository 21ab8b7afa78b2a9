"""Summaries of frequent tokens, mergeable samples, length batches and VARIANT counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aspectflow.functions.codec import counts_from_json, counts_map_of_variant, counts_of_variant, counts_variant
from aspectflow.operators import dashboard as D
from aspectflow.operators import heavy
from aspectflow.operators import vocab as V


def _texts(spark, n=300, seed=1, tasks=6):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [(i if i % 40 else None, " ".join(rnd.choices(words, weights, k=rnd.randint(0, 60))) if i % 50 else None) for i in range(n)]
    rows += [(n + i, " ".join(["tie1 tie2 tie3"] * 3)) for i in range(3)]
    return spark.createDataFrame(rows, "doc_id long, clean_text string").repartition(tasks).cache(), rows


def test_candidates_hold_every_frequent_token(spark):
    df, rows = _texts(spark)
    counts = Counter(w for _, t in rows for w in (t or "").split())
    for k, counters in ((1, 30), (5, 80), (5, 1000), (500, 1000)):
        found = heavy.candidates(df, k, counters)
        top = counts.most_common()
        least = top[min(k, len(top)) - 1][1]
        assert {w for w, n in counts.items() if n >= least} <= {r["token"] for r in found.collect()}
        for r in found.collect():
            assert r["low"] <= counts[r["token"]]
    assert heavy.candidates(df, 200, 60) is None                    # too few counters to prove anything


@pytest.mark.parametrize("k,counters", [(1, 30), (10, 120), (12, 1000), (200, 60), (1000, 1000)])
def test_top_tokens_equal_the_exact_path(spark, k, counters):
    df, _ = _texts(spark)
    want = sorted(tuple(r) for r in V.top_of_texts(df, k).select("token", "cnt", "rank").collect())
    assert sorted(tuple(r) for r in heavy.top_of_texts(df, k, counters=counters).select("token", "cnt", "rank").collect()) == want


def test_summaries_ship_few_rows_and_nothing_for_empty(spark):
    df, _ = _texts(spark)
    assert heavy.summaries(df, 30).count() <= 6 * 31
    none = df.where("false")
    assert heavy.top_of_texts(none, 5).collect() == []


def test_one_pass_vocabulary_breaks_ties_by_place(spark):
    """Tokens with one count and one first document go by their place in it; null ids come first."""
    rows = [(2, "b a c"), (1, "z y x"), (1, "z"), (None, "n m"), (3, "b a c"), (4, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, clean_text string")
    for k in (1, 2, 3, 4, 5, 8, 20):
        got = [r["token"] for r in V.top_of_texts(df, k).orderBy("rank").collect()]
        assert got == ["z", "b", "a", "c", "n", "m", "y", "x"][:k]


# --- samples

def test_sample_is_the_same_whatever_the_parts(spark):
    df = spark.range(500).withColumn("v", F.col("id") * 2)
    whole = sorted(tuple(r) for r in D.bottom_k(df, 40, "id", seed=3).collect())
    assert len(whole) == 40
    parts = [D.bottom_k(df.where(F.col("id") % 3 == i).repartition(i + 1), 40, "id", seed=3) for i in range(3)]
    merged = D.merged_samples(parts[0].union(parts[1]).union(parts[2]), 40, "id")
    assert sorted(tuple(r) for r in merged.collect()) == whole
    assert whole != sorted(tuple(r) for r in D.bottom_k(df, 40, "id", seed=4).collect())


def test_sample_of_repeated_null_and_few_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "id long, sample_hash string")
    out = D.bottom_k(df, 10, "id").collect()
    assert Counter(r["id"] for r in out) == {1: 1, None: 1, 2: 1}
    assert D.bottom_k(df, 0, "id").collect() == []


def test_every_key_is_equally_likely(spark):
    """Over 200 seeds, each of 50 keys is drawn about 40 times in samples of ten."""
    df = spark.range(50)
    drawn = Counter()
    parts = [D.bottom_k(df, 10, "id", seed=s).select("id") for s in range(200)]
    out = parts[0]
    for p in parts[1:40]:
        out = out.union(p)
    drawn.update(r["id"] for r in out.collect())
    assert sum(drawn.values()) == 400 and max(drawn.values()) <= 22 and len(drawn) == 50


# --- length batches

def test_length_batches_are_full_and_tight(spark):
    rnd = random.Random(4)
    rows = [(i, [1] * int(rnd.expovariate(1 / 60))) for i in range(1500)] + [(None, None), (7, [])]
    df = spark.createDataFrame(rows, "k long, ids array<int>").repartition(5)
    out = V.length_batches(df, "k", batch_size=32, buckets=4).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["batch"], []).append(r)
        assert r["padded"][: len(r["ids"])] == r["ids"] and not any(r["padded"][len(r["ids"]):])
    assert sorted(by) == list(range(len(by)))
    last = {max(b for b, rs in by.items() if rs[0]["bucket"] == k) for k in {rs[0]["bucket"] for rs in by.values()}}
    for b, rs in by.items():
        assert len({r["bucket"] for r in rs}) == 1 and (len(rs) == 32 or b in last)
        assert {len(r["padded"]) for r in rs} == {max(len(r["ids"]) for r in rs)}
    assert sum(len(r["padded"]) for r in out) <= 1.2 * sum(len(r["ids"]) for r in out)
    assert V.length_batches(df.where("false"), "k").collect() == []


# --- VARIANT

def test_variant_counts_equal_text_counts(spark):
    texts = ['{"car": 1, "motorcycle": 2, "bus": 0, "truck": 7}', '{"car": 3}', "{}", "", None, "not json", "[1]", '{"car": null}', '{"car": 1, "x": 2}']
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("v", counts_variant("t"))
    rows = df.select(counts_of_variant("v").alias("a"), counts_from_json(F.col("t")).alias("b"), counts_map_of_variant("v").alias("m")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows]
    assert rows[0]["m"] == {"car": 1, "motorcycle": 2, "bus": 0, "truck": 7} and rows[4]["m"] is None and rows[5]["m"] is None
