"""Operators on pairs: shingle join, embedding duplicates, nearest neighbours, connected components."""

import random

import numpy as np
from pyspark.sql import functions as F

from aspectflow.llm import ann, dense_dups, jaccard
from aspectflow.llm import stored as S
from aspectflow.llm import vectors as V
from tests.llm.helpers import components, jaccard_components, shingles


def test_shingle_join_equals_all_pairs(spark, corpus):
    texts = {r.doc_id: r.text for r in corpus.where("doc_id is not null").collect()}
    expected, sizes = jaccard_components(texts)
    got = jaccard.joined(corpus.withColumn("component_id", F.lit(1)).withColumn("node", F.lit("x"))).collect()
    assert len(got) == corpus.count()
    for r in got:
        if r.doc_id is None:                              # a null id takes part and gets its group's smallest id
            assert r.component_id == expected[7]
        else:
            assert (r.n_shingles, r.component_id) == (sizes[r.doc_id], expected[r.doc_id])


def test_shingle_join_with_combinations_and_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 700)
    monkeypatch.setattr(jaccard, "CHUNK_TOKENS", 500)
    docs = corpus.where("doc_id is not null")
    expected, _ = jaccard_components({r.doc_id: r.text for r in docs.collect()})
    assert {r.doc_id: r.component_id for r in jaccard.joined(docs).collect()} == expected


def test_index_keys_meet_for_every_linked_pair(monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    rnd = random.Random(5)
    often = {t: rnd.choice([2, 2, 3, 4, 9]) for t in range(300)}
    for _ in range(400):
        a = set(rnd.sample(range(300), rnd.randint(2, 40)))
        b = set(a)
        for _ in range(rnd.randint(0, 4)):
            b.discard(rnd.choice(sorted(b)))
            b.add(rnd.randrange(300))
        if a == b or 100 * len(a & b) < 75 * len(a | b):
            continue

        def keys(s):
            t = np.array(sorted(s), np.uint64)
            return set(jaccard.index_keys(t, np.array([often[int(x)] for x in t]), len(s)).tolist())

        assert keys(a) & keys(b)


def test_shingles_of_odd_texts():
    import pyarrow as pa

    from aspectflow.llm.shingles import shingle_set, word_hashes
    texts = ["a b c d e f", "A B C D E F", "a b", "a b", "a\x0bb", "", None, "É é", "  a  b c\td\ne\x0cf ", "x" * 9]
    words, at = word_hashes(pa.array(texts))
    sets = [shingle_set(words[at[i]:at[i + 1]], 5) for i in range(len(texts))]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    same = {(i, j) for i in range(len(texts)) for j in range(len(texts)) if np.array_equal(sets[i], sets[j])}
    assert same == {(i, j) for i in range(len(texts)) for j in range(len(texts)) if shingles(texts[i]) == shingles(texts[j])}


def test_shingle_join_empty_and_repeated(spark, no_docs, corpus):
    assert jaccard.joined(no_docs).count() == 0
    twice = corpus.where("doc_id in (3, 4, 7, 8)")
    got = jaccard.joined(twice.union(twice)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted(2 * [(3, 3), (4, 3), (7, 7), (8, 7)])


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299)]
    links += [(rnd.randrange(400, 500), rnd.randrange(400, 500)) for _ in range(60)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = S.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == components(nodes, [x for x in links if x[0] != x[1]])
    assert S.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _vectors(spark):
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (1, 2, None):
        for _ in range(12):
            base = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 9))):
                rows.append((n, [float(v) for v in base + rng.normal(size=16) * 0.12], label))
                n += 1
    hot = rng.normal(size=16)
    for _ in range(60):
        rows.append((n, [float(v) for v in hot + rng.normal(size=16) * 0.02], 1))
        n += 1
    odd = [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [1.0, None] + [0.0] * 14, 1), (n + 3, [float("nan")] * 16, 1),
           (n + 4, [float("inf")] + [0.0] * 15, 1), (n + 5, [], 1), (n + 6, [2.0, 1.0], 1), (n + 7, [4.0, 2.0], 1), (n + 8, [2.0, 1.0], 2)]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int"), rows + odd


def _good(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def _all_pairs(rows, threshold):
    links = []
    for i, (a, x, la) in enumerate(rows):
        for b, y, lb in rows[i + 1:]:
            if la is not None and la == lb and _good(x) and _good(y) and len(x) == len(y):
                if np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links.append((a, b))
    return links


def test_embedding_duplicates_equal_all_pairs(spark, monkeypatch):
    df, rows = _vectors(spark)
    links = _all_pairs(rows, 0.98)
    assert len(links) > 1500
    comp = components([r[0] for r in rows], links)
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    got = dense_dups.near_duplicates(df.withColumn("cell", F.lit(1)).withColumn("n_links", F.lit(9))).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (degree[i], comp[i], comp[i] == i) for i in degree}
    assert len(got) == len(rows)
    assert dense_dups.near_duplicates(df.limit(0)).count() == 0


def test_blocks_count_every_pair_once(spark):
    df, rows = _vectors(spark)
    classes = spark.range(50).select(F.col("id").alias("vec_id"), F.lit(1).alias("k"))
    dealt = V.in_blocks(classes, "k", "vec_id", block_rows=9).collect()
    met = {}
    for r in dealt:
        met.setdefault((r._i, r._j), []).append(r)
    seen = {}
    for (i, j), group in met.items():
        for a in group:
            for b in group:
                if a.vec_id < b.vec_id and (a._blk != b._blk or V.counted_here(a._blk, i, j, a._nb)):
                    seen[(a.vec_id, b.vec_id)] = seen.get((a.vec_id, b.vec_id), 0) + 1
    assert seen == {(a, b): 1 for a in range(50) for b in range(a + 1, 50)}


def test_e8_points_are_near_and_in_the_lattice():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 8)) * 3
    points, dist = dense_dups.near_e8(x, 4)
    half = points % 2
    assert ((half.sum(2) == 0) | (half.sum(2) == 8)).all() and (points.sum(2) % 4 == 0).all()
    assert (dist[:, 0] <= 1 + 1e-9).all() and (np.diff(dist, axis=1) >= 0).all()      # covering radius 1
    assert np.allclose(((x[:, None, :] - points / 2) ** 2).sum(2), dist)


def test_search_finds_nearest(spark):
    df, rows = _vectors(spark)
    rows = [r for r in rows if _good(r[1]) and len(r[1]) == 16]
    got = ann.search(df.withColumn("rank", F.lit(0)), F.col("vec_id") % 10 == 0).collect()
    hit = total = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    for q, x, _ in rows:
        if q % 10:
            continue
        exact = sorted((float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum())), i) for i, y, _ in rows if i != q)
        mine = sorted(by[q], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        distance = {i: d for d, i in exact}
        assert all(abs(distance[r.vec_id] - r.score) < 1e-12 for r in mine)
        hit += len({r.vec_id for r in mine} & {i for _, i in exact[:10]})
        total += 10
    assert hit / total >= 0.9
    assert ann.search(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_search_falls_back_to_all_rows(spark):
    rows = [(i, [float(100 ** i), 1.0]) for i in range(6)] + [(20, [1.0, 2.0, 3.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 2 == 0, k=4).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert {q: len(v) for q, v in found.items()} == {0: 4, 2: 4, 4: 4}     # all but its own, of its length
    assert sorted(found[4]) == [(1, 3), (2, 2), (3, 1), (4, 0)]


def test_perturbations_come_in_order_of_their_score():
    at = np.array([0.1, 0.45, 0.8])
    sets = ann.perturbations(at, 12)
    cost = [sum(at[k] ** 2 if d < 0 else (1 - at[k]) ** 2 for k, d in s) for s in sets]
    assert sets[0] == () and cost == sorted(cost) and len(set(sets)) == 12
    assert all(len({k for k, _ in s}) == len(s) for s in sets)


def test_nearest_far_from_the_origin():
    """The rough screen must not lose neighbours where coordinates are much larger than distances."""
    import pandas as pd

    rng = np.random.default_rng(11)
    for offset in (0.0, 1e4, 1e7, 1e12):
        x = rng.normal(size=(500, 32)) + offset
        rows = pd.DataFrame({"vec_id": np.arange(500), "embedding": list(x)})
        queries = rows[:20].rename(columns={"vec_id": "query_id"})
        got = ann.nearest(queries, rows, 10)
        for i in range(20):
            d = np.sqrt(((x - x[i]) ** 2).sum(1))
            d[i] = np.inf
            want = np.lexsort((np.arange(500), d))[:10]
            part = got[got["query_id"] == i]
            assert part["vec_id"].tolist() == want.tolist() and part["score"].tolist() == d[want].tolist()


def test_duplicates_of_tiny_and_huge_vectors(spark):
    rows = []
    for k, size in enumerate((1e-300, 1e-170, 1.0, 1e200, 1e300)):
        rows += [(10 * k, [size, 2 * size, -size], 1), (10 * k + 1, [size, 2 * size, -size], 1), (10 * k + 2, [-size, size, size], 1)]
    got = {r.vec_id: r for r in dense_dups.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    same = [v for v in got if v % 10 < 2]              # one direction, whatever the length
    assert all(got[v].n_links == len(same) - 1 and got[v].component_id == 0 for v in same)
    assert all(got[v].n_links == 4 and got[v].component_id == 2 for v in got if v % 10 == 2)
