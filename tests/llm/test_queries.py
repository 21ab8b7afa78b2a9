"""Registered queries on whole tables: against their SQL, or a plain version."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from aspectflow.llm import queries, tokens
from tests.conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"


def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, con, name):
    sql = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in sql.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(sql.fetchall())


def test_op4_query(spark, docs):
    rows = queries.op4_hypergeometric_shards(spark, SF).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(24)) and max(sizes.values()) - min(sizes[s] for s in range(24)) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r["shard"] == s) == list(range(n))


def test_op7_query(spark, docs):
    rows = sorted(queries.op7_wavelet_files(spark, SF).collect(), key=lambda r: r.doc_id)
    theirs, at = _tokenizer(), 0
    assert [r.doc_id for r in rows] == [i for i, _ in docs]
    for r, (_, text) in zip(rows, docs):
        ids = np.array(theirs.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_op8_query(spark, con):
    vectors = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], np.float64)
    rows = queries.op8_multiprobe_search(spark, SF).collect()
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        want = [ids[k] for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        assert [r["rank"] for r in mine] == list(range(1, len(want) + 1))
        assert all(abs(r.score - d[ids == r.vec_id][0]) < 1e-12 for r in mine) and [r.score for r in mine] == sorted(r.score for r in mine)
        hits, total = hits + len(set(want) & {r.vec_id for r in mine}), total + len(want)
    assert total and hits >= 0.9 * total


def test_op10_query(spark, docs):
    theirs, want = _tokenizer(), Counter()
    for i, text in docs:
        ids = np.array(theirs.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, s in enumerate(range(0, len(ids), 2048)):
            want[(i, piece, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes()))] += 1
    rows = queries.op10_best_fit_pack(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    fill = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= 1.02 * sum(fill.values()) / 2048 + 1
