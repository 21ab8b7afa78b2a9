"""Tables stored as folders, and work that must not grow faster than the input."""

import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from aspectflow.functions.batches import pieces
from aspectflow.ml import epochs as E
from aspectflow.ml import heads as L
from aspectflow.operators import heavy as H
from aspectflow.operators import vocab as V
from aspectflow.plans import ml_queries as M
from aspectflow.plans import queries as Q
from aspectflow.plans.streams import REPLAY_BATCHES, STREAM_QUERIES


def _folder_copy(spark, sf, d, tables, n):
    """``sf`` with some tables as folders of ``n`` files, the others as the files they are."""
    os.makedirs(d)
    for f in os.listdir(sf):
        if f.removesuffix(".parquet") in tables:
            spark.read.parquet(f"{sf}/{f}").repartition(n).write.parquet(f"{d}/{f}")
        else:
            os.symlink(f"{sf}/{f}", f"{d}/{f}")
    return d


@pytest.mark.parametrize("name,table", [("stream_reviews", "documents"), ("stream_frames", "orders")])
def test_streams_replay_tables_that_are_folders(spark, scratch, sf001, name, table):
    d = _folder_copy(spark, sf001, f"{scratch}/in", [table], REPLAY_BATCHES + 3)
    of_files, of_folders = (STREAM_QUERIES[name](spark, x) for x in (sf001, d))
    assert of_folders.count() == of_files.count() > 0
    assert of_folders.exceptAll(of_files).count() == 0


def test_a_file_beside_folders_is_replayed(spark, scratch, sf001):
    d = _folder_copy(spark, sf001, f"{scratch}/in", ["documents", "labels"], 2)
    assert STREAM_QUERIES["stream_frames"](spark, d).exceptAll(STREAM_QUERIES["stream_frames"](spark, sf001)).count() == 0


def test_pieces_are_whole_and_bounded():
    texts = ["ab" * 300, None, "", "x" * 5000, "yz"] * 40
    batch = pa.RecordBatch.from_pydict({"id": range(200), "text": texts, "ids": [list(range(len(t or ""))) for t in texts]})
    for column, each in (("text", 1), ("ids", 4)):
        cut = list(pieces(batch, column, 1500))
        assert pa.Table.from_batches(cut).equals(pa.Table.from_batches([batch]))
        assert all(p.num_rows == 1 or sum(each * len(v or "") for v in p[column].to_pylist()) <= 1500 for p in cut)
    assert [p.num_rows for p in pieces(batch.slice(0, 0), "text")] == [0]


def _largest_piece(kernel, column, n=8000, length=2000):
    """Bytes of Arrow memory that ``kernel`` holds at most over one batch of long texts, beside the batch itself."""
    text = " ".join(f"w{i % 50}" for i in range(length // 4))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), column: [text] * n})
    pool, was, most = pa.default_memory_pool(), pa.total_allocated_bytes(), 0
    for out in kernel(iter([batch])):
        most = max(most, pool.bytes_allocated() - was, out.nbytes)
        assert out.num_rows < n
    return most, batch.nbytes


def test_kernels_take_a_batch_in_pieces():
    class Table:
        value = pa.array([f"w{i}" for i in range(50)]), pa.array(range(2, 52), pa.int32())

    for kernel in (V._re2_whitelist("text", ["doc_id"]), V._arrow_encoder(Table, "text", "ids", ["doc_id"])):
        most, given = _largest_piece(kernel, "text")
        assert most < given


def test_summaries_reduce_inside_a_batch(spark):
    docs = spark.createDataFrame([(i, " ".join(f"t{i}x{j}" for j in range(600)) + " common") for i in range(300)], "doc_id long, clean_text string")
    got = H.top_of_texts(docs, 1, counters=2).select("token", "cnt").collect()
    assert [(r.token, r.cnt) for r in got] == [("common", 300)]


def test_losses_take_a_batch_in_pieces(spark):
    class Taken(Exception):
        pass

    class Rows:
        sparkSession = spark          # noqa: N815 - name of the interface

        def select(self, *_):
            return self

        def mapInArrow(self, f, _):   # noqa: N802
            raise Taken(f)

    with pytest.raises(Taken) as taken:
        E.judged(Rows(), E.LinearHeads.zeros([f"w{i}" for i in range(100)], ["a"]))
    n, each = 2000, 2000
    ids = pa.ListArray.from_arrays(pa.array(range(0, n * each + 1, each), pa.int32()), pa.array(np.tile(np.arange(2, 102, dtype=np.int32), n * each // 100)))
    batch = pa.RecordBatch.from_arrays([ids, pa.array([[1]] * n, pa.list_(pa.int32())), pa.array([1.0 / n] * n)], names=["ids", "labels", "weight"])
    tracemalloc.start()
    (out,) = taken.value.args[0](iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < batch.nbytes
    assert out["cnt"].to_pylist() == [n, n] and abs(out["loss"][-1].as_py() - np.log(4)) < 1e-12


def test_csv_is_written_in_files_of_bounded_size(spark, sf001, monkeypatch):
    whole = Q.q_csv_splits(spark, sf001).collect()
    monkeypatch.setattr(Q, "CSV_FILE_BYTES", 40 << 10)
    written = []
    read = Q.read_split_csv
    monkeypatch.setattr(Q, "read_split_csv", lambda s, path, schema: (written.append(s.read.text(path).inputFiles()), read(s, path, schema))[1])
    assert sorted(Q.q_csv_splits(spark, sf001).collect()) == sorted(whole)
    assert len(written[0]) > 3


def test_partitions_of_features_grow_with_the_tokens(spark, monkeypatch):
    docs = spark.range(4000, numPartitions=40).selectExpr("id", "cast(id % 2 as int) as a", "concat(repeat('x ', 50), 'w', id % 2) as clean_text")
    vocab = spark.createDataFrame([("x", 2), ("w0", 3), ("w1", 4)], "token string, id int")
    asked = []
    fit = L.LogisticRegression.fit
    monkeypatch.setattr(L.LogisticRegression, "fit", lambda self, data: (asked.append((data.rdd.getNumPartitions(), data.columns)), fit(self, data))[1])
    for most, n in ((10_000_000, 4), (20_000, 11)):
        monkeypatch.setattr(L, "PARTITION_TOKENS", most)
        L.train_heads(docs, vocab, ["a"], "clean_text", cleaned=True, max_iter=2, partitions=4)
        assert asked[-1][0] == n and not {"clean_text", L.TOKENS} & set(asked[-1][1])


def test_scored_reviews_keep_three_batches_of_more_files(spark, sf001, monkeypatch):
    asked, replay = [], M.replay_source
    monkeypatch.setattr(M, "SOURCE_BYTES", 20 << 10)
    monkeypatch.setattr(M, "replay_source", lambda *a, **k: (asked.append(k["max_files_per_trigger"]), replay(*a, **k))[1])
    (row,) = M.q_stream_scored(spark, sf001).collect()
    assert (row.n_batches, row.n_differ) == (3, 0) and row.n_rows == spark.read.parquet(f"{sf001}/documents.parquet").where("text is not null").count()
    assert asked[0] > 2
