"""The sink with commits: failed writes stay unseen, replays count once, files are bounded."""

import os

import pytest
from pyspark.sql import functions as F

from aspectflow.sources import committed as C
from aspectflow.streaming import pipelines as P

NOW = {"availableNow": True}


def _source(spark, scratch, parts):
    for i, (lo, hi) in enumerate(parts):
        spark.range(lo, hi).withColumn("cam", F.concat(F.lit("c"), F.col("id") % 3)).repartition(4).write.mode("append").parquet(f"{scratch}/s{i}")
    return spark.read.parquet(f"{scratch}/s0").schema


def _ids(spark, scratch, schema):
    return sorted(r["id"] for r in C.read_committed(spark, f"{scratch}/t", schema).collect())


def test_batches_are_whole_files_bounded_and_compacted(spark, scratch):
    schema = _source(spark, scratch, [(0, 40)])
    assert _ids(spark, scratch, schema) == []
    source = P.replay_source(spark, f"{scratch}/s0", schema, max_files_per_trigger=2)
    P.drain(C.write_committed(source, f"{scratch}/t", f"{scratch}/ck", 2, "cam", NOW))
    commits = C.manifests(f"{scratch}/t")
    assert len(commits) == 2 and all(len(m["files"]) <= 2 for m in commits.values()) and sum(m["rows"] for m in commits.values()) == 40
    assert _ids(spark, scratch, schema) == list(range(40))
    assert not [n for n in os.listdir(f"{scratch}/t/data") if "=" in n]              # no folder per source or batch
    P.drain(C.write_committed(source, f"{scratch}/t", f"{scratch}/ck", 2, "cam", NOW))     # nothing new: no empty batch
    assert C.compact(spark, f"{scratch}/t", schema, 1, "cam") == 2
    assert len(C.manifests(f"{scratch}/t")) == 1 and _ids(spark, scratch, schema) == list(range(40))
    files = sum(len(m["files"]) for m in commits.values())
    assert C.vacuum(f"{scratch}/t") == files and _ids(spark, scratch, schema) == list(range(40))
    assert C.compact(spark, f"{scratch}/none", schema, 1) == 0


def test_failed_write_is_never_seen_and_its_replay_counts_once(spark, scratch):
    schema = _source(spark, scratch, [(0, 40)])
    flag = f"{scratch}/fail"
    open(flag, "w").close()

    @F.udf("long")
    def sometimes(i):                    # one task of the second batch dies while others have written their files
        if i == 25 and os.path.exists(flag):
            raise RuntimeError("killed")
        return i

    def start():
        source = P.replay_source(spark, f"{scratch}/s0", schema, max_files_per_trigger=1)
        return C.write_committed(source.withColumn("id", sometimes("id")), f"{scratch}/t", f"{scratch}/ck", 2, None, NOW)

    with pytest.raises(Exception, match="killed"):
        P.drain(start())
    seen = _ids(spark, scratch, schema)
    assert 25 not in seen and len(seen) == sum(m["rows"] for m in C.manifests(f"{scratch}/t").values()) < 40
    os.remove(flag)
    P.drain(start())
    assert _ids(spark, scratch, schema) == list(range(40))
    data = [n for n in os.listdir(f"{scratch}/t/data") if n.endswith(".parquet")]
    listed = {f for m in C.manifests(f"{scratch}/t").values() for f in m["files"]}
    assert C.vacuum(f"{scratch}/t") == len(data) - len(listed) and _ids(spark, scratch, schema) == list(range(40))


def test_two_streams_share_a_table(spark, scratch):
    schema = _source(spark, scratch, [(0, 10), (10, 30)])
    for i in range(2):
        P.drain(C.write_committed(P.replay_source(spark, f"{scratch}/s{i}", schema), f"{scratch}/t", f"{scratch}/ck{i}", 1, "cam", NOW))
    assert _ids(spark, scratch, schema) == list(range(30))


def test_data_without_a_manifest_is_no_row(spark, scratch):
    """A writer killed between its files and its commit."""
    schema = _source(spark, scratch, [(0, 10)])
    P.drain(C.write_committed(P.replay_source(spark, f"{scratch}/s0", schema, max_files_per_trigger=None), f"{scratch}/t", f"{scratch}/ck", 1, None, NOW))
    name = next(iter(C.manifests(f"{scratch}/t").values()))["files"][0]
    with open(f"{scratch}/t/data/{name}", "rb") as a, open(f"{scratch}/t/data/orphan.parquet", "wb") as b:
        b.write(a.read())
    assert _ids(spark, scratch, schema) == list(range(10))
