"""Multi-line CSV over many tasks, against Spark's one-task reader and Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql.types import IntegerType, StringType, StructType

from aspectflow.sources import csv_split as C
from aspectflow.sources import io as IO

SCHEMA = StructType().add("text", StringType()).add("a", IntegerType()).add("b", StringType())


@pytest.fixture()
def small_splits(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def _write(path, rows, end="\n", blank=0, last=True):
    text = io.StringIO()
    w = csv.writer(text, lineterminator=end)
    w.writerow(["text", "a", "b"])
    for i, r in enumerate(rows):
        w.writerow(r)
        if blank and i % blank == 0:
            text.write(end)
    body = text.getvalue()
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(body if last else body[: -len(end)])


def _random_rows(seed, n):
    rnd = random.Random(seed)
    parts = ['"', '""', "\n", ",", "x", "ấ", " ", "\r\n", "\n\n", '",', ',"', "word word word"]
    return [("t" + "".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 5, 40]))), rnd.randint(0, 9), f"k{i}") for i in range(n)]


@pytest.mark.parametrize("end,blank,last", [("\n", 0, True), ("\n", 3, False), ("\r\n", 0, True), ("\r\n", 2, False)])
def test_records_equal_the_one_task_reader(spark, scratch, small_splits, end, blank, last):
    rows = _random_rows(hash(end) % 7 + blank, 150)
    _write(f"{scratch}/f.csv", rows, end, blank, last)
    got = C.read_split_csv(spark, f"{scratch}/f.csv", SCHEMA).orderBy("row_id").collect()
    whole = (spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(f"{scratch}/f.csv")).collect()
    assert [r["row_id"] for r in got] == list(range(len(rows)))
    assert [tuple(r)[:3] for r in got] == rows
    # Spark's reader turns line ends inside fields into the file's own
    assert [(r["text"].replace("\r\n", "\n"), r["a"], r["b"]) for r in got] == [(r["text"].replace("\r\n", "\n"), r["a"], r["b"]) for r in whole]
    assert C._lines(spark, f"{scratch}/f.csv").rdd.getNumPartitions() > 10


def test_many_files_and_splits_inside_one_field(spark, scratch, small_splits):
    import os

    os.makedirs(f"{scratch}/d")
    long = "line one, with \"quotes\"\n" * 400                 # dozens of splits inside one field
    all_rows = []
    for name, rows in (("b.csv", [(long, 1, "x"), ("y", 2, "z")]), ("a.csv", _random_rows(4, 30)), ("c.csv", []), ("d.csv", [("p\nq", 3, None)])):
        _write(f"{scratch}/d/{name}", rows)
    for name in ("a.csv", "b.csv", "d.csv"):
        all_rows += [(name, r) for r in ({"a.csv": _random_rows(4, 30), "b.csv": [(long, 1, "x"), ("y", 2, "z")], "d.csv": [("p\nq", 3, None)]}[name])]
    got = C.read_split_csv(spark, f"{scratch}/d", SCHEMA).orderBy("row_id").collect()
    assert [tuple(r) for r in got] == [(*r, i) for i, (_, r) in enumerate(all_rows)]
    open(f"{scratch}/empty.csv", "w").close()
    assert C.read_split_csv(spark, f"{scratch}/empty.csv", SCHEMA).count() == 0


def test_state_after_a_line():
    import pyarrow as pa

    lines = ['a,b', '"a', '"a""', '"a"""', 'x,"y', 'x,"y"', '"a","b', 'a"b', '""', '"",""', '","', 'end",3', 'end"",3', '', 'a""b,"c""']
    out, inside = C.line_ends(pa.array(lines))
    assert out.tolist() == [0, 1, 1, 0, 1, 0, 1, 0, 0, 0, 0, 0, 0, 0, 1]
    assert [inside.tolist()[i] for i in (0, 10, 11, 12, 13)] == [1, 1, 0, 1, 1]


def test_labelled_reader_over_many_tasks(spark, scratch, small_splits):
    from aspectflow.schemas import ASPECTS

    rnd = random.Random(2)
    rows = [[f'review "{i}"\nsecond line, {i}' if i % 2 else f"plain {i}", *[rnd.randint(-1, 2) for _ in ASPECTS]] for i in range(80)]
    with open(f"{scratch}/train.csv", "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f)
        w.writerow(["Review", *ASPECTS])
        w.writerows(rows)
    a = IO.read_labelled_csv(spark, f"{scratch}/train.csv").orderBy("row_id").collect()
    b = IO.read_labelled_csv(spark, f"{scratch}/train.csv", parallel=False).orderBy("row_id").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b] and [r["Review"] for r in a] == [r[0].replace("\n", "\n") for r in rows]
    assert sorted(r["Review"] for r in IO.read_review_csv(spark, f"{scratch}/train.csv").collect()) == sorted(r[0] for r in rows)
