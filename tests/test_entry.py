import __spark_entry__ as E

OPTIONAL = {k for k in E.queries() if k.startswith("op") or k == "pipeline"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 24 and df.columns == ["Aspect", "Sentiment", "Count"]


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - OPTIONAL == set(o) - OPTIONAL


def test_small_queries_run_on_smoke_tables(spark, sf001):
    for name in ["aspect_labels", "frame_counts", "early_stop", "val_loss", "promotion"]:
        rows = {"aspect_labels": "embeddings", "frame_counts": "orders"}.get(name)
        n = E.queries()[name](spark, sf001).count()
        assert n == spark.read.parquet(f"{sf001}/{rows}.parquet").count() if rows else n >= 1


def test_default_driver_memory_is_bounded():
    from aspectflow.session import default_driver_memory
    gb = int(default_driver_memory()[:-1])
    assert 1 <= gb <= 16
