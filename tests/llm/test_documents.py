"""Operators on documents and conversations against brute force, round trips and held-out accuracy."""

import hashlib
import math
import os
import subprocess
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aspectflow.llm import chat, langid, mixing, packing, quality, queries, sharding, token_files, tokens
from aspectflow.llm.stored import stored
from tests.conftest import TESTDATA
from tests.llm.helpers import kneser_ney


def _tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.vocabulary_path())


# --- 1: quality

def _symbols(text):
    out = [c + 32 if 65 <= c <= 90 else 32 if c in (0, 9, 10, 11, 12, 13) else c for c in (text or "").encode()]
    return out + [32]


def _quality_tables(spark):
    rows = [(i, ("the cat sat on the mat " * (1 + i % 3)) + str(i), "en") for i in range(150)]
    rows += [(200 + i, f"la casa de {i % 5} la luna", "es") for i in range(15)]
    rows += [(300, "ZX!! QK## VV%%", "en"), (301, None, "en"), (302, "", None), (303, "sat on the cat", None), (304, "é\x00É", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 140)] + [(200 + i, 1, None) for i in range(9)]
                                   + [(300, 0, 0), (145, 1, 1), (None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize("table_bytes", [1 << 26, 0])
def test_perplexity_equals_brute_force_on_both_paths(spark, table_bytes):
    docs, labels = _quality_tables(spark)
    got = quality.judged(docs.withColumn("gram", F.lit(1)), labels, table_bytes=table_bytes).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_id = {r.doc_id: r for r in got}
    p = kneser_ney([_symbols(texts[i]) for i, r in by_id.items() if r.trusted], quality.ORDER)
    for i, r in by_id.items():
        if not texts[i]:
            assert r.log_perplexity is None and not r.kept
            continue
        padded = [0] * (quality.ORDER - 1) + _symbols(texts[i])
        grams = [tuple(padded[k:k + quality.ORDER]) for k in range(len(padded) - quality.ORDER + 1)]
        assert r.log_perplexity == pytest.approx(-sum(math.log(p(g)) for g in grams) / len(grams), rel=1e-9)
    assert not by_id[300].kept and by_id[303].kept and by_id[145].kept
    assert {i for i, r in by_id.items() if r.trusted or r.calibrating} == {*range(140), *range(200, 209)}


@pytest.mark.parametrize("table_bytes", [1 << 26, 0])
def test_quality_in_many_shards(spark, monkeypatch, table_bytes):
    """Many shards, some of them without trusted text, give the same perplexities."""
    docs, labels = _quality_tables(spark)
    def by_id():
        return {r.doc_id: -1.0 if r.log_perplexity is None else r.log_perplexity
                for r in quality.judged(docs, labels, table_bytes=table_bytes).collect()}

    whole = by_id()
    monkeypatch.setattr(quality, "SHARD_BYTES", 100)
    assert by_id() == pytest.approx(whole, rel=1e-12)


def test_quality_stores_less_than_the_texts(spark, monkeypatch):
    """Disk: what is stored stays below the size of the texts."""
    sf, written = f"{TESTDATA}/sf0.01", {}

    def kept(df, name):
        out = stored(df, name)
        written[name] = sum(os.path.getsize(f.removeprefix("file:").replace("//", "/")) for f in out.inputFiles())
        return out

    monkeypatch.setattr(quality, "stored", kept)
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    assert quality.judged(docs, labels, table_bytes=0).count() == docs.count()
    text = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert sum(written.values()) < text, written


def test_grams_are_added_up_piece_by_piece(monkeypatch):
    texts = pa.table({"text": [f"the cat {i % 7} sat on the mat {i}" for i in range(300)] + [None, "", "é\x00É"]})

    def model():
        parts = pa.Table.from_batches(b for b in quality._counted(1)(iter(texts.to_batches(max_chunksize=20))))
        return len(parts), quality._orders(parts)

    (once, whole), _ = model(), monkeypatch.setattr(quality, "HELD_GRAMS", 200)
    monkeypatch.setattr("aspectflow.llm.shingles.BATCH_BYTES", 500)
    often, pieces = model()
    assert once == 1 and often > 3 and pieces.equals(whole)


def test_adding_up_grams_gives_up_what_it_was_given():
    """Memory: the counts given are not held beside their sorted copies."""
    import tracemalloc

    rng = np.random.default_rng(1)
    tracemalloc.start()
    try:
        held = [(rng.integers(0, 1 << 62, 1 << 18, dtype=np.uint64), np.ones(1 << 18, np.uint64)) for _ in range(4)]
        given = tracemalloc.get_traced_memory()[0]
        keys, n = quality._added(held)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(keys) == n.sum() == 1 << 20 and (keys[1:] > keys[:-1]).all()
    assert most < 3.4 * given, most / given


def test_quality_sends_small_arrow_batches(spark, monkeypatch):
    """Memory: neither the executor nor its Python holds 64 MB of text a task; the session's own limit is back afterwards."""
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}

    def kept(df, name):
        seen[name] = spark.conf.get(key)
        return stored(df, name)

    monkeypatch.setattr(quality, "stored", kept)
    before = spark.conf.get(key)
    quality.judged(*_quality_tables(spark)).count()
    assert int(seen["kneser_ney"]) == int(seen["perplexities"]) == 1 << 20
    assert spark.conf.get(key) == before


def test_distinct_grams_are_gathered_in_one_buffer(monkeypatch):
    monkeypatch.setattr(quality, "HELD_GRAMS", 50)
    rng, held, parts = np.random.default_rng(3), quality._Distinct(), []
    for size in (0, 1, 7, 99, 300, 1000, 5, 1000, 64):
        parts.append(rng.integers(0, 1500, size, dtype=np.uint64) << np.uint64(50))
        held.add(parts[-1])
    assert held.taken().tolist() == sorted({int(x) for part in parts for x in part})
    assert held.taken().tolist() == [] and len(held.x) == 100


def test_one_order_of_a_shard_is_unpacked_at_a_time(monkeypatch):
    import weakref

    parts = pa.Table.from_batches(quality._counted(1)(iter(pa.table({"text": ["the cat sat on the mat"] * 3}).to_batches())))
    rows, alive, most = quality._orders(parts).to_pylist(), [], []
    made = quality._order_table

    def table(*args):
        out = made(*args)
        most.append(sum(r() is not None for r in alive))
        alive.append(weakref.ref(out[1]))
        return out

    monkeypatch.setattr(quality, "_order_table", table)
    of = {k: (0.5, 1.0, 1.5) for k in range(1, quality.ORDER + 1)}
    grams = np.unique(quality.text_grams(pa.array(["the cat"]))[0].view(np.uint64))
    for _, tables in quality._shard_tables(iter(rows), of):
        assert (quality.probabilities(grams, tables) > 0).all()
    assert len(most) == quality.ORDER - quality.LOW and max(most) == 0


def test_kernels_give_freed_memory_back():
    """Memory: what a kernel has freed does not stay with the Python worker, which later stages find beside their own."""
    code = """if True:
        import numpy as np, pyarrow as pa
        from aspectflow.llm import jaccard, langid, packing, quality

        def resident():
            return int(open("/proc/self/statm").read().split()[1]) * 4096

        def batches():                        # small arrays between others that stay until the end: the heap can't shrink by itself
            x = np.ones(31 << 17); del x      # malloc now takes what is below that size from its heap
            held = [np.ones(1 << 16) for _ in range(200)]
            kept.extend(held[::20])
            del held
            yield pa.RecordBatch.from_pydict({"text": ["the cat sat on the mat"]})

        kept = []
        before = resident()
        for batch in quality._counted(1)(batches()):
            pass
        print(resident() - before)

        from aspectflow.functions import batches as b
        calls, b.give_back = [], lambda: calls.append(1)
        assert [*b.giving_back(iter)(iter(range(40)))] == [*range(40)] and len(calls) == 3
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert int(out) < 50 << 20, out           # 100 MB were freed


def test_packing_and_linking_send_small_arrow_batches(spark, monkeypatch):
    from aspectflow.llm import jaccard

    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}

    def kept(df, name):
        seen[name] = spark.conf.get(key)
        return stored(df, name)

    monkeypatch.setattr(jaccard, "stored", kept)
    monkeypatch.setattr(packing, "stored", kept)
    docs, before = _quality_tables(spark)[0], spark.conf.get(key)
    assert jaccard.joined(docs).count() == docs.count() and packing.packed(docs).count() == docs.count()
    assert [int(seen[x]) for x in ("shingle_index", "components", "pieces")] == [1 << 20, 1 << 20, 512 << 10] and spark.conf.get(key) == before


def test_packed_numbers_come_back():
    for x in ([], [0], [1, 5, 5, 2 ** 63, 2 ** 64 - 1]):
        x = np.array(x, dtype=np.uint64)
        assert quality.unpacked(quality.packed(x), len(x)).tolist() == x.tolist()


def test_kneser_ney_sums_to_one():
    p = kneser_ney([[1, 2, 3, 1, 2, 4, 1, 2, 3], [2, 2, 1, 3, 3]], 3)
    for context in ((1, 2), (2, 1), (9, 9), (0, 0)):
        assert sum(p((*context, s)) for s in range(256)) == pytest.approx(1)


def test_quality_without_labels_keeps_texts(spark, no_docs):
    docs, labels = _quality_tables(spark)
    got = quality.judged(docs, labels.limit(0)).collect()
    assert all(r.kept == bool(r.log_perplexity is not None) for r in got) and sum(r.kept for r in got) == docs.count() - 2
    assert quality.judged(no_docs, labels).count() == 0


def test_limit_is_the_quantile_itself(spark):
    scores = spark.createDataFrame([(i, i, "en", False, True, float(i)) for i in range(1, 101)]
                                   + [(200, 200, "en", False, False, 500.0)], f"{quality.KEYS}, log_perplexity double")
    assert [(r._lang, r.highest) for r in quality.limits(scores).collect()] == [("en", 99.0)]


def test_copies_of_one_trusted_text_set_no_limit(spark):
    rows = [(i, i, "en", False, True, float(i)) for i in range(1, 101)]
    rows += [(200 + i, 777, "xx", False, True, 2.0) for i in range(10)] + [(300, 300, "xx", False, False, 3.0)]
    scores = spark.createDataFrame(rows, f"{quality.KEYS}, log_perplexity double")
    got = {r._lang: r.highest for r in quality.limits(scores).collect()}
    assert got["en"] == 99.0 and got["xx"] > 99.0
    few = scores.where("lang = 'xx'")
    assert [r.highest for r in quality.limits(few).collect()] == [None]


def test_model_grows_with_the_corpus():
    def distinct(sf):
        texts = duckdb.sql(f"SELECT text FROM '{TESTDATA}/{sf}/documents.parquet'").to_arrow_table()["text"].combine_chunks()
        return len(np.unique(quality.text_grams(texts)[0]))

    assert distinct("sf0.1") > 3 * distinct("sf0.01")      # 10 x the text


def test_quality_rates_on_labelled_documents(spark):
    sf = f"{TESTDATA}/sf0.1"
    kept = {r.doc_id: r.kept for r in queries.op1_kneser_ney_quality(spark, sf).select("doc_id", "kept").collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    bad = [kept[r.doc_id] for r in labels.where("quality = 0").collect()]
    good = [kept[r.doc_id] for r in labels.where("quality = 1 and coalesce(toxic, 0) = 0").collect()]
    assert sum(bad) <= 0.25 * len(bad) and sum(good) >= 0.99 * len(good)


# --- 2: mixing

def test_mix_rates_and_counts(spark, corpus):
    docs = corpus.withColumn("rate", F.lit("clash")).withColumn("copies", F.lit(0)).withColumn("_source", F.lit("x"))
    rates = {r.source: r for r in mixing.source_rates(corpus).collect()}
    assert len(rates) == corpus.select("source").distinct().count() and None in rates
    total = sum(r.n_bytes for r in rates.values())
    assert sum(r.rate * r.n_bytes for r in rates.values()) == pytest.approx(total)
    for r in rates.values():
        assert r.rate * r.n_bytes / total == pytest.approx(r.weight)
    got = mixing.mixed(docs).collect()
    per = Counter((r.doc_id, r.text) for r in got)
    for r in got:
        u = int(hashlib.md5(f"7/{'~' if r.doc_id is None else r.doc_id}/{hashlib.md5((r.text or '').encode()).hexdigest()}"
                            .encode()).hexdigest()[:13], 16) / 2 ** 52
        k, p, c = 0, math.exp(-r.rate), math.exp(-r.rate)
        while c <= u:
            k += 1
            p *= r.rate / k
            c += p
        assert r.copies == k == per[(r.doc_id, r.text)] and 0 <= r.copy_no < k


def test_mix_given_weights_large_rates_and_empty(spark, no_docs):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"),
                                    F.when(F.col("id") < 100, "rare").when(F.col("id") < 110, "none").otherwise("hot").alias("source"))
    got = mixing.mixed(docs, weights={"rare": 0.5, "hot": 0.5}).groupBy("source").agg(F.count("*").alias("n"), F.max("rate").alias("rate"))
    by = {r.source: r for r in got.collect()}
    assert set(by) == {"rare", "hot"} and by["rare"].rate == pytest.approx(20)
    assert abs(by["rare"].n - 2000) < 5 * 2000 ** 0.5 and abs(by["hot"].n - 2000) < 5 * 2000 ** 0.5
    assert mixing.mixed(no_docs).count() == 0
    large = mixing.mixed(docs, weights={"none": 1.0}, epochs=10.0).groupBy("source").agg(F.count("*").alias("n"), F.max("rate").alias("rate")).collect()
    assert [(r.source, r.rate) for r in large] == [("none", pytest.approx(4000))] and abs(large[0].n - 40_000) < 5 * 200


def test_mix_spreads_unlike_rows_of_one_id(spark):
    docs = spark.range(2000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"),
                                    F.lit("s").alias("source"))
    nulls = mixing.mixed(docs).where("doc_id is null")
    n = nulls.count()
    assert n > 400 and nulls.select("mix_key").distinct().count() == n        # a third of all rows, no two on one key


def test_mix_of_a_short_document_beside_a_large_rest_equals_sql(spark, scratch):
    rows = [(0, "x", "tiny"), (1, "yz", None)] + [(i, "abcde " * 200_000, f"s{i % 3}") for i in range(2, 11)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{scratch}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{scratch}/documents.parquet/*.parquet'")
    sql = con.execute(queries.ORACLE_SQL["op2_poisson_mix"])
    names = [c[0] for c in sql.description]
    got = queries.op2_poisson_mix(spark, scratch).select(*names).collect()
    rates = {r.source: r.rate for r in got}
    assert rates["tiny"] > 1500 and rates[None] > 1000
    assert sorted(map(tuple, got), key=repr) == sorted(sql.fetchall(), key=repr)


# --- 4: sharding

def test_shards_are_exact_gapless_and_whole(spark, corpus):
    docs = (corpus.union(corpus.where("doc_id in (0, 1, 7)")).withColumn("shard", F.lit("x"))
            .withColumn("_h", F.lit(1)).withColumn("_rank", F.lit("r")).withColumn("a b.c", F.lit(2)))
    out = sharding.sharded(docs, shards=7, rows_per_lot=16)
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in docs.collect())
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(v) for v in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = sharding.sharded(docs.repartition(3), shards=7, rows_per_lot=16).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in got} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_communication_beyond_numpys_bound():
    lots = [700_000_000, 5, 0, 900_000_000, 1_400_000_000]
    m = sharding.communication_matrix(lots, 7, 1)
    assert m.sum(1).tolist() == lots and m.min() >= 0
    assert m.sum(0).max() - m.sum(0).min() <= 1 and m.sum() == sum(lots)
    mean = 900_000_000 / 7
    assert np.abs(m[3] - mean).max() < 6 * mean ** 0.5
    rng = np.random.default_rng(4)
    for good, bad, n in ((3, 2, 4), (50, 20, 30), (1, 0, 1), (10, 1000, 7)):        # the same distribution as numpy's
        mine = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(20000)])
        theirs = rng.hypergeometric(good, bad, n, 20000)
        assert abs(mine.mean() - theirs.mean()) < 5 * (theirs.std() / 100 + 1e-9) and abs(mine.std() - theirs.std()) < 0.05 * theirs.std() + 1e-9
        assert mine.min() >= max(0, n - bad) and mine.max() <= min(good, n)


def test_more_shards_than_rows_and_none(spark, no_docs):
    got = sharding.sharded(spark.range(3), shards=10).collect()
    assert len({r.shard for r in got}) == 3 and {r.slot for r in got} == {0}
    assert sharding.sharded(no_docs).count() == 0


def test_communication_matrix_has_exact_margins():
    m = sharding.communication_matrix([5, 0, 17, 3, 100], 4, seed=1)
    assert m.sum(1).tolist() == [5, 0, 17, 3, 100] and sorted(m.sum(0).tolist()) == [31, 31, 31, 32]
    mean = np.mean([sharding.communication_matrix([10, 30], 4, seed=s)[0] for s in range(2000)], axis=0)
    assert np.allclose(mean, 2.5, atol=0.15)


# --- 5: languages

def test_language_codes_on_held_out_documents(spark, sf001):
    got = queries.op5_language_codes(spark, sf001).join(
        spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 200 and {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_texts(spark, corpus, no_docs):
    train = spark.createDataFrame([("der hund und die katze sind im haus", "de"), ("the dog and the cat are in the house", "en"),
                                   (None, "en"), ("lost", None)] * 5, "text string, lang string")
    model = langid.fit(train)
    assert model.languages == ("de", "en")
    got = {r.doc_id: r for r in langid.identified(corpus.withColumn("score", F.lit("clash")), model).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == got[6].lang_pred == "und"
    assert got[0].score == 0 and got[0].ambiguous and got[7].lang_pred in ("de", "en") and len(got) == corpus.count()
    assert {r.lang_pred for r in langid.identified(corpus, langid.fit(no_docs)).collect()} == {"und"}
    one = langid.fit(train.where("lang = 'de'"))
    assert {r.lang_pred for r in langid.identified(train, one).collect()} == {"de", "und"}
    assert langid.identified(no_docs, model).count() == 0


@pytest.mark.parametrize("n", [2, 4, 7, 12, 40])
def test_codewords_differ(n):
    code = langid.codewords(n).astype(int)
    gaps = (code.shape[1] - code @ code.T) // 2
    assert gaps[~np.eye(n, dtype=bool)].min() >= (1 if n == 2 else 2)


# --- 6: chat

def test_escapes_are_reversible_and_hide_controls(spark):
    parts = ["<", "|", "\\", "n", "<|", "im_end|>", "<|im_start|>", "\n", "x", "\\\\", "<\\|"]
    rnd = np.random.default_rng(2)
    texts = ["".join(rnd.choice(parts, size=int(rnd.integers(0, 9)))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escaped(F.col("t")))
    for r in df.withColumn("back", chat.unescaped(F.col("e"))).collect():
        assert r.back.replace("\n", "n") == r.t.replace("\n", "n") and "<|" not in r.e


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "a <|im_end|> \\n"), (1, 0, "user", None), (2, 0, "user", "x"), (2, 1, "user", "y\n\\"),
            (2, 2, "tool\nx", ""), (2, 2, "tool\nx", ""), (3, 0, None, "é𝄞"), (3, None, "assistant", "first"), (None, 0, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("body", F.lit(1))
    out = chat.formatted(df)
    got = {r.conv_id: r for r in chat.conversation_digests(out).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        g = got[c]
        assert g.n_turns == len(turns) and g.loss_chars == len(loss)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert [got[c].valid for c in (1, 2, 3, None)] == [True, False, False, True]
    assert sum(g.formatted_chars for g in got.values()) == sum(len(r.formatted) for r in out.collect())
    assert chat.conversation_digests(chat.formatted(df.limit(0))).count() == 0


# --- 7 and 10: ids

def test_chunk_encoder_equals_the_tokenizer(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 50)
    rnd = np.random.default_rng(1)
    parts = list("aAbZ éÉßÑ.,!?;'sIİΣς_-#@{}019½漢한́‍\xa0\x1c\x85\t\nﬁªµ×") + ["<|endoftext|>", "<|ENDOFTEXT|>", "'RE", ". ", "...", "</w>"]
    texts = ["".join(rnd.choice(parts, size=int(rnd.integers(1, 40)))) for _ in range(4000)] + ["", "word, word. Word"]
    mine, theirs = tokens.ChunkEncoder(tokens.vocabulary_path()), _tokenizer()
    for t in texts:
        assert mine.encode(t).tolist() == theirs.encode(t, add_special_tokens=False).ids, repr(t)
    assert mine.encode(None).tolist() == []
    ids, lengths = mine.encode_all(pa.array([None, *texts, None]))
    want = [[], *(theirs.encode(t, add_special_tokens=False).ids for t in texts), []]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_wavelet_matrix_answers():
    rng = np.random.default_rng(3)
    for n, top, bits in ((0, 1, 4), (1, 5, 3), (700, 40, 6), (5000, 49000, 16), (64, 1, 1), (1500, 70000, 17)):
        ids = rng.integers(0, top, n)
        m = token_files.WaveletMatrix.from_bytes(token_files.WaveletMatrix.build(ids, bits).to_bytes())
        assert m.decode().tolist() == ids.tolist()
        for at in range(0, n, max(1, n // 50)):
            s, lo, hi = int(ids[at]), at // 2, (at + n) // 2
            assert m.access(at) == s and m.count(s, lo, hi) == int((ids[lo:hi] == s).sum())
            assert m.occurrences(s, lo, hi) == [lo + int(i) for i in np.flatnonzero(ids[lo:hi] == s)]
        assert m.count(1 << 20) == 0 and m.occurrences(1 << 20) == []


def test_token_files_round_trip(spark, corpus, no_docs, scratch):
    docs = corpus.union(corpus.where("doc_id = 9")).withColumn("payload", F.lit(1))
    token_files.write_token_files(docs, f"{scratch}/t", block_tokens=500)
    blocks = spark.read.parquet(f"{scratch}/t")
    got = sorted(token_files.read_documents(blocks).collect(), key=lambda r: r.start)
    theirs, at = _tokenizer(), 0
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    stream = []
    for g, r in zip(got, rows):
        ids = np.array(theirs.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
        stream += ids.tolist()
    assert token_files.occurrences(blocks, 2).count() == stream.count(2)
    token_files.write_token_files(no_docs, f"{scratch}/none")
    assert token_files.read_documents(spark.read.schema(token_files.BLOCKS).parquet(f"{scratch}/none")).count() == 0


def test_ids_above_double_precision_beside_null(spark, scratch):
    big = [(1 << 60) + 1, None, (1 << 60) + 3, (1 << 53) + 1]
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(big)], "doc_id long, text string").coalesce(1)
    placed = packing.packed(docs)
    assert Counter(r.doc_id for r in placed.collect()) == Counter(big)
    assert Counter(i for r in packing.sequences(docs, placed).collect() for i in r.doc_ids) == Counter(big)
    token_files.write_token_files(docs, f"{scratch}/big")
    assert Counter(r.doc_id for r in token_files.read_documents(spark.read.parquet(f"{scratch}/big")).collect()) == Counter(big)
    turns = spark.createDataFrame([(i, 0, "user", f"text {k}") for k, i in enumerate(big)], "conv_id long, turn long, role string, text string")
    got = chat.conversation_digests(chat.formatted(turns).coalesce(1)).collect()
    assert Counter((r.conv_id, r.n_turns) for r in got) == Counter((i, 1) for i in big)


def test_lengths_pack_well():
    rng = np.random.default_rng(0)
    for lengths in ([], [2048], [1, 1, 1], [1025, 1023, 700, 690, 683, 682], rng.integers(1, 2048, 3000), rng.integers(600, 1100, 500)):
        lengths = np.array(lengths, dtype=np.int64)
        bins, offsets = packing.pack_lengths(lengths)
        fill = Counter()
        for b, o, n in sorted(zip(bins.tolist(), offsets.tolist(), lengths.tolist())):
            assert o == fill[b]
            fill[b] += n
        large = Counter(bins[3 * lengths > 2048].tolist())
        assert all(v <= 2048 for v in fill.values()) and (not large or max(large.values()) <= 2)
    lengths = rng.integers(1, 2048, 3000)
    assert len(set(packing.pack_lengths(lengths)[0].tolist())) <= 1.04 * lengths.sum() / 2048


def test_packed_pieces_and_sequences(spark, corpus, no_docs):
    docs = corpus.union(corpus.where("doc_id = 9")).withColumn("offset", F.lit(1))
    placed = packing.packed(docs, pieces_per_lot=40).cache()
    theirs, rows = _tokenizer(), placed.collect()
    ids = {(r.doc_id, r.text): theirs.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    expected = Counter()
    for r in docs.collect():
        x = ids[(r.doc_id, r.text)]
        for piece, s in enumerate(range(0, len(x), 2048)):
            expected[(r.doc_id, piece, s, len(x[s:s + 2048]), zlib.crc32(np.array(x[s:s + 2048], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    fill = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048
    seqs = {r.sequence_id: r.ids for r in packing.sequences(docs, placed).collect()}
    assert {k: len(v) for k, v in seqs.items()} == fill
    for r in rows:
        part = np.array(seqs[r.sequence_id][r.offset:r.offset + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
    assert packing.packed(no_docs).count() == 0


# --- the queries and the pipeline

def test_mix_query_equals_sql(spark, sf001):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf001}/documents.parquet'")
    sql = con.execute(queries.ORACLE_SQL["op2_poisson_mix"])
    names = [c[0] for c in sql.description]
    expected = sorted(sql.fetchall(), key=repr)
    got = queries.op2_poisson_mix(spark, sf001).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == expected


def test_pipeline_stage_by_stage(spark, sf001):
    import corpus_pipeline as C
    from aspectflow.llm.stored import stored
    from tests.llm.helpers import jaccard_components

    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    seen = {}
    for name, stage in C.STAGES:
        before, docs = docs, stored(stage(spark, docs, sf001), "test")
        seen[name] = (before.collect(), docs.collect())
        if name != C.STAGES[-1][0]:
            assert docs.columns == before.columns
    rows_in, rows_out = seen["language_id"]
    assert len(rows_out) >= 0.97 * len(rows_in)
    rows_in, rows_out = seen["quality_classifier"]
    bad = {r.doc_id for r in spark.read.parquet(f"{sf001}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf001}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    kept = {r.doc_id for r in rows_out}
    came = {r.doc_id for r in rows_in}
    assert len(kept & good) >= 0.95 * len(came & good) and len(kept & bad) <= 0.6 * len(came & bad)
    rows_in, rows_out = seen["near_duplicates"]
    comp, _ = jaccard_components({r.doc_id: r.text for r in rows_in})
    assert sorted(r.doc_id for r in rows_out) == sorted(set(comp.values()))
    rows_in, rows_out = seen["source_mix"]
    assert {r.doc_id for r in rows_out} <= {r.doc_id for r in rows_in} and rows_out
    rows_in, rows_out = seen["sequence_packing"]
    theirs = _tokenizer()
    lengths = Counter()
    for r in rows_in:
        lengths[r.doc_id] += len(theirs.encode(r.text, add_special_tokens=False).ids) + 1
    packed = Counter()
    for r in rows_out:
        packed[r.doc_id] += r.length
    assert packed == lengths


def test_near_duplicates_with_null_and_repeated_ids(spark, sf001):
    import corpus_pipeline as C
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(3, a), (5, a + " end"), (5, b), (None, a + " more"), (None, c), (None, c + " end"), (None, None), (None, ""),
            (7, d), (7, d + " end"), (8, "lone"), (8, "lone"), (9, "LONE")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in C.near_duplicates(spark, docs, sf001).collect()]
    one_of = [{(None, c), (None, c + " end")}, {(7, d), (7, d + " end")}]
    assert [len(group & set(got)) for group in one_of] == [1, 1] and len(got) == 7
    assert {(3, a), (5, b), (8, "lone"), (None, None), (None, "")} <= set(got)


def test_pipeline_stages_take_empty_tables(spark, sf001, no_docs):
    import corpus_pipeline as C
    for _, stage in C.STAGES:
        assert stage(spark, no_docs, sf001).count() == 0
