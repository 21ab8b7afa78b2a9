import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aspectflow.functions import text as T
from tests import pyref

EDGE = [
    "",
    "   ",
    "GIÀY ĐẸP QUÁ SHOP",
    "😀 Hello, world! 😀",
    " ¡Hola! ",
    "a b c\x1cd\x85e",
    " lead and trail\x1c",
    "café decomposed",
    "đường đi",
    "Tab\tnew\nline\r\n  end",
    "x--y__z 123 4.5",
    "Ǆ İstanbul ǅ",
]


def _run(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return {r.i: r.o for r in df.select("i", expr(F.col("t")).alias("o")).collect()}


def test_clean_edges(spark):
    got = _run(spark, EDGE, T.clean)
    for i, t in enumerate(EDGE):
        assert got[i] == pyref.clean(t), (t, got[i], pyref.clean(t))


def test_clean_keeps_edge_space_when_char_dropped(spark):
    got = _run(spark, ["!abc!", "  abc  "], T.clean)
    assert got[0] == " abc "
    assert got[1] == "abc"


def test_clean_null_is_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(T.clean("t")).first()[0] is None


def test_keep_vietnamese_is_case_sensitive(spark):
    got = _run(spark, ["Ăn ngon", "ăn ngon"], T.keep_vietnamese)
    assert got[0] == " n ngon"
    assert got[1] == "ăn ngon"


def test_remove_tone(spark):
    texts = ["Tiếng Việt có dấu", "đường", "café", "ÀÉÎÕÜ ñ ç", "plain"]
    got = _run(spark, texts, T.remove_tone)
    for i, t in enumerate(texts):
        assert got[i] == pyref.remove_tone(t)
    assert got[1] == "đuong"


def test_normalise_and_tokenize(spark):
    texts = ["  a  b c\n", "", "   "]
    norm = _run(spark, texts, T.normalise_spaces)
    toks = _run(spark, texts, T.tokenize)
    for i, t in enumerate(texts):
        assert norm[i] == " ".join(t.split())
        assert list(toks[i]) == t.split()


ALPHABET = st.sampled_from(list("aZ09 .,!đĐấẤ\u00a0\x1c\x85\t\né😀-_") + ["\u0301", "\u2003", "E"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=25), min_size=1, max_size=8))
def test_clean_matches_python_random(spark, texts):
    got = _run(spark, texts, T.clean)
    for i, t in enumerate(texts):
        assert got[i] == pyref.clean(t)


def test_python_whitespace_set_matches_isspace():
    ws = T.python_whitespace()
    assert all(c.isspace() for c in ws)
    assert "\x1c" in ws and "\x85" in ws and "　" in ws
    assert unicodedata.category(" ") == "Zs" and " " in ws


def test_arrow_cleaned_matches_native_and_python(spark):
    from aspectflow.operators.vocab import cleaned
    texts = EDGE + [None, "ĐÂY là  một câu!!  ", " x ", "ÉCOLE—été…"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    a = {r.doc_id: r.clean_text for r in cleaned(df).collect()}
    b = {r.doc_id: r.clean_text for r in cleaned(df, engine="jvm").collect()}
    assert a == b
    for i, t in enumerate(texts):
        assert a[i] == (None if t is None else pyref.clean(t))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=25), min_size=1, max_size=8))
def test_arrow_cleaned_random(spark, texts):
    from aspectflow.operators.vocab import cleaned
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.clean_text for r in cleaned(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pyref.clean(t)


def test_kept_letters_engines_agree(spark):
    from aspectflow.operators.vocab import kept_letters
    texts = EDGE + [None, "Ăn ngon", "ăn ngon!", "a b c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    a = {r.doc_id: r.kept_text for r in kept_letters(df).collect()}
    b = {r.doc_id: r.kept_text for r in kept_letters(df, engine="jvm").collect()}
    assert a == b and a[len(EDGE) + 1] == " n ngon"
