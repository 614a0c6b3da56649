from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordtide import functions as fn
from wordtide.operators import classify, distinct_words, tokenize

SPACE = " \t\n\x0b\f\r"


def cut(text):
    """The tokeniser's definition in plain Python: trailing empty words go, a leading one stays."""
    stripped = re.sub(f"[^A-Za-z0-9{SPACE}]", "", text)
    if stripped == "":
        return [""]
    parts = re.split(f"[{SPACE}]+", stripped)
    while parts and parts[-1] == "":
        parts.pop()
    return [p.lower() for p in parts]


def tokens(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {i: [] for i in range(len(texts))}
    for r in tokenize(df).orderBy("id", "pos").collect():
        assert r["pos"] == len(got[r["id"]])
        got[r["id"]].append(r["word"])
    return [got[i] for i in range(len(texts))]


def test_tokenizer_rows(spark):
    cases = {
        "isn't": ["isnt"],
        "a  b ": ["a", "b"],
        " a": ["", "a"],
        "": [""],
        "   ": [],
        "\x0b": [],
        " ! ": [],
        "!?": [""],
        "it\x0bx": ["it", "x"],
        "Café ÉCOLE": ["caf", "cole"],
        "a b": ["ab"],  # not white space here, so deleted
        "a b c\r\nD": ["ab", "c", "d"],
        "\nOne,two THREE\n\n": ["", "onetwo", "three"],
        "x .\n": ["x"],
        "\U0001f600 ok": ["", "ok"],
    }
    assert tokens(spark, list(cases)) == list(cases.values())
    assert [cut(t) for t in cases] == list(cases.values())


def test_null_text_has_no_words(spark):
    df = spark.createDataFrame([(1, None)], "id int, text string")
    assert tokenize(df).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(
            alphabet=st.one_of(
                st.sampled_from(list(SPACE + "aZ9'-._!éßİK ​")),
                st.characters(exclude_categories=["Cs"]),
            ),
            max_size=12,
        ),
        min_size=1,
        max_size=60,
    )
)
def test_tokenizer_equals_definition(spark, texts):
    assert tokens(spark, texts) == [cut(t) for t in texts]


def test_distinct_words_of_a_text(spark):
    texts = [" b a b  a ", "", "\t", "x", "a\n", None, " ", "B b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted((r["id"], r["word"]) for r in distinct_words(df).collect())
    assert got == sorted((i, w) for i, t in enumerate(texts) if t is not None for w in set(cut(t)))


def test_word_classes(spark, words):
    cases = {
        "": (False, False),
        "abc": (False, False),
        "abcd": (True, False),
        "xyz": (False, False),  # short words are not asked
        "nest": (True, False),
        "nzzz": (True, False),
        "oval": (True, True),
        "zoom": (True, True),
        "1234": (True, False),
        "Zeta": (True, False),
        "école": (True, True),
        "\U0001f600abc": (True, True),
        "\x7fabc": (True, True),
    }
    got = {r["word"]: (r["is_long"], r["is_positive"]) for r in classify(words(*cases)).collect()}
    assert got == cases


def test_positive_is_first_code_point_above_110(spark):
    points = [c for c in range(1, 0x3000)] + [0x1F600, 0x10FFFF]
    df = spark.createDataFrame([(c, chr(c) + "abc") for c in points], "code int, word string")
    wrong = df.where(fn.is_positive(F.col("word")) != (F.col("code") > 110))
    assert wrong.count() == 0


def test_filters_split_the_words(spark, words):
    from wordtide import operators as op

    df = words("", "abc", "abcd", "oval", "the", "zeta", "1234")

    def get(f):
        return sorted(r["word"] for r in f(df).collect())

    assert get(op.long_words) == ["1234", "abcd", "oval", "zeta"]
    assert get(op.short_words) == ["", "abc", "the"]
    assert get(op.long_positive_words) == ["oval", "zeta"]
    assert get(op.long_negative_words) == ["1234", "abcd"]


def test_figures(spark):
    df = spark.createDataFrame(
        [(0, 0), (107, 40), (4627, 1086), (1, 3), (2, 3), (9007199254740993, 1)],
        "total bigint, n bigint",
    )
    got = df.select(
        fn.average(F.col("total"), F.col("n")).alias("avg"),
        fn.hundredths(F.col("total"), F.col("n")).alias("h"),
    ).collect()
    assert [r["avg"] for r in got[:3]] == [0.0, 2.675, 4627 / 1086]
    assert [r["h"] for r in got] == [0, 268, 426, 33, 67, 900719925474099300]


def test_floor_at_one(spark):
    got = spark.range(3).select(fn.floor_at_one(F.col("id")).alias("w")).collect()
    assert [r["w"] for r in got] == [1, 1, 2]


def test_quotients(spark):
    got = spark.range(-4, 5).select(
        fn.floor_quotient(F.col("id"), F.lit(3)).alias("floor"),
        fn.whole_quotient(F.col("id"), F.lit(3)).alias("whole"),
    )
    assert [r["floor"] for r in got.collect()] == [x // 3 for x in range(-4, 5)]
    assert [r["whole"] for r in got.collect()] == [int(x / 3) for x in range(-4, 5)]
