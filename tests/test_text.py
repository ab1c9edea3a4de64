import random

from pyspark.sql import functions as F

from corpusmill.functions import text


def one(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def preview(t, n):
    """The rule in words: on one line, cut at a word where that costs less than eight characters or a quarter."""
    if t is None or n < 1:
        return None
    flat = " ".join(t.split())
    if len(flat) <= n or n <= 3:
        return flat[:n]
    head = flat[: n - 3].rstrip()
    before, blank, tail = head.rpartition(" ")
    return (before if blank and before and len(tail) < max(8, n // 4) else head) + "..."


def test_preview(spark):
    rng = random.Random(1)
    texts = [None, "", "   ", "x" * 100, "Biomarker-guided immunotherapy improves response selection in cancer cohorts.", "a\n b\t c", "é ü　ö" * 30]
    texts += ["".join(rng.choice("ab cd  \n\t\xa0é") for _ in range(rng.randint(0, 90))) for _ in range(200)]
    for n in (0, 1, 3, 4, 10, 35, 60):
        assert one(spark, texts, text.preview("v", n)) == [preview(t, n) for t in texts]


def test_blank_and_eligible_differ(spark):
    values = [None, "", "  ", "\t", "\xa0", "\x1c", "  ", "a"]
    assert one(spark, values, text.is_blank("v")) == [True] * 7 + [False]
    assert one(spark, values, text.is_eligible("v")) == [False] * 3 + [True] * 5


def test_strip_is_pythons(spark):
    values = [a + "x y" + b for a in ("", " ", "\x1c\x85", " 　") for b in ("", "\n", "\xa0\x1f", "​")]
    assert one(spark, values, text.strip("v")) == [v.strip() for v in values]


def test_words_prompt_clip(spark):
    df = spark.createDataFrame([(" a b ", "c\n\nd"), (None, "\t"), ("x", None), ("", " y ")], "title string, abstract string")
    assert [r[0] for r in df.select(text.combined_words("title", "abstract")).collect()] == [4, 0, 1, 1]
    assert one(spark, ["\x00 a\x00b🧪c "], text.clipped("v", 3)) == ["ab🧪"]
    assert [r[0] for r in df.limit(1).select(text.prompt("title", "abstract")).collect()] == ["a b c\n\nd"]


def test_year_and_slug(spark):
    assert one(spark, ["Winter 2003", "1998 Dec-1999 Jan", "1899", "x20031", None, ""], text.year_in("v")) == [2003, 1998, None, None, None, None]
    assert one(spark, ["Org/Model v1", "--", "", "ÄÖ"], text.slug(F.col("v"))) == ["org-model-v1", "model", "model", "model"]
