import unicodedata

import pytest

from corpusmill.llm.lookalike import look_alikes, look_groups, normalize, normalized, script_kind, script_tokens

SAME = [
    ("Effect of drug", "Ｅｆｆｅｃｔ　ｏｆ　ｄｒｕｇ"), ("café über", "café über"), ("a b c", "a b c"), ("abc", "a​b­c﻿"), ("Paper cocoa", "Рaрer сосоa"),
    ("Type", "Τype"), ("vor", "νοr"), ("first flow office", "ﬁrst ﬂow oﬃce"), ("5 µg", "5 μg"), ("300 K", "300 K"), ("follow-up", "follow‑up"), ("ABC", "АВС"), ("don't", "don’t"), ("nó", "nό"), ("wait...", "wait…"), ("⚕️", "⚕"), ("37 °C", "37 ℃"),
]
OTHER = [("Drug", "drug"), ("cafe", "café"), ("10³", "103"), ("и", "й"), ("one", "two"), ("a b", "ab"), ("½", "12"), ("a\nb", "a b"), ("H₂O", "H2O"), ("α-X", "β-X")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same_look(a, b):
    assert normalize(a) == normalize(b)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other_look(a, b):
    assert normalize(a) != normalize(b)


def test_one_script_is_chosen():
    assert normalize("сocоa") == "cocoa" and normalize("Cлово") == "Слово" and normalize("Исследование") == "Исследование"
    assert normalize("结果显示ΜΡ") == "结果显示MP"
    assert (script_kind("сocoa"), script_kind("сосо"), script_kind("слово"), script_kind("word")) == ("mixed", "whole", "single", "single")


def test_form_is_stable():
    for t in [x for p in SAME + OTHER for x in p] + ["", " ", "Ǆ ﷺ 힣 " + chr(0x10FFFF)]:
        assert normalize(normalize(t)) == normalize(t)
        assert unicodedata.is_normalized("NFC", normalize(t))


def test_pairs(spark):
    rows = [(1, "Ab c"), (2, "Ab c"), (3, "Ab c"), (4, None), (5, ""), (6, " "), (7, " "), (8, "other"), (9, "x" * 100_000 + "é"), (10, "x" * 100_000 + "é"), (11, "АЬ с"), (8, "оther")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, form string, key int")
    assert {tuple(r) for r in look_alikes(df).collect()} == {(1, 2), (2, 3), (9, 10)}
    assert look_alikes(df.limit(0)).count() == 0
    forms = {r.doc_id: r.form for r in normalized(df.drop("form")).collect()}
    assert forms[4] is None and forms[5] == "" and forms[2] == "Ab c"


def test_more_scripts_and_accents():
    assert normalize("ԱՕ") == normalize("ԱO") and normalize("օոհ") == "onh" and normalize("ᎪᏴᏟ") == normalize("ꓮꓐꓚ") == "ABC"
    assert normalize("\u0430\u030a") == "\u00e5" and normalize("q\u0301x") == normalize("\u051b\u0301\u0445")
    assert script_kind("հօուն") == "single" and script_kind("оnе") == "mixed" and script_kind("ᎪᏴᏟ") == "whole"


def test_groups_and_kinds(spark):
    rows = [(1, "Ab c"), (2, "Аb c"), (3, "Ab c"), (4, None), (5, " "), (6, "слово сосо"), (7, "слово coco"), (8, "plain")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, look string, members int")
    got = {r.doc_id: (r.look, r.members, r.spellings, r.links) for r in look_groups(df).collect()}
    assert got == {1: (1, 3, 2, 1), 2: (1, 3, 2, 2), 3: (1, 3, 2, 1), 6: (6, 2, 2, 1), 7: (6, 2, 2, 1), 8: (8, 1, 1, 0)}
    assert {r.doc_id: (r.mixed, r.whole) for r in script_tokens(df).collect()} == {2: (1, 0), 6: (0, 1)}
    assert look_groups(df.limit(0)).count() == script_tokens(df.limit(0)).count() == 0
