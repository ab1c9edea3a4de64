from pyspark.sql import functions as F

from corpusmill.operators import quality
from corpusmill.plans import problems

TITLE = "Effect of drug {} on the outcome of patients with rare disease in town {}"


def table(spark, rows):
    return spark.createDataFrame([(i, t, y, b, "clash", 3) for i, (t, y, b) in enumerate(rows)], "pmid bigint, title string, year int, basename string, mask string, words int")


def base(n=400):
    return [(TITLE.format(f"name{i}", f"place{i * 7}"), 2000 + i % 20, f"load{i % 8}") for i in range(n)]


def test_values_that_are_no_texts(spark):
    odd = ["", "  ", "\t", " ", "N/A", "unknown", "[Not Available].", "12345", "10.1000/j.12.3", "https://example.org/a/1", "2001-03-04", "xxxxxxxx", "test test test", "......", "###", "<i>" + TITLE, TITLE + " &amp; more", "a \\u00e9 " + TITLE, "This abstract is not available in our records"]
    df = table(spark, base() + [(t, 2000, "load0") for t in odd])
    found = {r.key for r in quality.text_violations(df, "title", key="pmid", load="basename", markup=True).collect()}
    assert found == {400 + i for i in range(len(odd) - 1)} | ({418} if 418 in found else set())


def test_dominant_short_values_are_fine(spark):
    df = table(spark, [("oral", 2000, "a")] * 90 + [("by mouth", 2000, "a")] * 9 + [("7", 2000, "a")])
    assert [r.key for r in quality.text_violations(df, "title", key="pmid", load="basename").collect()] == [99]


def test_frequent_values_that_are_no_texts(spark):
    closed = ["N/A", "n/a", "unknown", "null", "None", "Untitled", "tba", "-", "???", "###", "asdf", "12345", "https://example.org/a/1", "2001-03-04", "4 March 2001", "March 2001", "10.1000/j.12.3", "xxxxxxxx", "test test test", "sample " * 300, "PMC12345"]
    short = ["Malaria", "Marching on", "Aprotinin", "Nullomers", "Test anxiety in school", "Tuberculosis in 1999", "Vitamin B12"]
    rows = [(t, 2000, "a") for t in closed + short for _ in range(30)]
    got = {r.key // 30 for r in quality.text_violations(table(spark, rows), "title", key="pmid", load="basename").collect()}
    assert got == set(range(len(closed)))


def test_repeated_units_are_looked_for_in_whole_values(spark):
    closed = ["test " * 60, "lorem " * 60 + "lor", "ab\n" * 200, ("Draft" + "-" * 30) * 20, "-" * 300 + "ha ha ha", "ha ha ha" + " " * 300, "(a) " * 100, "слово " * 60, "ha " * 100_000]
    text = ["test " * 60 + "of the effect", "ha " * 100_000 + "of the effect", "ab\n" * 200 + "in rats", "Malaria " + "in Kenya " * 40, " " * 100_000 + "Malaria in rats", "Введение   " + "в теорию игр " * 30, "-" * 45 + " see note"]
    c = F.col("v")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(closed + text)], "i int, v string")
    got = df.filter(quality.closed_form(c, quality.is_short(c, 6))).collect()
    assert {r.i for r in got} == set(range(len(closed)))
    # where short values are usual, the form alone decides
    usual = ["Malaria"] * 40 + ["Malaria in rats"] * 40
    df = table(spark, [(t, 2000, "a") for t in [*usual, closed[2], closed[3], text[0], text[3]]])
    assert {r.key for r in quality.text_violations(df, "title", key="pmid", load="basename").collect()} == {80, 81}


def test_long_stand_ins_repeat_at_a_rare_length(spark):
    long = "The following words stand for nothing at all and were put in by a form that wants some text, whatever it is, in this place and in every other one."
    rows = base(4000) + [(long, 2000, f"load{i % 3}") for i in range(8)] + [(long.replace("nothing", f"x{i}q"), 2000, "load0") for i in range(8)] + [(long + " once", 2000, "load4")] * 8
    got = {r.key for r in quality.text_violations(table(spark, rows), "title", key="pmid", load="basename").collect()}
    # eight of them in several loads; not those that differ, nor those of one load
    assert got == set(range(4000, 4008))


def test_years(spark):
    df = table(spark, [("t", y, "a") for y in (None, 1799, 1800, 2027, 2028, -1, 20203)])
    assert {r.key for r in quality.range_violations(df, "year", 1800, 2027, key="pmid", load="basename").collect()} == {1, 4, 5, 6}


def departing(spark, rows, field):
    x = quality.Limits()
    df = table(spark, rows)
    counts = quality.text_counts(df, "title", load="basename") if field == "title" else quality.number_counts(df, "year", 1800, 2027, load="basename")
    floors = {"null_rate": x.rate, "repeats": x.distinct, "top_share": x.distinct, "divergence": x.divergence, "center": x.position if field == "year" else x.length}
    return {(r.load, r.measure) for r in quality.departures(quality.load_profile(counts, field), floors).collect()}


def test_loads(spark):
    rows = base(4000)
    assert departing(spark, rows, "title") == set() == departing(spark, rows, "year")
    nulls = [(None if b == "load3" and i % 2 else t, y, b) for i, (t, y, b) in enumerate(rows)]
    nulls = [(None if b == "load3" and i % 16 < 8 else t, y, b) for i, (t, y, b) in enumerate(rows)]
    assert ("load3", "null_rate") in departing(spark, nulls, "title")
    upper = [(t.upper() if b == "load4" else t, y, b) for t, y, b in rows]
    assert ("load4", "divergence") in departing(spark, upper, "title")
    same = [(TITLE if b == "load5" else t, y, b) for t, y, b in rows]
    assert ("load5", "repeats") in departing(spark, same, "title")
    early = [(t, y - 60 if b == "load6" else y, b) for t, y, b in rows]
    assert ("load6", "center") in departing(spark, early, "year")


def test_load_of_evenly_repeated_values(spark, tmp_path):
    rows = [(TITLE.format(f"name{i // 8 % 30}", "place") if b == "load5" else t, y, b) for i, (t, y, b) in enumerate(base(5200)) for b in [f"load{i % 8}"]]
    df = spark.createDataFrame([(i, t, t, y, b) for i, (t, y, b) in enumerate(rows)], "pmid bigint, title string, abstract string, year int, basename string")
    df.write.parquet(str(tmp_path / "articles.parquet"))
    got = {(r.field, r.load, r.measure) for r in problems.p4_departures(spark, str(tmp_path)).collect()}
    assert ("title", "load5", "distinct_share") in got and {x[1] for x in got} == {"load5"}


def test_load_of_short_values(spark):
    rows = [(" ".join(t.split()[:3]) + f" x{i}y" if b == "load2" else t, y, b) for i, (t, y, b) in enumerate(base(800))]
    rows += [("Aspirin", 2000, "load1"), ("unknown", 2000, "load2")]
    df = table(spark, rows)
    got = {r.key for r in quality.text_violations(df, "title", key="pmid", load="basename").collect()}
    assert got == {800, 801}
    n = {r.load: r.n for r in quality.load_profile(quality.text_counts(df, "title", load="basename"), "title").collect()}
    assert set(n.values()) == {100}
    assert ("load2", "center") in departing(spark, rows, "title")
    one = [("Short title" if b == "load2" else t, y, b) for t, y, b in base(800)]
    assert {("load2", "center"), ("load2", "repeats")} <= departing(spark, one, "title")


def test_nothing_there(spark):
    df = table(spark, [])
    assert quality.text_violations(df, "title", key="pmid", load="basename").count() == 0
    assert quality.load_profile(quality.text_counts(df, "title", load="basename"), "title").count() == 0
    nulls = table(spark, [(None, None, None)] * 3)
    p = quality.load_profile(quality.text_counts(nulls, "title", load="basename"), "title").collect()
    assert [(r.load, r.null_rate, r.n) for r in p] == [(None, 1.0, 0)]


def test_masks(spark):
    df = spark.createDataFrame([("Ab cd, 12 é-x.",), ("aa  bb\ncc",)], "v string")
    assert [r[0] for r in df.select(quality.fine_mask(F.col("v"))).collect()] == ["W, 9 a-a.", "W"]
    assert [r[0] for r in df.select(quality.distinct_words(F.col("v"))).collect()] == [2, 3]
