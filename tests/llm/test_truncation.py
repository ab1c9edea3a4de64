import random

from corpusmill.llm.truncation import by_source, proper_prefixes, truncated, vocabulary

TEMPLATES = [
    "We enrolled {n} patients with {d} at several centres in the northern region.",
    "Treatment with {x} lowered the symptom burden in most carriers of the variant.",
    "The primary endpoint was change in visual acuity at {n} months.",
    "These data identify {x} as a candidate target in early {d}.",
    "Samples of tissue were analysed by mass spectrometry and expression was quantified.",
    "Monitoring of blood pressure should be considered before {x} is started.",
]


def corpus(n=600, seed=4):
    rng = random.Random(seed)
    names = [a + b + c for a in ("neuro", "cardio", "hepato") for b in ("lamino", "stroma", "vesico") for c in ("osis", "pathy", "itis")]
    return [" ".join(t.format(n=rng.randint(2, 99), d=rng.choice(names), x="x" + rng.choice(names)) for t in rng.choices(TEMPLATES, k=5)) for _ in range(n)]


def reasons(spark, texts):
    df = spark.createDataFrame([(i, t, "J " if i % 2 else "j", "clash", 1) for i, t in enumerate(texts)], "pmid bigint, abstract string, journal string, reason string, id int")
    return {r.pmid: r.reason for r in truncated(df).collect()}, df


def test_cut_and_whole(spark):
    whole = corpus()
    body = "We enrolled 12 patients with cardiostromaitis at several centres in the northern region. "
    cut = [
        (body + "Treatment with xneurolaminoosis lowered the symptom bur", "prefix"), (body + "Samples of tissue were analysed by", "context"), (body + "Samples of tissue were analysed [truncated]", "mark"),
        (body + "Samples of tissue were...", "mark"), (body + "Samples of tissue (text cut by the system)", "mark"), (body + "Samples of tissue were analysed (", "open"), (body + "Samples of tissue,", "open"), (body + "Samples of tissue were…»", "mark"),
    ]
    fine = [body.strip(), body.strip()[:-1], body.strip() + '"', body.strip()[:-1] + "!", body + "  \n", body.strip() + " [12].", None, "", " ", "N/A", "No abstract available", body[:-2] + ")", "Seen (control)." + body]
    fine += [body + "Funding: none"] * 40
    found, df = reasons(spark, whole + [t for t, _ in cut] + fine)
    assert {i: r for i, r in found.items() if i >= len(whole)} == {len(whole) + i: r for i, (_, r) in enumerate(cut)}
    assert not [i for i in found if i < len(whole)]
    rows = {r.journal: (r.texts, r.cut) for r in by_source(df, truncated(df)).collect()}
    assert set(rows) == {"j"} and rows["j"][1] == len(cut)


def test_stops_that_end_nothing(spark):
    whole = corpus()
    body = "We enrolled 12 patients with cardiostromaitis at several centres in the northern region. "
    cut = [body + "Of 518 primary care patients, 12 (40.", body + "Samples of tissue (sensitivity 66.3%, specificity 18.", body + "Samples of tissue were analysed [truncated].", "Samples of tissue [truncated]", body + "Samples of tissue were compared vs."]
    fine = [body + "Samples of tissue were analysed (n = 12.5).", body + "Samples were analysed (in part.)", body + "Samples (a) of tissue.", body + "The mean was 4.5."]
    found, _ = reasons(spark, whole + cut + fine)
    assert {i - len(whole): r for i, r in found.items()} == {0: "open", 1: "open", 2: "mark", 3: "mark", 4: "open"}


def test_lengths_that_are_limits(spark):
    whole = corpus(900, 5)
    cut = [t[:200] for t in corpus(120, 6)]
    found, _ = reasons(spark, whole + cut)
    inside = [i for i, t in enumerate(cut) if not t.rstrip().endswith(".")]
    hit = [i for i in inside if len(whole) + i in found]
    assert len(hit) >= 0.95 * len(inside) and not [i for i in found if i < len(whole)]


def test_trie_and_empty(spark):
    words = vocabulary(spark.createDataFrame([("Abc abd. (xy) last",), ("",)], "text string"))
    assert {r.word: r.n for r in words.collect()} == {"abc": 1, "abd": 1, "xy": 1}
    assert {r.prefix for r in proper_prefixes(words).collect()} == {"a", "ab", "x"}
    assert reasons(spark, [])[0] == {} and reasons(spark, [None, "", "a"])[0] == {}
    assert reasons(spark, ["word " * 100_000 + "end here now then so it is"])[0] in ({}, {0: "context"}, {0: "limit"})
