import json

from corpusmill.operators import nested

ARTICLE = {
    "ArticleTitle": {"#text": " T "},
    "Journal": {"Title": "J\n", "JournalIssue": {"PubDate": {"Year": " 2020 "}}},
    "Abstract": {"AbstractText": [{"@Label": "BG", "#text": "one"}, None, "", {"@Label": " "}, "two", {"@Label": "END"}, 7]},
    "AuthorList": {"Author": [{"LastName": "A", "AffiliationInfo": [{"Affiliation": "x"}, "y", None]}, None, {"CollectiveName": "G", "AffiliationInfo": "z"}, {"Initials": "Q", "AffiliationInfo": {"Affiliation": "w"}}]},
}
MESH = {"MeshHeading": [{"DescriptorName": "d1", "QualifierName": ["q", {"#text": "r"}]}, {"DescriptorName": {"#text": "d2"}, "QualifierName": {"#text": "{s}"}}]}


def rows(spark, payloads, f=nested.items):
    raw = spark.createDataFrame([(i, p if p is None or isinstance(p, str) else json.dumps(p), "clash", 1) for i, p in enumerate(payloads)], "rec_id bigint, payload string, item string, v int")
    return f(raw).collect()


def citation(**more):
    return {"MedlineCitation": {"PMID": "12", "Article": ARTICLE, "MeshHeadingList": MESH} | more}


def test_all_tables(spark):
    got = {tuple(r)[1:] for r in rows(spark, [citation()])}
    assert got == {
        ("year", 0, 1, "2020"), ("journal", 0, 1, "J"), ("section", 0, 1, "BG"), ("section", 0, 2, ""), ("section", 0, 3, "END"), ("section", 0, 4, ""),
        ("author", 0, 1, "A"), ("author", 0, 3, "G"), ("affiliation", 1, 1, "x"), ("affiliation", 1, 2, "y"), ("affiliation", 3, 1, "z"), ("affiliation", 4, 1, "w"),
        ("heading", 0, 1, "d1"), ("heading", 0, 2, "d2"), ("qualifier", 1, 1, "q"), ("qualifier", 1, 2, "r"), ("qualifier", 2, 1, "{s}"),
    }
    a = rows(spark, [citation()], nested.articles)[0]
    assert (a.pmid, a.title, a.abstract, a.year, a.journal) == (12, "T", "BG: one\n\ntwo\n\nEND:\n\n7", 2020, "J")
    assert set(nested.tables(spark.createDataFrame([(1, "{}")], "rec_id bigint, payload string"))) == {*nested.ENTITIES, "text", "articles"}


def test_wrappers_and_ids(spark):
    good = [{"PubmedArticle": citation()}, {"PubmedArticle": [citation()]}, {"PubmedArticleSet": {"PubmedArticle": [citation()]}}, citation(PMID=12), citation(PMID={"@Version": "1", "#text": " 12 "})]
    bad = [None, "", "[]", "{}", "<x/>", json.dumps(citation())[:-3], citation(PMID="12x"), citation(PMID=None), citation(PMID=" "), citation(Article=None), citation(Article="x"), {"MedlineCitation": None}, "7", '"t"']
    assert {r.rec_id for r in rows(spark, good + bad)} == set(range(len(good)))
    assert rows(spark, []) == []


def test_year_order(spark):
    def one(pub, **more):
        article = {"Journal": {"JournalIssue": {"PubDate": pub}}} | ({"ArticleDate": more.pop("date")} if "date" in more else {})
        return citation(Article=article, **more)

    cases = [
        (one({"Year": "abcd", "MedlineDate": "Winter 2003"}), "2003"), (one({"MedlineDate": "1998 Dec-1999 Jan"}), "1998"), (one({"MedlineDate": "1899"}, date={"Year": 2011}), "2011"),
        (one({"MedlineDate": "1899"}, date=[{"Year": "n.d."}, {"Year": "2012"}], DateCompleted={"Year": "2001"}), "2001"), (one({}, DateCompleted={"Year": "2001"}), "2001"), (one({"Year": {"#text": "2020"}}), "2020"), (one(None), None),
    ]
    got = {r.rec_id: r.item for r in rows(spark, [c for c, _ in cases]) if r.entity == "year"}
    assert [got.get(i) for i in range(len(cases))] == [y for _, y in cases]


def test_very_long_and_repeated(spark):
    long = citation(Article={"ArticleTitle": "x" * 300_000, "Abstract": {"AbstractText": ["y" * 300_000] * 5}})
    got = rows(spark, [long, long])
    assert {r.rec_id for r in got} == {0, 1} and sum(r.entity == "section" for r in got) == 10
