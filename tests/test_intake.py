import gzip
import os

import pytest

from corpusmill.ingest import ingest
from corpusmill.sources import listing
from corpusmill.sources.citation_xml import changes_in, read_changes
from corpusmill.store import Table, VectorStore, merge_shards


def article(pmid, title="T", rest="", date="<PubDate><Year>2020</Year></PubDate>"):
    return f"<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><ArticleTitle>{title}</ArticleTitle>{rest}<Journal><Title>J</Title><JournalIssue>{date}</JournalIssue></Journal></Article></MedlineCitation></PubmedArticle>"


def write(path, *parts, root="PubmedArticleSet"):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(f"<?xml version='1.0'?><{root} xmlns='http://x.invalid'>" + "".join(parts) + f"</{root}>")
    return str(path)


def test_fields(tmp_path):
    abstract = "<Abstract><AbstractText Label='BG'>one <sup>2</sup> tail</AbstractText><AbstractText>two</AbstractText><AbstractText Label='E'/><AbstractText> </AbstractText><CopyrightInformation>c</CopyrightInformation></Abstract>"
    cases = [
        (article(1, "Foo <i>bar</i> baz &amp; q", abstract), ("Foo bar baz & q", "BG: one 2 tail\n\ntwo\n\nE:", 2020)),
        (article(2, "  "), (None, None, 2020)),
        (article(3, date="<PubDate><Year>abcd</Year><MedlineDate>Winter 2003</MedlineDate></PubDate>"), ("T", None, 2003)),
        (article(4, date="<PubDate><MedlineDate>1899</MedlineDate></PubDate>", rest="<ArticleDate><Year>2011</Year></ArticleDate>"), ("T", None, 2011)),
        (article(5, date="<PubDate><Year><b>2020</b></Year></PubDate>"), ("T", None, None)),
        (article(6, "p &lt;0.05 and y&gt;3 <i>z</i>"), ("p <0.05 and y>3 z", None, 2020)),
    ]
    path = write(tmp_path / "a.xml.gz", *[c for c, _ in cases], article("12x"), article(" "))
    got = [(r[4], r[5], r[6]) for r in changes_in(path)]
    assert got == [w for _, w in cases]


def test_delete_scope(spark, tmp_path):
    path = write(tmp_path / "a.xml.gz", "<DeleteCitation><PMID>7</PMID><PMID>8</PMID></DeleteCitation>")
    assert [r.pmid for r in read_changes(spark, [path]).collect()] == [7]
    assert sorted(r.pmid for r in read_changes(spark, [path], delete_scope="all").collect()) == [7, 8]


def test_ingest(spark, tmp_path):
    root, a = str(tmp_path / "data"), tmp_path / "in"
    a.mkdir()
    one = write(a / "u25n1.xml.gz", article(1), article(2), article(1, "newer"), "<DeleteCitation><PMID>2</PMID></DeleteCitation>", article(3))
    two = write(a / "u25n2.xml.gz", article(2, "back"), "<DeleteCitation><PMID>3</PMID></DeleteCitation>")
    cut = a / "u25n3.xml.gz"
    cut.write_bytes(open(write(tmp_path / "whole.xml.gz", *[article(i) for i in range(50, 90)]), "rb").read()[:-40])
    assert ingest(spark, root, [two, one, str(cut)], on_corrupt="quarantine") == {"files": 2, "skipped": 0, "corrupt": 1, "refetched": 0, "upserts": 5, "deletes": 2}
    state = lambda: {r.pmid: r.title for r in Table(spark, f"{root}/articles").read().collect()}
    assert state() == {1: "newer", 2: "back"}
    assert ingest(spark, root, [one, two])["skipped"] == 2
    write(cut, article(4))
    assert ingest(spark, root, [one, two, str(cut)])["files"] == 1
    assert state() == {1: "newer", 2: "back", 4: "T"}
    assert Table(spark, f"{root}/ledger").read().count() == 3
    # an old file with another time is taken again and overwrites
    os.utime(one, ns=(1, 1))
    ingest(spark, root, [one])
    assert state() == {1: "newer", 3: "T", 4: "T"}
    cut.write_bytes(b"\x1f\x8b broken")
    with pytest.raises(Exception):
        ingest(spark, root, [str(cut)])
    asked = []
    with pytest.raises(OSError):
        ingest(spark, root, [str(cut)], refetch=asked.append, attempts=3)
    assert len(asked) == 2 and state() == {1: "newer", 3: "T", 4: "T"}
    done = ingest(spark, root, [str(cut)], refetch=lambda p: write(p, article(5)))
    assert (done["files"], done["refetched"]) == (1, 1) and set(state()) == {1, 3, 4, 5}
    assert ingest(spark, root, [str(cut)])["skipped"] == 1


def test_store(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "v"))
    df = lambda *rows: spark.createDataFrame(list(rows), "pmid bigint, embedding array<float>")
    with pytest.raises(FileNotFoundError):
        store.read()
    store.add(df((1, [1.0, 0.0])), properties={"embedding_source": "x"})
    store.add(df((1, [9.0, 9.0]), (2, [0.0, 1.0])))
    assert {r.pmid: r.embedding for r in store.read().collect()} == {1: [1.0, 0.0], 2: [0.0, 1.0]}
    assert store.properties() == {"embedding_source": "x", "dim": "2", "ntotal": "2", "query_index_type": "flat"}
    before = store.manifest()
    for bad in (df((3, [1.0])), df((3, [1.0, 2.0]), (3, [1.0, 2.0]))):
        with pytest.raises(ValueError):
            store.add(bad)
    # a part that was written but not committed isn't seen
    store._write(df((5, [1.0, 1.0])))
    assert store.manifest() == before and store.read().count() == 2
    shards = [df((10, [1.0, 0.0])), df(), df((11, [1.0, 0.0]))]
    assert merge_shards(store, shards)["properties"]["ntotal"] == "4"
    with pytest.raises(ValueError):
        merge_shards(store, [df((20, [1.0, 0.0])), df((20, [1.0, 0.0]))])
    with pytest.raises(ValueError):
        merge_shards(store, [df()])


def test_listing(spark, tmp_path):
    pages = spark.createDataFrame([("https://x.invalid/d/", "<A class=q HREF='b.xml.gz'>b</A><a href=\"a.xml.gz\"><a href='a.xml.gz'><a href='../c.xml.gz'><a href='n.txt'>"), ("https://x.invalid/e", None)], "url string, html string")
    assert sorted(tuple(r) for r in listing.listed_files(pages).collect()) == [("a.xml.gz", "https://x.invalid/d/a.xml.gz"), ("b.xml.gz", "https://x.invalid/d/b.xml.gz")]
    remote = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", 4)], "name string, size bigint")
    local = spark.createDataFrame([("a", 1), ("b", 2), ("c", 9)], "name string, size bigint")
    assert sorted(r.name for r in listing.to_fetch(remote, local).collect()) == ["b", "c", "d"]
    assert listing.to_fetch(remote, local, force=True).count() == 4

    def read(name):
        if name == "bad.xml.gz":
            raise OSError
        return b"12345"

    done = listing.fetch([("bad.xml.gz", 5), ("ok.xml.gz", 5)], str(tmp_path), read)
    assert (done.saved, done.failed) == (1, 1) and os.listdir(tmp_path) == ["ok.xml.gz"]
    assert listing.fetch([("ok.xml.gz", 5)], str(tmp_path), read).skipped == 1
    assert listing.fetch([("ok.xml.gz", None)], str(tmp_path), read).saved == 1
    assert [os.path.basename(p) for p in listing.local_files(str(tmp_path))] == ["ok.xml.gz"]
