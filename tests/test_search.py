import json

import numpy as np
import pytest

from corpusmill import embedding as E
from corpusmill import search as S
from corpusmill.operators import ivf
from corpusmill.store import Table, VectorStore


@pytest.fixture()
def articles(spark):
    rows = [(101, "Cancer immunotherapy biomarkers", "Biomarker-guided immunotherapy improves response selection in cancer cohorts.", 2024, "Journal A"), (202, "Cardiology outcomes study", "Cardiology endpoints and follow-up outcomes are summarized for a separate cohort.", 2023, "Journal B")]
    return spark.createDataFrame(rows, "pmid bigint, title string, abstract string, year int, journal string")


class Fixed:
    name = "local"

    def __call__(self, texts):
        return np.array([[1.0, 0.0]] * len(texts))


@pytest.fixture()
def store(spark, tmp_path):
    s = VectorStore(spark, str(tmp_path / "vectors"))
    s.add(spark.createDataFrame([(101, [1.0, 0.0]), (202, [0.0, 1.0]), (303, [0.97, 0.24])], "pmid bigint, embedding array<float>"), properties={"embedding_source": "local"})
    return s


def test_flat_and_index(spark, tmp_path, articles, store):
    index = str(tmp_path / "cells")
    find = lambda **k: S.search(spark, articles, store, index, "cancer", Fixed(), source="local", preview_chars=35, **k)
    found, choice = find()
    rows = found.collect()
    assert [r.pmid for r in rows] == [101, 303, 202] and choice == S.Choice("flat") and rows[1].title is None
    shown = S.render_text(rows[:1], "flat")
    assert all(x in shown for x in ("Index: flat", "1. PMID 101  score=1.0000", "2024 | Journal A", "Abstract: Biomarker-guided immunotherapy..."))
    assert S.render_text([], "flat").endswith("No results.")
    said = json.loads(S.render_json(find(k=2)[0].collect(), "flat"))
    assert [h["pmid"] for h in said["hits"]] == [101, 303] and said["hits"][1]["title"] is None
    S.build_index(spark, store, index, ivf.Params(cells=2, probes=2))
    with pytest.raises(FileExistsError):
        S.build_index(spark, store, index)
    found, choice = find()
    assert choice == S.Choice("ivf") and [r.pmid for r in found.collect()] == [101, 303, 202]
    assert find(flat_only=True)[1] == S.Choice("flat")
    plan = S.hits(spark, Table(spark, index).read(), articles, [1.0, 0.0], centroids=np.array(json.loads(Table(spark, index).properties()["centroids"])), probes=1)
    assert plan.count() < 3
    store.add(spark.createDataFrame([(404, [0.5, 0.5])], "pmid bigint, embedding array<float>"))
    found, choice = find()
    assert choice.kind == "flat" and "Falling back to flat index" in choice.warning and found.count() == 4


def test_refusals(spark, articles, store):
    with pytest.raises(ValueError, match="blank"):
        S.search(spark, articles, store, None, " ", Fixed(), source="local")
    with pytest.raises(ValueError, match="made by"):
        S.search(spark, articles, store, None, "x", lambda t: 1 / 0, source="ollama")
    with pytest.raises(ValueError, match="dimension"):
        S.search(spark, articles, store, None, "x", E.HashingEmbedder(3), source="local")
    with pytest.raises(ValueError):
        S.search(spark, articles, store, None, "x", Fixed(), source="local", probes=0)


@pytest.mark.parametrize(
    ("now", "built", "kind"),
    [
        ({"dim": "2", "ntotal": "3", "query_index_type": "ivf"}, {"built_from_dim": "2", "built_from_ntotal": "3"}, "ivf"),
        ({}, {"built_from_dim": "2", "built_from_ntotal": "3"}, "ivf"),
        ({"dim": "4"}, {"built_from_dim": "2", "built_from_ntotal": "3"}, "flat"),
        ({"ntotal": "4"}, {"built_from_dim": "2", "built_from_ntotal": "3"}, "flat"),
        ({"query_index_type": "flat"}, {"built_from_dim": "2", "built_from_ntotal": "3"}, "flat"),
        ({}, {"built_from_dim": "x"}, "flat"),
        ({}, None, "flat"),
    ],
)
def test_selection(now, built, kind):
    assert S.select_index(now, built).kind == kind
    assert (S.select_index(now, built).warning is None) == (kind == "ivf" or built is None)
    if kind == "flat" and built:
        with pytest.raises(RuntimeError):
            S.select_index(now, built, flat_exists=False)


def test_job_resumes(spark, tmp_path):
    df = spark.createDataFrame([(i, f"title {i}", f"text {i}", 2020, "j") for i in range(25)] + [(99, "\t", "\t", 1, "j")], "pmid bigint, title string, abstract string, year int, journal string")
    s = VectorStore(spark, str(tmp_path / "v"))
    go = lambda **k: E.embed_pending(df, s, lambda _: E.HashingEmbedder(8), source="hashing", model="m", chunk=10, on_empty="skip", **k)
    calls = iter([False, True])
    first = go(stop=lambda: next(calls))
    assert 0 < first < 25
    assert first + go() == 25 and go() == 0
    assert s.read().count() == 25 and s.properties()["dim"] == "8"
    norms = [np.linalg.norm(r.embedding) for r in s.read().collect()]
    assert np.allclose(norms, 1, atol=1e-5)
    with pytest.raises(Exception, match="empty text"):
        E.embed(df.filter("pmid = 99").selectExpr("pmid", "'' as prompt"), lambda _: E.HashingEmbedder()).collect()
    with pytest.raises(ValueError):
        E.embed_pending(df, s, lambda _: E.HashingEmbedder(8), source="local", model="m")


def test_answers():
    assert E.vectors_in([[1, 2], [3, 4]], 2).shape == (2, 2)
    assert E.vectors_in({"embeddings": [[1, 2]]}, 1).shape == E.vectors_in({"embedding": [1, 2]}, 1).shape == E.vectors_in([1, 2], 1).shape == (1, 2)
    for bad, n in (([1, 2], 2), ({}, 1), ([[1], [2]], 1), ([], 1)):
        with pytest.raises(ValueError):
            E.vectors_in(bad, n)


def test_servers():
    seen = []

    def post(path, body, headers):
        seen.append((path, len(body.get("input", body.get("prompt", ""))), body.get("truncate", "-")))
        if path == "/api/embed":
            return (404, "old")
        return (400, "long") if len(body["prompt"]) > 8192 else (200, {"embedding": [3.0, 4.0]})

    assert E.SingleServer(post, "m")(["x" * 10_000]).tolist() == [[3.0, 4.0]]
    assert [s[1] for s in seen] == [10_000] * 6 + [8192] * 2
    with pytest.raises(RuntimeError, match="500"):
        E.SingleServer(lambda *_: (500, "no"), "m")(["x"])
    with pytest.raises(RuntimeError, match="every length"):
        E.SingleServer(lambda *_: (400, "no"), "m")(["x"])
    asked = {}
    E.BatchServer(lambda p, b, h: (asked.update(b, **h), (200, [[1.0]] * 2))[1], token="t")(["a", "b"])
    assert asked == {"inputs": ["a", "b"], "truncate": True, "Authorization": "Bearer t"}


def test_names(monkeypatch):
    assert E.endpoint(["a", "b"], 3) == "b" and E.slug("Org/Model v1") == "org-model-v1" and E.model_name(" BGE-large-en-v1.5") == "BAAI/bge-large-en-v1.5" and E.model_name("x/y") == "x/y"
    with pytest.raises(ValueError):
        E.provider_name("tei")
    monkeypatch.setenv("LOCAL_EMBED_BATCH_SIZE", "x")
    monkeypatch.setenv("TEI_BATCH_SIZE", "7")
    assert E.batch_size() == 7 and E.batch_size(3) == 3
