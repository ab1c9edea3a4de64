import json

import pytest

from corpusmill.cli import main
from test_intake import article, write


def test_from_files_to_hits(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.delenv("EMBEDDING_MODEL", raising=False)
    root = str(tmp_path)
    go = lambda *x: main(["--data-dir", root, *x], spark)
    assert go("ingest") == 1
    body = "<Abstract><AbstractText>{}</AbstractText></Abstract>"
    write(tmp_path / "u25n1.xml.gz", article(1, "Heart failure", body.format("heart failure in adults")), article(2, "Liver disease", body.format("liver disease in children")), article(3, "Empty"))
    assert go("ingest") == 0 and "'files': 1" in capsys.readouterr().out
    assert go("profile") == 0 and "total: 3" in capsys.readouterr().out
    assert (tmp_path / "profile" / "words.csv").exists()
    assert go("embed") == 2 and go("embed", "--model", "m", "--source", "tei") == 2 and go("embed", "--model", "m", "--shard-id", "1") == 2
    assert go("query", "--model", "m", "heart") == 1
    assert go("embed", "--model", "m") == 0 and "embedded 2" in capsys.readouterr().out
    assert go("index", "--model", "m", "--cells", "2", "--probes", "2") == 0 and go("index", "--model", "m") == 1 and go("index", "--model", "m", "--probes", "0") == 2
    capsys.readouterr()
    assert go("query", "--model", "m", "--json", "heart", "failure") == 0
    said = json.loads(capsys.readouterr().out)
    assert said["index_type"] == "ivf" and said["hits"][0]["pmid"] == 1
    assert go("query", "--model", "m", "--flat-only", "--top-k", "1", "liver", "children") == 0
    assert "1. PMID 2" in capsys.readouterr().out
    assert go("query", "--model", "m", " ") == 2 and go() == 2


def test_benchmark(capsys):
    assert main(["benchmark", "--model", "m", "--batches", "2", "--warmup", "0"]) == 0
    assert "texts/s" in capsys.readouterr().out


def test_benchmark_of_two(capsys):
    assert main(["benchmark", "--model", "m", "--batches", "1", "--warmup", "0", "--against", "hashing"]) == 0
    assert "ratio" in capsys.readouterr().out
    assert main(["benchmark", "--model", "m", "--against", "nothing"]) == 1


@pytest.mark.parametrize("bad", [["query"], ["nothing"], ["profile", "--word-bins", "x"]])
def test_wrong_arguments(bad):
    assert main(bad) == 2
