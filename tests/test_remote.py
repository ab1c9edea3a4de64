import http.server
import threading

import pytest

from corpusmill.cli import main
from corpusmill.sources import remote
from test_intake import article, write


@pytest.fixture()
def server(tmp_path):
    folder = tmp_path / "served"
    for name in ("base", "updates"):
        (folder / name).mkdir(parents=True)
    asked = []

    class Handler(http.server.SimpleHTTPRequestHandler):
        def __init__(self, *a):
            super().__init__(*a, directory=str(folder))

        def log_message(self, *a):
            asked.append((self.command, self.path))

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", folder, asked
    s.shutdown()


def test_download_and_refetch(spark, tmp_path, server, capsys):
    url, folder, asked = server
    write(folder / "base" / "b25n1.xml.gz", article(1, "one"))
    write(folder / "updates" / "u25n2.xml.gz", article(2, "two"))
    (folder / "base" / "notes.txt").write_text("x")
    root = tmp_path / "data"
    go = lambda *x: main(["--data-dir", str(root), *x], spark)
    pages = ["--url", f"{url}/base/", "--url", f"{url}/updates"]
    assert go("download", *pages) == 0 and "'saved': 2" in capsys.readouterr().out
    assert sorted(p.name for p in root.iterdir()) == ["b25n1.xml.gz", "u25n2.xml.gz"]
    # the same size is left alone, another one isn't
    (root / "b25n1.xml.gz").write_bytes(b"short")
    assert go("download", *pages) == 0 and "'saved': 1, 'skipped': 1" in capsys.readouterr().out
    assert any(c == "HEAD" for c, _ in asked)
    # a corrupt file is fetched again from the directory that has it
    (root / "u25n2.xml.gz").write_bytes(b"\x1f\x8b broken")
    assert go("ingest", "--refetch-url", f"{url}/base", "--refetch-url", f"{url}/updates/") == 0
    assert "'refetched': 1" in capsys.readouterr().out
    with pytest.raises(OSError, match="no directory"):
        remote.refetcher([f"{url}/base"])(str(root / "u25n2.xml.gz"))
    assert remote.remote_size(f"{url}/none") is None
    assert go("download", "--url", f"{url}/none/") == 1
