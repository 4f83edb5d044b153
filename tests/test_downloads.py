import gzip
import sys
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from klangwerk import __main__ as cli
from klangwerk.operators import pronounce
from klangwerk.sources import downloads


class Site:
    """A server of one file whose answers a test sets."""

    def __init__(self):
        self.body, self.tag, self.get_tag, self.told, self.gets = gzip.compress(b"{}\n"), '"a"', None, None, 0
        site = self

        class Handler(BaseHTTPRequestHandler):
            def _answer(self, tag):
                self.send_response(200)
                if tag:
                    self.send_header("ETag", tag)
                self.send_header("Last-Modified", "Mon, 02 Mar 2026 23:30:00 GMT")
                self.send_header("Content-Length", str(site.told or len(site.body)))
                self.end_headers()

            def do_HEAD(self):
                self._answer(site.tag)

            def do_GET(self):
                site.gets += 1
                self._answer(site.get_tag or site.tag)
                self.wfile.write(site.body)

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}/dump.jsonl.gz"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()


@pytest.fixture
def site():
    made = Site()
    yield made
    made.server.shutdown()
    made.server.server_close()


def test_unchanged_files_stay(site, tmp_path):
    path = str(tmp_path / "d.gz")
    first, new = downloads.download(site.url, path)
    assert new and gzip.open(path).read() == b"{}\n" and first.n_bytes == len(site.body) and downloads.read_receipt(path) == first
    assert downloads.download(site.url, path) == (first, False) and site.gets == 1
    # a file that was changed here, a new tag, a lost receipt and a server without tags: fetched again
    (tmp_path / "d.gz").write_bytes(b"x")
    assert downloads.download(site.url, path)[1] and gzip.open(path).read() == b"{}\n"
    site.tag, site.body = '"b"', gzip.compress(b"[]\n")
    assert downloads.download(site.url, path)[1] and gzip.open(path).read() == b"[]\n"
    (tmp_path / "d.gz.receipt.json").write_text('{"url": 1}')
    assert downloads.download(site.url, path)[1] and not downloads.download(site.url, path)[1]
    site.tag = None
    assert downloads.download(site.url, path)[1] and downloads.download(site.url, path)[1]


def test_failures_keep_the_former_file(site, tmp_path):
    path = str(tmp_path / "d.gz")
    first, _ = downloads.download(site.url, path)
    good = site.body
    for body, get_tag, told, message in (
        (gzip.compress(b""), None, None, "holds nothing"), (b"no archive", None, None, "damaged"), (good[:-4], None, None, "damaged"),
        (good, '"c"', None, "changed"), (good, None, len(good) + 5, "bytes came|IncompleteRead"),
    ):
        site.tag, site.body, site.get_tag, site.told = '"b"', body, get_tag, told
        with pytest.raises(downloads.DownloadError, match=message):
            downloads.download(site.url, path)
        assert (tmp_path / "d.gz").read_bytes() == good and downloads.read_receipt(path) == first
        assert {p.name for p in tmp_path.iterdir()} == {"d.gz", "d.gz.receipt.json"}
    site.server.shutdown()
    site.server.server_close()
    with pytest.raises(downloads.DownloadError):
        downloads.download(site.url, path)


def test_fetch_names_files_by_their_addresses(site, tmp_path, capsys):
    cli.main(["fetch", site.url, "--out", str(tmp_path / "a")])
    cli.main(["fetch", site.url, "--out", str(tmp_path / "a")])
    assert [line.split()[1:] for line in capsys.readouterr().out.splitlines()] == [["fetched", "v20260302"], ["unchanged", "v20260302"]]
    for urls in ([site.url, site.url + "?again"], [site.url.replace("dump.jsonl.gz", "")]):
        with pytest.raises(SystemExit):
            cli.main(["fetch", *urls, "--out", str(tmp_path / "a")])


def test_an_engine_is_known_by_its_files(tmp_path):
    engine, data = tmp_path / "engine", tmp_path / "data"
    (data / "deep").mkdir(parents=True)
    (data / "deep" / "voice").write_text("a")
    engine.write_text(f"#!{sys.executable}\nprint('toy: 1.0  Data at: {data}')\n")
    engine.chmod(0o755)
    assert pronounce.files(str(engine)) == sorted([str(engine.resolve()), str(data / "deep" / "voice")])
    before = pronounce.fingerprint(str(engine))
    assert before.startswith("toy: 1.0") and pronounce.fingerprint(str(engine)) == before
    (data / "deep" / "voice").write_text("b")
    assert pronounce.fingerprint(str(engine)) != before
    # a binary's libraries are among its files
    assert any(".so" in p for p in pronounce.files(sys.executable))
