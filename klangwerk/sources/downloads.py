"""Archives over HTTP, on the driver: what is there already and unchanged is not fetched again."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import zlib
from dataclasses import asdict, dataclass
from http.client import HTTPException
from urllib.request import Request, urlopen

from klangwerk.sources import sinks

CHUNK = 1 << 20
TIMEOUT_S = 60


class DownloadError(Exception):
    """Nothing was replaced."""


@dataclass(frozen=True)
class Receipt:
    """What a file was when it was fetched; last_modified names a release (plans.build.release_name)."""

    url: str
    etag: str
    last_modified: str
    sha256: str
    n_bytes: int


def receipt_path(path: str) -> str:
    return f"{path}.receipt.json"


def read_receipt(path: str) -> Receipt | None:
    """The receipt beside path, if it can be read."""
    try:
        with open(receipt_path(path), encoding="utf-8") as f:
            return Receipt(**json.load(f))
    except (OSError, ValueError, TypeError):
        return None


def check_archive(path: str) -> None:
    """Reads a gzip file to its end: an error where it is damaged or holds nothing."""
    empty = True
    try:
        with gzip.open(path) as f:
            while f.read(CHUNK):
                empty = False
    except (OSError, EOFError, zlib.error) as e:
        raise DownloadError(f"{path}: damaged archive: {e}") from e
    if empty:
        raise DownloadError(f"{path}: the archive holds nothing")


def _body(url: str, etag: str, out) -> tuple[str, int]:
    """(digest, bytes) of what was written to out."""
    sha, size = hashlib.sha256(), 0
    with urlopen(url, timeout=TIMEOUT_S) as got:
        if (got.headers.get("ETag") or "") != etag:
            raise DownloadError(f"{url}: changed while it was asked for")
        while chunk := got.read(CHUNK):
            out.write(chunk)
            sha.update(chunk)
            size += len(chunk)
        told = got.headers.get("Content-Length")
    if told is not None and int(told) != size:
        raise DownloadError(f"{url}: {size} of {told} bytes came")
    return sha.hexdigest(), size


def download(url: str, path: str) -> tuple[Receipt, bool]:
    """The archive at path, and whether it had to be fetched. After a failure, the former file and its receipt are still there.

    A file is taken as it is if the server names the same entity tag as its receipt and its digest is the
    receipt's; without a tag it is fetched each time. The file is replaced before its receipt, so that a stop
    between the two leaves a receipt that does not fit and the next call fetches again.
    """
    try:
        with urlopen(Request(url, method="HEAD"), timeout=TIMEOUT_S) as head:
            etag, modified = head.headers.get("ETag") or "", head.headers.get("Last-Modified") or ""
        known = read_receipt(path)
        if etag and known and (known.url, known.etag) == (url, etag) and os.path.exists(path) and sinks.digest(path) == known.sha256:
            return known, False
        part = f"{path}.{os.getpid()}.part"
        try:
            with open(part, "wb") as out:
                sha, size = _body(url, etag, out)
            check_archive(part)
            os.replace(part, path)
        finally:
            if os.path.exists(part):
                os.unlink(part)
    except (OSError, HTTPException) as e:
        raise DownloadError(f"{url}: {e}") from e
    new = Receipt(url, etag, modified, sha, size)
    sinks.write_report(asdict(new), receipt_path(path))
    return new, True
