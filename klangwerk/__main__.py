"""python -m klangwerk fetch|build|report: archives from their addresses, a release from archives, or their sizes and digests."""

from __future__ import annotations

import argparse
import os
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession

from klangwerk.functions import inventory as inv
from klangwerk.operators import pronounce
from klangwerk.plans.build import Build, release_name
from klangwerk.session import ship
from klangwerk.sources import downloads, dumps, sinks


def fetch(urls: list[str], folder: str) -> None:
    """Each archive under the last part of its address, which no two may share."""
    paths = [os.path.join(folder, os.path.basename(unquote(urlsplit(url).path))) for url in urls]
    if len(set(paths)) < len(paths) or any(not os.path.basename(p) for p in paths):
        raise SystemExit("the addresses don't give each archive a name of its own")
    os.makedirs(folder, exist_ok=True)
    with sinks.build_lock(folder):
        for url, path in zip(urls, paths):
            got, new = downloads.download(url, path)
            print(path, "fetched" if new else "unchanged", release_name(got.last_modified) if got.last_modified else "undated")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="klangwerk", description=__doc__)
    todo = parser.add_subparsers(dest="todo", required=True)
    build, report = todo.add_parser("build"), todo.add_parser("report")
    for p in (build, report):
        p.add_argument("archives", nargs="+")
        p.add_argument("--out", required=True)
    build.add_argument("--release-version", required=True)
    build.add_argument("--engine", default="espeak-ng")
    build.add_argument("--language", action="append", choices=inv.LANGUAGES)
    build.add_argument("--report-only", action="store_true", help="keep source pronunciations that differ very much from generated ones")
    build.add_argument("--extreme-distance", type=float, default=0.8)
    load = todo.add_parser("fetch")
    load.add_argument("urls", nargs="+")
    load.add_argument("--out", required=True, help="the folder of the archives")
    asked = parser.parse_args(argv)
    if asked.todo == "fetch":
        fetch(asked.urls, asked.out)
        return
    spark = ship(SparkSession.builder.getOrCreate())
    if asked.todo == "report":
        sinks.check_paths(asked.archives, [asked.out])
        rows = dumps.fingerprints(spark, asked.archives).collect()
        sinks.write_report({"archives": [r.asDict() for r in rows]}, asked.out)
    else:
        pronouncer, version = pronounce.command(pronounce.resolve(asked.engine)), pronounce.fingerprint(asked.engine)
        languages = tuple(asked.language or inv.LANGUAGES)
        Build(spark, asked.out, asked.release_version, pronouncer, version, languages, not asked.report_only, asked.extreme_distance).from_dumps(asked.archives)


if __name__ == "__main__":
    main()
