"""Command line: python -m panelforge COMMAND ...; each command prints one JSON value or writes a folder."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from panelforge.plans import delivery
from panelforge.sources import files, sinks


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="panelforge")
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, what: str, *arguments: str) -> argparse.ArgumentParser:
        one = commands.add_parser(name, help=what)
        for a in arguments:
            one.add_argument(a)
        return one

    add("inspect", "tables of a SQLite file, or columns and first rows of a CSV file", "path")
    add("discover", "import files below a folder", "folder", "pattern")
    add("tables", "tables that an import lists and holds", "path")
    add("deliver", "merge batches (Parquet) into a candidate folder and seal it", "batches", "out").add_argument("--order", nargs="*", help="batches after the base, oldest first")
    add("quality", "evidence of three panels (Parquet) as Parquet tables", "base", "incoming", "final", "out").add_argument("--additive", action="store_true")
    add("gate", "what keeps a candidate shut", "candidate", "decisions", "accepted")
    add("seal", "write a folder's manifest", "folder")
    add("verify", "files that changed since the seal", "folder")
    one = add("publish", "copy a sealed candidate to a named release", "candidate", "releases", "label")
    one.add_argument("--warnings", type=int, default=0)
    one.add_argument("--accept-warnings", action="store_true")
    add("recover", "end an interrupted publication", "releases")
    return top


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.toLocalIterator()]


def run(arguments: list[str], spark: SparkSession) -> object:
    a = _parser().parse_args(arguments)
    if a.command == "inspect":
        return files.inspect(spark, a.path)
    if a.command == "discover":
        return _rows(files.discover(spark, a.folder, a.pattern))
    if a.command == "tables":
        return _rows(files.import_tables(spark, a.path).orderBy("name"))
    if a.command == "deliver":
        batches = spark.read.parquet(a.batches)
        done = delivery.deliver(delivery.ordered(batches, a.order) if a.order else batches)
        for name in ("merged", "events", "skipped", "counts", "findings"):
            sinks.write_parquet(getattr(done, name), f"{a.out}/{name}", verify=name == "merged")
        if not done.mismatches.isEmpty():
            raise ValueError("the merge differs from its replay")
        sinks.seal(a.out)
        return {"candidate": a.out}
    if a.command == "quality":
        panels = [spark.read.parquet(p) for p in (a.base, a.incoming, a.final)]
        for name, df in delivery.quality(*panels, additive=a.additive).items():
            df.write.parquet(f"{a.out}/{name}")
        return {"evidence": a.out}
    if a.command == "gate":
        read = lambda path: spark.read.option("header", True).csv(path)
        return _rows(delivery.gate(spark.read.parquet(f"{a.candidate}/findings"), read(a.decisions), read(a.accepted)).orderBy("table_name", "id"))
    if a.command == "seal":
        sinks.seal(a.folder)
        return {"sealed": a.folder}
    if a.command == "verify":
        return sinks.verify(a.folder)
    if a.command == "recover":
        return sinks.recover(a.releases)
    return sinks.publish(a.candidate, a.releases, a.label, a.accept_warnings, a.warnings)


if __name__ == "__main__":
    print(json.dumps(run(sys.argv[1:], SparkSession.builder.appName("panelforge").getOrCreate()), default=str, indent=2))
