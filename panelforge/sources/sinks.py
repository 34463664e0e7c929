"""Sinks: panels as Parquet, CSV, JSON lines or SQLite, written aside, checked, and published as named releases."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import sqlite3
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from panelforge.operators.repair import multiset_difference

# Fixed value: what a release may be called.
LABEL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,79}")


def write_parquet(df: DataFrame, path: str, partition: str | None = None, verify: bool = True) -> None:
    """Write df, read it again and compare all rows as multisets."""
    out = df.write.mode("errorifexists")
    (out.partitionBy(partition) if partition else out).parquet(path)
    if verify:
        back = df.sparkSession.read.parquet(path).select(*df.columns)
        if not multiset_difference(df, back).isEmpty():
            raise ValueError(f"{path} doesn't hold what was written")


def flat(df: DataFrame) -> DataFrame:
    """df with nested columns as JSON text, as CSV needs them."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    return df.withColumns({n: F.to_json(n) for n in nested}) if nested else df


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def write_json(value: object, path: str) -> None:
    """A small JSON file, never half written; NaN is an error."""
    aside = f"{path}.part"
    Path(aside).write_text(json.dumps(value, allow_nan=False, indent=2, sort_keys=True), encoding="utf-8")
    os.replace(aside, path)


def write_sqlite(wide: DataFrame, path: str, name: str) -> None:
    """One series as a SQLite table, streamed row by row in key order; for single tables, as clients of the format want them."""
    if wide.columns != list(dict.fromkeys(wide.columns)):
        raise ValueError("repeated column")
    quote = lambda n: '"' + n.replace('"', '""') + '"'
    kinds = {"string": "VARCHAR(255)", "double": "DOUBLE(53)", "int": "INTEGER", "bigint": "INTEGER"}
    with sqlite3.connect(path) as db:
        db.execute(f"CREATE TABLE {quote(name)} ({', '.join(f'{quote(c)} {kinds[t]}' for c, t in wide.dtypes)})")
        rows = (tuple(r) for r in wide.orderBy(*[c for c, t in wide.dtypes if t == "string"]).toLocalIterator())
        db.executemany(f"INSERT INTO {quote(name)} VALUES ({', '.join('?' * len(wide.columns))})", rows)


def digest(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def manifest(folder: str) -> dict[str, str]:
    """Hash of each file below a folder."""
    root = Path(folder)
    return {str(p.relative_to(root)): digest(str(p)) for p in sorted(root.rglob("*")) if p.is_file() and p.name != "manifest.json"}


def seal(folder: str) -> None:
    write_json(manifest(folder), f"{folder}/manifest.json")


def verify(folder: str) -> list[str]:
    """Files that are missing, added or changed since the folder was sealed."""
    was, now = json.loads(Path(folder, "manifest.json").read_text()), manifest(folder)
    return sorted(k for k in was.keys() | now.keys() if was.get(k) != now.get(k))


def inputs(folder: str, marker: str = ".generated") -> dict[str, str]:
    """Hash of each input file directly in a folder, taken before anything is written; packages marked as generated are left out."""
    root = Path(folder)
    return {p.name: digest(str(p)) for p in sorted(root.iterdir()) if p.is_file() and p.name != marker and not (root / f"{p.name}{marker}").exists() and not p.name.endswith(marker)}


def publish(candidate: str, releases: str, label: str, warnings_accepted: bool = False, warnings: int = 0) -> str:
    """Copy a sealed candidate to a named release; an existing name, a broken seal or unaccepted warnings stop it.

    A journal names what is under way until the release bears its name; `recover` ends what a crash left behind.
    """
    if not LABEL.fullmatch(label):
        raise ValueError(f"no release label: {label}")
    if verify(candidate):
        raise ValueError("the candidate has changed since it was sealed")
    if warnings and not warnings_accepted:
        raise ValueError(f"{warnings} warnings aren't accepted")
    target = Path(releases, label)
    if target.exists():
        raise FileExistsError(target)
    recover(releases)
    write_json({"label": label, "candidate": str(Path(candidate).resolve())}, str(Path(releases, JOURNAL)))
    aside = Path(releases, f".{label}.part")
    shutil.copytree(candidate, aside)
    if verify(str(aside)):
        raise ValueError("the copy differs from the sealed candidate")
    os.replace(aside, target)
    Path(releases, JOURNAL).unlink()
    return str(target)


JOURNAL = "pending.json"


def recover(releases: str) -> str | None:
    """End a publication that was interrupted: its half copy is removed, a release that is whole stays. Returns its label."""
    journal = Path(releases, JOURNAL)
    if not journal.exists():
        return None
    label = json.loads(journal.read_text())["label"]
    if not LABEL.fullmatch(label):
        raise ValueError(f"no release label in the journal: {label}")
    shutil.rmtree(Path(releases, f".{label}.part"), ignore_errors=True)
    target = Path(releases, label)
    if target.exists() and verify(str(target)):
        raise ValueError(f"{target} isn't what was sealed; it needs a look")
    journal.unlink()
    return label
