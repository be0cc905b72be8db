"""Published report tables: versioned folders and one pointer that is moved last.

``<target>/versions/<run>/<table>`` holds what one run built; ``<target>/pointer/<number>.json`` says for every
table in which version it is. A run adds its pointer as a new file that is renamed to its name when it is complete,
and readers take the greatest number, so all tables of a report change at once: a run that stops
before leaves the report as it was.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .sinks import file_system

KEEP = 2        # versions that the last so many pointers name stay for readers that have resolved them


def version_path(target: str, run: str, table: str = "") -> str:
    return "/".join([target.rstrip("/"), "versions", run, *([table] if table else [])])


def _pointers(spark: SparkSession, target: str) -> list[str]:
    """Names of the complete pointers, oldest first."""
    fs, folder = file_system(spark, f"{target.rstrip('/')}/pointer")
    if not fs.exists(folder):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.endswith(".json"))


def _read(spark: SparkSession, target: str, name: str) -> dict[str, str]:
    return json.loads(spark.read.text(f"{target.rstrip('/')}/pointer/{name}", wholetext=True).first()[0])


def current(spark: SparkSession, target: str) -> dict[str, str]:
    """The version that each published table is in."""
    names = _pointers(spark, target)
    return _read(spark, target, names[-1]) if names else {}


def read_published(spark: SparkSession, target: str, table: str) -> DataFrame:
    """A table of the report as it is now. Tables read one after the other may be of two
    reports; ``current`` and ``version_path`` give those of one."""
    versions = current(spark, target)
    if table not in versions:
        raise ValueError(f"{table} is not published under {target}")
    return spark.read.parquet(version_path(target, versions[table], table))


def move_pointer(spark: SparkSession, target: str, changed: dict[str, str]) -> None:
    """*Action*: from now on the ``changed`` tables (table -> version) are read, the others stay. Two runs that
    publish at the same time cannot both move it: the second one fails."""
    names = _pointers(spark, target)
    versions = {**(_read(spark, target, names[-1]) if names else {}), **changed}
    number = int(names[-1].split(".")[0]) + 1 if names else 1
    fs, new = file_system(spark, f"{target.rstrip('/')}/pointer/{number:012d}.json")
    _, temporary = file_system(spark, f"{target.rstrip('/')}/pointer/.{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps(versions, indent=1).encode()))
    out.close()
    if fs.exists(new) or not fs.rename(temporary, new):
        fs.delete(temporary, False)
        raise RuntimeError(f"another run published to {target} at the same time")


def drop_version(spark: SparkSession, target: str, run: str) -> None:
    fs, path = file_system(spark, version_path(target, run))
    fs.delete(path, True)


def drop_old_versions(spark: SparkSession, target: str, keep: int = KEEP) -> None:
    """*Action*: remove the versions that none of the last ``keep`` pointers names, and older pointers."""
    names = _pointers(spark, target)
    named = {run for n in names[-keep:] for run in _read(spark, target, n).values()}
    before = {run for n in names[:-keep] for run in _read(spark, target, n).values()}
    for run in before - named:
        drop_version(spark, target, run)
    for n in names[:-keep]:
        fs, path = file_system(spark, f"{target.rstrip('/')}/pointer/{n}")
        fs.delete(path, False)
