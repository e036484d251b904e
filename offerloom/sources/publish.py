"""Publishing partitions of several tables in one step.

New folders are staged beside the tables. Once all are whole, a list of the moves is written under a final name: from then on the publication is
decided. The moves are renames, and doing them again does no harm, so a job that dies between two of them is finished by :func:`recover`, which
every publication calls first; one that dies before the list is there leaves the tables as they were.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from offerloom.sources.tables import _file_system

_DECIDED = "moves.json"


def _children(spark: SparkSession, path: str) -> list[str]:
    at, system = _file_system(spark, path)
    return [s.getPath().getName() for s in system.listStatus(at) if s.isDirectory()] if system.exists(at) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole."""
    at, system = _file_system(spark, path)
    hidden, _ = _file_system(spark, f"{path}.new")
    out = system.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.rename(hidden, at)


def _read_text(spark: SparkSession, path: str) -> str | None:
    at, system = _file_system(spark, path)
    if not system.exists(at):
        return None
    opened = system.open(at)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    opened.close()
    return text


def _delete(spark: SparkSession, path: str) -> None:
    at, system = _file_system(spark, path)
    system.delete(at, True)


def _move(spark: SparkSession, staged: str | None, target: str) -> None:
    """Put the staged folder in the target's place. Once it is there, nothing is left to do."""
    to, system = _file_system(spark, target)
    if staged is None:
        system.delete(to, True)
        return
    at, _ = _file_system(spark, staged)
    if system.exists(at):
        system.delete(to, True)
        system.mkdirs(to.getParent())
        if not system.rename(at, to):
            raise OSError(f"cannot move {staged} to {target}")


def _finish(spark: SparkSession, folder: str) -> None:
    for staged, target in json.loads(_read_text(spark, f"{folder}/{_DECIDED}")):
        _move(spark, staged, target)
    _delete(spark, folder)


def recover(spark: SparkSession, root: str) -> None:
    """Finish publications below ``root`` that were decided, and drop what others left."""
    for name in _children(spark, root):
        if name.startswith("_publish-"):
            folder = f"{root}/{name}"
            if _read_text(spark, f"{folder}/{_DECIDED}") is None:
                _delete(spark, folder)
            else:
                _finish(spark, folder)


class Publication:
    """Stage partitions of tables, then publish all of them. One writer per ``root`` at a time."""

    def __init__(self, spark: SparkSession, root: str):
        recover(spark, root)
        self.spark = spark
        self.folder = f"{root}/_publish-{uuid.uuid4().hex}"
        self.moves: list[tuple[str | None, str]] = []

    def stage(self, df: DataFrame, path: str, col: str, clear: Iterable[object] = (), order: Sequence[str] = ()) -> set[str]:
        """Write ``df`` by ``col``; each of its partitions is to replace that of the table. Partitions ``clear`` without rows are to go.

        The plan runs once: the partitions are read off the staged folders. Returns their values.
        """
        staged = f"{self.folder}/{len(self.moves)}"
        out = df.hint("rebalance", col)
        out = out.sortWithinPartitions(col, *order) if order else out
        out.write.partitionBy(col).parquet(staged)
        names = [n for n in _children(self.spark, staged) if re.match(rf"{re.escape(col)}=", n)]
        self.moves += [(f"{staged}/{n}", f"{path}/{n}") for n in names]
        values = {n[len(col) + 1 :] for n in names}
        self.moves += [(None, f"{path}/{col}={value}") for value in sorted({str(v) for v in clear} - values)]
        # A table whose partitions all go is still a table.
        at, system = _file_system(self.spark, path)
        system.mkdirs(at)
        return values

    def publish(self) -> None:
        self.decide()
        _finish(self.spark, self.folder)

    def decide(self) -> None:
        at, system = _file_system(self.spark, self.folder)
        system.mkdirs(at)
        _write_text(self.spark, f"{self.folder}/{_DECIDED}", json.dumps(self.moves))
