"""Which loads of a lake count: a journal that makes replacing a file's rows one step.

A load is one input file's rows of one run, in the partitions ``load=<key>@<run>``.
A run first notes the keys it is going to write (an *intent*), then writes, then
renames the note to *done*: that rename is the moment from which its rows count
and those of earlier runs with the same keys do not.  Whatever crashes before or
after leaves either the old rows or the new ones counted, never both or neither.
Partitions that do not count are deleted at last, and the note with them, so
that a lake at rest has an empty journal and is read without any filter.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

JOURNAL = "_loads"
RUN_MARK = "@"


class Journal:
    """The notes in ``<lake>/_loads``, through the Hadoop file system that holds the lake."""

    def __init__(self, spark: SparkSession, lake: str):
        self.spark, self.lake, self.folder = spark, lake, f"{lake}/{JOURNAL}"
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(lake).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def begin(self, run: str, keys: list[str]) -> None:
        out = self._fs.create(self._path(f"{self.folder}/{run}.intent"), False)
        try:
            out.write(bytearray(json.dumps(sorted(keys)).encode()))
        finally:
            out.close()

    def commit(self, run: str) -> None:
        if not self._fs.rename(self._path(f"{self.folder}/{run}.intent"), self._path(f"{self.folder}/{run}.done")):
            raise RuntimeError(f"the load {run} of {self.lake} could not be committed")

    def notes(self) -> list[tuple[str, str, set[str]]]:
        """(run, 'intent' or 'done', keys) of every note, in the order in which they were committed or begun."""
        folder = self._path(self.folder)
        if not self._fs.exists(folder):
            return []
        found = []
        for s in self._fs.listStatus(folder):
            run, _, state = s.getPath().getName().rpartition(".")
            if state in ("intent", "done"):
                stream = self._fs.open(s.getPath())
                try:
                    text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                finally:
                    stream.close()
                found.append((run, state, set(json.loads(text))))
        return sorted(found)

    def partitions(self) -> dict[str, list[str]]:
        """Load value -> its partition folders, from one listing of the lake's partitions."""
        utils = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        out: dict[str, list[str]] = {}
        for s in self._fs.globStatus(self._path(f"{self.lake}/year=*/load=*")) or []:
            out.setdefault(utils.unescapePathName(s.getPath().getName().removeprefix("load=")), []).append(str(s.getPath()))
        return out

    def void(self, there) -> set[str]:
        """Of the load values ``there`` those that do not count."""
        return void_loads(self.notes(), there)

    def drop_run(self, run: str) -> None:
        """Delete the partitions of a run that could not be committed."""
        for value, folders in self.partitions().items():
            if value.endswith(RUN_MARK + run):
                for folder in folders:
                    self._fs.delete(self._path(folder), True)

    def clean(self, run: str) -> None:
        """Delete what the committed run has replaced, then its note."""
        notes = self.notes()
        keys = next(k for r, _, k in notes if r == run)
        held = self.partitions()
        for value in void_loads(notes, held):
            if key_of(value) in keys:
                for folder in held[value]:
                    self._fs.delete(self._path(folder), True)
        for other, _, theirs in notes:  # also those of runs that broke off and have nothing left
            if other == run or theirs <= keys and other < run:
                self._fs.delete(self._path(f"{self.folder}/{other}.intent"), False)
                self._fs.delete(self._path(f"{self.folder}/{other}.done"), False)


def key_of(value: str) -> str:
    return value.rpartition(RUN_MARK)[0] or value


def void_loads(notes: list[tuple[str, str, set[str]]], there) -> set[str]:
    """Of the load values ``there``: rows of a run that is not committed, and rows that a committed run has replaced."""
    latest: dict[str, str] = {}
    pending = set()
    for run, state, keys in notes:
        for k in keys:
            if state == "done":
                latest[k] = max(run, latest.get(k, ""))
            else:
                pending.add(f"{k}{RUN_MARK}{run}")
    return {v for v in there if v in pending or key_of(v) in latest and v != f"{key_of(v)}{RUN_MARK}{latest[key_of(v)]}"
            and (RUN_MARK not in v or v.rpartition(RUN_MARK)[2] < latest[key_of(v)])}
