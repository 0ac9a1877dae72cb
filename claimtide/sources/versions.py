"""Tables in versions: parts are written first, then one small log entry publishes them.

A reader takes the newest entry and sees all tables as that one left them. An
entry is written aside and renamed to its number without overwriting, so of two
writers with the same base one fails and leaves nothing behind that is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

Fold = Callable[[DataFrame], DataFrame]


class Conflict(RuntimeError):
    """Another writer has published the version that this one was to become."""


class VersionedTables:
    """Named tables under a folder every executor can reach.

    A table is a list of parts, each with a level. `replace` gives a table one
    new part. `append` adds a part of level 0; as soon as `fan` parts of one
    level stand together they are folded to one of the next level, so a table of
    n appended parts has at most about `fan` times log(n) of them, and each row
    is rewritten about log(n) times. `fold` says how rows of several parts
    become one, else they are kept as they are. `partitions` names the columns
    whose values become folders of a table's folded parts; fresh parts are kept
    as written, so they don't fall into a file per task and value. `options`
    are the writer's for a table.

    A commit may carry the name of a run. A run that any kept entry names is
    not repeated, so a run that is started again changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, fan: int = 8, partitions: dict[str, list[str]] | None = None, options: dict[str, dict[str, str]] | None = None):
        self.spark, self.path, self.fan = spark, path, fan
        self.partitions, self.options = partitions or {}, options or {}

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _numbers(self) -> list[int]:
        files, folder = self._files(f"{self.path}/log")
        if not files.exists(folder):
            return []
        names = (entry.getPath().getName() for entry in files.listStatus(folder))
        return sorted(int(name) for name in names if name.isdigit())

    def _entry(self, number: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/log/{number:010d}", wholetext=True).first()[0])

    def _publish(self, entry: dict) -> None:
        jvm, number = self.spark._jvm, entry["number"]
        files, aside = self._files(f"{self.path}/log/_{number}-{uuid.uuid4().hex}")
        _, place = self._files(f"{self.path}/log/{number:010d}")
        stream = files.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(entry).encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(aside), files.makeQualified(place), no_options)
        except Py4JJavaError as error:
            files.delete(aside, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise Conflict(f"version {number} of {self.path} exists") from error
            raise

    def version(self) -> int:
        """Number of the newest entry; 0 before the first."""
        return max(self._numbers(), default=0)

    def latest(self, version: int | None = None) -> dict:
        number = self.version() if version is None else version
        return self._entry(number) if number else {"number": 0, "run": None, "tables": {}}

    def has_run(self, run: str) -> bool:
        return any(self._entry(n)["run"] == run for n in reversed(self._numbers()))

    def _read(self, parts: list[dict]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.path}/{p['part']}") for p in parts])

    def table(self, name: str, version: int | None = None) -> DataFrame | None:
        """The table as of a version, the newest by default; None before its first row set."""
        parts = self.latest(version)["tables"].get(name)
        return self._read(parts) if parts else None

    def _write(self, name: str, rows: DataFrame, level: int) -> dict:
        part = f"data/{name}-{uuid.uuid4().hex}"
        writer = rows.write.options(**self.options.get(name, {}))
        writer.partitionBy(*(self.partitions.get(name, []) if level else [])).parquet(f"{self.path}/{part}")
        return {"part": part, "level": level}

    def _folded(self, name: str, parts: list[dict], fold: Fold | None) -> list[dict]:
        while len(parts) >= self.fan and len({p["level"] for p in parts[-self.fan :]}) == 1:
            last = parts[-self.fan :]
            rows = self._read(last)
            parts = [*parts[: -self.fan], self._write(name, fold(rows) if fold else rows, last[0]["level"] + 1)]
        return parts

    def commit(
        self,
        run: str | None = None,
        replace: dict[str, DataFrame] | None = None,
        append: dict[str, DataFrame] | None = None,
        folds: dict[str, Fold] | None = None,
        base: int | None = None,
    ) -> int:
        """Publish new contents of tables together; the number of the version that holds them.

        `base`: the version the rows were worked out from; if another has been
        published since, the commit fails with Conflict.
        """
        now = self.latest()
        if run is not None and self.has_run(run):
            return now["number"]
        if base is not None and base != now["number"]:
            raise Conflict(f"version {base} of {self.path} is not the newest")
        tables = dict(now["tables"])
        for name, rows in (replace or {}).items():
            tables[name] = [self._write(name, rows, 0)]
        for name, rows in (append or {}).items():
            parts = [*tables.get(name, []), self._write(name, rows, 0)]
            tables[name] = self._folded(name, parts, (folds or {}).get(name))
        self._publish({"number": now["number"] + 1, "run": run, "tables": tables})
        return now["number"] + 1

    def expire(self, keep: int = 4) -> None:
        """Forget all versions but the newest `keep`, and the parts only they had.

        Readers of a forgotten version fail; so may a writer that is about to
        publish, whose parts no entry names yet: run it between commits.
        """
        numbers = self._numbers()
        stay = numbers[-keep:]
        used = {p["part"] for n in stay for parts in self._entry(n)["tables"].values() for p in parts}
        for number in numbers[:-keep]:
            files, place = self._files(f"{self.path}/log/{number:010d}")
            files.delete(place, False)
        files, folder = self._files(f"{self.path}/data")
        if files.exists(folder):
            for entry in files.listStatus(folder):
                if f"data/{entry.getPath().getName()}" not in used:
                    files.delete(entry.getPath(), True)

