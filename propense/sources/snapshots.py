"""Tables as snapshots below a path.

Every write goes to a folder of its own and is named by an entry, a small file that is written last and
has the folder's schema and row count. The entries of the newest generation are the table: one base, and
the rows appended to it. A write that fails leaves no entry, so the table stays as it was; a table can be
replaced from itself; two writers that append have an entry each. Of two that replace at the same time
one has the last word. Reading takes schemas from entries and opens no file for them.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRIES = "_entries"
# What rows are appended to before there is a base.
NO_BASE = f"{0:012d}-none"


@dataclass(frozen=True)
class Entry:
    name: str
    folder: str
    schema: str
    rows: int


@dataclass(frozen=True)
class Snapshots:
    spark: SparkSession
    path: str

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path.rstrip("/"), *parts]))

    def _files(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        files, folder = self._files(), self._at(ENTRIES)
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(n for n in names if n.endswith(".json") and not n.startswith("."))

    def _read(self, name: str) -> Entry:
        stream = self._files().open(self._at(ENTRIES, name))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Entry(name, **json.loads(text))

    def _current(self) -> tuple[str, list[str]]:
        """The newest base, and the names of its entries, in the order in which they were made."""
        names = self._names()
        bases = [n.removesuffix(".json") for n in names if "+" not in n]
        base = max(bases, default=NO_BASE)
        return base, [n for n in names if n == f"{base}.json" or n.startswith(f"{base}+")]

    def entries(self) -> list[Entry]:
        """What the table is made of; empty where there is no table."""
        _, names = self._current()
        # the base sorts behind what was appended to it, as "+" comes before "."
        return [self._read(n) for n in sorted(names, key=lambda n: ("+" in n, n))]

    def exists(self) -> bool:
        return bool(self._current()[1])

    def read(self) -> DataFrame:
        """All rows; columns that some of the writes lack are NULL there."""
        by_schema: dict[str, list[str]] = {}
        for entry in self.entries():
            by_schema.setdefault(entry.schema, []).append(f"{self.path.rstrip('/')}/{entry.folder}")
        if not by_schema:
            raise ValueError(f"no table at {self.path}")
        frames = [
            self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*folders)
            for schema, folders in by_schema.items()
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def rows(self) -> int:
        """Number of rows, without reading them."""
        return sum(entry.rows for entry in self.entries())

    def _write(self, df: DataFrame, name: str) -> int:
        folder = f"data-{uuid.uuid4().hex}"
        observed = Observation()
        counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
        counted.write.parquet(f"{self.path.rstrip('/')}/{folder}")
        rows = observed.get["rows"]
        text = json.dumps({"folder": folder, "schema": df.schema.json(), "rows": rows})
        files, draft = self._files(), self._at(ENTRIES, f".{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        # the name is like no other, so no entry of another writer is in the way
        if not files.rename(draft, self._at(ENTRIES, f"{name}.json")):
            raise OSError(f"cannot write the entry {name} of {self.path}")
        return rows

    def replace(self, df: DataFrame) -> int:
        """Write the table anew; returns the number of rows."""
        base, _ = self._current()
        generation = int(base.split("-")[0]) + 1
        return self._write(df, f"{generation:012d}-{uuid.uuid4().hex}")

    def append(self, df: DataFrame) -> int:
        base, _ = self._current()
        return self._write(df, f"{base}+{time.time_ns():020d}-{uuid.uuid4().hex}")

    def expire(self, seconds: float) -> int:
        """Delete folders and entries that are not current and older than that; returns how many.

        The age must be above that of the longest read and write, as both use folders that are not current.
        """
        files = self._files()
        current = {e.folder for e in self.entries()} | {e.name for e in self.entries()}
        before = (time.time() - seconds) * 1000
        gone = 0
        for folder, keep in ((ENTRIES, ()), ("", (ENTRIES,))):
            if not files.exists(self._at(folder) if folder else self._at()):
                continue
            for status in files.listStatus(self._at(folder) if folder else self._at()):
                name = status.getPath().getName()
                if name not in current and name not in keep and status.getModificationTime() < before:
                    gone += bool(files.delete(status.getPath(), True))
        return gone
