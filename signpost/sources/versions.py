"""Tables whose change becomes visible by one rename, whole or by hashed parts of a key.

Data files are never changed once written. A numbered record in `log/` lists, for each part, the
folders that hold its rows; the highest number is the table. A writer that dies before its record
is renamed into place leaves the earlier table as it was, and two writers that started from one
record cannot both win. Only these records, bounded by the number of parts, pass the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signpost.session import materialize

PART = "_part"

# A stream, by a name that no other has (its checkpoint), and the number of its micro-batch.
Batch = tuple[str, int]


class Conflict(RuntimeError):
    """Another writer was first."""


class VersionedTable:
    """A table under `path`; with `key`, its rows are dealt to `parts` parts by the key's hash.

    Of an existing table the number of parts is the recorded one. The `keep` newest records stay
    readable; what only older ones hold is deleted after a change.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str | None = None,
        parts: int = 64,
        form: str = "parquet",
        keep: int = 3,
    ):
        self.spark, self.path, self.key, self.form = spark, path.rstrip("/"), key, form
        self.keep = max(1, keep)
        self._parts = parts if key else 1
        jvm = spark.sparkContext._jvm
        self._jpath = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        root = self._jpath(self.path)
        self._files = root.getFileSystem(conf)
        # Unlike the renames of a file system, those of a context never replace their target.
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files.makeQualified(root).toUri(), conf
        )
        self._no_option = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self._read_bytes = jvm.org.apache.commons.io.IOUtils.toByteArray

    # --- records -----------------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        at = self._jpath(f"{self.path}/{folder}")
        if not self._files.exists(at):
            return []
        return [s.getPath().getName() for s in self._files.listStatus(at)]

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in self._names("log") if n.isdigit())

    def _record(self, number: int) -> dict:
        stream = self._files.open(self._jpath(f"{self.path}/log/{number}"))
        try:
            return json.loads(bytes(self._read_bytes(stream)).decode())
        finally:
            stream.close()

    def _current(self) -> tuple[int, dict | None]:
        numbers = self._numbers()
        return (numbers[-1], self._record(numbers[-1])) if numbers else (-1, None)

    def _switch(self, number: int, record: dict) -> None:
        """Make `record` the table, if no other writer took its number."""
        draft = self._jpath(f"{self.path}/drafts/{uuid.uuid4().hex}")
        target = self._jpath(f"{self.path}/log/{number}")
        self._files.mkdirs(target.getParent())
        out = self._files.create(draft, False)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        try:
            self._context.rename(draft, target, self._no_option)
        except Exception as error:
            self._files.delete(draft, False)
            if self._files.exists(target):
                raise Conflict(f"{self.path}: record {number} was written by another") from error
            raise
        self._prune()

    def _prune(self) -> None:
        """Delete what no kept record lists, data before the record that names it."""
        numbers = self._numbers()
        kept = {f for n in numbers[-self.keep :] for fs in self._record(n)["folders"].values() for f in fs}
        for n in numbers[: -self.keep]:
            for folder in {f for fs in self._record(n)["folders"].values() for f in fs} - kept:
                self._files.delete(self._jpath(f"{self.path}/{folder}"), True)
            self._files.delete(self._jpath(f"{self.path}/log/{n}"), False)

    # --- reading -----------------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self._numbers())

    def folders(self, parts: list[int] | None = None) -> list[str]:
        """The folders that hold the rows, or those of the given parts."""
        return self._folders(self._current()[1], parts)

    def _folders(self, record: dict | None, parts: list[int] | None) -> list[str]:
        held = record["folders"] if record else {}
        chosen = held if parts is None else [str(p) for p in parts]
        return [f"{self.path}/{f}" for p in chosen for f in held.get(p, [])]

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """The rows as of now; with `parts`, only their files are read."""
        record = self._current()[1]
        if record is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._read(record, parts)

    def _read(self, record: dict, parts: list[int] | None) -> DataFrame:
        schema = StructType.fromJson(record["schema"])
        paths = self._folders(record, parts)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).format(self.form).load(paths)

    # --- writing -----------------------------------------------------------------------

    @staticmethod
    def _applied(record: dict | None, batch: Batch | None) -> bool:
        """Was this batch of its stream applied before?"""
        return bool(record and batch and batch[1] <= record["batches"].get(batch[0], -1))

    def part(self, record: dict | None = None) -> Column:
        """The part of a row, by the hash of its key."""
        n = record["parts"] if record else self._parts
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(n)).cast("int")

    def _write(self, rows: DataFrame, record: dict | None) -> dict[str, str]:
        """Write rows under a new name; the folder of each part that has rows."""
        version = f"data/{uuid.uuid4().hex}"
        if self.key is None:
            rows.write.format(self.form).save(f"{self.path}/{version}")
            return {"0": version}
        # Files follow parts; adaptive execution splits a part that is large and joins small ones.
        dealt = rows.withColumn(PART, self.part(record)).hint("rebalance", PART)
        dealt.write.partitionBy(PART).format(self.form).save(f"{self.path}/{version}")
        names = [n for n in self._names(version) if n.startswith(f"{PART}=")]
        return {n.partition("=")[2]: f"{version}/{n}" for n in names}

    def _commit(self, number: int, record: dict | None, rows: DataFrame, folders: dict, batch: Batch | None) -> None:
        new = {
            "schema": json.loads(rows.schema.json()),
            "parts": record["parts"] if record else self._parts,
            "batches": (record["batches"] if record else {}) | dict([batch] if batch else []),
            "folders": folders,
        }
        self._switch(number + 1, new)

    def replace(self, rows: DataFrame, batch: Batch | None = None) -> None:
        """All rows of the table become `rows`, at once. An empty table is a table."""
        number, record = self._current()
        if self._applied(record, batch):
            return
        written = self._write(rows, record)
        self._commit(number, record, rows, {p: [f] for p, f in written.items()}, batch)

    def append(self, rows: DataFrame, batch: Batch | None = None, attempts: int = 10) -> None:
        """Add rows of the table's columns; nothing that is stored is read or rewritten.

        Where another writer was first, its record is extended: the written rows stand as they are.
        """
        number, record = self._current()
        if record is None:
            return self.replace(rows, batch)
        if self._applied(record, batch):
            return
        rows = rows.select(*[f["name"] for f in record["schema"]["fields"]])
        written = self._write(rows, record)
        for left in range(attempts - 1, -1, -1):
            folders = {p: list(fs) for p, fs in record["folders"].items()}
            for p, f in written.items():
                folders.setdefault(p, []).append(f)
            try:
                return self._commit(number, record, rows, folders, batch)
            except Conflict:
                if not left:
                    raise
                number, record = self._current()

    def merge(
        self,
        changes: DataFrame,
        apply: Callable[[DataFrame, DataFrame], DataFrame],
        batch: Batch | None = None,
    ) -> None:
        """Replace the parts that `changes` touch by `apply(their rows, changes)`.

        `changes` has the key column, and `apply` returns only rows whose keys are in those parts.
        Other parts keep their files. A batch of a stream that was applied is not applied again.
        """
        number, record = self._current()
        if record is None:
            raise FileNotFoundError(f"no table at {self.path}")
        if self._applied(record, batch):
            return
        # Written once, so that the parts found are those of the rows applied.
        changes = materialize(changes, "changes")
        # One small row per part.
        touched = [r[0] for r in changes.select(self.part(record).alias(PART)).distinct().collect()]
        rows = apply(self._read(record, touched), changes)
        written = self._write(rows, record)
        folders = {p: fs for p, fs in record["folders"].items() if int(p) not in set(touched)}
        self._commit(number, record, rows, folders | {p: [f] for p, f in written.items()}, batch)


def replace_table(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """Replace the table at `path` as a whole: readers see the old one or the new one."""
    VersionedTable(rows.sparkSession, path, form=form).replace(rows)


def read_table(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return VersionedTable(spark, path, form=form).read()
