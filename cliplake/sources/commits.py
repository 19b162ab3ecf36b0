"""Tables with a commit log over Parquet files: write-once rows and replaced snapshots as transactions.

    <path>/txn=<transaction>/*.parquet   written first
    <path>/_log/<version>.json           names the folders that a version adds, or that replace all before

A version's log entry can be made once. Whoever makes it has committed; whoever
finds it made reads what it says, keeps its own files if they don't concern the
same keys, and tries the next version. So writers never wait, readers never see
half a write, and a lost job leaves files that no entry names. (Spark can read the
folder as it is, too; then such files count.)"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: So many versions after the last, an entry lists all folders, and reading starts there.
CHECKPOINT = 20


class Conflict(RuntimeError):
    """Another writer was first, again and again."""


class Table:
    """A table of `schema` at `path`, by whatever file system Spark knows for it."""

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._jvm = spark._jvm
        self._log = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_log")
        self._fs = self._log.getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- the log

    def versions(self) -> list[int]:
        if not self._fs.exists(self._log):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _entry(self, version: int) -> dict:
        stream = self._fs.open(self._jvm.org.apache.hadoop.fs.Path(self._log, f"{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def folders(self, version: int | None = None) -> list[str]:
        """The folders of a version, by default the last."""
        every = [v for v in self.versions() if version is None or v <= version]
        found: list[list[str]] = []
        for v in reversed(every):
            entry = self._entry(v)
            found.append(entry["all"] if "all" in entry else entry["add"])
            if "all" in entry:
                break
        return [f for part in reversed(found) for f in part]

    def _publish(self, version: int, entry: dict) -> bool:
        """Make the entry of a version; False if somebody has."""
        body = json.dumps(entry | {"version": version, "committed_at": datetime.now(UTC).isoformat()}, sort_keys=True).encode()
        path = self._jvm.org.apache.hadoop.fs.Path
        final, own = path(self._log, f"{version:012d}.json"), path(self._log, f".{uuid4().hex}")
        self._fs.mkdirs(self._log)
        out = self._fs.create(own, False)
        out.write(body)
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":  # a rename of local files would replace
                local = lambda p: p.toUri().getPath()
                try:
                    os.link(local(own), local(final))
                except FileExistsError:
                    return False
                return True
            if self._fs.exists(final):
                return False
            # without OVERWRITE a file context's rename fails if the target is there
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
            none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            try:
                context.rename(own, final, none)
            except Exception:
                if self._fs.exists(final):
                    return False
                raise
            return True
        finally:
            self._fs.delete(own, False)

    # ---- rows

    def _files(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/txn={f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the last; none before the first."""
        return self._files(self.folders(version))

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        """A new folder with rows, and how many they are."""
        name = uuid4().hex
        fields = [f.name for f in self.spark.createDataFrame([], self.schema).schema]
        rows.select(*fields).write.mode("errorifexists").parquet(f"{self.path}/txn={name}")
        return name, self._files([name]).count()

    def _drop(self, folders: list[str]) -> None:
        for f in folders:
            self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/txn={f}"), True)

    def _commit(self, version: int, add: list[str]) -> bool:
        entry = {"all": [*self.folders(version - 1), *add]} if version % CHECKPOINT == 0 else {"add": add}
        return self._publish(version, entry)

    def replace(self, build: Callable[[], DataFrame], tries: int = 10) -> int:
        """What build() returns becomes the whole table, as one version; build() is asked again if another version came between."""
        for _ in range(tries):
            last = max(self.versions(), default=0)
            name, _ = self._write(build())
            if self._publish(last + 1, {"all": [name]}):
                return last + 1
            self._drop([name])
        raise Conflict(f"{self.path}: another writer was first {tries} times")

    def add_once(self, rows: DataFrame, key: str, digest: str, order: Column | None = None, tries: int = 10) -> DataFrame:
        """Keep one row a key for good; returns key, digest, outcome: `new`, `reused` (kept already with this digest) or `artifact_mismatch` (kept with another).

        Of several digests of a new key in one batch the one with the least `order`
        is kept (by default the least digest), the others are mismatches; a digest
        has one outcome however often it is in the batch. Rows with a null key or
        digest are left out. rows is read more than once: give what is written."""
        body = rows.where(F.col(key).isNotNull() & F.col(digest).isNotNull())
        told = body.groupBy(F.col(key).alias("_k"), F.col(digest).alias("_d")).agg(F.min(F.struct((F.lit(0) if order is None else order).alias("o"), F.col(digest).alias("d"))).alias("first"))
        mine: list[str] = []
        last = max(self.versions(), default=0)
        seen = last
        for _ in range(tries):
            if not mine:
                kept = self.read(last).select(F.col(key).alias("_old"))
                fresh = told.join(kept, F.col("_k") == F.col("_old"), "left_anti").groupBy("_k").agg(F.min("first")["d"].alias("_d"))
                chosen = body.join(fresh, (F.col(key) == F.col("_k")) & (F.col(digest) == F.col("_d")), "left_semi").dropDuplicates([key])
                name, count = self._write(chosen)
                if not count:
                    self._drop([name])
                    break
                mine, seen = [name], last
            if self._commit(last + 1, mine):
                last += 1
                break
            # somebody was first: if their keys are others, the files stand
            last = max(self.versions())
            theirs = self._files([f for v in range(seen + 1, last + 1) for f in self._entry(v).get("add", self._entry(v).get("all", []))])
            if self._files(mine).join(theirs.select(F.col(key).alias("_old")), F.col(key) == F.col("_old"), "left_semi").limit(1).count():
                self._drop(mine)
                mine = []
            seen = last
        else:
            raise Conflict(f"{self.path}: another writer was first {tries} times")
        now = self.read(last).select(F.col(key).alias("_now"), F.col(digest).alias("_kept"))
        own = self._files(mine).select(F.col(key).alias("_own"))
        got = told.join(now, F.col("_k") == F.col("_now"), "left").join(own, F.col("_k") == F.col("_own"), "left")
        outcome = F.when(F.col("_d") != F.col("_kept"), "artifact_mismatch").when(F.col("_own").isNotNull(), "new").otherwise("reused")
        return got.select(F.col("_k").alias(key), F.col("_d").alias(digest), outcome.alias("outcome"))
