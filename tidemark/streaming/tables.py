"""Tables in files: versions behind a pointer that moves last, keyed tables in hash buckets, append logs, control values."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer has made the revision first."""


class Files:
    """Small files through Hadoop's file systems, so paths may be in any store."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A whole new file or none: written under another name and moved. Raises Conflict if the file is there already."""
        fs, t = self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(t, True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.gateway.new_array(kind, 1)
        how[0] = kind.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), self.conf).rename(fs.makeQualified(t), fs.makeQualified(p), how)
        except Exception as error:
            fs.delete(t, False)
            if fs.exists(p):
                raise Conflict(f"{path} exists") from error
            raise

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


class Pointer:
    """A JSON value in numbered files, the greatest of which counts.

    A new value is a new file, so at every moment the old or the new value is there, and of two writers of one number the second fails.
    """

    def __init__(self, files: Files, path: str, keep: int = 3):
        self.files, self.path, self.keep = files, path.rstrip("/"), keep

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(self.path) if n.endswith(".json") and n[:-5].isdigit())

    def get(self) -> tuple[dict | None, int]:
        """The value and its number; (None, 0) before the first."""
        for n in reversed(self._numbers()):
            text = self.files.read(f"{self.path}/{n:012d}.json")
            if text is not None:  # another writer may have dropped an old one just now
                return json.loads(text), n
        return None, 0

    def put(self, value: dict, after: int) -> int:
        """The value that follows number `after`; raises Conflict if there is one already."""
        numbers = self._numbers()
        if numbers and numbers[-1] != after:
            raise Conflict(f"{self.path}: {numbers[-1]}, not {after}")
        self.files.create(f"{self.path}/{after + 1:012d}.json", json.dumps(value))
        for n in numbers[: -self.keep + 1]:
            self.files.delete(f"{self.path}/{n:012d}.json")
        return after + 1


class VersionedTable:
    """A table whose versions are folders; batch ids make writes idempotent. For small tables that are written whole."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.path, self.keep, self.files = spark, path.rstrip("/"), keep, Files(spark)
        self.pointer = Pointer(self.files, f"{self.path}/_versions")

    def state(self) -> dict:
        return self.pointer.get()[0] or {"version": None, "batch_id": -1, "history": []}

    def exists(self) -> bool:
        return self.state()["version"] is not None

    def read(self) -> DataFrame | None:
        version = self.state()["version"]
        return None if version is None else self.spark.read.parquet(f"{self.path}/{version}")

    def replace(self, rows: DataFrame, batch_id: int) -> bool:
        """Makes rows the current version; a batch id at or below the current one changes nothing."""
        found, number = self.pointer.get()
        state = found or {"version": None, "batch_id": -1, "history": []}
        if batch_id <= state["batch_id"]:
            return False
        version = f"v={batch_id}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.path}/{version}")
        history = [*state["history"], version]
        self.pointer.put({"version": version, "batch_id": batch_id, "history": history[-self.keep :]}, number)
        for old in history[: -self.keep]:
            self.files.delete(f"{self.path}/{old}")
        return True


class BucketedTable:
    """A keyed table in hash buckets of which a batch rewrites only those that its keys fall in.

    The manifest names the folder of each bucket and moves last, so a crash at any point leaves the table as it was, and a
    batch that comes again changes nothing. Folders that no manifest names are left by crashes; vacuum() drops them.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.files = spark, path.rstrip("/"), list(keys), Files(spark)
        self.pointer, self.default = Pointer(self.files, f"{self.path}/_manifest"), buckets

    def state(self) -> dict:
        return self.pointer.get()[0] or {"batch_id": -1, "n": self.default, "buckets": {}, "schema": None, "retired": []}

    def exists(self) -> bool:
        return self.state()["schema"] is not None

    def bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(n)).cast("int")

    def _rows(self, state: dict, names: list[str] | None = None) -> DataFrame | None:
        if state["schema"] is None:
            return None
        chosen = [p for b, p in state["buckets"].items() if names is None or b in names]
        if not chosen:
            return self.spark.createDataFrame([], state["schema"])
        return self.spark.read.schema(state["schema"]).parquet(*[f"{self.path}/{p}" for p in chosen])

    def read(self) -> DataFrame | None:
        return self._rows(self.state())

    def merge(self, batch_keys: DataFrame, change: Callable[[DataFrame | None], DataFrame], batch_id: int) -> int:
        """Puts change(rows of the touched buckets) in their place. batch_keys: the key columns of the batch, typed as in the table.

        Returns the number of buckets written, 0 for a batch that is in already. Nothing but the numbers of touched buckets
        comes to the driver, at most as many as there are buckets.
        """
        found, number = self.pointer.get()
        state = found or self.state()
        if batch_id <= state["batch_id"]:
            return 0
        n = state["n"]
        touched = sorted(str(r["b"]) for r in batch_keys.select(self.bucket(n).alias("b")).distinct().collect())
        rows = change(self._rows(state, touched))
        part = f"data/b={batch_id}-{uuid.uuid4().hex[:8]}"
        rows.withColumn("_bucket", self.bucket(n)).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{part}")
        made = {name.split("=", 1)[1]: f"{part}/{name}" for name in self.files.names(f"{self.path}/{part}") if name.startswith("_bucket=")}
        gone = [state["buckets"][b] for b in touched if b in state["buckets"]]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        kept = {b: p for b, p in state["buckets"].items() if b not in touched}
        self.pointer.put({"batch_id": batch_id, "n": n, "buckets": kept | made, "schema": schema, "retired": gone}, number)
        for old in state["retired"]:  # readers of the version before may still be at what was retired just now
            self.files.delete(f"{self.path}/{old}")
        return len(made)

    def vacuum(self) -> int:
        """Drops bucket folders that the manifest doesn't name, as crashes leave them. Not while a batch is being written."""
        state, dropped = self.state(), 0
        named = {*state["buckets"].values(), *state["retired"]}
        for part in self.files.names(f"{self.path}/data"):
            inside = [f"data/{part}/{b}" for b in self.files.names(f"{self.path}/data/{part}") if b.startswith("_bucket=")]
            if not any(p in named for p in inside):
                self.files.delete(f"{self.path}/data/{part}")
                dropped += 1
        return dropped


class AppendLog:
    """Append-only rows, one folder a batch, so that a replayed batch overwrites itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame | None:
        names = [n for n in self.files.names(self.path) if n.startswith("batch=")]
        return self.spark.read.option("mergeSchema", "true").parquet(self.path) if names else None

    def retain(self, now: datetime, hours: float | None = None, most: int | None = None, column: str = "captured_at") -> list[int]:
        """Drops batches all of whose rows are older than `hours`, or lie beyond the newest `most` rows. Returns the batches dropped."""
        rows = self.read()
        if rows is None:
            return []
        age = F.timestamp_diff("SECOND", F.max(column), F.lit(now).cast("timestamp_ntz"))
        found = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), age.alias("age")).orderBy(F.desc("batch")).collect()  # a row for each batch kept
        gone, newer = [], 0
        for r in found:
            if (hours is not None and r["age"] is not None and r["age"] > 3600 * hours) or (most is not None and newer >= most):
                gone.append(int(r["batch"]))
            newer += r["n"]
        for b in gone:
            self.files.delete(f"{self.path}/batch={b}")
        return gone


class ControlTable:
    """Keyed JSON values with revisions; a write names the revision it has read, and of two that read the same one fails."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.files = path.rstrip("/"), Files(spark)

    def _pointer(self, key: str) -> Pointer:
        return Pointer(self.files, f"{self.path}/{key}")

    def get(self, key: str) -> tuple[dict | None, int]:
        return self._pointer(key).get()

    def put(self, key: str, value: dict, revision: int | None = None) -> int:
        pointer = self._pointer(key)
        return pointer.put(value, pointer.get()[1] if revision is None else revision)

    def update(self, key: str, change: Callable[[dict | None], dict], attempts: int = 5) -> int:
        """Compare-and-swap, tried again on conflicts."""
        for _ in range(attempts):
            value, revision = self.get(key)
            try:
                return self.put(key, change(value), revision)
            except Conflict:
                continue
        raise RuntimeError(f"{key}: too many conflicts")
