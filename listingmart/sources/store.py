"""Parquet table store for the bronze / silver / gold tables.

Tables live under one shared base folder (on a cluster: a distributed file
system path). Two write modes:

* **versioned** tables (dimensions, fact, bridges, summaries): every attempt writes
  a folder of its own, ``<table>/v=<n>-<attempt>``, and publishes it by creating the file
  ``<table>/_published/<n>`` that names it; the highest number whose file names a folder is
  current. Of two runs that want one number the second finds the file there, deletes its own
  folder and fails. So no published content is ever overwritten, and a write that
  fails anywhere leaves the previous version current. The file is created without
  overwriting, which is exclusive on HDFS and what follows its contract; on an object store it
  needs conditional writes, otherwise let one run at a time write a table;
* **bucketed** tables (the fact): versioned, but a version is a list of bucket folders, a bucket holding
  the rows whose key hashes to it. An upsert reads and rewrites only the buckets that
  its batch touches and publishes them, with the folders of all others as they are, in one file;
* **located** tables (staging A): versioned, a version lists a folder for each date and the bucket
  folders of a locator (key -> date). An upsert that moves a key to another date finds where it
  was from the locator's touched buckets, without scanning keys, and publishes the
  rewritten dates and locator buckets in one file, so no crash leaves a key in two dates;
* **date-partitioned** tables (staging, daily fact): dynamic partition
  overwrite replaces only the partitions present in the written frame.
  Frames that read the partitions they replace are checkpointed first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingmart.operators.lookup import small_side
from listingmart.operators.merge import upsert_in_place
from listingmart.session import cut_lineage


def bucket_of(key: list[str], n: int) -> Column:
    """The bucket of a row."""
    return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")


class _Named:
    """What a publication file names: one folder, or a folder for each part (bucket or date) and locator bucket."""

    def __init__(self, what: str):
        head, *lines = what.split("\n")
        self.kind = head.split(" ")[0] if " " in head else ""
        self.n = int(head.split(" ")[1]) if self.kind else None
        items = [x.split(" ", 2) for x in lines] if self.kind else [["part", "", what]] if what else []
        self.parts = {k: f for what_, k, f in items if what_ == "part"}
        self.locator = {int(k): f for what_, k, f in items if what_ == "where"}

    def attempts(self) -> set[str]:
        """Top folders of all that is named."""
        return {f.split("/")[0] for f in [*self.parts.values(), *self.locator.values()]}


def _listing(kind: str, n: int, parts: dict, locator: dict | None = None) -> str:
    return "\n".join([f"{kind} {n}", *[f"part {k} {f}" for k, f in sorted(parts.items())],
                      *[f"where {k} {f}" for k, f in sorted((locator or {}).items())]])


class TableStore:
    def __init__(self, spark: SparkSession, base: str, buckets: int = 16):
        """``buckets`` of new bucketed tables: choose it for buckets of some hundred MB (``rebucket`` changes it)."""
        self.spark = spark
        self.base = base.rstrip("/")
        self.buckets = buckets
        self._versions: dict[str, tuple[int, str]] = {}  # (number, what it names) this store published or looked up

    # -- paths -------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def _fs(self, path: str):
        """(file system, path): Hadoop's API works for any cluster file system."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names of the files and folders in a folder; none if it does not exist."""
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def note(self, path: str) -> str:
        """The text of a small file ('' if there is none)."""
        fs, p = self._fs(path)
        if not fs.exists(p):
            return ""
        stream = fs.open(p)
        try:
            return bytes(stream.readNBytes(int(fs.getFileStatus(p).getLen()))).decode()
        finally:
            stream.close()

    def write_note(self, path: str, text: str, overwrite: bool = True) -> None:
        """Write a small file; without ``overwrite`` it must be new."""
        fs, p = self._fs(path)
        stream = fs.create(p, overwrite)
        stream.write(bytearray(text.encode()))
        stream.close()

    def _numbers(self, name: str) -> list[int]:
        """Numbers taken, whether or not their files name a folder (a run may have died in between)."""
        return sorted(int(n) for n in self.names(f"{self.path(name)}/_published") if n.isdigit())

    def _named(self, name: str, number: int) -> str:
        """What a publication file names: see ``_Named`` ('' if its run died before it could)."""
        return self.note(f"{self.path(name)}/_published/{number}")

    def _current(self, name: str) -> tuple[int, str] | None:
        """(number, what it names) of the highest published version; None if the table was never written.

        A version folder with data but no publication at all means that the files
        were lost (or that the very first run died between data and publication): that
        is an error to look at, never an empty table.
        """
        if name in self._versions:
            return self._versions[name]
        for number in reversed(self._numbers(name)):
            if folder := self._named(name, number):
                self._versions[name] = (number, folder)
                return number, folder
        for folder in self.names(self.path(name)):
            if folder.startswith("v=") and any(f.startswith("part-") for f in self.names(f"{self.path(name)}/{folder}")):
                raise FileNotFoundError(f"{self.path(name)}/{folder} holds data but no version is published")
        return None

    def current_version(self, name: str) -> int | None:
        """The number of the current version; None if the table was never written."""
        found = self._current(name)
        return found and found[0]

    def current_path(self, name: str) -> str:
        """Folder of the current version of a table without buckets."""
        found = self._current(name)
        if not found or _Named(found[1]).kind:
            raise FileNotFoundError(f"{self.path(name)} was never published")
        return f"{self.path(name)}/{found[1]}"

    def exists(self, name: str) -> bool:
        """The table was written at least once (a published version or a data folder)."""
        return self.current_version(name) is not None or self._exists(f"{self.path(name)}/data")

    # -- reads -------------------------------------------------------------
    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """The current content, or an empty frame with ``schema`` if never written."""
        found = self._current(name)
        if found:
            return self._read_folders(name, schema, list(_Named(found[1]).parts.values()))
        data = f"{self.path(name)}/data"
        if self._exists(data):
            return self.spark.read.schema(schema).parquet(data)
        return self.spark.createDataFrame([], schema)

    def _read_folders(self, name: str, schema: T.StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path(name)}/{f}" for f in folders])

    def read_keys(self, name: str, schema: T.StructType, key: list[str], keys: list[tuple]) -> DataFrame:
        """The rows of a few keys: only their buckets' folders are listed and read."""
        found = self._current(name)
        named = _Named(found[1] if found else "")
        rows = self.read(name, schema)
        types = T.StructType([schema[c] for c in key])
        wanted = self.spark.createDataFrame(keys, types)
        if named.kind == "buckets":
            own = {str(r[0]) for r in wanted.select(bucket_of(key, named.n)).distinct().collect()}
            rows = self._read_folders(name, schema, [f for b, f in named.parts.items() if b in own])
        return rows.join(F.broadcast(wanted), key, "left_semi")  # the caller's list

    def read_partition(self, name: str, schema: T.StructType, col: str, value) -> DataFrame:
        """One date partition; a located table's folder of that date alone, else the filter prunes partitions at planning time."""
        found = self._current(name)
        if found and (named := _Named(found[1])).kind == "located":
            return self._read_folders(name, schema, [named.parts[str(value)]] if str(value) in named.parts else [])
        return self.read(name, schema).where(F.col(col) == F.lit(value).cast(schema[col].dataType))

    # -- writes ------------------------------------------------------------
    def _attempt(self, name: str) -> tuple[int, str]:
        """The next number, and a folder that no other run writes."""
        found = self._current(name)
        # a number whose run died before it named a folder is passed over
        v = max([found[0] if found else 0, *[n for n in self._numbers(name) if not self._named(name, n)]]) + 1
        return v, f"v={v}-{uuid.uuid4().hex}"

    def _publish(self, name: str, v: int, folder: str, what: str) -> None:
        try:
            self.write_note(f"{self.path(name)}/_published/{v}", what, overwrite=False)
        except Exception as e:
            own, p = self._fs(f"{self.path(name)}/{folder}")
            own.delete(p, True)
            self._versions.pop(name, None)
            raise FileExistsError(f"version {v} of {name} was published by another run") from e
        self._versions[name] = (v, what)

    def replace(self, name: str, df: DataFrame) -> None:
        """Write a new version, then publish it (K8)."""
        v, folder = self._attempt(name)
        df.write.mode("error").parquet(f"{self.path(name)}/{folder}")
        self._publish(name, v, folder, folder)

    def upsert_buckets(self, name: str, schema: T.StructType, key: list[str], batches: list[tuple[DataFrame, list[str]]]) -> list[int]:
        """M1 on a bucketed table: batches of (rows, columns to update), in order; returns the buckets rewritten.

        A batch is computed once. Only the buckets that some batch touches are read. Where a
        batch is proven small it is broadcast, so the table's rows meet it where they are
        read and are written from there, without a shuffle; beyond that they meet in a full outer join.
        A table without buckets gets them with its first upsert.
        """
        found = self._current(name)
        named = _Named(found[1] if found else "")
        n, folders = named.n or self.buckets, named.parts
        whole = bool(found) and named.kind != "buckets"
        batches = [(cut_lineage(rows.select(*schema.names)), update) for rows, update in batches]
        touched = sorted({str(r[0]) for rows, _ in batches for r in rows.select(bucket_of(key, n)).distinct().collect()})  # n numbers at most
        if not touched and not whole:
            return []
        rows = self._read_folders(name, schema, [f for b, f in folders.items() if whole or b in touched])
        for batch, update in batches:
            rows = upsert_in_place(rows, batch, key, update)
        return self._write_buckets(name, rows, key, n, {} if whole else folders)

    def rebucket(self, name: str, schema: T.StructType, key: list[str], buckets: int) -> None:
        """Rewrite a table into another number of buckets."""
        self._write_buckets(name, self.read(name, schema).repartition(buckets, bucket_of(key, buckets)), key, buckets, {})

    def _write_buckets(self, name: str, rows: DataFrame, key: list[str], n: int, folders: dict[str, str]) -> list[int]:
        v, folder = self._attempt(name)
        path = f"{self.path(name)}/{folder}"
        (rows.withColumn("_bucket", bucket_of(key, n)).sortWithinPartitions("_bucket", *key)  # sorted: row groups can be skipped by key
         .write.mode("error").partitionBy("_bucket").parquet(path))
        new = self._written(name, folder)
        self._publish(name, v, folder, _listing("buckets", n, folders | new))
        return sorted(map(int, new))

    def _written(self, name: str, folder: str) -> dict[str, str]:
        """Part -> folder of what a write partitioned by one column left."""
        return {f.split("=", 1)[1]: f"{folder}/{f}" for f in self.names(f"{self.path(name)}/{folder}") if "=" in f}

    def upsert_located(self, name: str, schema: T.StructType, key: list[str], by: str, batch: DataFrame, update_cols: list[str]) -> list[str]:
        """K2 + T21: upsert by ``key`` into dates ``by``, which the batch may change; returns the dates rewritten.

        Read are the locator's buckets of the batch's keys, and of the table only the dates that
        hold one of them and the batch's own. A date without rows left is no longer listed.
        """
        if by not in update_cols:
            raise ValueError(f"{by} must be one of the columns to update")
        found = self._current(name)
        named = _Named(found[1] if found else "")
        fresh = named.kind != "located"  # a table of another layout is taken over whole
        n = named.n if not fresh else self.buckets
        where = T.StructType([*[schema[c] for c in key], schema[by]])
        batch = cut_lineage(batch.select(*schema.names))
        touched = {r[0] for r in batch.select(bucket_of(key, n)).distinct().collect()}  # n numbers at most
        if not touched:
            return []
        held = self.read(name, schema).select(*where.names) if fresh else self._read_folders(
            name, where, [f for b, f in named.locator.items() if b in touched])
        keys = small_side(batch.select(*key))
        days = {str(r[0]) for r in held.join(keys, key, "left_semi").select(by).unionByName(batch.select(by)).distinct().collect()}
        old = self.read(name, schema) if fresh else self._read_folders(name, schema, [f for d, f in named.parts.items() if d in days])
        v, folder = self._attempt(name)
        path = f"{self.path(name)}/{folder}"
        merged = upsert_in_place(old, batch, key, update_cols).withColumn("_part", F.col(by).cast("string"))
        merged.sortWithinPartitions("_part", *key).write.mode("error").partitionBy("_part").parquet(f"{path}/rows")
        moved = held.join(keys, key, "left_anti").unionByName(batch.select(*where.names).dropna(subset=key))
        (moved.withColumn("_bucket", bucket_of(key, n)).sortWithinPartitions("_bucket", *key)
         .write.mode("error").partitionBy("_bucket").parquet(f"{path}/where"))
        parts = {} if fresh else {d: f for d, f in named.parts.items() if d not in days}
        new = self._written(name, f"{folder}/rows")
        locator = ({} if fresh else named.locator) | {int(b): f for b, f in self._written(name, f"{folder}/where").items()}
        self._publish(name, v, folder, _listing("located", n, parts | new, locator))
        return sorted(new)

    def vacuum(self, name: str, keep: int = 2) -> list[int]:
        """Delete all but the last ``keep`` published versions and older folders nobody published; returns the deleted numbers."""
        found = self._current(name)
        if not found:
            return []
        last = found[0] - max(1, keep)
        kept = set().union(*[_Named(self._named(name, n)).attempts() for n in self._numbers(name) if n > last])
        gone = [n for n in self._numbers(name) if n <= last]
        for path in [f"_published/{n}" for n in gone] + [
                f for f in self.names(self.path(name))
                if f.startswith("v=") and f not in kept and int(f[2:].split("-")[0]) <= last]:
            fs, p = self._fs(f"{self.path(name)}/{path}")
            fs.delete(p, True)
        return gone

    def vacuum_all(self, keep: int = 2) -> dict[str, list[int]]:
        """``vacuum`` of every versioned table of the store."""
        return {t: gone for t in self.names(self.base) if self._exists(f"{self.path(t)}/_published") and (gone := self.vacuum(t, keep))}

    def overwrite_partitions(self, name: str, df: DataFrame, col: str, reads_self: bool = True) -> None:
        """Replace only the ``col`` partitions present in ``df`` (M6, K2, K3)."""
        if reads_self:
            df = cut_lineage(df)
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(col).parquet(f"{self.path(name)}/data"))

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows that are known to be new."""
        df.write.mode("append").parquet(f"{self.path(name)}/data")

    def land(self, name: str, df: DataFrame, batch: str) -> None:
        """K1: land a raw batch; landing it again (a retry) replaces it."""
        df.write.mode("overwrite").parquet(f"{self.path(name)}/data/batch={batch}")
