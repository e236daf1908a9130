"""Tables hashed into key buckets, so that a batch reads and writes only the buckets of its own keys.

Rows are Parquet files that Spark writes, partitioned by commit and bucket. A snapshot is one small
manifest: which commit holds each bucket's base, which appended commits wait to be folded into
it, and the last number of every writer. A commit writes its files first and then renames a
finished manifest to the next version, so readers see a batch whole or not at all, a batch that
is repeated changes nothing, and a crash leaves files that no manifest names. A reader keeps its
snapshot; files that no kept manifest names are removed by ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

COMMIT, BUCKET, ADDED = "_commit", "_bucket", "_added"
Fold = Callable[[DataFrame, DataFrame], DataFrame]


def _loose(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere, as files give it back."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_loose(kind.keyType), _loose(kind.valueType))
    return kind


class Conflict(RuntimeError):
    """Another writer made the next version first."""


@dataclass
class Snapshot:
    version: int = 0
    #: bucket -> commit of its base
    base: dict[int, str] = field(default_factory=dict)
    #: appended commits in their order: (number, commit, buckets that still wait for it)
    waiting: list[tuple[int, str, list[int]]] = field(default_factory=list)
    #: writer -> last number that it committed
    writers: dict[str, int] = field(default_factory=dict)

    def commits(self) -> set[str]:
        return {*self.base.values(), *(c for _, c, b in self.waiting if b)}

    def text(self) -> str:
        return json.dumps({"version": self.version, "base": self.base, "waiting": self.waiting, "writers": self.writers})

    @classmethod
    def read(cls, text: str) -> Snapshot:
        raw = json.loads(text)
        return cls(raw["version"], {int(k): v for k, v in raw["base"].items()}, [(n, c, b) for n, c, b in raw["waiting"]], raw["writers"])


class _Files:
    """The few calls on the shared file system that Spark's readers and writers do not make."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.jvm.org.apache.hadoop.fs
        path = self.fs.Path(root)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.store = path.getFileSystem(conf)
        self.context = self.fs.FileContext.getFileContext(self.store.getUri(), conf)
        self.gateway = spark.sparkContext._gateway

    def names(self, folder: str) -> list[str]:
        path = self.fs.Path(folder)
        return [s.getPath().getName() for s in self.store.listStatus(path)] if self.store.exists(path) else []

    def read(self, path: str) -> str:
        stream = self.store.open(self.fs.Path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self.store.create(self.fs.Path(path), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def rename(self, a: str, b: str) -> bool:
        """False if ``b`` is there already."""
        options = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self.context.rename(self.fs.Path(a), self.fs.Path(b), options)
        except Exception as e:  # py4j wraps what the file system throws
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        return True

    def age(self, path: str) -> float:
        """Seconds since the last change."""
        return (self.jvm.java.lang.System.currentTimeMillis() - self.store.getFileStatus(self.fs.Path(path)).getModificationTime()) / 1000

    def remove(self, path: str) -> None:
        self.store.delete(self.fs.Path(path), True)


class BucketTable:
    """A table of one row per key under ``path``; ``fold`` puts appended rows into base rows.

    ``fold(base, later)`` gets later rows with their commit's number in the column ``_added``.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 256, fold: Fold | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), _loose(schema)
        self.keys, self.buckets, self.fold = list(keys), buckets, fold
        self.files = _Files(spark, self.path)

    # ------------------------------------------------------------ snapshots

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/manifests") if n.endswith(".json"))

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest snapshot, or that of a version which is still kept."""
        if version is None:
            version = max(self.versions(), default=0)
        return Snapshot.read(self.files.read(f"{self.path}/manifests/{version:012d}.json")) if version else Snapshot()

    def _commit(self, old: Snapshot, new: Snapshot) -> None:
        new.version = old.version + 1
        draft = f"{self.path}/manifests/.{uuid.uuid4().hex}"
        self.files.write(draft, new.text())
        if not self.files.rename(draft, f"{self.path}/manifests/{new.version:012d}.json"):
            self.files.remove(draft)
            raise Conflict(f"version {new.version} of {self.path} was made by another writer")

    # ------------------------------------------------------------ rows

    def bucket(self, *keys: str):
        return F.pmod(F.xxhash64(*(keys or self.keys)), F.lit(self.buckets)).cast("int")

    def _at(self, commit: str, bucket: int) -> str:
        return f"{self.path}/rows/{COMMIT}={commit}/{BUCKET}={bucket}"

    def _rows(self, places: dict[str, list[int]]) -> DataFrame:
        """Rows of the given buckets of commits, with commit and bucket."""
        whole = T.StructType([*self.schema.fields, T.StructField(COMMIT, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        paths = [self._at(c, b) for c, bs in places.items() for b in bs]
        if not paths:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/rows").parquet(*paths)

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """A new commit's files, and the buckets that have some; Spark splits crowded buckets and joins small ones by size."""
        commit = uuid.uuid4().hex
        dealt = rows.select(*(F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema)).withColumn(BUCKET, self.bucket())
        at = f"{self.path}/rows/{COMMIT}={commit}"
        dealt.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(at)
        return commit, sorted(int(n.partition("=")[2]) for n in self.files.names(at) if n.startswith(f"{BUCKET}="))

    def parts(self, snapshot: Snapshot | None = None, buckets: Sequence[int] | None = None) -> tuple[DataFrame, DataFrame]:
        """(base rows, waiting rows with the number of their commit) of a snapshot or of some of its buckets."""
        s = snapshot or self.snapshot()
        wanted = None if buckets is None else set(buckets)
        has = lambda b: wanted is None or b in wanted
        base: dict[str, list[int]] = {}
        for b, commit in s.base.items():
            if has(b):
                base.setdefault(commit, []).append(b)
        later = {c: [b for b in bs if has(b)] for _, c, bs in s.waiting}
        number = F.create_map(*(F.lit(x) for n, c, _ in s.waiting for x in (c, n))) if s.waiting else None
        waiting = self._rows(later).withColumn(ADDED, F.lit(0).cast("bigint") if number is None else number[F.col(COMMIT)].cast("bigint"))
        return self._rows(base).drop(COMMIT, BUCKET), waiting.drop(COMMIT, BUCKET)

    def read(self, snapshot: Snapshot | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table as of a snapshot, by default the newest; buckets without waiting rows are plain scans."""
        s = snapshot or self.snapshot()
        pending = {b for _, _, bs in s.waiting for b in bs}
        chosen = set(s.base) | pending if buckets is None else set(buckets)
        names = [f.name for f in self.schema]
        still = self.parts(s, sorted(chosen - pending))[0].select(*names)
        if not chosen & pending:
            return still
        base, later = self.parts(s, sorted(chosen & pending))
        return still.unionByName(self._folded(base, later))

    def _folded(self, base: DataFrame, later: DataFrame) -> DataFrame:
        if self.fold is None:
            raise ValueError(f"{self.path} has appended rows but no fold")
        return self.fold(base, later).select(*(F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema))

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Buckets that the keys of some rows fall into: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def look_up(self, keys: DataFrame, snapshot: Snapshot | None = None) -> DataFrame:
        """Rows of the buckets that some keys fall into, for a join on these keys."""
        return self.read(snapshot, self.buckets_of(keys))

    # ------------------------------------------------------------ commits

    def done(self, writer: str, number: int) -> bool:
        return self.snapshot().writers.get(writer, -1) >= number

    def append(self, writer: str, number: int, rows: DataFrame) -> bool:
        """Adds rows that wait to be folded; nothing is read. False if this number of the writer is there."""
        if self.done(writer, number):
            return False
        commit, touched = self._write(rows)
        for _ in range(100):  # appends of several writers do not exclude each other
            old = self.snapshot()
            if old.writers.get(writer, -1) >= number:
                return False
            order = max((n for n, _, _ in old.waiting), default=old.writers.get("", 0)) + 1
            new = Snapshot(0, old.base, [*old.waiting, (order, commit, touched)], {**old.writers, writer: number, "": order})
            try:
                self._commit(old, new)
                return True
            except Conflict:
                continue
        raise Conflict(f"{self.path}: 100 attempts to append were overtaken")

    def merge(self, writer: str, number: int, changes: DataFrame, change: Fold) -> bool:
        """Rewrites the buckets of the changes' keys by ``change(current rows of these buckets, changes)``.

        Rows of the result are those buckets' new rows. ``changes`` is read twice: pass a stored
        table, or one that gives the same rows again. False if this number of the writer is there.
        """
        if self.done(writer, number):
            return False
        old = self.snapshot()
        touched = self.buckets_of(changes)
        if not touched:
            self._commit(old, Snapshot(0, old.base, old.waiting, {**old.writers, writer: number}))
            return True
        commit, filled = self._write(change(self.read(old, touched), changes))
        gone = set(touched)
        if not set(filled) <= gone:
            raise ValueError("a change moved rows to other buckets")
        base = {b: c for b, c in old.base.items() if b not in gone} | {b: commit for b in filled}
        waiting = [(n, c, [b for b in bs if b not in gone]) for n, c, bs in old.waiting]
        self._commit(old, Snapshot(0, base, [w for w in waiting if w[2]], {**old.writers, writer: number}))
        return True

    def compact(self, least: int = 1, most: int | None = None) -> list[int]:
        """Folds the waiting rows of buckets that have at least ``least`` waiting commits, the fullest first, ``most`` buckets at a time."""
        old = self.snapshot()
        count: dict[int, int] = {}
        for _, _, bs in old.waiting:
            for b in bs:
                count[b] = count.get(b, 0) + 1
        chosen = sorted((b for b in count if count[b] >= least), key=lambda b: (-count[b], b))[:most]
        if not chosen:
            return []
        commit, filled = self._write(self.read(old, chosen))
        gone = set(chosen)
        while True:
            now = self.snapshot()  # appends may have come since; what they brought waits on
            if any(now.base.get(b) != old.base.get(b) for b in gone):
                raise Conflict(f"{self.path}: a bucket was rewritten during compaction")
            folded = {c for _, c, _ in old.waiting}
            base = {b: c for b, c in now.base.items() if b not in gone} | {b: commit for b in filled}
            waiting = [(n, c, [b for b in bs if b not in gone or c not in folded]) for n, c, bs in now.waiting]
            try:
                self._commit(now, Snapshot(0, base, [w for w in waiting if w[2]], now.writers))
                return sorted(chosen)
            except Conflict:
                continue

    def vacuum(self, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
        """Removes all but the newest ``keep`` manifests and the commits that none of these names.

        Commits younger than ``older_than`` seconds stay: they may belong to a batch that is not finished.
        """
        versions = self.versions()
        kept = versions[-keep:]
        named = set().union(*(self.snapshot(v).commits() for v in kept)) if kept else set()
        for v in versions[:-keep]:
            self.files.remove(f"{self.path}/manifests/{v:012d}.json")
        gone = []
        for name in self.files.names(f"{self.path}/rows"):
            at = f"{self.path}/rows/{name}"
            if name.partition("=")[2] not in named and self.files.age(at) >= older_than:
                self.files.remove(at)
                gone.append(name.partition("=")[2])
        return gone
