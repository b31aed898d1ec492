"""Materialisation points and result publishing (OP-32).

Lineage is cut by writing Parquet under the cluster's shared work folder
(``spark.checkpoint.dir``), never by ``localCheckpoint``: a written table
survives the loss of any executor, is read back columnar with pruning, and
gives the optimizer real size statistics for later joins.

A published table is a folder with data batches and, in ``_manifests``, one
small object per version that lists the files of its batches.  Putting that
object is the commit: nothing is renamed, which object stores do by copy and
delete, and nothing that a version lists is changed afterwards.  The last
versions are kept, so a reader finishes on the version it opened.
"""

from __future__ import annotations

import json
import tempfile
import time
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def work_root(spark: SparkSession) -> str:
    """The shared work folder: ``spark.checkpoint.dir`` of the session.

    Unset, a local session gets a temporary folder of its own; a cluster
    session is refused, since its machines share no local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not getattr(sc, "_own_work_root", None):
        sc._own_work_root = "file://" + tempfile.mkdtemp(prefix="provgraph-work-")
    return sc._own_work_root


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


class Materializer:
    """Writes intermediate tables of one pipeline run under a unique prefix of the shared work folder.

    ``enabled=False`` keeps plans lazy (for plan inspection and tests).
    """

    def __init__(self, spark: SparkSession, root: str | None = None, enabled: bool = True):
        self.spark = spark
        self.enabled = enabled
        self.folder = f"{(root or work_root(spark)).rstrip('/')}/provgraph-{uuid.uuid4().hex}" if enabled else None

    def __call__(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        if not self.enabled:
            return df
        # Written once and read a few times: the bytes cost more than the compression.
        return self._write(df, f"{self.folder}/{name}", partition_by, compression="zstd")

    def _write(self, df: DataFrame, path: str, partition_by: list[str] | None, **options: str) -> DataFrame:
        writer = df.write.mode("overwrite").options(**options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def remove(self) -> None:
        """Delete everything this run materialised; frames that read it are of no use afterwards."""
        if self.enabled:
            delete_folder(self.spark, self.folder)


# --------------------------------------------------------------------------- published tables

MANIFESTS = "_manifests"
#: Versions that stay readable after a publish, the current one included.
KEEP = 3


class PublishConflictError(RuntimeError):
    """Another publish committed to the table after this one had read its current version."""


@dataclass(frozen=True)
class Batch:
    """What one run added to a table: its folder and Parquet files, below the parent of the table's folder."""

    run: str
    folder: str
    files: tuple[tuple[str, int], ...]


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: dict
    batches: tuple[Batch, ...]
    committed_at: float


def _parent(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[0]


def _manifest_path(path: str, version: int) -> str:
    return f"{path}/{MANIFESTS}/{version:020d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that the table lists, ascending."""
    fs, p = file_system(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())


def read_manifest(spark: SparkSession, path: str, version: int) -> Manifest | None:
    """A version's manifest; none if it is gone, or still being written where a put is not atomic."""
    fs, p = file_system(spark, _manifest_path(path, version))
    try:
        stream = fs.open(p)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            return None
        raise
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        m = json.loads(text)
    except json.JSONDecodeError:
        return None
    batches = tuple(Batch(b["run"], b["folder"], tuple((f, n) for f, n in b["files"])) for b in m["batches"])
    return Manifest(m["version"], m["schema"], batches, m["committed_at"])


def current_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest of the newest version that is complete."""
    for v in reversed(versions(spark, path)):
        if (m := read_manifest(spark, path, v)) is not None:
            return m
    return None


def current_version(spark: SparkSession, path: str) -> int | None:
    m = current_manifest(spark, path)
    return None if m is None else m.version


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of a published table, by default the current one; exactly the files that its manifest lists."""
    path = path.rstrip("/")
    m = current_manifest(spark, path) if version is None else read_manifest(spark, path, version)
    if m is None:
        raise FileNotFoundError(f"no published table at {path}" if version is None else f"no version {version} of the table at {path}")
    schema = StructType.fromJson(m.schema)
    flat, frames = [], []
    for b in m.batches:
        files, base = [f"{_parent(path)}/{f}" for f, _ in b.files], f"{_parent(path)}/{b.folder}"
        if all(f.rsplit("/", 1)[0] == b.folder for f, _ in b.files):
            flat += files
        elif files:
            # Columns of a partitioned batch come from the names of the folders below it.
            frames.append(spark.read.schema(schema).option("basePath", base).parquet(*files))
    if flat or not frames:
        frames.append(spark.read.schema(schema).parquet(*flat) if flat else spark.createDataFrame([], schema))
    return reduce(DataFrame.unionByName, (f.select(*schema.names) for f in frames))


def _files(spark: SparkSession, base: str, folder: str) -> tuple[tuple[str, int], ...]:
    """Data files of a folder with their sizes, relative to ``base``."""
    fs, p = file_system(spark, f"{base}/{folder}")
    if not fs.exists(p):
        return ()
    root, found, listed = fs.makeQualified(p).toUri().getPath(), [], fs.listFiles(p, True)
    while listed.hasNext():
        s = listed.next()
        if not s.getPath().getName().startswith(("_", ".")):
            found.append((folder + s.getPath().toUri().getPath().removeprefix(root), s.getLen()))
    return tuple(sorted(found))


def _names_and_types(schema: dict) -> list[tuple]:
    return [(f["name"], json.dumps(f["type"])) for f in schema["fields"]]


def commit(spark: SparkSession, path: str, batch: Batch, schema: StructType, mode: str) -> Manifest:
    """Put the manifest of the table's next version.

    ``overwrite``: the version is this batch alone.  ``append``: it is the
    current version's batches and this one, which takes the place of a batch
    of the same run; so a run that is repeated, finished or not, leaves no row
    twice.
    """
    before = current_manifest(spark, path)
    kept: tuple[Batch, ...] = ()
    if mode == "append" and before is not None:
        if _names_and_types(before.schema) != _names_and_types(schema.jsonValue()):
            raise ValueError(f"the rows to append to {path} have other columns than the table")
        kept = tuple(b for b in before.batches if b.run != batch.run)
    # A version that is not complete still has its number.
    version = max(versions(spark, path), default=0) + 1
    m = Manifest(version, schema.jsonValue(), (*kept, batch), time.time())
    fs, p = file_system(spark, _manifest_path(path, version))
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getSimpleName():
            raise PublishConflictError(f"another publish has committed version {version} of {path}") from e
        raise
    out.write(bytearray(json.dumps(asdict(m)).encode()))
    out.close()
    return m


def expire(spark: SparkSession, paths: Iterable[str], keep: int = KEEP) -> None:
    """Drop all but the last ``keep`` complete versions of the tables, and the batch folders that only dropped versions list.

    ``paths`` are all tables that share batch folders.  Folders that no version lists (of running or killed jobs) are left to
    :func:`vacuum`.
    """
    listed: set[str] = set()
    gone: dict[str, str] = {}
    old: list[tuple[str, int]] = []
    for path in paths:
        complete = [m for v in versions(spark, path) if (m := read_manifest(spark, path, v)) is not None]
        listed |= {f"{_parent(path)}/{b.folder}" for m in complete[-keep:] for b in m.batches}
        for m in complete[:-keep]:
            old.append((path, m.version))
            gone |= {f"{_parent(path)}/{b.folder}": path for b in m.batches}
    for path, version in old:
        delete_folder(spark, _manifest_path(path, version))
    for folder in gone.keys() - listed:
        delete_folder(spark, folder)


def vacuum(spark: SparkSession, out: str, tables: Iterable[str], older_than_hours: float = 24.0) -> list[str]:
    """Delete run folders below ``out`` that no version of the tables lists and that are older than any job still running; returns them.

    For what killed jobs left behind.  A younger folder may belong to a publish that has not committed yet.
    """
    out = out.rstrip("/")
    listed = {b.folder for t in tables for v in versions(spark, f"{out}/{t}") if (m := read_manifest(spark, f"{out}/{t}", v)) for b in m.batches}
    fs, p = file_system(spark, f"{out}/{DATA}")
    gone = []
    for s in fs.listStatus(p) if fs.exists(p) else ():
        folder = f"{DATA}/{s.getPath().getName()}"
        if s.getModificationTime() < (time.time() - older_than_hours * 3600) * 1000 and not any(f.startswith(f"{folder}/") for f in listed):
            delete_folder(spark, f"{out}/{folder}")
            gone.append(folder)
    return gone


def _check_mode(mode: str) -> None:
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unsupported mode {mode!r}")


def publish(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, run: str | None = None, keep: int = KEEP
) -> None:
    """OP-32: publish one result table below the folder ``path``.

    ``overwrite`` replaces the table in full (CREATE OR REPLACE / truncate +
    load); ``append`` adds rows (INSERT), once for each ``run``: repeating a
    run replaces what it added.  Without ``run`` every call is a run of its own.
    A failed job leaves the table as it was; its rows are in no manifest.
    """
    _check_mode(mode)
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"{path.rsplit('/', 1)[1]}/data/{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    target = f"{_parent(path)}/{folder}"
    try:
        writer.parquet(target)
        commit(spark, path, Batch(run or uuid.uuid4().hex, folder, _files(spark, _parent(path), folder)), df.schema, mode)
    except BaseException:
        delete_folder(spark, target)
        raise
    expire(spark, [path], keep)


#: Folder of the data of :class:`Publication`, one folder per run below it.
DATA = "_data"


class Publication(Materializer):
    """Publishes many tables of one pipeline run below ``out``, each written once.

    ``stages`` names the stages that are results, with the columns they are
    partitioned by.  A result goes straight to the folder of this run below
    ``out``; later stages read it from there, and :meth:`commit` lists the same
    files in the tables' manifests.  Other stages go to the work folder.
    """

    def __init__(self, spark: SparkSession, out: str, stages: dict[str, list[str]], mode: str = "overwrite", run: str | None = None, keep: int = KEEP):
        _check_mode(mode)
        super().__init__(spark)
        self.out, self.stages, self.mode, self.keep = out.rstrip("/"), stages, mode, keep
        self.run = run or uuid.uuid4().hex
        self.data = f"{DATA}/{uuid.uuid4().hex}"
        self.schemas: dict[str, StructType] = {}

    def __call__(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        if name not in self.stages:
            return super().__call__(df, name, partition_by)
        self.schemas[name] = df.schema
        return self._write(df, f"{self.out}/{self.data}/{name}", self.stages[name])

    def commit(self, tables: dict[str, tuple[str, str | None]]) -> None:
        """Commit each table: its stage and, for a part of a partitioned stage, the part's folder (``column=value``).

        Tables are committed one after the other, each at once.  After a
        failure in between, the same run again commits all of them.
        """
        for table, (stage, part) in tables.items():
            folder = f"{self.data}/{stage}" + (f"/{part}" if part else "")
            fields = [f for f in self.schemas[stage] if not part or f.name != part.split("=", 1)[0]]
            batch = Batch(self.run, folder, _files(self.spark, self.out, folder))
            commit(self.spark, f"{self.out}/{table}", batch, StructType(fields), self.mode)
        expire(self.spark, [f"{self.out}/{t}" for t in tables], self.keep)

    def abandon(self) -> None:
        """Delete what this run has written, unless some table already lists it."""
        fs, p = file_system(self.spark, self.out)
        for s in fs.listStatus(p) if fs.exists(p) else ():
            table = f"{self.out}/{s.getPath().getName()}"
            m = None if s.getPath().getName() == DATA else current_manifest(self.spark, table)
            if m is not None and any(b.folder.startswith(f"{self.data}/") for b in m.batches):
                return
        delete_folder(self.spark, f"{self.out}/{self.data}")
