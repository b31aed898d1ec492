"""Helpers shared by the operators: shared-folder tables, text words, row positions."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from provgraph.plans.publish import work_root

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Byte table that lower-cases A-Z and leaves every other byte of UTF-8 alone.
LOWER_TABLE = bytes.maketrans(_UPPER.encode(), _LOWER.encode())


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_shipped_package", False):
        return
    package = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp(prefix="package-"))
    with zipfile.ZipFile(path := folder / f"{package.name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    sc._shipped_package = True


#: Spark's setting that a query's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Parquet tables in a folder of their own below the shared work folder.

    A saved table cuts lineage: losing an executor never loses it, and what
    its writing shuffled goes with the write.  Tables
    that only later steps of the same operator read are dropped by it; those
    that the returned (lazy) frame reads stay until the caller drops them.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.folder = f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._shared: list[Broadcast] = []

    def save(self, df: DataFrame, *, sort_by: list[str] | None = None) -> DataFrame:
        self._n += 1
        path = f"{self.folder}/{self._n}"
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        while self._shared:
            self._shared.pop().destroy()
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def share(self, value) -> Broadcast:
        """Broadcast what the next table that is saved, and no later one, is computed with."""
        self._shared.append(self.spark.sparkContext.broadcast(value))
        return self._shared[-1]

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for f in frames:
            p = jvm.org.apache.hadoop.fs.Path(f._scratch_path)
            p.getFileSystem(conf).delete(p, True)


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text, A-Z lower-cased; null has none."""
    return text.translate(LOWER_TABLE).split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, all other characters kept."""
    return F.translate(c, _UPPER, _LOWER)


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``mod``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(mod)


def split(rows: DataFrame, key: str, keys: DataFrame, of: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` may be among the values ``of`` of ``keys``, rows whose key is not).

    A map of 2 ** 27 bits at most, 16 MB whatever the size of ``keys``, goes to
    the scan, so that of the rows without a partner few meet a shuffle.  It
    only ever lets too many rows through, and the first part is still to be
    joined.  Both parts read ``rows``.  A null key is a value like any other.
    """
    place = lambda c: F.xxhash64(c).bitwiseAND(F.lit((1 << 27) - 1))
    # At most 4,096 rows of 4 KB.
    bits = keys.select(place(keys[of]).alias("p")).groupBy(F.shiftright("p", 15).alias("bucket")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(32767))).alias("bits"))
    mine = place(rows[key].cast(keys.schema[of].dataType))
    bit = mine.bitwiseAND(F.lit(32767)).cast("int")
    byte = F.conv(F.hex(F.substring(bits["bits"], F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    may = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7))) == 1, F.lit(False))
    held = rows.join(F.broadcast(bits), F.shiftright(mine, 15) == bits["bucket"], "left")
    return held.where(may).select(rows["*"]), held.where(~may).select(rows["*"])


def numbered(scratch: Scratch, df: DataFrame, by: list[str], name: str = "pos") -> DataFrame:
    """Add a gapless 0-based position in the order of ``by``.

    Range-partitioned sort; each partition numbers its own rows and adds the
    rows of the partitions before it.  The per-partition counts (one row for
    each shuffle partition) are the only thing that one task sees whole.
    """
    spark = scratch.spark
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = scratch.save(df.repartitionByRange(n, *by).withColumn("_part", F.spark_partition_id()))
    starts = (
        part.groupBy("_part").count()
        .withColumn("_start", F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .select("_part", F.coalesce("_start", F.lit(0)).alias("_start"))
    )
    local = part.withColumn(name, F.row_number().over(Window.partitionBy("_part").orderBy(*by)) - 1)
    return local.join(F.broadcast(starts), "_part").withColumn(name, F.col(name) + F.col("_start")).drop("_part", "_start")


def row_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of consecutive rows with equal keys, as tables."""
    last, held = None, []
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1 if b.num_rows else []
        for start, end in pairwise([0, *change, b.num_rows]):
            if start == end:
                continue
            key = tuple(c[start] for c in cols)
            if key != last and held:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(start, end - start))
    if held:
        yield last, pa.Table.from_batches(held)
