"""Discovery of claim files from the folders of a partitioned dataset (OP-03's input); no row is read."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provgraph.config import PipelineConfig
from provgraph.plans.publish import file_system
from provgraph.sources.schemas import MEDICARE_FILES

#: How Spark names the folder of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def partition_folders(spark: SparkSession, path: str, columns: Sequence[str]) -> list[tuple[str | None, ...]]:
    """Values of the first partition levels below ``path``, from folder names ``column=value``.

    One listing for each folder of a level but the last; folders below the
    asked levels are not listed.  A folder without any data file in it counts
    if its name does, as an empty table of the catalog would.
    """
    fs, root = file_system(spark, path)
    found: list[tuple[tuple, object]] = [((), root)]
    for column in columns:
        below = []
        for values, folder in found:
            for s in fs.listStatus(folder):
                name = s.getPath().getName()
                if s.isDirectory() and name.startswith(f"{column}="):
                    value = unquote(name.split("=", 1)[1])
                    below.append(((*values, None if value == NULL_FOLDER else value), s.getPath()))
        found = below
    return sorted((v for v, _ in found), key=str)


def medicare_files(spark: SparkSession, path: str) -> DataFrame:
    """The (vintage, release) files of a Medicare claims dataset partitioned by them; two rows per year at most."""
    listed = partition_folders(spark, path, ("vintage", "release"))
    rows = [(int(v), r) for v, r in listed if v is not None and v.isdigit() and r is not None]
    return spark.createDataFrame(rows, MEDICARE_FILES)


def newest_file(claims: DataFrame, files: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The newest vintage's quarterly file, or its annual one if there is no other, with its latest service date (OP-21's Medicare clock).

    One row; of a partitioned dataset only that file's folder is scanned.
    """
    newest = F.max(F.struct("vintage", (F.col("release") == "quarterly").alias("quarterly"), "release"))
    file = files.filter(F.col("vintage") > cfg.vintage_floor).agg(newest.alias("f")).select("f.vintage", "f.release")
    return (
        claims.join(F.broadcast(file), ["vintage", "release"], "left_semi")
        .groupBy("vintage", "release").agg(F.max("clm_thru_dt").alias("max_clm_thru_dt"))
    )
