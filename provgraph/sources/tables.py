"""The set of source DataFrames the pipeline reads."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from provgraph.plans.publish import file_system
from provgraph.sources.catalog import medicare_files
from provgraph.sources.schemas import ROLE_SCHEMAS, conform


def fits_broadcast(df: DataFrame, rows: int | None = None) -> bool:
    """Whether a table is within the session's broadcast threshold by the number of its rows and the width of its columns.

    Spark's own check goes by the size of the files.  Ids in sequence take a
    byte or two of a packed file each, and twenty times that in the table that
    the driver builds of them.  ``rows``: their number, if known; those of
    Parquet files are counted by their footers.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    # As Spark reckons a row: its columns and eight bytes.
    return limit > 0 and (df.count() if rows is None else rows) * (df._jdf.schema().defaultSize() + 8) <= limit


def lookup(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A table that others are joined with: by a merge join where it does not fit a broadcast, else as Spark decides."""
    return df if fits_broadcast(df, rows) else df.hint("merge")


@dataclass(frozen=True)
class Sources:
    commercial_claims: DataFrame
    medicare_claims: DataFrame
    medicare_availability: DataFrame
    crosswalk: DataFrame
    physicians: DataFrame
    companies: DataFrame
    claim_availability: DataFrame
    directory_physicians: DataFrame
    group_practice: DataFrame
    physician_groups: DataFrame
    surgery_centers: DataFrame
    imaging_centers: DataFrame

    @property
    def medicare_files(self) -> DataFrame | None:
        """The Medicare claim files by the folders of the dataset; none where it is not known to be partitioned by them."""
        return getattr(self, "_medicare_files", None)

    @staticmethod
    def from_parquet(spark: SparkSession, root: str) -> "Sources":
        """Read one Parquet dataset per role from ``{root}/{role}``.

        ``medicare_claims`` is expected to be partitioned by
        ``vintage/release/claim_type``: vintage selection prunes files then,
        and the folders tell which files there are, so that
        ``medicare_availability`` may be left out.
        """
        frames: dict[str, DataFrame] = {}
        files = medicare_files(spark, f"{root}/medicare_claims")
        listed = bool(files.head(1))
        for f in fields(Sources):
            fs, p = file_system(spark, f"{root}/{f.name}")
            if f.name == "medicare_availability" and listed and not fs.exists(p):
                frames[f.name] = spark.createDataFrame([], ROLE_SCHEMAS[f.name])
            else:
                frames[f.name] = conform(spark.read.parquet(f"{root}/{f.name}"), ROLE_SCHEMAS[f.name])
        sources = Sources(**frames)
        if listed:
            object.__setattr__(sources, "_medicare_files", files)
        return sources
