"""Final assembly, directory-only rows, uplift and inclusion (OP-25 .. OP-31).

Everything here is at affiliation grain.  OP-25 deals rows by physician: the
affiliations are exchanged once, for the physicians' running totals; the other
frames keyed by (physician, company) are united, gathered and joined as they
lie, and the rank within a firm type finds its rows in place
(``spark.sql.requireAllClusterKeysForCoPartition=false``; otherwise Spark
exchanges them again for the join on both keys).  A physician's rows are
bounded by the companies.  In-place UPDATE / INSERT of the original become
conditional projections and a ``unionByName`` in DAG order (Q21, Q24).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provgraph.config import PipelineConfig
from provgraph.functions.dialect import canonical_long, rounded
from provgraph.operators.rollup import FEATURES, SUMMARY_COLUMNS
from provgraph.operators.shares import with_claim_shares

ASSEMBLED_COLUMNS = SUMMARY_COLUMNS + [
    "other_source_flag",
    "current_flag",
    "score",
    "score_bucket",
    "current_decay_remaining_val",
    "pct_claims_mcr",
    "pct_claims_comm",
    "pct_claims",
    "firm_type_rank",
    "patients_comm",
    "patients_mcr",
]
FINAL_COLUMNS = ASSEMBLED_COLUMNS + ["include_flag"]
KEY = ["physician_npi", "company_id"]


def other_source_pairs(group_affils: DataFrame, hospital_affils: DataFrame) -> DataFrame:
    """OP-26 input: distinct (physician, company) pairs known to the directory."""
    pick = lambda df: df.select(F.col("npi").alias("physician_npi"), F.col("hospital_id").alias("company_id"))
    return pick(group_affils).unionByName(pick(hospital_affils)).distinct()


def other_source_flag(in_directory: str):
    """OP-26: 1 when the affiliation is also in the directory, else 0."""
    return F.when(F.col(in_directory), 1).otherwise(0)


def current_flag(remaining: str, cfg: PipelineConfig):
    """OP-27: 1 when the remaining value (rounded, Q16) reaches the threshold."""
    v = rounded(remaining, cfg.boundary_digits)
    return F.when(v >= cfg.current_threshold, 1).otherwise(0)


def firm_type_rank(score: str, cfg: PipelineConfig):
    """OP-28: ROW_NUMBER per (physician, firm type) by score, ties by company id (Q22)."""
    w = Window.partitionBy("physician_npi", "firm_type").orderBy(
        rounded(score, cfg.boundary_digits).desc(), F.col("company_id")
    )
    return F.row_number().over(w)


def feature_rows(pairs: DataFrame, patients_comm: DataFrame, patients_mcr: DataFrame) -> DataFrame:
    """The directory pairs and patient counts as rows (physician, company, one of :data:`rollup.FEATURES`).

    The rollup takes them along with the edges (:func:`rollup.unify_edges`).
    """
    by_column = {"in_directory": pairs.withColumn("in_directory", F.lit(True)), "patients_comm": patients_comm, "patients_mcr": _numeric_physicians(patients_mcr)}
    nulls = {c: F.lit(None).cast(t).alias(c) for c, t in FEATURES.items()}
    return reduce(DataFrame.unionByName, [df.select(*KEY, *[F.col(c) if c == name else nulls[c] for c in FEATURES]) for name, df in by_column.items()])


def _numeric_physicians(patients_mcr: DataFrame) -> DataFrame:
    """Medicare patients by the numeric physician id; raw strings that are no number's canonical form drop out."""
    numeric = patients_mcr.select(canonical_long("physician_npi").alias("physician_npi"), "company_id", "patients_mcr")
    return numeric.filter(F.col("physician_npi").isNotNull())


def gather(affiliations: DataFrame, features: dict[str, DataFrame]) -> DataFrame:
    """Left join ``affiliations`` with frames that have one row per (physician, company) and one column, named by the key of ``features``.

    The frames, narrow as they are, are united and gathered by their key first, dealt by physician as the affiliations are.
    """
    types = {c: df.schema[c].dataType for c, df in features.items()}
    rows = [df.select(*KEY, *[F.col(c) if c == name else F.lit(None).cast(t).alias(c) for c, t in types.items()]) for name, df in features.items()]
    gathered = reduce(DataFrame.unionByName, rows).repartition("physician_npi").groupBy(*KEY).agg(*[F.max(c).alias(c) for c in types])
    return affiliations.join(gathered, KEY, "left")


def assemble(
    scored: DataFrame,
    pairs: DataFrame | None,
    running_totals: DataFrame | None,
    patients_comm: DataFrame | None,
    patients_mcr: DataFrame | None,
    cfg: PipelineConfig,
) -> DataFrame:
    """OP-25: affiliation summary + flags, score, decay, shares and patients.

    ``scored`` is the affiliation summary with decay, score and bucket
    columns (all 1:1 per affiliation), ``running_totals`` the physicians'
    (:func:`shares.physician_running_totals`), none where ``scored`` has the
    shares already.  Medicare patients are keyed by
    the raw physician string; only the canonical decimal form can equal
    ``CAST(npi AS STRING)``, so it is converted to the numeric key first.
    ``has_totals`` tells the affiliations that OP-13 has a row for.
    No ``pairs``: the rollup has brought the features (:func:`feature_rows`);
    the bucket may then follow, when the bounds of the scores are known.
    """
    gathered = scored if running_totals is None else with_claim_shares(scored, running_totals, "left")
    if pairs is not None:
        gathered = gather(gathered, {"in_directory": pairs.withColumn("in_directory", F.lit(True)), "patients_comm": patients_comm, "patients_mcr": _numeric_physicians(patients_mcr)})
    if "firm_type_rank" not in gathered.columns:
        gathered = gathered.withColumn("firm_type_rank", firm_type_rank("score", cfg))
    return gathered.withColumns(
        {
            "other_source_flag": other_source_flag("in_directory"),
            "current_flag": current_flag("current_decay_remaining_val", cfg),
        }
    ).select(*[c for c in ASSEMBLED_COLUMNS if c != "score_bucket" or c in gathered.columns], "has_totals")


def directory_only_rows(assembled: DataFrame, hospital_affils: DataFrame, group_affils: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """OP-29: directory affiliations with no claim edge, five columns set.

    Hospitals: bucket ``7 - rank`` when the physician has no 'Hospital' claim
    edge at all, else 2.  Physician groups: bucket 6.  Both are flagged as
    other-source.  Both branches read the table before the insert (Q24).
    ``pairs``: the table as rows are looked up in it by :data:`KEY`, if that
    is not left to Spark.
    """
    edges = (assembled if pairs is None else pairs).select(F.col("physician_npi").alias("npi"), F.col("company_id").alias("hospital_id"))
    with_hospital_edge = (
        assembled.filter(F.col("firm_type") == "Hospital")
        .select(F.col("physician_npi").alias("npi"))
        .distinct()
        .withColumn("_has_hospital", F.lit(True))
    )
    hosp = (
        hospital_affils.join(edges, ["npi", "hospital_id"], "left_anti")
        .join(with_hospital_edge, "npi", "left")
        .select(
            F.col("npi").alias("physician_npi"),
            F.col("hospital_id").alias("company_id"),
            "firm_type",
            F.when(F.col("_has_hospital"), F.lit(2)).otherwise(7 - F.col("affiliation_rank")).cast("long").alias(
                "score_bucket"
            ),
            F.lit(1).alias("other_source_flag"),
        )
    )
    groups = group_affils.join(edges, ["npi", "hospital_id"], "left_anti").select(
        F.col("npi").alias("physician_npi"),
        F.col("hospital_id").alias("company_id"),
        "firm_type",
        F.lit(6).cast("long").alias("score_bucket"),
        F.lit(1).alias("other_source_flag"),
    )
    return hosp.unionByName(groups)


def uplift_bucket(df: DataFrame) -> DataFrame:
    """OP-30: corroborated claim affiliations move up one bucket.

    Applies to rows with claims and other-source = 1: a physician group
    below 6 goes to 6, 10 stays 10, else +1.
    """
    claims = F.coalesce(F.col("comm_claims"), F.lit(0)) + F.coalesce(F.col("mcr_claims"), F.lit(0))
    applies = (claims > 0) & (F.col("other_source_flag") == 1)
    b = F.col("score_bucket")
    raised = (
        F.when((F.col("firm_type") == "Physician Group") & (b < 6), F.lit(6).cast("long"))
        .when(b == 10, F.lit(10).cast("long"))
        .otherwise(b + 1)
    )
    return df.withColumn("score_bucket", F.when(applies, raised).otherwise(b))


def include_flag(cfg: PipelineConfig):
    """OP-31: the inclusion rule (three-valued logic as in SQL: unknown -> 0)."""
    c = F.col
    strong = (
        (c("score_bucket") > 1)
        & ((c("pct_claims_mcr") > cfg.share_threshold) | (c("pct_claims_comm") > cfg.share_threshold) | (c("firm_type_rank") == 1))
        & (c("months") > 1)
        & ((F.coalesce(c("patients_comm"), F.lit(0)) + F.coalesce(c("patients_mcr"), F.lit(0))) > 2)
    )
    return F.when(strong | (c("score_bucket") >= 6) | (c("other_source_flag") == 1), 1).otherwise(0)


def finalize(assembled: DataFrame, hospital_affils: DataFrame, group_affils: DataFrame, cfg: PipelineConfig, pairs: DataFrame | None = None) -> DataFrame:
    """OP-29 -> OP-30 -> OP-31 in order; 31 columns."""
    appended = assembled.unionByName(
        directory_only_rows(assembled, hospital_affils, group_affils, pairs), allowMissingColumns=True
    )
    return uplift_bucket(appended).withColumn("include_flag", include_flag(cfg)).select(*FINAL_COLUMNS)
