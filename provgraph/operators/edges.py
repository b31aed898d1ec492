"""Monthly physician -> organisation edge lists (OP-01 .. OP-07).

Each claim source is scanned once; edges, physician totals and patients all
start from what is written then.  A claim is expanded in its row into its
organisation or physician roles (an ``inline`` of a small array, no shuffle),
so all edge lists of a source come out of a single dedup + aggregate.
Commercial ids are resolved by two joins, one for the physician and one for
the organisations of all roles.

Claims are dealt once, by physician, organisation and month: the DISTINCT and
the count find their rows there.  A physician or organisation with a huge share
of the claims, blank ids included, is spread over its partners and months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.config import PipelineConfig
from provgraph.functions.dialect import claim_year_month, month_start, packed_date, tsql_int, unpadded

EDGE_COLUMNS = [
    "physician_npi",
    "claim_month",
    "org_npi",
    "claims",
    "min_service_to_date",
    "max_service_to_date",
]

COMMERCIAL_ROLES = {"billing": "billing_npiid", "service_facility": "service_facility_npiid"}
MEDICARE_ROLES = {"attending": "at_physn_npi", "operating": "op_physn_npi", "rendering": "rndrng_physn_npi"}


def expand_roles(df: DataFrame, roles: dict[str, dict[str, str]], role_col: str) -> DataFrame:
    """One output row per (input row, role), with the role's own columns under common names; no shuffle."""
    rows = [F.struct(F.lit(r).alias(role_col), *[F.col(c).alias(name) for name, c in cols.items()]) for r, cols in roles.items()]
    return df.select("*", F.inline(F.array(*rows)))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt by physician, organisation and month, over all shuffle partitions.

    The DISTINCT and the count that follow hold their rows in hash tables of one
    task, so the partitions are not coalesced by their small packed size.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "physician_npi", "org_npi", "claim_month")


def _any_role(roles, role_col: str, predicate) -> Column:
    keep = None
    for r in roles:
        p = (F.col(role_col) == r) & predicate(r)
        keep = p if keep is None else keep | p
    return keep


# --------------------------------------------------------------------------- commercial


def _commercial_role_predicate(role: str) -> Column:
    org, rendering = F.col("org_npiid"), F.col("rendering_npiid")
    if role == "billing":
        return org.isNotNull() & (org != rendering)
    if role == "service_facility":
        # facility <> IFNULL(billing, 0); facility = rendering is not excluded (Q1)
        return org.isNotNull() & (org != F.coalesce(F.col("billing_npiid"), F.lit(0)))
    raise ValueError(role)


def billed_by_other() -> Column:
    """The claim's billing id differs from the rendering id; a claim without a billing id is not (Q10)."""
    return F.col("billing_npiid") != F.col("rendering_npiid")


def totals_role() -> Column:
    """The row holds the claim's first non-null organisation id (billing, else facility), and it differs from the rendering id (Q2)."""
    first = (F.col("org_role") == "billing") | F.col("billing_npiid").isNull()
    return first & (F.col("org_npiid") != F.col("rendering_npiid"))


def commercial_claim_grain(claims: DataFrame, crosswalk: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """A row per commercial claim, from the first claim year on, and organisation role with an id; ids resolved.

    The rendering NPIID becomes ``physician_npi`` (a claim whose rendering id
    is NULL or unknown drops out of every consumer).  Then a claim becomes one
    row per role that an edge list, the totals or the patients can use, so that
    a single join resolves the organisations of both roles: ``org_npi``,
    ``org_company_id``, ``org_known``.  Where the crosswalk is broadcast no
    claim is exchanged, else twice.  Repeated claims are left to the consumers,
    each of which has a DISTINCT of its own, with map-side combination.
    """
    base = claims.filter(F.col("claim_year") >= cfg.min_claim_year).select(
        "claim_year", "service_to_date", "rendering_npiid", "billing_npiid", "service_facility_npiid", "dpid"
    )
    physician = crosswalk.select(F.col("npiid").alias("rendering_npiid"), F.col("npi").alias("physician_npi"))
    roles = expand_roles(base.join(physician, "rendering_npiid"), {r: {"org_npiid": c} for r, c in COMMERCIAL_ROLES.items()}, "org_role")
    used = _any_role(COMMERCIAL_ROLES, "org_role", _commercial_role_predicate) | billed_by_other() | totals_role()
    org = crosswalk.select(
        F.col("npiid").alias("org_npiid"), F.col("npi").alias("org_npi"), F.col("company_id").alias("org_company_id"), F.lit(True).alias("org_known")
    )
    return roles.filter(F.col("org_npiid").isNotNull() & used).drop("service_facility_npiid").join(org, "org_npiid", "left")


def commercial_roles(resolved: DataFrame, roles=tuple(COMMERCIAL_ROLES)) -> DataFrame:
    """The rows of these roles whose organisation id the crosswalk knows."""
    return resolved.filter(F.col("org_known") & F.col("org_role").isin(*roles))


def commercial_edges_by_role(resolved: DataFrame, roles=tuple(COMMERCIAL_ROLES)) -> DataFrame:
    """Edges for several organisation roles in one pass, from :func:`commercial_claim_grain`.

    Returns ``org_role`` plus :data:`EDGE_COLUMNS`.  Per role: keep claims that
    meet the role predicate, DISTINCT (claim year, service date, rendering NPI,
    org NPI, patient), then count with min/max service date per (rendering,
    claim year, claim month, org).  The claim year stays a hidden group key.
    """
    visits = (
        commercial_roles(resolved, roles)
        .filter(_any_role(roles, "org_role", _commercial_role_predicate))
        # From a generator, so that the dates are parsed once: later filters on the month would repeat the expression.
        .select("org_role", "claim_year", "physician_npi", "org_npi", "dpid", F.inline(F.array(F.struct(packed_date("service_to_date").alias("service_date")))))
        .withColumn("claim_month", claim_year_month("claim_year", "service_date"))
    )
    visits = _dealt(visits).dropDuplicates()
    return (
        visits.groupBy("org_role", "physician_npi", "claim_year", "claim_month", "org_npi")
        .agg(
            F.count(F.lit(1)).alias("claims"),
            F.min("service_date").alias("min_service_to_date"),
            F.max("service_date").alias("max_service_to_date"),
        )
        .select("org_role", *EDGE_COLUMNS)
    )


def commercial_edges(claims: DataFrame, crosswalk: DataFrame, cfg: PipelineConfig, role: str) -> DataFrame:
    """OP-01 (``role='billing'``) / OP-02 (``role='service_facility'``)."""
    return commercial_edges_by_role(commercial_claim_grain(claims, crosswalk, cfg), (role,)).drop("org_role")


# --------------------------------------------------------------------------- Medicare


def select_vintages(available: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """OP-03: which (vintage, release) files to read.

    Every vintage above the floor with an annual file uses it; a vintage with
    only a quarterly file uses that.  ``available`` is the small catalog of
    existing files (one row per vintage and release).
    """
    files = available.select("vintage", "release").filter(F.col("vintage") > cfg.vintage_floor).distinct()
    annual = files.filter(F.col("release") == "annual")
    quarterly_only = files.filter(F.col("release") == "quarterly").join(
        annual.select("vintage"), "vintage", "left_anti"
    )
    return annual.unionByName(quarterly_only)


def selected_claims(claims: DataFrame, available: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Claims of the selected files only.

    The selection has at most two rows per calendar year, so it is broadcast;
    on a dataset partitioned by vintage/release this semi join becomes
    dynamic partition pruning of the claim scan.
    """
    sel = select_vintages(available, cfg)
    return claims.join(F.broadcast(sel), ["vintage", "release"], "left_semi")


def medicare_claim_grain(claims: DataFrame) -> DataFrame:
    """The Medicare claims, ids without the trailing blanks that comparisons ignore.

    Repeated claims are left to the consumers: the events have a DISTINCT of
    their own, the patients are counted distinct.
    """
    ids = ["org_npi_num", *MEDICARE_ROLES.values()]
    return claims.select("vintage", "claim_type", "clm_thru_dt", "desy_sort_key", *[unpadded(c).alias(c) for c in ids])


def _medicare_role_predicate(role: str) -> Column:
    npi_raw, org_raw = F.col("npi_raw"), F.col("org_npi_num")
    # All comparisons are on the raw strings, before the cast (Q7); a NULL
    # attending / operating id compares as '0'.
    p = npi_raw != org_raw
    if role in ("operating", "rendering"):
        p = p & (npi_raw != F.coalesce(F.col("at_physn_npi"), F.lit("0")))
    if role == "rendering":
        p = p & (npi_raw != F.coalesce(F.col("op_physn_npi"), F.lit("0")))
    return p


def medicare_events(grain: DataFrame, roles: tuple[str, ...] = tuple(MEDICARE_ROLES)) -> DataFrame:
    """OP-04: normalised, de-duplicated claim events per role with their month, from :func:`medicare_claim_grain`.

    Claim type and vintage are part of the DISTINCT, which is what DISTINCT
    inside each per-type branch followed by UNION ALL gives (Q5).  The rows
    stay where :func:`medicare_edges_by_role` counts them.
    """
    # The organisation id is the same for every role: cast and test it once
    # per claim, before the rows are multiplied by the role expansion.
    base = grain.withColumn("org_npi", tsql_int("org_npi_num")).filter(F.col("org_npi").isNotNull())
    expanded = expand_roles(base, {r: {"npi_raw": MEDICARE_ROLES[r]} for r in roles}, "role")
    events = (
        expanded.filter(_any_role(roles, "role", _medicare_role_predicate))
        .withColumn("physician_npi", tsql_int("npi_raw"))
        .filter(F.col("physician_npi").isNotNull())
        .select(
            "role",
            "vintage",
            "claim_type",
            F.col("clm_thru_dt").alias("service_to_date"),
            "physician_npi",
            "org_npi",
            F.col("desy_sort_key").alias("patient"),
            month_start("clm_thru_dt").alias("claim_month"),
        )
    )
    return _dealt(events).dropDuplicates()


def medicare_edges_by_role(events: DataFrame) -> DataFrame:
    """OP-05/06/07 for all roles present in ``events``: ``role`` + EDGE_COLUMNS.

    The vintage stays a hidden group key, so an (npi, org, month) can repeat
    when a vintage holds dates of another year (Q4).  Attending edges drop
    NPI 0 and org 0; operating and rendering edges keep them (Q6).
    """
    edges = events.groupBy(
        "role", "physician_npi", "vintage", "claim_month", "org_npi"
    ).agg(
        F.count(F.lit(1)).alias("claims"),
        F.min("service_to_date").alias("min_service_to_date"),
        F.max("service_to_date").alias("max_service_to_date"),
    )
    not_blank = (F.col("physician_npi") != 0) & (F.col("org_npi") != 0)
    return edges.filter((F.col("role") != "attending") | not_blank).select("role", *EDGE_COLUMNS)


def medicare_edges(claims: DataFrame, available: DataFrame, cfg: PipelineConfig, role: str) -> DataFrame:
    """One Medicare edge list (OP-05 attending, OP-06 operating, OP-07 rendering)."""
    events = medicare_events(medicare_claim_grain(selected_claims(claims, available, cfg)), (role,))
    return medicare_edges_by_role(events).drop("role")
