"""Derive the claim-pipeline source roles from the driver's TPC-H-style tables.

Every role is a Spark transformation of the given tables, so its size grows
with the scale factor.  Ids are offset so that no derived id is 0 (0 means
"blank" to the pipeline):

- physician  = 1,000,000,000 + o_custkey / c_custkey
- billing    = 1,100,000,000 + l_partkey / p_partkey
- facility   = 1,200,000,000 + l_suppkey / s_suppkey
- company    = s_suppkey + 1; its firm type goes by s_suppkey modulo 5
- patient    = o_orderkey

Claims come from lineitem joined to orders: line status 'O' rows become
commercial claims, 'F' rows Medicare claims.  Line numbers, tax and return
flags switch on the edge cases the pipeline must handle (blank and padded ids,
bad dates, claim-year shifts, duplicated claims).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provgraph.plans.publish import Materializer
from provgraph.sources.catalog import medicare_files
from provgraph.sources.schemas import ROLE_SCHEMAS, conform
from provgraph.sources.tables import Sources

# Fixed values of the adapter design.
PHYSICIAN_BASE = 1_000_000_000
BILLING_BASE = 1_100_000_000
FACILITY_BASE = 1_200_000_000
CLAIM_TYPES = ["inp", "out", "snf", "hha", "hosp"]
# Vintages below QUARTERLY_FROM have an annual file only, this one a quarterly
# file only; later ones have both, but the annual file of a year after
# LAST_FULL_ANNUAL ends with its ninth month.
QUARTERLY_FROM, LAST_FULL_ANNUAL, LAST_ANNUAL_MONTH = 1999, 2000, 9
FIRM_TYPES = ["Hospital", "Physician Group", "Ambulatory Surgery Center", "Imaging Center", "Hospital"]
# Extra availability row of another analysis type, this many days later.
OTHER_ANALYSIS_TYPE_SHIFT_DAYS = 40


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax",
        "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("d"),
    )
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).drop("o_orderkey")


def _commercial_claims(lines: DataFrame) -> DataFrame:
    ln, d = F.col("l_linenumber"), F.col("d")
    phys = F.lit(PHYSICIAN_BASE) + F.col("o_custkey")
    bill = F.lit(BILLING_BASE) + F.col("l_partkey")
    fac = F.lit(FACILITY_BASE) + F.col("l_suppkey")
    ymd = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    packed = (
        F.when((ln == 3) & (F.col("l_tax") >= 0.08), F.year(d) * 10000 + 1301)
        .when((ln == 3) & (F.col("l_tax") >= 0.07), F.year(d) * 10000 + F.month(d) * 100 + 32)
        .otherwise(ymd)
    )
    copies = F.when(F.col("l_returnflag") == "R", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    out = (
        lines.filter(F.col("l_linestatus") == "O")
        .select("*", F.explode(copies).alias("_copy"))
        .select(
            (F.year(d) - F.when((F.month(d) == 1) & (ln == 1), 1).otherwise(0)).alias("claim_year"),
            packed.alias("service_to_date"),
            phys.alias("rendering_npiid"),
            F.when(ln == 6, F.lit(None)).when(ln == 7, phys).otherwise(bill).alias("billing_npiid"),
            F.when(ln == 5, F.lit(None)).when(ln == 4, bill).otherwise(fac).alias("service_facility_npiid"),
            F.col("l_orderkey").alias("dpid"),
        )
    )
    return conform(out, ROLE_SCHEMAS["commercial_claims"])


def _medicare_claims(lines: DataFrame, n_customers: Column) -> DataFrame:
    ln, d = F.col("l_linenumber"), F.col("d")
    phys = (F.lit(PHYSICIAN_BASE) + F.col("o_custkey")).cast("string")
    vintage = F.year(d) - F.when((F.month(d) == 1) & (ln == 2), 1).otherwise(0)
    annual = (vintage < QUARTERLY_FROM) | (vintage == LAST_FULL_ANNUAL) | ((vintage > LAST_FULL_ANNUAL) & (F.month(d) <= LAST_ANNUAL_MONTH))
    releases = F.array_compact(
        F.array(F.when(annual, F.lit("annual")), F.when(vintage >= QUARTERLY_FROM, F.lit("quarterly")))
    )
    # Claim files are fixed width in places: some ids end in blanks.
    padded = lambda c, when: F.when(when, F.concat(c, F.lit("  "))).otherwise(c)
    types = F.array(*[F.lit(t) for t in CLAIM_TYPES])
    # Dealt by folder as lines: numbers, before the ids become text and lines are repeated for each release.
    dealt = (
        lines.filter(F.col("l_linestatus") == "F")
        .select("*", vintage.alias("_vintage"), F.element_at(types, (F.col("l_suppkey") % len(CLAIM_TYPES) + 1).cast("int")).alias("claim_type"))
        .hint("rebalance", F.col("_vintage"), F.col("claim_type"))
    )
    out = (
        dealt.select("*", vintage.alias("vintage"), F.explode(releases).alias("release"))
        .select(
            "vintage",
            "release",
            "claim_type",
            d.alias("clm_thru_dt"),
            F.when(ln == 7, F.lit("")).when(ln == 6, F.lit("UNKNOWN")).otherwise(padded(phys, ln == 4)).alias("at_physn_npi"),
            F.when(ln % 3 == 0, phys)
            .when(ln % 3 == 1, (F.lit(PHYSICIAN_BASE) + F.col("l_suppkey")).cast("string"))
            .otherwise(F.lit(""))
            .alias("op_physn_npi"),
            F.when(ln % 4 == 0, F.lit(None).cast("string"))
            .when(ln % 4 == 1, (F.lit(PHYSICIAN_BASE) + F.col("l_partkey") % n_customers).cast("string"))
            .when(ln % 4 == 2, phys)
            .otherwise(F.lit(""))
            .alias("rndrng_physn_npi"),
            F.when((F.col("l_returnflag") == "A") & (ln == 5), F.lit(""))
            .otherwise(padded((F.lit(BILLING_BASE) + F.col("l_partkey")).cast("string"), ln <= 2))
            .alias("org_npi_num"),
            F.col("l_orderkey").alias("desy_sort_key"),
        )
    )
    return conform(out, ROLE_SCHEMAS["medicare_claims"])


def load_testdata(spark: SparkSession, sf_dir: str, stage: bool = True, read_once: tuple[str, ...] = ()) -> Sources:
    """All source roles derived from ``{sf_dir}/*.parquet``.

    With ``stage`` a role is written as a Parquet dataset when it is first
    used (Medicare claims partitioned by vintage / release / claim type, like
    the production layout), so that its derivation is not repeated by every
    consumer and unused roles cost nothing.  Roles of ``read_once`` have one
    consumer, which derives them.
    """
    sources = derive_sources(spark, sf_dir)
    return StagedSources(spark, sources, read_once=read_once) if stage else sources


class StagedSources:
    """The roles of ``Sources``, each written once, on first use, and read back."""

    def __init__(self, spark: SparkSession, sources: Sources, materialize: Callable | None = None, read_once: tuple[str, ...] = ()):
        # Roles read once are as they are derived.
        vars(self).update({role: getattr(sources, role) for role in read_once})
        self._derived = sources
        self._materialize = materialize or Materializer(spark)

    def __getattr__(self, role: str) -> DataFrame:
        if role == "medicare_files":
            # Listed from the folders of the staged claims.
            staged = medicare_files(self._materialize.spark, self._path_of("medicare_claims"))
            setattr(self, role, staged)
            return staged
        if role not in ROLE_SCHEMAS:
            raise AttributeError(role)
        if role == "medicare_availability":
            staged = self._materialize(medicare_availability_of(self.medicare_claims), f"sources/{role}")
        elif role == "medicare_claims":
            part = ["vintage", "release", "claim_type"]
            # Dealt by vintage and claim type (_medicare_claims): Spark splits a large one over several files.
            staged = conform(self._materialize(self._derived.medicare_claims, f"sources/{role}", partition_by=part), ROLE_SCHEMAS[role])
        else:
            staged = conform(self._materialize(getattr(self._derived, role), f"sources/{role}"), ROLE_SCHEMAS[role])
        setattr(self, role, staged)
        return staged

    def _path_of(self, role: str) -> str:
        getattr(self, role)
        return f"{self._materialize.folder}/sources/{role}"

    def stage_all(self) -> StagedSources:
        for f in fields(Sources):
            getattr(self, f.name)
        return self


def medicare_availability_of(medicare_claims: DataFrame) -> DataFrame:
    """The file catalog: latest service date per (vintage, release)."""
    return conform(
        medicare_claims.groupBy("vintage", "release").agg(F.max("clm_thru_dt").alias("max_clm_thru_dt")),
        ROLE_SCHEMAS["medicare_availability"],
    )


def derive_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """Lazy DataFrames for every source role."""
    customer = _read(spark, sf_dir, "customer")
    part = _read(spark, sf_dir, "part")
    supplier = _read(spark, sf_dir, "supplier")
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    lineitem = _read(spark, sf_dir, "lineitem")

    lines = _claim_lines(spark, sf_dir)
    n_customers = customer.select(F.count(F.lit(1))).scalar()
    n_companies = supplier.select(F.count(F.lit(1))).scalar()
    commercial = _commercial_claims(lines)
    medicare = _medicare_claims(lines, n_customers)

    medicare_availability = medicare_availability_of(medicare)

    ckey, skey = F.col("c_custkey"), F.col("s_suppkey")
    crosswalk = conform(
        customer.select(
            (F.lit(PHYSICIAN_BASE) + ckey).alias("npiid"),
            (F.lit(PHYSICIAN_BASE) + ckey).alias("npi"),
            F.lit(None).cast("long").alias("company_id"),
        )
        .unionByName(
            part.select(
                (F.lit(BILLING_BASE) + F.col("p_partkey")).alias("npiid"),
                (F.lit(BILLING_BASE) + F.col("p_partkey")).alias("npi"),
                F.when(F.col("p_size") != 50, F.col("p_partkey") % n_companies + 1).alias("company_id"),
            )
        )
        .unionByName(
            supplier.select(
                (F.lit(FACILITY_BASE) + skey).alias("npiid"),
                (F.lit(FACILITY_BASE) + skey).alias("npi"),
                (skey + 1).alias("company_id"),
            )
        ),
        ROLE_SCHEMAS["crosswalk"],
    )

    physicians = conform(
        customer.filter(F.col("c_acctbal") >= 0).select((F.lit(PHYSICIAN_BASE) + ckey).alias("npi")),
        ROLE_SCHEMAS["physicians"],
    )

    kind = (skey % len(FIRM_TYPES)).cast("int")
    # One after the other: both together are reckoned larger than the suppliers' files, and the suppliers would be broadcast.
    placed = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
    companies = conform(
        placed.select(
            (skey + 1).alias("hospital_id"),
            F.col("s_name").alias("hospital_name"),
            F.element_at(F.array(*[F.lit(t) for t in FIRM_TYPES]), kind + 1).alias("firm_type"),
            F.col("n_name").alias("hq_city"),
            F.col("r_name").alias("hq_state"),
        ),
        ROLE_SCHEMAS["companies"],
    )

    last_day = lineitem.select(F.max(F.col("l_shipdate").cast("date")).alias("d"))
    claim_availability = conform(
        last_day.select(
            F.explode(
                F.array(
                    F.struct(F.col("d").alias("claim_date"), F.lit(1).alias("analysis_type_id")),
                    F.struct(
                        F.date_add("d", OTHER_ANALYSIS_TYPE_SHIFT_DAYS).alias("claim_date"),
                        F.lit(2).alias("analysis_type_id"),
                    ),
                )
            ).alias("a")
        ).select("a.*"),
        ROLE_SCHEMAS["claim_availability"],
    )

    primary = (ckey * 3) % n_companies + 1
    directory_physicians = conform(
        customer.select(
            (F.lit(PHYSICIAN_BASE) + ckey).alias("npi"),
            primary.alias("primary_affiliation_hospital_id"),
            F.when(ckey % 2 == 0, ckey % n_companies + 1).alias("hospital_id2"),
            F.when(ckey % 3 == 0, (ckey * 7) % n_companies + 1).alias("hospital_id3"),
            # An id that no company has.
            F.when(ckey % 5 == 0, n_companies + 1).alias("hospital_id4"),
            F.when(ckey % 7 == 0, primary).alias("hospital_id5"),
        ),
        ROLE_SCHEMAS["directory_physicians"],
    )

    # The groups are the companies of the second firm type; each has a surgery
    # centre (the company after it) and an imaging centre (the one after that).
    group_copies = F.when(ckey % 10 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    group_practice = conform(
        customer.filter(ckey % 4 != 0)
        .select(ckey, F.explode(group_copies).alias("_copy"))
        .select((F.lit(PHYSICIAN_BASE) + ckey).alias("npi"), (5 * (ckey % F.floor(n_companies / 5)) + 2).alias("hospital_id")),
        ROLE_SCHEMAS["group_practice"],
    )
    physician_groups = conform(supplier.filter(kind == 1).select((skey + 1).alias("hospital_id")), ROLE_SCHEMAS["physician_groups"])
    surgery_centers = conform(
        supplier.filter(kind == 2).select((skey + 1).alias("hospital_id"), skey.alias("pg_parent_id")), ROLE_SCHEMAS["surgery_centers"]
    )
    imaging_centers = conform(
        supplier.filter(kind == 3).select((skey + 1).alias("hospital_id"), (skey - 1).alias("pg_parent_id")), ROLE_SCHEMAS["imaging_centers"]
    )

    return Sources(
        commercial_claims=commercial,
        medicare_claims=medicare,
        medicare_availability=medicare_availability,
        crosswalk=crosswalk,
        physicians=physicians,
        companies=companies,
        claim_availability=claim_availability,
        directory_physicians=directory_physicians,
        group_practice=group_practice,
        physician_groups=physician_groups,
        surgery_centers=surgery_centers,
        imaging_centers=imaging_centers,
    )
