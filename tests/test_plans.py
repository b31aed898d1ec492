"""Shapes of the plans that scale depends on, with broadcasting off."""

from __future__ import annotations

import itertools
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SF0001, rows_of
from provgraph.config import PipelineConfig
from provgraph.operators import assemble as asm
from provgraph.operators import rollup, scoring
from provgraph.operators.shares import claim_shares
from provgraph.plans.pipeline import FUSED, WRITTEN, AffiliationPipeline
from provgraph.plans.publish import Materializer
from provgraph.plans.queries import STAGES, pipeline_for
from provgraph.sources.adapter import load_testdata
from provgraph.sources.tables import fits_broadcast, lookup


@pytest.fixture
def no_broadcast(spark):
    # Without adaptive execution the plan shows every exchange.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def _depth(line: str) -> int:
    return len(re.match(r"[\s:+|*-]*", line)[0])


def _exchanges_above(plan: list[str], leaf: int) -> list[str]:
    """Exchanges between a leaf of the plan and its root."""
    found, depth = [], _depth(plan[leaf])
    for line in reversed(plan[:leaf]):
        if _depth(line) < depth:
            depth = _depth(line)
            if "Exchange" in line:
                found.append(line.strip(" :+-|*"))
    return found


def test_the_affiliations_are_exchanged_once_in_the_assembly(spark, no_broadcast):
    pipe = AffiliationPipeline(
        spark, load_testdata(spark, SF0001), PipelineConfig.for_testdata(), Materializer(spark), tuple(w for w in WRITTEN if w != "assembled")
    )
    plan = _plan(pipe.assembled)
    leaves = [i for i, line in enumerate(plan) if "FileScan" in line and "physician_npi" in line and "hospital_name" in line]
    assert len(leaves) == 1
    above = _exchanges_above(plan, leaves[0])
    assert len(above) == 1 and above[0].startswith("Exchange hashpartitioning(physician_npi"), above


@pytest.mark.parametrize("key", ["affiliation_summary", "affiliation_score", "affiliation_decay"])
def test_no_affiliation_is_dealt_by_company(spark, no_broadcast, key):
    """The names come with the organisations; only companies and the crosswalk are dealt by company."""
    pipe = pipeline_for(spark, SF0001, key=key)
    plan = _plan(STAGES[key](pipe))
    months = [i for i, line in enumerate(plan) if "Window" in line]
    assert months
    above = _exchanges_above(plan, months[0])
    assert not any("company_id" in x for x in above), above


def test_commercial_claims_are_exchanged_twice_at_most(spark, no_broadcast):
    """Once by the physician's id, once by the organisations' of all roles."""
    pipe = AffiliationPipeline(spark, load_testdata(spark, SF0001), PipelineConfig.for_testdata(), Materializer(spark, enabled=False))
    plan = _plan(pipe.commercial_grain)
    leaves = [i for i, line in enumerate(plan) if "FileScan" in line and "claim_year" in line]
    assert len(leaves) == 1
    above = [re.match(r"Exchange hashpartitioning\((\w+?)#", x)[1] for x in _exchanges_above(plan, leaves[0])]
    assert above == ["rendering_npiid", "org_npiid"]


def test_no_claim_is_exchanged_where_the_crosswalk_is_broadcast(spark):
    pipe = AffiliationPipeline(spark, load_testdata(spark, SF0001), PipelineConfig.for_testdata(), Materializer(spark, enabled=False))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(pipe.commercial_grain)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert not any("Exchange hashpartitioning" in line for line in plan)


def test_the_bounds_of_the_scores_come_with_the_written_affiliations(spark):
    pipe = AffiliationPipeline(spark, load_testdata(spark, SF0001), PipelineConfig.for_testdata())
    plan = _plan(pipe.scored)
    # The other scan is that of the one-row dates.
    scans = [line for line in plan if "FileScan" in line and "physician_npi" in line]
    assert len(scans) == 1, scans
    lazy = AffiliationPipeline(spark, load_testdata(spark, SF0001), PipelineConfig.for_testdata(), Materializer(spark, enabled=False))
    assert lazy.score_bounds is None
    cols = ["physician_npi", "company_id", "score_bucket"]
    assert rows_of(pipe.scored, *cols) == rows_of(lazy.scored, *cols)


def test_score_bounds_of_no_affiliations(spark, cfg):
    empty = AffiliationPipeline(spark, load_testdata(spark, SF0001), PipelineConfig.for_testdata()).affiliations.limit(0)
    seen = Observation()
    assert scoring.observe_score(empty, seen).count() == 0
    assert scoring.with_score_bucket(scoring.with_score(empty), cfg, seen).count() == 0


def test_the_assembly_equals_plain_left_joins(spark, cfg):
    rng = random.Random(4)
    rows = [(p, c, f"n{c}", rng.random()) for p in range(1, 30) for c in rng.sample(range(40), rng.randint(1, 9))]
    affiliations = spark.createDataFrame(rows, "physician_npi long, company_id long, name string, score double")
    keys = [(p, c) for p in range(1, 40) for c in range(40) if rng.random() < 0.2]
    a = spark.createDataFrame([(*k, rng.randrange(9)) for k in keys], "physician_npi long, company_id long, a long")
    b = spark.createDataFrame([(*k, True) for k in keys[::3]], "physician_npi long, company_id long, b boolean")
    got = asm.gather(affiliations, {"a": a, "b": b})
    want = affiliations.join(a, asm.KEY, "left").join(b, asm.KEY, "left")
    assert got.columns == ["physician_npi", "company_id", "name", "score", "a", "b"]
    cols = got.columns
    assert rows_of(got, *cols) == rows_of(want, *cols)


def test_claim_shares_by_definition(spark):
    rng = random.Random(9)
    month = lambda i: date(2016 + i // 12, i % 12 + 1, 1)
    totals = {s: {(p, i): rng.randint(1, 50) for p in range(1, 8) for i in rng.sample(range(60), rng.randint(0, 25))} for s in ("comm", "mcr")}
    totals["comm"][8, None] = 5  # only a NULL month: a row, but nothing to divide by
    frames = [
        spark.createDataFrame([(p, None if i is None else month(i), n) for (p, i), n in totals[s].items()], f"physician_npi long, claim_month date, {c} long")
        for s, c in (("comm", "physician_total_claims_comm"), ("mcr", "physician_total_claims_mcr"))
    ]
    affiliations, want = [], []
    for p in range(1, 10):
        for company in range(6):
            spans, dens = [], []
            for s in ("comm", "mcr"):
                lo, hi = sorted(rng.sample(range(-3, 66), 2))
                lo, hi = (None, None) if rng.random() < 0.3 else (max(lo, 0), max(hi, 0))
                spans += [None if x is None else month(x) + timedelta(days=rng.randrange(28)) for x in (lo, hi)]
                dens.append(0 if lo is None else sum(n for (q, i), n in totals[s].items() if q == p and i is not None and lo <= i <= hi))
            n = rng.randrange(20), rng.randrange(20)
            affiliations.append((p, company, *spans, *n))
            if any(q == p for s in totals for q, _ in totals[s]):
                ratio = lambda x, y: round(x / y, 9) if y else 0.0
                want.append((p, company, ratio(sum(n), sum(dens)), ratio(n[1], dens[1]), ratio(n[0], dens[0])))
    df = spark.createDataFrame(
        affiliations,
        "physician_npi long, company_id long, min_date_comm date, max_date_comm date, min_date_mcr date, max_date_mcr date, comm_claims long, mcr_claims long",
    )
    got = [(*r[:2], *(round(x, 9) for x in r[2:])) for r in rows_of(claim_shares(df, *frames), "physician_npi", "company_id", "pct_claims", "pct_claims_mcr", "pct_claims_comm")]
    assert got == sorted(want)


def _pipe_without(spark, *stages):
    return AffiliationPipeline(spark, load_testdata(spark, SF0001), PipelineConfig.for_testdata(), Materializer(spark), tuple(w for w in WRITTEN if w not in stages))


def test_medicare_claims_are_exchanged_once_for_their_edges(spark, no_broadcast):
    plan = _plan(_pipe_without(spark, "medicare_grain", "medicare_edges").medicare_edges)
    leaves = [i for i, line in enumerate(plan) if "FileScan" in line and "desy_sort_key" in line]
    above = _exchanges_above(plan, leaves[0])
    assert len(leaves) == 1 and len(above) == 1 and above[0].startswith("Exchange hashpartitioning(physician_npi"), above
    # Not coalesced: the hash tables of the DISTINCT and of the count are in one task.
    assert "REPARTITION_BY_NUM" in above[0]


def test_unified_edges_are_exchanged_once_for_months_and_summary(spark, no_broadcast):
    plan = _plan(_pipe_without(spark, "affiliations").affiliations)
    dealt = [line for line in plan if "Exchange hashpartitioning(physician_npi" in line and "company_id" in line]
    assert len(dealt) == 1 and "claim_month" not in dealt[0].split("]")[0].split(")")[0], dealt


def test_the_months_of_an_affiliation_are_computed_once(spark):
    dates = ", ".join(f"{e}_date_{s} date" for s in ("comm", "mcr") for e in ("min", "max"))
    affiliations = spark.createDataFrame([], f"physician_npi long, company_id long, {dates}, comm_claims long, mcr_claims long")
    totals = [spark.createDataFrame([], f"physician_npi long, claim_month date, physician_total_claims_{s} long") for s in ("comm", "mcr")]
    # Scans of files, so that the optimizer keeps the plan of empty tables.
    folder = Materializer(spark)
    frames = [folder(df, f"t{i}") for i, df in enumerate([affiliations, *totals])]
    plan = claim_shares(*frames)._jdf.queryExecution().optimizedPlan().toString()
    # One for each of the four dates and one for each source's totals.
    assert 4 <= plan.count("year(") <= 6, plan.count("year(")


def _in_place(spark):
    written = tuple(w for w in FUSED if w != "assembled")
    return AffiliationPipeline(spark, load_testdata(spark, SF0001), PipelineConfig.for_testdata(), Materializer(spark), written, by_physician=True)


@pytest.fixture
def plain_session(spark):
    """As Spark comes, but for adaptive execution; small dimensions are broadcast."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_affiliations_are_assembled_where_their_edges_were_dealt_to(spark, plain_session):
    plan = _plan(_in_place(spark).assembled)
    months = [i for i, line in enumerate(plan) if "Window [lag(" in line]
    assert months and all(not [x for x in _exchanges_above(plan, i) if x.startswith("Exchange hashpartitioning")] for i in months), plan


def test_generated_methods_are_short_enough_to_be_compiled(spark, plain_session):
    """The JVM interprets methods above 8,000 bytes of code; the months of commercial edges had 15,771."""
    parts = _in_place(spark).assembled._jdf.queryExecution().debug().codegenToSeq()
    assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < 8000


def test_edges_dealt_by_physician_equal_the_others(spark):
    """Blank ids (NPI 0) on the whitelist or not, NPIs of two companies, features that have no edge."""
    rng = random.Random(5)
    schema = "physician_npi long, claim_month date, org_npi long, claims long, min_service_to_date date, max_service_to_date date"
    edges = [
        spark.createDataFrame([(rng.randrange(6), date(2016, rng.randint(1, 9), 1), rng.randrange(5), rng.randint(1, 4), date(2016, 1, 2), date(2016, 9, 3)) for _ in range(60)], schema)
        for _ in range(2)
    ]
    crosswalk = spark.createDataFrame([(i, i % 5, i % 4) for i in range(8)], "npiid long, npi long, company_id long")
    avail = spark.createDataFrame([(date(2016, 8, 1), 1)], "claim_date date, analysis_type_id int")
    companies = spark.createDataFrame([(i, f"c{i}", "Hospital") for i in range(4)], "hospital_id long, hospital_name string, firm_type string")
    cfg = PipelineConfig(as_of=date(2020, 1, 1))
    features = spark.createDataFrame([(p, c, True if p == c else None, p + 1, None) for p in range(9) for c in range(4)], "physician_npi long, company_id long, in_directory boolean, patients_comm long, patients_mcr long")
    for listed in ([0, 1, 2, 3], [1, 2, 3]):
        physicians = spark.createDataFrame([(i,) for i in listed], "npi long")
        plain, dealt, more = (rollup.unify_edges(*edges, physicians, crosswalk, **x) for x in ({}, {"by_physician": True}, {"by_physician": True, "features": features}))
        cols = rollup.UNIFIED_COLUMNS
        assert rows_of(plain, *cols) == rows_of(dealt, *cols)
        summaries = [rollup.affiliation_summary(rollup.monthly_rollup(x, avail, cfg, by), companies) for x, by in ((plain, False), (dealt, True), (more, True))]
        assert len({tuple(rows_of(s, *rollup.SUMMARY_COLUMNS)) for s in summaries}) == 1
        got = summaries[2].select("physician_npi", "company_id", *rollup.FEATURES)
        want = summaries[0].select("physician_npi", "company_id").join(features, ["physician_npi", "company_id"], "left")
        assert rows_of(got, *got.columns) == rows_of(want, *got.columns)


def _many_packed_rows(spark):
    """The sources of sf0.001 with dimensions of many rows that no claim uses; ids in sequence and missing names make small files of them."""
    sources, folder = load_testdata(spark, SF0001), Materializer(spark)
    ids = lambda name, first, n: spark.range(first, first + n).withColumnRenamed("id", name)
    more = {
        "physicians": ids("npi", 2 * 10**9, 50_000), "directory_physicians": ids("npi", 2 * 10**9, 50_000), "companies": ids("hospital_id", 10**6, 8_000),
        "crosswalk": ids("npiid", 2 * 10**9, 30_000).withColumn("npi", F.col("npiid")),
    }
    for role, rows in more.items():
        setattr(sources, role, folder(getattr(sources, role).unionByName(rows, allowMissingColumns=True).coalesce(1), role))
    return sources


def _broadcast_tables(plan: list[str]) -> list[str]:
    """Columns of the tables that are broadcast as they are read."""
    found = []
    for i, line in enumerate(plan):
        if "BroadcastExchange" in line and "ReusedExchange" not in line:
            chain = itertools.takewhile(lambda x: not re.search("Exchange|Join|Union|Aggregate", x), plan[i + 1:])
            found += [re.search(r"ReadSchema: (\S+)", x)[1] for x in itertools.islice((x for x in chain if "FileScan" in x), 1)]
    return found


def test_a_dimension_of_many_rows_is_not_broadcast_for_its_small_files(spark, plain_session):
    """The driver builds the table of a broadcast from its rows; the check of the files alone let tables pass that are twenty times larger."""
    sources, cfg = _many_packed_rows(spark), PipelineConfig.for_testdata()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    for role in ("physicians", "directory_physicians", "companies", "crosswalk"):
        assert getattr(sources, role)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 200 * 1024, role
    written = tuple(w for w in FUSED if w != "assembled")
    pipe = AffiliationPipeline(spark, sources, cfg, Materializer(spark), written, by_physician=True)
    large = ("struct<npi:bigint>", "hospital_name", "struct<npiid:bigint", "struct<npi:bigint,company_id:bigint>", "struct<hospital_id:bigint>")
    for df in (pipe.assembled, pipe.directory_only, pipe.final):
        tables = _broadcast_tables(_plan(df))
        assert not [x for x in tables if any(y in x for y in large)], tables
    plan = _plan(pipe.assembled)
    months = [i for i, line in enumerate(plan) if "Window [lag(" in line]
    assert months and all(not [x for x in _exchanges_above(plan, i) if x.startswith("Exchange hashpartitioning")] for i in months), plan
    # Names came along with the organisations; the rows are those of the small dimensions.
    cols = asm.ASSEMBLED_COLUMNS
    assert rows_of(pipe.assembled, *cols) == rows_of(_in_place(spark).assembled, *cols)


@pytest.mark.parametrize("key", ["directory_only_affiliations", "final_affiliations"])
def test_the_assembled_pairs_are_not_broadcast_for_two_of_many_columns(spark, plain_session, key):
    """Their share of the packed file is a small part of what the driver would build of them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "24k")
    pipe = pipeline_for(spark, SF0001, key=key)
    pairs = pipe.assembled.select(*asm.KEY)
    assert pairs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 24 * 1024 < pairs.count() * 24
    tables = _broadcast_tables(_plan(STAGES[key](pipe)))
    assert tables and not [x for x in tables if "physician_npi:bigint,company_id:bigint>" in x], tables


def test_a_dimension_fits_a_broadcast_by_its_rows(spark, plain_session):
    df = spark.range(1000)
    # A long and eight bytes a row.
    for limit, fits in (("16000b", True), ("15999b", False), ("-1", False)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert fits_broadcast(df) is fits
        assert lookup(df).count() == 1000
