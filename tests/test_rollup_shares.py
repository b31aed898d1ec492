from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF0001, frame, rows_of
from provgraph.config import PipelineConfig
from provgraph.operators import rollup, shares
from provgraph.operators.edges import EDGE_COLUMNS
from provgraph.plans.pipeline import AffiliationPipeline
from provgraph.sources import schemas as S
from provgraph.sources.adapter import load_testdata

EDGE = T.StructType([
    T.StructField("physician_npi", T.LongType()),
    T.StructField("claim_month", T.DateType()),
    T.StructField("org_npi", T.LongType()),
    T.StructField("claims", T.LongType()),
    T.StructField("min_service_to_date", T.DateType()),
    T.StructField("max_service_to_date", T.DateType()),
])


def e(npi, y, m, org, n, d1, d2):
    return (npi, date(y, m, 1), org, n, date(y, m, d1), date(y, m, d2))


def test_rollup_and_summary(spark, cfg):
    comm = frame(spark, EDGE, [e(1, 2016, 1, 10, 2, 3, 9), e(1, 2016, 4, 10, 1, 2, 2), e(1, 2016, 4, 11, 5, 1, 1)])
    mcr = frame(spark, EDGE, [e(1, 2016, 4, 10, 3, 5, 6), e(1, 2016, 9, 12, 1, 7, 7), e(2, 2016, 1, 10, 1, 1, 1)])
    physicians = frame(spark, S.PHYSICIANS, [(1,)])
    xw = frame(spark, S.CROSSWALK, [(10, 10, 100), (11, 11, 100), (12, 12, 100)])
    avail = frame(spark, S.CLAIM_AVAILABILITY, [(date(2016, 12, 31), 1)])
    companies = frame(spark, S.COMPANIES, [(100, "H", "Hospital", "c", "s")])
    unified = rollup.unify_edges(comm, mcr, physicians, xw)
    assert unified.count() == 5  # physician 2 is not whitelisted
    monthly = rollup.monthly_rollup(unified, avail, cfg)
    assert rows_of(monthly, "claim_month", "commercial_claims", "medicare_claims", "months_between") == [
        (date(2016, 1, 1), 2, 0, None),
        (date(2016, 4, 1), 6, 3, 3),
        (date(2016, 9, 1), 0, 1, 5),
    ]
    s = rollup.affiliation_summary(monthly, companies).collect()[0].asDict()
    assert s["months"] == 3 and s["months_comm"] == 2 and s["months_mcr"] == 2
    assert s["months_denom"] == 9 and s["comm_claims"] == 8 and s["mcr_claims"] == 4
    assert s["avg_month_lag"] == 4.0 and s["min_month_lag"] == 3 and s["max_month_lag"] == 5
    assert s["min_date"] == date(2016, 1, 3) and s["max_date"] == date(2016, 9, 7)
    assert s["min_date_mcr"] == date(2016, 4, 5) and s["max_date_comm"] == date(2016, 4, 2)


def test_names_that_come_with_the_organisations(spark, cfg):
    """Same affiliations as by a join after the summary; companies that are not listed go."""
    comm = frame(spark, EDGE, [e(1, 2016, 1, 10, 2, 3, 9), e(1, 2016, 4, 11, 1, 2, 2), e(2, 2016, 4, 12, 5, 1, 1)])
    mcr = frame(spark, EDGE, [e(1, 2016, 4, 10, 3, 5, 6), e(1, 2016, 9, 13, 1, 7, 7), e(3, 2016, 9, 14, 1, 7, 7)])
    physicians, avail = frame(spark, S.PHYSICIANS, [(1,), (2,), (3,)]), frame(spark, S.CLAIM_AVAILABILITY, [(date(2016, 12, 31), 1)])
    xw = frame(spark, S.CROSSWALK, [(10, 10, 100), (11, 11, 101), (12, 12, 101), (13, 13, 999), (14, 14, None)])
    companies = frame(spark, S.COMPANIES, [(100, "H", "Hospital", "c", "s"), (101, None, "Imaging Center", "c", "s")])
    plain = rollup.affiliation_summary(rollup.monthly_rollup(rollup.unify_edges(comm, mcr, physicians, xw), avail, cfg), companies)
    brought = rollup.unify_edges(comm, mcr, physicians, xw, by_physician=True, companies=companies)
    named = rollup.affiliation_summary(rollup.monthly_rollup(brought, avail, cfg, by_physician=True), companies)
    assert named.columns == plain.columns and named.count() == 3
    assert rows_of(named, *plain.columns) == rows_of(plain, *plain.columns)


def test_month_window_bounds(spark, cfg):
    edges = frame(spark, EDGE, [e(1, 2015, 12, 10, 1, 1, 1), e(1, 2017, 2, 10, 1, 1, 1), e(1, 2016, 5, 10, 1, 1, 1)])
    empty = frame(spark, EDGE, [])
    unified = rollup.unify_edges(
        edges, empty, frame(spark, S.PHYSICIANS, [(1,)]), frame(spark, S.CROSSWALK, [(10, 10, 100)])
    )
    # the month ceiling is the latest date over all analysis types (Q9)
    avail = frame(spark, S.CLAIM_AVAILABILITY, [(date(2016, 12, 31), 1), (date(2017, 2, 10), 2)])
    months = rows_of(rollup.monthly_rollup(unified, avail, cfg), "claim_month")
    assert months == [(date(2016, 5, 1),), (date(2017, 2, 1),)]


AFFIL = T.StructType([
    T.StructField("physician_npi", T.LongType()),
    T.StructField("company_id", T.LongType()),
    T.StructField("comm_claims", T.LongType()),
    T.StructField("mcr_claims", T.LongType()),
    T.StructField("min_date_comm", T.DateType()),
    T.StructField("max_date_comm", T.DateType()),
    T.StructField("min_date_mcr", T.DateType()),
    T.StructField("max_date_mcr", T.DateType()),
])
TOT_C = T.StructType([T.StructField("physician_npi", T.LongType()), T.StructField("claim_month", T.DateType()),
                      T.StructField("physician_total_claims_comm", T.LongType())])
TOT_M = T.StructType([T.StructField("physician_npi", T.LongType()), T.StructField("claim_month", T.DateType()),
                      T.StructField("physician_total_claims_mcr", T.LongType())])


def test_claim_shares_hand_computed(spark):
    a = frame(spark, AFFIL, [
        (1, 100, 4, 2, date(2016, 2, 10), date(2016, 4, 2), date(2016, 4, 1), date(2016, 4, 30)),
        (1, 200, 1, 0, date(2016, 5, 3), date(2016, 5, 3), None, None),
        (2, 100, 0, 3, None, None, date(2016, 1, 1), date(2016, 1, 1)),  # no totals for npi 2 (Q28)
        (3, 100, 1, 0, date(2016, 1, 1), date(2016, 1, 1), None, None),  # only a NULL-month total
    ])
    tc = frame(spark, TOT_C, [(1, date(2016, 1, 1), 7), (1, date(2016, 2, 1), 3), (1, date(2016, 4, 1), 5),
                              (1, date(2016, 5, 1), 2), (3, None, 4)])
    tm = frame(spark, TOT_M, [(1, date(2016, 4, 1), 8), (1, date(2016, 6, 1), 1)])
    got = {(r.physician_npi, r.company_id): r for r in shares.claim_shares(a, tc, tm).collect()}
    assert set(got) == {(1, 100), (1, 200), (3, 100)}
    r = got[(1, 100)]
    assert abs(r.pct_claims_comm - 4 / 8) < 1e-12
    assert abs(r.pct_claims_mcr - 2 / 8) < 1e-12
    assert abs(r.pct_claims - 6 / 16) < 1e-12
    r = got[(1, 200)]
    assert abs(r.pct_claims_comm - 1 / 2) < 1e-12 and r.pct_claims_mcr == 0.0
    assert got[(3, 100)].pct_claims == 0.0


def test_claim_shares_of_a_hot_physician(spark):
    """One physician with very many affiliations joins one row of totals."""
    a = frame(spark, AFFIL, [(1, c, 2, 0, date(2016, 1 + c % 6, 1), date(2016, 6, 30), None, None) for c in range(3000)])
    tc = frame(spark, TOT_C, [(1, date(2016, m, 1), 10) for m in range(1, 13)])
    got = {r.company_id: r.pct_claims_comm for r in shares.claim_shares(a, tc, frame(spark, TOT_M, [])).collect()}
    assert len(got) == 3000 and all(abs(v - 2 / (10 * (6 - c % 6))) < 1e-12 for c, v in got.items())


def test_unify_keeps_edge_columns(spark):
    assert EDGE_COLUMNS == [f.name for f in EDGE.fields]


def test_claim_year_month_outside_service_window_q29(spark):
    # The affiliation's commercial window comes from service dates (Jan 2017);
    # a total booked under claim year 2016 for that visit falls outside it.
    a = frame(spark, AFFIL, [(1, 100, 2, 0, date(2017, 1, 5), date(2017, 1, 20), None, None)])
    tc = frame(spark, TOT_C, [(1, date(2016, 1, 1), 3), (1, date(2017, 1, 1), 4)])
    tm = frame(spark, TOT_M, [])
    r = shares.claim_shares(a, tc, tm).collect()[0]
    assert abs(r.pct_claims_comm - 2 / 4) < 1e-12


def test_copartitioned_rollup_is_equivalent(spark):
    from dataclasses import replace

    base = PipelineConfig.for_testdata()
    src = load_testdata(spark, SF0001)
    a = AffiliationPipeline(spark, src, base).affiliations
    b = AffiliationPipeline(spark, src, replace(base, copartition_rollup=True)).affiliations
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
