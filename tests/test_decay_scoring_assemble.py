from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import frame, rows_of
from provgraph.config import PipelineConfig
from provgraph.operators import assemble as asm
from provgraph.operators import decay, scoring
from provgraph.sources import schemas as S

AFF = T.StructType([
    T.StructField("physician_npi", T.LongType()),
    T.StructField("company_id", T.LongType()),
    T.StructField("max_date", T.DateType()),
    T.StructField("max_date_comm", T.DateType()),
    T.StructField("avg_month_lag", T.DoubleType()),
    T.StructField("max_month_lag", T.IntegerType()),
])


def test_decay_formula_and_clock(spark, cfg):
    a = frame(spark, AFF, [
        (1, 1, date(2020, 1, 15), date(2020, 1, 15), 2.0, 4),  # commercial owns the clock (tie, Q17)
        (1, 2, date(2020, 1, 15), date(2019, 5, 1), None, None),  # Medicare clock
        (1, 3, date(2020, 5, 1), date(2020, 5, 1), 3.0, 4),  # within the average gap
    ])
    out = {
        r.company_id: r
        for r in decay.with_decay(a, spark.createDataFrame([(date(2020, 6, 1), date(2020, 9, 1))], "dt_comm date, dt_mcr date"), cfg).collect()
    }
    assert out[1].current_month_lag == 5 and out[2].current_month_lag == 8 and out[3].current_month_lag == 1
    rate = 0.1 ** (1 / 5) - 1
    assert abs(out[1].decay_rate - rate) < 1e-12
    assert abs(out[1].current_decay_remaining_val - (1 + rate) ** 5) < 1e-12  # = 0.1 at max+1
    assert abs(out[2].decay_rate - (0.1 ** 0.5 - 1)) < 1e-12  # NULL max lag -> 1
    assert out[3].current_decay_remaining_val == 1.0


def test_medicare_clock_reads_the_quarterly_file(spark, cfg):
    comm = frame(spark, S.CLAIM_AVAILABILITY, [(date(2020, 12, 31), 1), (date(2021, 3, 1), 2)])
    both = frame(spark, S.MEDICARE_AVAILABILITY, [(2020, "annual", date(2020, 9, 30)), (2020, "quarterly", date(2020, 12, 31)), (2019, "quarterly", date(2021, 1, 5))])
    r = decay.analysis_dates(comm, both, cfg).collect()
    assert [tuple(x) for x in r] == [(date(2020, 10, 1), date(2021, 1, 1))]
    annual = both.filter("release = 'annual'")
    assert decay.analysis_dates(comm, annual, cfg).collect()[0].dt_mcr == date(2020, 10, 1)


def test_current_flag_boundary_q16(spark, cfg):
    df = spark.createDataFrame([(0.1 - 1e-15,), (0.0999,), (0.1,)], "current_decay_remaining_val double")
    got = [r.f for r in df.select(asm.current_flag("current_decay_remaining_val", cfg).alias("f")).collect()]
    assert got == [1, 0, 1]


def test_equal_width_buckets(spark, cfg):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "score double")
    b = scoring.equal_width_bucket(df, "score", 10, 9)
    got = dict((r.score, r.score_bucket) for r in b.collect())
    assert got[0.0] == 1 and got[1.0] == 1 and got[2.0] == 2 and got[10.0] == 10 and got[None] is None
    same = spark.createDataFrame([(3.0,), (3.0,)], "score double")  # degenerate range (Q20)
    assert [r.score_bucket for r in scoring.equal_width_bucket(same, "score", 10, 9).collect()] == [1, 1]


SCORE_IN = T.StructType([
    T.StructField("months", T.LongType()),
    T.StructField("months_mcr", T.LongType()),
    T.StructField("months_comm", T.LongType()),
    T.StructField("min_date_mcr", T.DateType()),
    T.StructField("max_date_mcr", T.DateType()),
    T.StructField("min_date_comm", T.DateType()),
    T.StructField("max_date_comm", T.DateType()),
    T.StructField("comm_claims", T.LongType()),
    T.StructField("mcr_claims", T.LongType()),
    T.StructField("avg_month_lag", T.DoubleType()),
])


def test_score_terms(spark):
    df = frame(spark, SCORE_IN, [
        (4, 2, 3, date(2016, 1, 1), date(2016, 4, 9), date(2016, 2, 1), date(2016, 2, 20), 90, 10, 2.0),
    ])
    r = scoring.with_score(df).collect()[0]
    assert abs(r.log_pct_months_mcr - 1.6989700043360187) < 1e-12  # log10(100*2/4)
    assert r.log_pct_months_comm == 0.0  # one-month span
    assert abs(r.score - (r.log_pct_months_mcr + 0.0 + 0.6020599913279624 + 2.0 - 0.3010299956639812)) < 1e-12


FINAL_IN = T.StructType([
    T.StructField("physician_npi", T.LongType()),
    T.StructField("company_id", T.LongType()),
    T.StructField("firm_type", T.StringType()),
    T.StructField("score_bucket", T.LongType()),
    T.StructField("other_source_flag", T.IntegerType()),
    T.StructField("comm_claims", T.LongType()),
    T.StructField("mcr_claims", T.LongType()),
])


def test_uplift_bucket(spark):
    df = frame(spark, FINAL_IN, [
        (1, 1, "Physician Group", 3, 1, 5, 0),  # group below 6 -> 6
        (1, 2, "Hospital", 10, 1, 5, 0),  # stays at 10
        (1, 3, "Hospital", 4, 1, 0, 2),  # +1
        (1, 4, "Hospital", 4, 0, 5, 0),  # not corroborated
        (1, 5, "Hospital", 4, 1, None, None),  # inserted directory row: no claims (Q24)
    ])
    got = dict(rows_of(asm.uplift_bucket(df), "company_id", "score_bucket"))
    assert got == {1: 6, 2: 10, 3: 5, 4: 4, 5: 4}


INC = T.StructType([
    T.StructField("score_bucket", T.LongType()),
    T.StructField("pct_claims_mcr", T.DoubleType()),
    T.StructField("pct_claims_comm", T.DoubleType()),
    T.StructField("firm_type_rank", T.IntegerType()),
    T.StructField("months", T.LongType()),
    T.StructField("patients_comm", T.LongType()),
    T.StructField("patients_mcr", T.LongType()),
    T.StructField("other_source_flag", T.IntegerType()),
])


def test_include_flag(spark, cfg):
    df = frame(spark, INC, [
        (2, 0.06, 0.0, 3, 2, 2, 1, 0),  # strong arm
        (2, 0.06, 0.0, 3, 1, 2, 1, 0),  # one month only
        (2, 0.0, 0.0, 1, 2, None, 3, 0),  # rank 1, Medicare patients only
        (1, 0.9, 0.9, 1, 9, 9, 9, 0),  # bucket 1
        (6, None, None, None, None, None, None, 0),  # bucket >= 6
        (None, None, None, None, None, None, None, 1),  # other source
        (5, None, 0.01, 2, 3, 3, 3, 0),  # unknown share, low share
    ])
    got = [r.f for r in df.select(asm.include_flag(cfg).alias("f")).collect()]
    assert got == [1, 0, 1, 0, 1, 1, 0]


def test_directory_only_rows(spark):
    assembled = spark.createDataFrame(
        [(1, 10, "Hospital"), (2, 20, "Physician Group")], "physician_npi long, company_id long, firm_type string"
    )
    hosp = spark.createDataFrame(
        [(1, 10, "Hospital", 1), (1, 11, "Hospital", 1), (1, 11, "Hospital", 5), (2, 12, "Hospital", 2)],
        "npi long, hospital_id long, firm_type string, affiliation_rank int",
    )
    groups = spark.createDataFrame(
        [(2, 20, "Physician Group"), (2, 21, "Physician Group"), (2, 21, "Physician Group")],
        "npi long, hospital_id long, firm_type string",
    )
    out = asm.directory_only_rows(assembled, hosp, groups)
    assert rows_of(out, "physician_npi", "company_id", "score_bucket", "other_source_flag") == [
        (1, 11, 2, 1), (1, 11, 2, 1),  # physician 1 already has a Hospital edge
        (2, 12, 5, 1),  # no Hospital edge: 7 - rank
        (2, 21, 6, 1), (2, 21, 6, 1),  # groups: bucket 6, bag
    ]


def test_firm_type_rank_ties_by_company(spark, cfg):
    df = spark.createDataFrame(
        [(1, 3, "Hospital", 1.0), (1, 2, "Hospital", 1.0 + 1e-13), (1, 1, "Hospital", 0.5), (1, 4, "Group", 0.1)],
        "physician_npi long, company_id long, firm_type string, score double",
    )
    got = rows_of(df.withColumn("r", asm.firm_type_rank("score", cfg)), "company_id", "r")
    assert got == [(1, 3), (2, 1), (3, 2), (4, 1)]


def test_analysis_dates(spark):
    cfg = PipelineConfig(vintage_floor=2015)
    avail = frame(spark, S.CLAIM_AVAILABILITY, [(date(2020, 5, 31), 1), (date(2020, 7, 31), 2)])
    files = frame(spark, S.MEDICARE_AVAILABILITY, [
        (2019, "annual", date(2019, 12, 31)), (2020, "annual", date(2020, 6, 30)),
        (2020, "quarterly", date(2020, 9, 30)), (2021, "quarterly", date(2021, 3, 31)),
    ])
    r = decay.analysis_dates(avail, files, cfg).collect()[0]
    assert r.dt_comm == date(2020, 3, 1)  # May 31 - 3 months = Feb 29, + 1 day
    assert r.dt_mcr == date(2021, 4, 1)


def test_finalize_inserted_rows_q24_q25(spark, cfg):
    from provgraph.operators.assemble import ASSEMBLED_COLUMNS, FINAL_COLUMNS
    from provgraph.plans.columns import COLUMN_TYPES

    schema = ", ".join(f"{c} {COLUMN_TYPES[c]}" for c in ASSEMBLED_COLUMNS)
    row = {c: None for c in ASSEMBLED_COLUMNS}
    row.update(physician_npi=1, company_id=10, firm_type="Hospital", score_bucket=3, other_source_flag=1,
               comm_claims=2, mcr_claims=0, months=1, firm_type_rank=1)
    assembled = spark.createDataFrame([tuple(row[c] for c in ASSEMBLED_COLUMNS)], schema)
    hosp = spark.createDataFrame([(1, 11, "Hospital", 2)], "npi long, hospital_id long, firm_type string, affiliation_rank int")
    groups = spark.createDataFrame([(1, 12, "Physician Group")], "npi long, hospital_id long, firm_type string")
    out = asm.finalize(assembled, hosp, groups, cfg)
    assert out.columns == FINAL_COLUMNS
    got = {r.company_id: (r.score_bucket, r.include_flag, r.comm_claims) for r in out.collect()}
    assert got[10] == (4, 1, 2)  # claim edge corroborated: +1, included as other source
    assert got[11] == (2, 1, None)  # inserted hospital row: not uplifted (Q24), included (Q25)
    assert got[12] == (6, 1, None)
