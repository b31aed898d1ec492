"""End-to-end checks on the sf0.001 fixture: oracle agreement, invariants,
determinism across shuffle partitionings, publish round trip."""

from __future__ import annotations

import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF0001
from provgraph.config import PipelineConfig
from provgraph.plans.pipeline import AffiliationPipeline
from provgraph.plans import queries as registry
from provgraph.plans.oracle import QUERIES as ORACLE_QUERIES
from provgraph.plans.oracle import oracle_sql
from provgraph.plans.pipeline import RESULTS, result
from provgraph.plans.publish import Materializer, publish, read_published
from provgraph.sources.adapter import load_testdata
from tools.check_oracle import TABLES, digest


@pytest.fixture(scope="module")
def pipe(spark):
    return AffiliationPipeline(spark, load_testdata(spark, SF0001), PipelineConfig.for_testdata())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


# Every query of the pipeline; one session-wide staging feeds them all here.
@pytest.mark.parametrize("key", list(registry.STAGES))
def test_matches_oracle(pipe, con, key):
    cols = ORACLE_QUERIES[key][1]
    s = registry._typed(key, registry.STAGES[key](pipe), cols).toPandas()
    o = con.execute(oracle_sql()[key]).df()
    assert digest(s) == digest(o)
    assert len(s) > 0


# As registered, each query alone writes only what it reads again.
@pytest.mark.parametrize("key", ["monthly_rollup", "claim_shares", "affiliation_decay", "score_buckets", "directory_only_affiliations", "final_affiliations"])
def test_registered_alone_matches_oracle(spark, con, key):
    s = entry.queries()[key](spark, SF0001).toPandas()
    assert digest(s) == digest(con.execute(oracle_sql()[key]).df())


def test_stages_read_once_are_not_written(spark):
    p = registry.pipeline_for(spark, SF0001, key="affiliation_summary")
    files = p.affiliations.inputFiles()
    assert files and not any(f"/{stage}/" in f for f in files for stage in ("commercial_grain", "commercial_claims", "medicare_edges", "affiliations"))


def test_every_query_has_an_oracle():
    assert set(registry.STAGES) == set(oracle_sql()) <= set(entry.queries())
    assert len(registry.STAGES) == 32


def test_roles_are_staged_on_first_use_only(spark):
    src = load_testdata(spark, SF0001)
    AffiliationPipeline(spark, src, PipelineConfig.for_testdata()).hospital_affiliations.count()
    assert set(vars(src)) - {"_derived", "_materialize"} == {"directory_physicians", "companies"}


def test_fixture_grows_with_the_scale_factor(spark):
    small, large = (load_testdata(spark, d, stage=False) for d in (SF0001, "/root/testdata/sf0.01"))
    for role, col in (("commercial_claims", "dpid"), ("medicare_claims", "desy_sort_key"), ("companies", "hospital_id")):
        a, b = (getattr(x, role).select(col).distinct().count() for x in (small, large))
        assert b > 5 * a > 0, role


def test_repeated_company_ids_are_refused(spark, pipe):
    class Twice:
        companies = pipe.src.companies.union(pipe.src.companies)

    with pytest.raises(ValueError, match="not a key"):
        AffiliationPipeline(spark, Twice(), PipelineConfig.for_testdata()).check_inputs()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 31 and df.count() > 0


def test_invariants(pipe):
    a = pipe.affiliations
    bad = a.filter(
        (F.col("months") > F.col("months_denom"))
        | (F.col("months_comm") > F.col("months"))
        | (F.col("months_mcr") > F.col("months"))
        | (F.col("months") > F.col("months_comm") + F.col("months_mcr"))
    )
    assert bad.count() == 0
    s = pipe.scored
    assert s.filter((F.col("score_bucket") < 1) | (F.col("score_bucket") > 10)).count() == 0
    assert s.filter((F.col("current_decay_remaining_val") <= 0) | (F.col("current_decay_remaining_val") > 1)).count() == 0
    # company ids are a key of the company dimension (Q8 precondition)
    assert pipe.src.companies.groupBy("hospital_id").count().filter("count > 1").count() == 0
    asm = pipe.assembled
    assert asm.count() == a.count()
    ranks = asm.groupBy("physician_npi", "firm_type").agg(
        F.count("*").alias("n"), F.max("firm_type_rank").alias("mx"), F.countDistinct("firm_type_rank").alias("d")
    )
    assert ranks.filter((F.col("n") != F.col("mx")) | (F.col("n") != F.col("d"))).count() == 0
    # directory-only rows are disjoint from claim edges
    d = pipe.directory_only.select("physician_npi", "company_id")
    assert d.join(asm.select("physician_npi", "company_id"), ["physician_npi", "company_id"]).count() == 0


def test_deterministic_across_partitionings(spark):
    src = load_testdata(spark, SF0001)
    cfg = PipelineConfig.for_testdata()
    outs = []
    for n in ("1", "37"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            df = AffiliationPipeline(spark, src, cfg, Materializer(spark, enabled=False)).final
            outs.append(df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
                        .collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(outs[0], key=key) == sorted(outs[1], key=key)


def test_publish_replaces_in_full_and_survives_a_failed_job(spark, pipe, tmp_path):
    path = str(tmp_path / "final")
    final = pipe.final
    publish(final, path)
    back = read_published(spark, path)
    assert back.dtypes == final.dtypes  # Parquet reads every column back as nullable
    assert back.exceptAll(final).count() == 0 and final.exceptAll(back).count() == 0
    publish(final.limit(3), path, mode="append")
    assert read_published(spark, path).count() == final.count() + 3
    with pytest.raises(ValueError):
        publish(final, path, mode="merge")
    with pytest.raises(Exception):  # noqa: B017
        publish(final.withColumn("company_id", F.raise_error(F.lit("lost"))), path)
    assert read_published(spark, path).count() == final.count() + 3
    publish(final.limit(2), path)
    assert read_published(spark, path).count() == 2
    assert len([f for f in (tmp_path / "final").iterdir() if f.name.startswith("v-") and any(f.glob("*.parquet"))]) <= 2


def test_sources_from_parquet_round_trip(spark):
    from dataclasses import fields

    from provgraph.sources.adapter import derive_sources
    from provgraph.sources.tables import Sources

    root = tempfile.mkdtemp(prefix="provgraph-roles-")
    derived = derive_sources(spark, SF0001)
    for f in fields(Sources):
        part = ["vintage", "release", "claim_type"] if f.name == "medicare_claims" else None
        w = getattr(derived, f.name).write.mode("overwrite")
        (w.partitionBy(*part) if part else w).parquet(f"{root}/{f.name}")
    back = Sources.from_parquet(spark, root)
    for f in fields(Sources):
        a, b = getattr(derived, f.name), getattr(back, f.name)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_command_line_publishes_every_table(spark, pipe, tmp_path):
    from provgraph.__main__ import main

    out = str(tmp_path / "out")
    main(["--testdata", SF0001, "--out", out, "--as-of", "2001-11-05"], spark=spark)
    for name in RESULTS:
        back, want = read_published(spark, f"{out}/{name}"), result(pipe, name)
        assert back.columns == want.columns and back.count() == want.count() > 0, name
    assert "update_date" in read_published(spark, f"{out}/affiliation_decay").columns
    assert len(read_published(spark, f"{out}/final_affiliations").columns) == 31
