"""Discovery of claim files from partition folders (OP-03)."""

from __future__ import annotations

from dataclasses import fields
from datetime import date

import pytest

from conftest import SF0001, medicare, rows_of
from provgraph.config import PipelineConfig
from provgraph.operators.decay import analysis_dates
from provgraph.operators.edges import select_vintages
from provgraph.plans.pipeline import AffiliationPipeline
from provgraph.plans.publish import Materializer
from provgraph.sources import schemas as S
from provgraph.sources.adapter import derive_sources, load_testdata, medicare_availability_of
from provgraph.sources.catalog import medicare_files, newest_file, partition_folders
from provgraph.sources.tables import Sources

CFG = PipelineConfig.for_testdata()


def _claims(spark):
    row = lambda vintage, release, day: (vintage, release, "inp", day, "1", "2", "3", "4", 5)
    return medicare(spark, [
        row(2015, "annual", date(2015, 5, 1)), row(2017, "quarterly", date(2017, 5, 1)), row(2018, "annual", date(2018, 12, 31)),
        row(2018, "quarterly", date(2018, 9, 30)), row(2018, "quarterly", date(2018, 6, 30)), row(2016, "annual", date(2016, 5, 1)),
    ])


def test_files_are_listed_from_folders(spark, cfg, tmp_path):
    path, claims = str(tmp_path / "claims"), _claims(spark)
    claims.write.partitionBy("vintage", "release", "claim_type").parquet(path)
    (tmp_path / "claims" / "vintage=2019" / "release=not%20yet").mkdir(parents=True)
    (tmp_path / "claims" / "vintage=__HIVE_DEFAULT_PARTITION__" / "release=annual").mkdir(parents=True)
    (tmp_path / "claims" / "_temporary").mkdir()
    listed = partition_folders(spark, path, ("vintage", "release"))
    assert ("2019", "not yet") in listed and (None, "annual") in listed and len(listed) == 7
    assert partition_folders(spark, path, ("vintage",))[0] == ("2015",)
    files = medicare_files(spark, path)
    assert rows_of(select_vintages(files, cfg), "vintage", "release") == [(2016, "annual"), (2017, "quarterly"), (2018, "annual")]
    assert rows_of(select_vintages(files, cfg), "vintage", "release") == rows_of(select_vintages(medicare_availability_of(claims), cfg), "vintage", "release")
    kept = files.filter("release <> 'not yet'")
    assert rows_of(newest_file(spark.read.parquet(path), kept, cfg), "vintage", "release", "max_clm_thru_dt") == [(2018, "quarterly", date(2018, 9, 30))]
    only = kept.filter("release = 'annual'")
    assert rows_of(newest_file(spark.read.parquet(path), only, cfg), "vintage", "max_clm_thru_dt") == [(2018, date(2018, 12, 31))]
    (tmp_path / "flat").mkdir()
    assert medicare_files(spark, str(tmp_path / "flat")).count() == 0


def test_selection_and_dates_equal_those_of_the_availability_table(spark):
    src = load_testdata(spark, SF0001)
    pipe = AffiliationPipeline(spark, src, CFG)
    table = src.medicare_availability
    assert rows_of(pipe.vintages, "vintage", "release") == rows_of(select_vintages(table, CFG), "vintage", "release")
    assert rows_of(pipe.dates, "dt_comm", "dt_mcr") == rows_of(analysis_dates(src.claim_availability, table, CFG), "dt_comm", "dt_mcr")


def test_the_selection_scans_no_claims_and_the_clock_one_file(spark):
    pipe = AffiliationPipeline(spark, load_testdata(spark, SF0001), CFG, Materializer(spark))
    plan = pipe.vintages._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    scan = pipe.medicare_clock._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in scan and "ReadSchema: struct<clm_thru_dt:date>" in scan


def test_stages_are_written_with_zstd(spark, tmp_path):
    keep = Materializer(spark, str(tmp_path))
    keep(spark.range(3), "stage")
    written = list(tmp_path.rglob("*.parquet"))
    assert written and all(f.name.endswith(".zstd.parquet") for f in written)


def test_roles_without_an_availability_table(spark, tmp_path):
    root, derived = str(tmp_path / "roles"), derive_sources(spark, SF0001)
    for f in fields(Sources):
        if f.name != "medicare_availability":
            w = getattr(derived, f.name).write
            (w.partitionBy("vintage", "release", "claim_type") if f.name == "medicare_claims" else w).parquet(f"{root}/{f.name}")
    pipe = AffiliationPipeline(spark, Sources.from_parquet(spark, root), CFG)
    want = AffiliationPipeline(spark, derived, CFG, Materializer(spark, enabled=False))
    assert derived.medicare_files is None
    assert rows_of(pipe.vintages, "vintage", "release") == rows_of(want.vintages, "vintage", "release")
    assert rows_of(pipe.dates, "dt_comm", "dt_mcr") == rows_of(want.dates, "dt_comm", "dt_mcr")
    assert pipe.src.medicare_availability.schema == S.MEDICARE_AVAILABILITY
    with pytest.raises(Exception):  # noqa: B017
        Sources.from_parquet(spark, str(tmp_path / "nothing"))
