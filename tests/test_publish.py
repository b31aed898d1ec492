"""Publishing (OP-32): runs that are repeated or killed, readers across publishes, retention, and every stage written once."""

from __future__ import annotations

import re
import subprocess
import sys
from collections import Counter
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from provgraph.__main__ import parse_args
from provgraph.config import PipelineConfig
from provgraph.plans import publish as P
from provgraph.plans.pipeline import PUBLISHED, RESULTS, run_and_publish
from provgraph.plans.publish import current_version, publish, read_published, vacuum, versions
from provgraph.sources.adapter import load_testdata


def _frame(spark, lo, hi):
    return spark.range(lo, hi).withColumn("half", F.col("id") / 2).repartition(3)


def _ids(spark, path, version=None):
    return sorted(r.id for r in read_published(spark, path, version).collect())


def test_a_repeated_run_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(_frame(spark, 0, 10), path, mode="append", run="2019")
    publish(_frame(spark, 10, 15), path, mode="append", run="2020")
    publish(_frame(spark, 10, 17), path, mode="append", run="2020")
    assert _ids(spark, path) == list(range(17))
    publish(_frame(spark, 0, 3), path, mode="append")
    publish(_frame(spark, 0, 3), path, mode="append")
    assert _ids(spark, path) == sorted([*range(17), *range(3), *range(3)])
    with pytest.raises(ValueError, match="other columns"):
        publish(spark.range(3), path, mode="append", run="2021")
    publish(_frame(spark, 5, 6), path)
    assert _ids(spark, path) == [5]


def test_a_failed_or_killed_publish_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(_frame(spark, 0, 4), path, run="a")
    with pytest.raises(Exception, match="lost"):
        publish(_frame(spark, 4, 8).withColumn("half", F.raise_error(F.lit("lost")).cast("double")), path, mode="append", run="b")
    assert _ids(spark, path) == [0, 1, 2, 3] and len(list((tmp_path / "t" / "data").iterdir())) == 1
    # Killed after its files were written: nothing lists them.
    with monkeypatch.context() as m:
        m.setattr(P, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        m.setattr(P, "delete_folder", lambda *a: None)
        with pytest.raises(KeyboardInterrupt):
            publish(_frame(spark, 4, 8), path, mode="append", run="b")
    assert _ids(spark, path) == [0, 1, 2, 3]
    publish(_frame(spark, 4, 8), path, mode="append", run="b")
    assert _ids(spark, path) == list(range(8))


def test_a_reader_finishes_on_the_version_it_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(_frame(spark, 0, 50), path)
    opened, first = read_published(spark, path), current_version(spark, path)
    for n in (60, 70):
        publish(_frame(spark, 0, n), path)
        assert _ids(spark, path) == list(range(n))
        assert opened.agg(F.sum("id")).first()[0] == sum(range(50))
    assert _ids(spark, path, first) == list(range(50))
    publish(_frame(spark, 0, 80), path)
    assert versions(spark, path) == [first + 1, first + 2, first + 3]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 3
    with pytest.raises(FileNotFoundError):
        read_published(spark, path, first)


def test_a_manifest_that_is_being_written_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(_frame(spark, 0, 5), path)
    (tmp_path / "t" / "_manifests" / f"{2:020d}.json").write_text('{"version": 2, "sch')
    assert current_version(spark, path) == 1 and _ids(spark, path) == list(range(5))
    publish(_frame(spark, 0, 6), path)
    assert current_version(spark, path) == 3 and _ids(spark, path) == list(range(6))


def test_two_publishers_of_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(_frame(spark, 0, 5), path)
    stale = versions(spark, path)
    publish(_frame(spark, 0, 6), path)
    monkeypatch.setattr(P, "versions", lambda *a: stale)
    with pytest.raises(P.PublishConflictError):
        publish(_frame(spark, 0, 7), path)
    monkeypatch.undo()
    assert _ids(spark, path) == list(range(6))


def test_partitions_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "year=1" / "t")
    df = spark.range(20).select("id", (F.col("id") % 3).alias("third"), F.lit(None).cast("date").alias("day"))
    publish(df, path, partition_by=["third"])
    back = read_published(spark, path)
    assert back.dtypes == df.dtypes and back.exceptAll(df).count() == 0 and back.count() == 20
    publish(df.limit(0), path, partition_by=["third"])
    assert read_published(spark, path).dtypes == df.dtypes and read_published(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"))


CFG = replace(PipelineConfig.for_testdata(), as_of=date(2001, 11, 5))


def _counts(spark, out):
    return {t: read_published(spark, f"{out}/{t}").count() for t in RESULTS}


def test_a_load_killed_between_two_tables_is_run_again(spark, tmp_path, monkeypatch):
    out, sources = str(tmp_path / "out"), load_testdata(spark, SF0001)
    run_and_publish(spark, sources, CFG, out, mode="append", run_id="1")
    once = _counts(spark, out)
    assert min(once.values()) > 0
    real, done = P.commit, []

    def killed(*a):
        if len(done) == 7:
            raise KeyboardInterrupt
        done.append(a[1])
        return real(*a)

    with monkeypatch.context() as m:
        m.setattr(P, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            run_and_publish(spark, sources, CFG, out, mode="append", run_id="2")
    half = _counts(spark, out)
    assert sorted(Counter(half[t] // once[t] for t in RESULTS).items()) == [(1, len(RESULTS) - 7), (2, 7)]
    for _ in range(2):
        run_and_publish(spark, sources, CFG, out, mode="append", run_id="2")
        assert _counts(spark, out) == {t: 2 * n for t, n in once.items()}
    run_and_publish(spark, sources, CFG, out)
    assert _counts(spark, out) == once
    assert vacuum(spark, out, RESULTS, older_than_hours=0) == [] or _counts(spark, out) == once
    assert parse_args(["--roles", "r", "--out", "o", "--mode", "append", "--run-id", "7"]).run_id == "7"
    with pytest.raises(SystemExit):
        parse_args(["--roles", "r", "--out", "o", "--mode", "append"])
    with pytest.raises(ValueError, match="run id"):
        run_and_publish(spark, sources, CFG, out, mode="append")


ONE_RUN = """
import sys
from provgraph.config import PipelineConfig
from provgraph.plans.pipeline import run_and_publish
from provgraph.session import local_session
from provgraph.sources.adapter import load_testdata
work, sf = sys.argv[1:]
spark = local_session(4, 8, checkpoint_dir=f"{work}/ckpt", event_log_dir=f"{work}/log")
run_and_publish(spark, load_testdata(spark, sf).stage_all(), PipelineConfig.for_testdata(), f"{work}/out")
spark.stop()
"""


def test_a_publishing_run_computes_no_stage_twice(tmp_path):
    """By the event log: one query for each stage.  The claims of a source are scanned by one of them, and one Medicare file by the clock."""
    from tools.stage_times import events

    (tmp_path / "log").mkdir()
    subprocess.run([sys.executable, "-c", ONE_RUN, str(tmp_path), SF0001], check=True, timeout=600, cwd=Path(__file__).parents[1])
    plans = [e["physicalPlanDescription"] for e in events(str(tmp_path / "log")) if e["Event"].endswith("SparkListenerSQLExecutionStart")]
    reads = [{f.strip().rsplit("/", 1)[-1] for files in re.findall(r"Location: \S+ \[([^\]]*)\]", p) for f in files.split(",")} for p in plans]
    # The check of the inputs comes first, then the stages.
    begin = max(i for i, r in enumerate(reads) if r == {"companies"}) + 1
    run = reads[begin:]
    assert len(run) == len(PUBLISHED)
    assert [r for r in run if "commercial_claims" in r] == [{"commercial_claims", "crosswalk"}]
    assert [r for r in run if "medicare_claims" in r] == [{"medicare_claims"}, {"claim_availability", "medicare_claims"}]
    assert not any(name.endswith(".parquet") for r in run for name in r)
