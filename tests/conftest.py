from __future__ import annotations

import os
import sys
import tempfile
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from provgraph.config import PipelineConfig  # noqa: E402
from provgraph.sources import schemas as S  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="provgraph-test-ckpt-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("provgraph-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture(scope="session")
def cfg():
    return PipelineConfig(
        min_claim_year=2016, vintage_floor=2015, min_claim_month=date(2016, 1, 1), as_of=date(2020, 1, 1)
    )


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def crosswalk(spark, rows):
    """rows: (npiid, npi, company_id)"""
    return frame(spark, S.CROSSWALK, rows)


def commercial(spark, rows):
    """rows: (claim_year, service_to_date, rendering, billing, facility, dpid)"""
    return frame(spark, S.COMMERCIAL_CLAIMS, rows)


def medicare(spark, rows):
    """rows: (vintage, release, claim_type, date, at, op, rn, org, patient)"""
    return frame(spark, S.MEDICARE_CLAIMS, rows)


def _key(t):
    return tuple((v is None, 0 if v is None else v) for v in t)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)
