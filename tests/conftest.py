from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortex.sources.schema import SESSION_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("cohortex-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def session(
    client="c1",
    visit_id=1,
    suffix="20240110",
    start=None,
    visit_number=1,
    channel="Direct",
    browser="Chrome",
    os_name="Android",
    device="mobile",
    mobile=True,
    region="R",
    city="C",
    source="src",
    medium="cpc",
    visits=1,
    pageviews=1,
    hits_total=1,
    timeonsite=10,
    bounces=None,
    transactions=0,
    revenue=None,
    hits=(("cat", "act", "lab"),),
):
    """One nested session row in the declared schema (compact keyword form)."""
    start = visit_id if start is None else start
    return (
        client,
        visit_id,
        visit_number,
        start,
        suffix,
        channel,
        (browser, os_name, device, mobile),
        (region, city),
        (source, medium),
        (visits, pageviews, hits_total, timeonsite, bounces, transactions, revenue),
        None if hits is None else [((c, a, l),) for c, a, l in hits],
        suffix,
    )


@pytest.fixture
def sessions_df(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), SESSION_SCHEMA)

    return make
