"""Queries against their SQL twins at the smallest scale.

A sample runs by default; TIDEWIRE_ALL=1 runs every query.
"""

import os

import pytest
from compare import compare, duck

from tidewire import catalog

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "daily_summary sentiment_scores style_features link_rows entity_mentions canonical_mentions message_languages "
    "quote_spans stance_edges topic_share_daily rate_limited categories_balanced entity_scores page_mail "
    "normalised_messages streamed_rate_cap"
).split()
NAMES = sorted(catalog.oracle()) if os.environ.get("TIDEWIRE_ALL") else SAMPLE


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, connection, name):
    assert compare(spark, connection, name, catalog.runnable()[name], catalog.oracle()[name], FOLDER) is None


@pytest.mark.parametrize("name", ["daily_summary", "topic_share_daily", "stance_edges", "rate_limited", "entity_stance_daily"])
def test_no_cartesian_product(spark, name):
    plan = catalog.runnable()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
