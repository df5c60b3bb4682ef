"""A fast part of the result check; ``python -m tests.compare`` runs all of it."""

import pytest

import __spark_entry__ as entry
from tests.compare import TESTDATA, connect, differences

FAST = ["mart", "s1_csv_typed", "v2_types", "t4_scale", "e1_describe", "e7_corr", "flagship", "s8_stream", "m3_dbscan_dense", "c10_flags"]
BASE = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    text, ok = differences(spark, connect(BASE), BASE, name)
    assert ok, text


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
