"""Rules over short rows run in as many tasks as the session asks for, however small the file is."""

import pytest

from pagemill.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["text_cleanup", "list_fields", "display_text"])
def test_a_small_table_is_dealt_before_its_rules(spark, name):
    assert QUERIES[name](spark, FOLDER).rdd.getNumPartitions() == 4


def test_rewards_are_parsed_once(spark):
    df = QUERIES["reward_summary"](spark, FOLDER)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "hashpartitioning(p_partkey" in plan
