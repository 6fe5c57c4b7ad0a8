"""Every registered query against its SQL, and the plans of the main ones."""

import __spark_entry__ as contract
import pytest
from oracle import database, difference

from tidemark import plans

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(plans.queries())


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, connection, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert len(got) > 0
    assert difference(got, connection.execute(contract.oracle_sql()[name]).df()) is None


def test_every_query_has_sql():
    assert set(plans.oracle_sql()) == set(plans.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["item_id", "window_end", "view_count", "rank"]
    assert df.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: Queries whose feature is a function of the caller's own.
OWN = {"sensor_avg_folded", "geometric_means"}


@pytest.mark.parametrize("name", NAMES)
def test_plans_stay_in_the_jvm_and_never_pair_everything(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text or (name in OWN and bad == "Arrow")


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(contract.queries()["hot_item_counts"](spark, FOLDER))
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in text
    text = plan(contract.queries()["word_count"](spark, FOLDER))
    assert "ReadSchema: struct<text:string>" in text


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["running_word_count", "short_word_counts"])
def test_running_counts_read_their_input_once(spark, name):
    assert final_plan(contract.queries()[name](spark, FOLDER)).count("FileScan parquet") == 1


def test_a_log_line_is_made_and_split_once(spark):
    text = final_plan(contract.queries()["access_log_parse"](spark, FOLDER))
    assert text.count("date_format") == 1 and text.count("split(") <= 2  # a line that ends with the separator is split apart


def test_top_is_pruned_before_the_exchange(spark):
    text = plan(contract.queries()["hot_items_top3"](spark, FOLDER))
    assert text.count("WindowGroupLimit") == 2


def test_patterns_take_one_exchange(spark):
    for name in ("login_fail_pairs", "order_success", "order_timeouts"):
        assert plan(contract.queries()[name](spark, FOLDER)).count("Exchange hashpartitioning") == 1


def test_counts_are_partial_before_the_exchange(spark):
    for name in ("word_count", "hot_item_counts", "sensor_avg"):
        assert "partial_" in plan(contract.queries()[name](spark, FOLDER))
