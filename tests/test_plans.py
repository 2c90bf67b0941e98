"""Physical plans: what is pushed down, broadcast, shuffled and split."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tidemark.operators import enrich, gold, keys, validation
from tidemark.operators.temporal import point_in_time
from tidemark.plans.domain import Domain
from tidemark.session import bound_tasks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


def test_lookup_reaches_the_scan(spark):
    from tidemark.plans import QUERIES

    text = plan(QUERIES["key_time_lookup"](spark, SF_DIR))
    assert "EqualTo(o_custkey,42)" in text and "GreaterThan(o_orderdate" in text
    assert "o_orderpriority" not in text


def test_small_side_is_broadcast_and_large_side_is_not(spark, rows, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    facts = spark.range(1000).select((F.col("id") % 5).cast("string").alias("region"))
    regions = rows([(str(i), f"R{i}") for i in range(5)], "region_code string, region_name string")
    assert "BroadcastHashJoin" in plan(enrich.enriched_revenue(facts, regions))
    assert enrich.is_small(regions, max_rows=5) and not enrich.is_small(regions, max_rows=4)
    assert not enrich.is_small(regions, max_bytes=50)
    wide = spark.range(200_000).select(F.col("id").cast("string").alias("region_code"))
    assert "SortMergeJoin" in plan(enrich.enriched_revenue(facts, wide))


def test_hot_key_in_a_key_check_is_split(spark, settings):
    """A third of the rows share a key: the join reads that partition in pieces."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
        spark__sql__shuffle__partitions="16",
    )
    facts = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.col("id").alias("n"),
    )
    dim = facts.filter("k != 'k5'").select("k")
    marked = validation.mark_known(facts, dim, "k", "known")
    result = marked.agg(F.count("*"), F.count_if("known"))
    total, known = result.first()
    assert total == 90_000
    assert known == facts.filter("k != 'k5'").count()
    marked.write.format("noop").mode("overwrite").save()
    checked = validation.mark_known(facts, dim, "k", "known")
    checked.collect()
    assert "skew=true" in plan(checked)


def test_newest_per_key_reduces_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    text = plan(keys.latest_per_key(lines, ["l_partkey"], ["l_shipdate"]))
    assert "Window" not in text and text.index("partial_max") > text.index("Exchange hashpartitioning(l_partkey")


def test_gold_aggregates_before_it_joins(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    d = Domain(spark, SF_DIR)
    facts = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("customer_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("line_total"), F.col("l_shipdate").alias("order_ts"),
    )
    customers = spark.range(10).select(F.col("id").alias("customer_id"))
    returns = facts.select("customer_id", F.col("order_id").alias("return_id"), F.col("line_total").alias("refund_amount"))
    text = plan(gold.customer_metrics(facts, returns, customers, d.as_of))
    # customers + two aggregates: one shuffle each, none added by the two joins.
    assert text.count("Exchange hashpartitioning(customer_id") == 3


def test_point_in_time_shuffles_facts_once_by_key_and_chunk(spark, rows, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    facts = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    dim = rows([], "o_custkey long, city string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    text = plan(point_in_time(facts, dim, "o_custkey", "o_orderdate", ["city"]))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "SortMergeJoin" not in text
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert len(wide) == len([line for line in wide if "_chunk" in line]) + 1


def test_no_query_has_a_cartesian_product(spark):
    from tidemark.plans import QUERIES

    for name in ("revenue_daily", "customer_metrics", "product_trend_7d", "point_in_time_join", "fct_returns"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_facts_are_read_from_stored_layers(spark):
    from tidemark.plans import QUERIES

    for name in ("revenue_daily", "customer_metrics", "load_summary", "fk_orphans", "incremental_revenue", "append_dedup"):
        assert "lineitem.parquet" not in plan(QUERIES[name](spark, SF_DIR)), name


def test_date_windows_read_their_months_only(spark):
    from tidemark.plans import QUERIES

    for name in ("product_trend_7d", "last_week_revenue", "trending_products"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "PartitionFilters: [isnotnull(order_month" in text, name


def test_layers_follow_their_files(spark, tmp_path):
    import shutil

    for name in ("lineitem", "orders", "customer", "part", "nation", "region"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path)
    before = Domain(spark, str(tmp_path)).fct_orders.count()
    (tmp_path / "lineitem.parquet").unlink()
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").filter("l_linenumber = 1").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert 0 < Domain(spark, str(tmp_path)).fct_orders.count() < before


def test_tasks_follow_the_size_of_the_layers(spark, settings):
    """What a task holds stays bounded as tables grow, whatever the session began with."""
    names = ["adaptive.coalescePartitions.initialPartitionNum", "adaptive.advisoryPartitionSizeInBytes", "files.maxPartitionBytes"]
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64MB", spark__sql__files__maxPartitionBytes="2m")
    try:
        Domain(spark, SF_DIR).fct_orders
        assert [spark.conf.get(f"spark.sql.{n}") for n in names] == ["4", str(4 << 20), str(2 << 20)]
        assert bound_tasks(spark, 6 * 10**9) == 716
        counts = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").groupBy("l_partkey").count()
        assert "hashpartitioning(l_partkey" in plan(counts) and ", 716)" in plan(counts)
    finally:
        bound_tasks(spark, 0)


def test_closing_instants_few_enough_spare_the_facts_a_shuffle(spark, rows, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    facts = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    dim = rows([], "o_custkey long, city string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    text = plan(point_in_time(facts, dim, "o_custkey", "o_orderdate", ["city"], closed=True))
    assert "LeftSemi, BuildRight" in text
