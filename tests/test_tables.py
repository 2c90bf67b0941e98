"""Sources, sinks, versions and layout."""

import glob

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, values
from tidemark.operators import layout
from tidemark.operators.merge import scd1_upsert
from tidemark.operators.validation import RowCountError
from tidemark.session import configure_aqe, scratch_path, size_shuffles
from tidemark.sinks import tables, versions
from tidemark.sources import external, files, literals
from tidemark.streaming.sinks import run_to_table

LAYOUT = "id STRING, amount DOUBLE"


def test_csv_header_is_checked_by_name(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    rows([("a", 1.5), (None, 2.0)], LAYOUT).write.option("header", True).csv(path)
    scanned = files.csv_scan_lineage(spark, path, LAYOUT)
    assert values(scanned, "id", "amount") == [(None, 2.0), ("a", 1.5)]
    assert scanned.filter("_source_file LIKE '%.csv' AND _ingested_at IS NOT NULL").count() == 2
    with pytest.raises(Py4JJavaError, match="does not conform"):
        files.csv_scan(spark, path, "amount DOUBLE, id STRING").collect()
    with pytest.raises(Py4JJavaError, match="does not conform"):
        files.csv_scan(spark, path, "id STRING, total DOUBLE").collect()


def test_schema_evolution_and_frozen_mode(rows):
    old, new = rows([("a",)], "id string"), rows([("b", "1.25"), ("c", "?")], "id string, worth string")
    merged = files.evolve(old, new, {"worth": "decimal(12,2)"})
    assert dict(merged.dtypes)["worth"] == "decimal(12,2)"
    assert [(r.id, r.worth and float(r.worth)) for r in merged.orderBy("id").collect()] == [
        ("a", None), ("b", 1.25), ("c", None),
    ]
    with pytest.raises(files.SchemaMismatch):
        files.require_columns(new, ["id"])


def test_increments_load_each_file_once(spark, rows, tmp_path):
    source, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        return run_to_table(files.csv_increments(spark, source, LAYOUT).select("id"), table, state)

    rows([("a", 1.0)], LAYOUT).write.mode("append").option("header", True).csv(source)
    assert values(run()) == [("a",)]
    rows([("b", 1.0)], LAYOUT).write.mode("append").option("header", True).csv(source)
    assert values(run()) == [("a",), ("b",)]
    assert values(run()) == [("a",), ("b",)]


def test_reference_files(spark, rows, tmp_path):
    path = str(tmp_path / "categories")
    schema = "category string, sub_category string, display_name string, is_seasonal string, margin_band string"
    tables.export_csv(rows([("a", "b", "A", "true", "high"), ("a", "c", "C", "maybe", "low")], schema), path, files=1)
    assert len(glob.glob(f"{path}/*.csv")) == 1
    assert values(files.load_categories(spark, path), "sub_category", "is_seasonal") == [("b", True), ("c", None)]
    assert literals.inline_products(spark).count() == 25
    assert literals.inline_regions(spark).count() == 9
    assert files.load_regions(spark).filter("region_code = 'nl-west' AND country = 'NL'").count() == 1


def test_topic_options_carry_no_credentials_by_default():
    topic = external.Topic("broker:9093", "orders", group="readers", starting_offsets="latest")
    assert topic.options() == {
        "kafka.bootstrap.servers": "broker:9093", "subscribe": "orders", "kafka.group.id": "readers",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    secured = external.Topic("broker:9093", "orders", username="u", password="p")
    assert secured.options()["kafka.security.protocol"] == "SASL_SSL"
    assert "password='p'" not in repr(secured) and 'password="p"' in secured.options()["kafka.sasl.jaas.config"]


def test_catalog_table_replaces_schema(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.save_table(rows([(1,)], "a int"), "layer_x.t", path=path)
    replaced = tables.save_table(rows([("x", 2)], "b string, c int"), "layer_x.t", path=path)
    assert values(replaced) == [("x", 2)] and values(spark.table("layer_x.t")) == [("x", 2)]


def test_partitioned_write_prunes_folders(rows, tmp_path):
    data = [(i, f"2024-01-0{1 + i % 3} 10:00:00") for i in range(9)]
    df = rows(data, "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    table = tables.write_partitioned(df, str(tmp_path / "p"), "ts")
    one = table.filter(F.col("_partition_date") == F.lit("2024-01-02").cast("date"))
    assert one.count() == 3
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_partition_date" in plan


def test_versions(spark, rows, tmp_path):
    path = str(tmp_path / "v")
    assert versions.version_history(spark, path).count() == 0
    stamps = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]
    for n, stamp in enumerate(stamps, start=1):
        assert versions.commit(rows([(i,) for i in range(n)], "a int"), path, "WRITE", stamp) == n - 1
    assert versions.as_of_version(spark, path).count() == 3
    assert versions.as_of_version(spark, path, version=1).count() == 2
    assert versions.as_of_version(spark, path, version=99).count() == 3
    assert versions.as_of_version(spark, path, ts="2024-01-02 12:00:00").count() == 2
    assert versions.as_of_version(spark, path, ts="2023-12-31 00:00:00").count() == 0
    with pytest.raises(RowCountError):
        versions.restore(spark, path, "2024-01-01 12:00:00", "2024-01-02 12:00:00", "2024-01-04 00:00:00", min_rows=3)
    assert versions.version_history(spark, path).count() == 3
    assert versions.restore(spark, path, "2024-01-01 12:00:00", "2024-01-02 12:00:00", "2024-01-04 00:00:00") == 3
    assert versions.as_of_version(spark, path).count() == 2
    with pytest.raises(ValueError):
        versions.restore(spark, path, "2025-01-01 00:00:00", "2025-01-02 00:00:00", "2025-01-04 00:00:00")
    assert [r.row_count for r in versions.version_history(spark, path).orderBy("version").collect()] == [1, 2, 3, 2]


def test_failed_commit_is_invisible(spark, rows, tmp_path):
    path = str(tmp_path / "v")
    versions.commit(rows([(1,)], "a int"), path, "WRITE", "2024-01-01 00:00:00")
    rows([(7,)], "a int").write.parquet(f"{path}/data/version=1")  # data without its history row
    assert values(versions.as_of_version(spark, path)) == [(1,)]
    assert versions.commit(rows([(2,)], "a int"), path, "WRITE", "2024-01-02 00:00:00") == 1
    assert values(versions.as_of_version(spark, path)) == [(2,)]


def test_restore_copies_no_rows(spark, rows, tmp_path):
    path = str(tmp_path / "v")
    for n, stamp in ((3, "2024-01-01 00:00:00"), (1, "2024-01-02 00:00:00")):
        versions.commit(rows([(i,) for i in range(n)], "a int"), path, "WRITE", stamp)
    for stamp in ("2024-01-03 00:00:00", "2024-01-04 00:00:00"):  # the second restores a restored version
        newest = versions.restore(spark, path, "2023-12-31 00:00:00", "2024-01-01 12:00:00", stamp)
    assert newest == 3 and versions.as_of_version(spark, path).count() == 3
    assert len(glob.glob(f"{path}/data/version=*")) == 2
    assert versions.commit(rows([(9,)], "a int"), path, "WRITE", "2024-01-05 00:00:00") == 4
    assert values(versions.as_of_version(spark, path)) == [(9,)]


def test_merge_rewrites_only_touched_buckets(spark, rows, tmp_path):
    path, schema = str(tmp_path / "dim"), "id int, name string"

    def load(data, at):
        return tables.create_or_merge(
            rows(data, schema), path, "id", lambda t, s: scd1_upsert(t, s, "id", ["name"], at), buckets=4
        )

    def files_now():
        return set(glob.glob(f"{path}/*/*.parquet"))

    assert load([(i, "old") for i in range(20)], "2024-01-01").count() == 20
    before = files_now()
    table = load([(7, "new"), (7, "new")], "2024-01-02")
    assert values(table.filter("name = 'new'"), "id") == [(7,)] and table.count() == 20
    assert len(before & files_now()) == len(before) - 1
    again = values(load([(7, "new")], "2024-01-02"))
    assert again == values(load([(7, "new")], "2024-01-02"))


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_path):
    small, large = str(tmp_path / "s"), str(tmp_path / "l")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    orders.repartition(20).write.parquet(small)
    before = layout.file_report(spark.read.parquet(small))
    table = layout.compact_files(spark, small, large)
    assert (before.count(), layout.file_report(table).count()) == (20, 1)
    assert values(table) == values(orders)


def test_zorder_narrows_the_files_a_lookup_reads(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").select(
        F.concat(F.lit("C"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("customer"), "o_orderdate"
    )
    files_count = 16
    table = tables.overwrite_table(layout.zorder(orders, ["customer", "o_orderdate"], files_count), str(tmp_path / "z"))
    assert values(table) == values(orders)
    spans = table.groupBy(F.col("_metadata.file_path")).agg(
        F.min("customer").alias("c0"), F.max("customer").alias("c1"),
        F.min("o_orderdate").alias("d0"), F.max("o_orderdate").alias("d1"),
    ).collect()
    assert len(spans) > files_count // 2
    customer = orders.agg(F.max("customer")).first()[0]
    assert len([s for s in spans if s["c0"] <= customer <= s["c1"]]) <= len(spans) // 2
    day = orders.agg(F.max("o_orderdate")).first()[0]
    assert len([s for s in spans if s["d0"] <= day <= s["d1"]]) <= len(spans) // 2


def test_session_helpers(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 100 * 1024**4) == 409_600
        assert size_shuffles(spark, 1) == 409_600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    configure_aqe(spark, broadcast_threshold_mb=3)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == str(3 * 1024 * 1024)
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or first.startswith(base)
