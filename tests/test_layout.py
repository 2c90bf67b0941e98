"""Layout jobs judged by the files and rows that lookups read."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, values
from tidemark.operators import layout
from tidemark.plans import QUERIES


def spans(table, *columns):
    """Rows of least and greatest values per file, as a reader sees them in the footers."""
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends).collect()


def test_an_outlier_takes_one_rank(spark, rows):
    keys = spark.range(2000).select(F.format_string("customer-%06d", "id").alias("k"), (F.col("id") * 7 % 2000).alias("n"))
    for table in (keys, keys.unionByName(rows([("A", 10**12)], "k string, n long")), keys.unionByName(rows([(None, None)], "k string, n long"))):
        cells = layout.z_value(table, ["k"], bits=6).select("_z").distinct().count()
        assert cells == 64
        assert layout.z_value(table, ["n"], bits=6).select("_z").distinct().count() == 64
    assert layout.z_value(keys.limit(0), ["k", "n"]).count() == 0


def test_a_box_lookup_reads_a_share_of_the_files(spark, tmp_path):
    path, files = str(tmp_path / "z"), 64
    points = spark.range(40_000).select(
        F.format_string("c%05d", F.pmod(F.xxhash64("id"), F.lit(5000))).alias("c"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**8))).cast("timestamp_ntz").alias("t"))
    layout.zorder(points, ["c", "t"], files).write.parquet(path)
    table = spark.read.parquet(path)
    assert table.count() == 40_000
    seen = spans(table, "c", "t")
    assert len(seen) >= 60
    lo, hi = points.agg(F.expr("percentile(unix_timestamp(cast(t as timestamp)), array(0.4, 0.5))").alias("q")).first().q
    at = [points.select(F.timestamp_seconds(F.lit(float(s))).cast("timestamp_ntz")).first()[0] for s in (lo, hi)]
    box = [s for s in seen if s.lo_c <= "c02500" and s.hi_c >= "c02000" and s.lo_t <= at[1] and s.hi_t >= at[0]]
    one = [s for s in seen if s.lo_c <= "c01234" <= s.hi_c]
    # of 64 files: a tenth for a box of a tenth by a tenth, under a third for one key at any time (ranges straddle cells)
    assert len(box) <= 7 and len(one) <= 20


def test_packing_reads_and_joins_small_files_only(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "p")
    data = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    data.filter("id >= 20000").coalesce(1).write.parquet(source)
    data.filter("id < 20000").repartitionByRange(16, "id").sortWithinPartitions("id").write.mode("append").parquet(source)
    big = max(glob.glob(f"{source}/*.parquet"), key=os.path.getsize)
    packed = layout.pack_files(spark, source, target, target_mb=0.5, sort=["id"])
    assert [p.split("/")[-1] for p in packed.kept] == [os.path.basename(big)]
    new = glob.glob(f"{target}/*.parquet")
    assert 3 <= len(new) <= 5 and all(os.path.getsize(f) < 0.8 * layout.MEGABYTE for f in new)
    table = packed.read()
    assert table.count() == 60_000 and table.agg(F.sum("id")).first()[0] == sum(range(60_000))
    ends = sorted((s.lo_id, s.hi_id) for s in spans(spark.read.parquet(target), "id"))
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))  # files keep their ranges
    for f in new:
        ids = [r.id for r in spark.read.parquet(f).collect()]
        assert ids == sorted(ids)
    again = layout.pack_files(spark, target, str(tmp_path / "q"), target_mb=0.1)
    assert again.folder is None and len(again.kept) == len(new)


@pytest.mark.parametrize("megabyte", [1 << 20, 1 << 14, 1 << 10])
def test_compaction_packs_every_row_at_any_size(spark, monkeypatch, megabyte):
    """A smaller megabyte makes the table a larger one: no file of it is left out."""
    monkeypatch.setattr(layout, "MEGABYTE", megabyte)
    done, pack_files = [], layout.pack_files

    def seen(spark, source, target, *args, **kw):
        done.append((spark.read.parquet(source).count(), pack_files(spark, source, target, *args, **kw)))
        return done[-1][1]

    monkeypatch.setattr(layout, "pack_files", seen)
    report = QUERIES["compact_files"](spark, SF_DIR).collect()
    ((rows, packed),) = done
    assert packed.kept == [] and spark.read.parquet(packed.folder).count() == rows == report[0].row_count
    assert report[0].fewer_files


@pytest.mark.parametrize("key, found", [(12_345, 1), (-5, 0), (777_777, 0)])
def test_bloom_filters_skip_row_groups(spark, tmp_path, key, found):
    plain, path = str(tmp_path / "plain"), str(tmp_path / "t")
    rows = spark.range(100_000).select(
        (F.col("id") * 10 + 5).alias("key"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("customer"), F.rand(1).alias("v"))
    table = layout.write_lookup(rows, path, ["key"], ["customer"], row_group_mb=0.25)
    rows.repartitionByRange("customer").sortWithinPartitions("customer").write.option(
        "parquet.block.size", layout.MEGABYTE // 4).parquet(plain)
    hit = table.filter(F.col("key") == key)
    assert hit.count() == found
    scanned = layout.rows_scanned(table.filter(F.col("key") == key))
    without = layout.rows_scanned(spark.read.parquet(plain).filter(F.col("key") == key))
    assert scanned <= (0.35 if found else 0.2) * 100_000
    assert without >= (0.9 if 0 <= key else 0) * 100_000
    assert layout.rows_scanned(table.filter("customer = 17")) <= 40_000


def test_files_for_and_bits(spark):
    assert [layout.bits_for(n, 2) for n in (1, 16, 1000, 10**6)] == [4, 4, 7, 10]
    assert layout.files_for(spark.read.parquet(f"{SF_DIR}/orders.parquet")) == 1
