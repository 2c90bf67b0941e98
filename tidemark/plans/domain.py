"""Shop tables (orders, returns, customers, products, regions) derived from the
parquet tables, with deterministic defects.  ``oracle.py`` states the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import PRICE
from tidemark.functions.times import ORDER_TS_FORMAT, RETURN_DATE_FORMAT
from tidemark.operators import history, validation
from tidemark.session import bound_tasks, enable_skew_splitting, scratch_path
from tidemark.sinks.tables import overwrite_table, read_if_exists, save_bucketed
from tidemark.sources.files import parquet_stream
from tidemark.sources.schemas import RETURN_REASONS

V1_DATE = "1995-01-01 00:00:00"
V2_DATE = "1998-01-01 00:00:00"
TRACKED = ["email", "city", "country", "phone"]
CARRIED = ["first_name", "last_name", "segment"]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                "l_returnflag", "l_shipdate", "o_custkey", "o_orderdate"]
#: Tables that the stored layers are made of.
LAYER_INPUTS = ["lineitem", "orders", "customer", "part", "nation", "region"]
#: Where a session keeps each layer: (application, directory, state of its files, layer) -> path.
_LAYERS: dict[tuple, str] = {}
PRODUCT_COLUMNS = ["product_name", "category", "unit_price", "supplier_id"]


def padded(prefix: str, number: str, width: int) -> Column:
    """``prefix`` + number padded to ``width``; longer numbers stay whole."""
    text = F.col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def every(number: str, n: int) -> Column:
    return F.col(number) % n == 0


class Domain:
    """The domain tables of one data directory.

    Raw lines and validated facts are layers: written once per session and state of the
    input files, then read by every query.  Everything else is lazy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        enable_skew_splitting(spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        return parquet_stream(self.spark, f"{self.dir}/{name}.parquet", self.table(name).schema)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table in the shared folder: for plans that read it more than once,
        so its joins run once and a lost executor costs a re-read, not a re-run."""
        return overwrite_table(df, self.scratch(name))

    @cached_property
    def _files(self) -> int | None:
        """Changes with the path, time or size of any file that the layers are made of.

        The bytes of these files also set the number of tasks of what reads the layers.
        """
        paths = [f"{self.dir}/{name}.parquet" for name in LAYER_INPUTS]
        files = self.spark.read.format("binaryFile").load(paths)
        state, size = files.agg(F.bit_xor(F.xxhash64("path", "modificationTime", "length")), F.sum("length")).first()
        bound_tasks(self.spark, size or 0)
        return state

    def layer(self, name: str, build: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
        """The stored table ``name``, written by its first reader (again if it is gone)."""
        slot = (self.spark.sparkContext.applicationId, self.dir, self._files, name)
        found = read_if_exists(self.spark, _LAYERS[slot]) if slot in _LAYERS else None
        if found is None:
            path, rows = self.scratch(name), build()
            if partition is None:
                writer = rows.write
            else:
                writer = rows.hint("rebalance", F.col(partition)).write.partitionBy(partition)
            writer.option("compression", "zstd").parquet(path)
            _LAYERS[slot] = path
            found = self.spark.read.parquet(path)
        return found

    def catalog_table(self, name: str, build: Callable[[], DataFrame], key: str) -> DataFrame:
        """The catalog table ``name`` in buckets of ``key``, written by its first reader and read by name."""
        slot = (self.spark.sparkContext.applicationId, self.dir, self._files, f"table {name}")
        if slot not in _LAYERS or not self.spark.catalog.tableExists(_LAYERS[slot]):
            path = self.scratch(name)
            table = "t_" + path.rsplit("/", 1)[-1].replace("-", "_")
            save_bucketed(build(), table, key, int(self.spark.conf.get("spark.sql.shuffle.partitions")), path)
            _LAYERS[slot] = table
        return self.spark.table(_LAYERS[slot])

    @cached_property
    def as_of(self) -> Column:
        """Time of the newest order, as a scalar subquery on one column."""
        return self.table("orders").agg(F.max("o_orderdate")).scalar()

    # --- raw layer

    @cached_property
    def order_lines(self) -> DataFrame:
        """Order lines with the columns of their order, which both facts come from."""

        def build() -> DataFrame:
            joined = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            return joined.select(*LINE_COLUMNS)

        return self.layer("order-lines", build)

    @cached_property
    def orders_raw(self) -> DataFrame:
        key = "l_orderkey"
        price = F.col("l_extendedprice").cast(PRICE)
        return self.order_lines.select(
            F.when(~every(key, 97), _order_id()).alias("order_id"),
            F.when(every(key, 89), F.lit("C-UNKNOWN"))
            .otherwise(padded("C", "o_custkey", 6))
            .alias("customer_id"),
            padded("P", "l_partkey", 5).alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.when(every(key, 83), None).when(every(key, 79), -price).otherwise(price).alias("unit_price"),
            F.when(every(key, 73), F.lit("not-a-date"))
            .otherwise(F.date_format("o_orderdate", ORDER_TS_FORMAT))
            .alias("order_ts"),
        )

    @cached_property
    def returns_raw(self) -> DataFrame:
        key = "l_orderkey"
        refund = F.col("l_extendedprice").cast(PRICE)
        reasons = F.array(*[F.lit(r) for r in RETURN_REASONS])
        return self.order_lines.filter(F.col("l_returnflag") == "R").select(
            F.concat(F.lit("R"), _order_id()).alias("return_id"),
            F.when(every(key, 67), F.lit("O-UNKNOWN")).otherwise(_order_id()).alias("order_id"),
            padded("C", "o_custkey", 6).alias("customer_id"),
            padded("P", "l_partkey", 5).alias("product_id"),
            F.date_format("l_shipdate", RETURN_DATE_FORMAT).alias("return_date"),
            F.element_at(reasons, (F.col("l_suppkey") % 6 + 1).cast("int")).alias("reason_code"),
            F.when(every(key, 71), -refund).otherwise(refund).alias("refund_amount"),
        )

    # --- dimensions

    @cached_property
    def _customer_rows(self) -> DataFrame:
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        name = F.split("c_name", "#")
        email = F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com"))
        return (
            self.table("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("c_custkey"),
                padded("C", "c_custkey", 6).alias("customer_id"),
                name[0].alias("first_name"),
                name[1].alias("last_name"),
                email.alias("email"),
                F.when(~every("c_custkey", 11), F.col("c_custkey").cast("string")).alias("phone"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("country"),
                F.lower("n_name").alias("region"),
                F.lower("c_mktsegment").alias("segment"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self._customer_rows.drop("c_custkey")

    @cached_property
    def customer_keys(self) -> DataFrame:
        """The keys of the customer history's current rows, which facts are checked against."""
        return self.layer("current-customers", lambda: history.current_rows(self.dim_customers).select("customer_id"))

    @cached_property
    def customers_v1(self) -> DataFrame:
        return self._customer_rows.filter(F.col("c_custkey") % 25 != 24).drop("c_custkey")

    @cached_property
    def customers_v2(self) -> DataFrame:
        moved = F.when(every("c_custkey", 10), F.lit("MOVED")).otherwise(F.col("city"))
        renamed = F.when(every("c_custkey", 15), F.concat(F.lit("new."), "email")).otherwise(
            F.col("email")
        )
        return (
            self._customer_rows.filter(F.col("c_custkey") % 50 != 13)
            .withColumns({"city": moved, "email": renamed})
            .drop("c_custkey")
        )

    @cached_property
    def dim_customers(self) -> DataFrame:
        """Type-2 history after both loads, a layer too: joins in time read it several times."""

        def build() -> DataFrame:
            first = history.scd2_apply(None, self.customers_v1, "customer_id", TRACKED, CARRIED, V1_DATE)
            return history.scd2_apply(first, self.customers_v2, "customer_id", TRACKED, CARRIED, V2_DATE)

        return self.layer("dim-customers", build)

    @cached_property
    def _product_rows(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey"),
            padded("P", "p_partkey", 5).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.lower("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").cast(PRICE).alias("unit_price"),
            F.lit(None).cast("string").alias("supplier_id"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._product_rows.drop("p_partkey")

    @cached_property
    def products_v1(self) -> DataFrame:
        return self._product_rows.filter(F.col("p_partkey") % 25 != 24).drop("p_partkey")

    @cached_property
    def products_v2(self) -> DataFrame:
        raised = (F.col("unit_price") * F.lit("1.10").cast("decimal(3,2)")).cast(PRICE)
        return (
            self._product_rows.filter(F.col("p_partkey") % 50 != 13)
            .withColumn("unit_price", F.when(every("p_partkey", 5), raised).otherwise(F.col("unit_price")))
            .drop("p_partkey")
        )

    @cached_property
    def regions(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.lower("n_name").alias("region_code"),
                F.col("n_name").alias("region_name"),
                F.col("r_name").alias("country"),
                F.lit("UTC").alias("timezone"),
            )
        )

    # --- validated facts

    @cached_property
    def flagged_orders(self) -> DataFrame:
        return validation.flag_orders(self.orders_raw, self.customer_keys, self.products)

    @cached_property
    def orders_by_month(self) -> DataFrame:
        """Valid order lines, a folder per month of ``order_ts``."""
        month = F.trunc("order_ts", "month").alias("order_month")
        return self.layer(
            "fct-orders", lambda: validation.fct_orders(self.flagged_orders).select("*", month), "order_month"
        )

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self.orders_by_month.drop("order_month")

    def recent_orders(self, days: int) -> DataFrame:
        """``fct_orders`` from the months that the ``days`` before ``as_of`` fall into; the others are not read."""
        first = self.table("orders").agg(F.trunc(F.date_sub(F.max("o_orderdate"), days), "month")).scalar()
        return self.orders_by_month.filter(F.col("order_month") >= first).drop("order_month")

    @cached_property
    def flagged_returns(self) -> DataFrame:
        return validation.flag_returns(self.returns_raw, self.fct_orders)

    @cached_property
    def fct_returns(self) -> DataFrame:
        return self.layer("fct-returns", lambda: validation.fct_returns(self.flagged_returns))

    @cached_property
    def placed_orders(self) -> DataFrame:
        """Valid order lines with the product's category and the customer's region."""
        return self.placed(self.fct_orders)

    def placed(self, orders: DataFrame) -> DataFrame:
        return orders.join(self.products.select("product_id", F.col("category").alias("product_category")), "product_id").join(
            self.customers.select("customer_id", "region"), "customer_id"
        )


def _order_id() -> Column:
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
