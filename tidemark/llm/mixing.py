"""Mix sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Each source gets a target of words.  Its documents get the same expected number of
copies, target / size of the source: a whole part and a fraction.  The fractions are
rounded dependently: two fractional documents exchange probability mass, counted in
words, in a random direction whose odds keep both expectations, until one of them
is 0 or 1; the other goes on.  A block of documents is folded this way into at most
one document that is still fractional, and these residuals are combined by the same
fold over blocks of blocks: a reduction tree.  A block is folded by falling size, so that
large documents are settled by small ones and what stays fractional is mostly small.
The words taken from a source miss its target by less than the last such document.

A hot source is as many blocks as it has documents for, so no task sees more than a
block of it.  Rows that agree in all columns are pre-aggregated to one unit with a
count, so repeats of a row cannot crowd one block.  Randomness comes from hashes of
the rows, so reruns agree whatever the partitioning.

Defined results: null text has size 0; a null source is a source of its own, last in
order; documents of size 0 take part with 0 words; an empty table gives no rows;
repeated rows come out repeated; other columns are ignored by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import fresh, row_hash
from tidemark.session import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 64
SEED = 20
NEAR = 1e-9


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target, copies (expected per document); one row per source.

    Targets fill up like water: sorted by how soon a source reaches its limit, one
    is limited if the level that the rest of the budget gives to it and all later
    ones would lift it above its limit.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weighted = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    limit = F.lit(float(most)) * F.col("source_size")
    rising = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0)))
        / F.sum("weight").over(onward)
    )
    stated = weighted.select("source", "source_size", "weight", limit.alias("limit"), level.alias("level"))
    stated = stated.withColumn("full", F.col("limit") <= F.col("weight") * F.col("level"))
    final = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(everything)["level"]
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.least("limit", F.col("weight") * final))
    return stated.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("copies"),
    )


def units(documents: DataFrame) -> DataFrame:
    """Rows of the same content once, with their number: doc_id, row_hash, source, size, n."""
    rows = documents.select("doc_id", row_hash(documents).alias("row_hash"), "source", word_count(F.col("text")).alias("size"))
    return rows.groupBy("doc_id", "row_hash", "source", "size").agg(F.count(F.lit(1)).alias("n"))


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts, F.lit(SEED)), 11).cast("double") / float(1 << 53)


def _fold(level: int) -> Column:
    """Pivotal rounding along the array ``items`` (structs with key, mass, size).

    Result: ``ones`` (places rounded up) and the place and mass of what is still
    fractional (place -1: nothing).
    """
    start = F.struct(
        F.lit(0).alias("i"), F.lit(-1).alias("at"), F.lit(0.0).alias("mass"), F.lit(0.0).alias("size"),
        F.array().cast("array<int>").alias("ones"),
    )

    def step(s: Column, x: Column) -> Column:
        size = x["size"].cast("double")

        def state(at, mass, of, ones):
            gone = (mass <= NEAR * of)
            up = (mass >= (1 - NEAR) * of)
            return F.struct(
                (s["i"] + 1).alias("i"), F.when(gone | up, F.lit(-1)).otherwise(at).alias("at"), mass.alias("mass"),
                of.alias("size"), F.when(up, F.concat(ones, F.array(at))).otherwise(ones).alias("ones"),
            )

        raised = F.least(s["size"] - s["mass"], x["mass"])
        lowered = F.least(s["mass"], size - x["mass"])
        raise_it = _uniform(x["key"], F.lit(level)) * (raised + lowered) < lowered
        with_held, with_new = F.concat(s["ones"], F.array(s["at"])), F.concat(s["ones"], F.array(s["i"]))
        return (
            F.when(s["at"] < 0, state(s["i"], x["mass"], size, s["ones"]))
            .when(raise_it & (s["size"] - s["mass"] <= x["mass"]), state(s["i"], x["mass"] - raised, size, with_held))
            .when(raise_it, state(s["at"], s["mass"] + raised, s["size"], s["ones"]))
            .when(s["mass"] <= size - x["mass"], state(s["i"], x["mass"] + lowered, size, s["ones"]))
            .otherwise(state(s["at"], s["mass"] - lowered, s["size"], with_new))
        )

    return F.aggregate("items", start, step)


def rounded(documents: DataFrame, block: int = BLOCK, **rules) -> DataFrame:
    """Units with their source's figures and ``total``: copies of all n rows of the unit."""
    unit = stored(units(documents), "mixing-units")
    goal = targets(unit.select("source", (F.col("size") * F.col("n")).alias("size")), **rules)
    counts = unit.groupBy("source").agg(F.count(F.lit(1)).alias("n_units"))
    goal = stored(goal.join(counts, goal["source"].eqNullSafe(counts["source"])).select(goal["*"], "n_units"), "mixing-targets")
    renamed = goal.withColumnRenamed("source", "_source")
    joined = unit.join(renamed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    whole = F.floor("copies")
    expected = F.col("n") * (F.col("copies") - whole)
    sure = F.floor(expected + NEAR)
    part = F.greatest(expected - sure, F.lit(0.0))
    key = F.xxhash64("doc_id", "row_hash", F.lit(SEED))
    blocks = F.ceil(F.col("n_units") / F.lit(float(block))).cast("long")
    state = joined.select(
        "source", F.pmod(key, blocks).alias("block"),
        F.struct(
            (-F.col("size")).alias("falling"), key.alias("key"), "doc_id", "row_hash", "size", "n", "source_size", "target",
            (F.col("n") * whole + sure).alias("base"),
            F.when((F.col("size") > 0) & (part > NEAR), part * F.col("size")).otherwise(0.0).alias("mass"),
        ).alias("item"),
    )
    state = stored(state, "mixing-items")
    fraction = F.col("item.mass") > 0
    done = state.filter(~fraction).select("source", "item", F.lit(0).alias("one"))
    open_items = state.filter(fraction)
    n_blocks = goal.agg(F.max(F.ceil(F.col("n_units") / F.lit(float(block))))).first()[0] or 0
    level = 0
    while n_blocks:
        folded = (
            open_items.groupBy("source", "block").agg(F.array_sort(F.collect_list("item")).alias("items"))
            .withColumn("f", _fold(level))
            .select("source", "block", F.col("f.ones").alias("ones"), F.col("f.at").alias("at"),
                    F.col("f.mass").alias("left"), F.posexplode("items").alias("place", "item"))
        )
        held = F.col("place") == F.col("at")
        folded = stored(folded.select(
            "source", "block", "item", held.alias("held"), "left", F.array_contains("ones", F.col("place")).alias("up")
        ), f"mixing-level-{level}")
        done = done.unionByName(folded.filter("NOT held").select("source", "item", F.col("up").cast("int").alias("one")))
        rest = folded.filter("held")
        last = n_blocks == 1
        if last:
            lucky = _uniform(F.col("item.key"), F.lit("last")) * F.col("item.size") < F.col("left")
            done = done.unionByName(rest.select("source", "item", lucky.cast("int").alias("one")))
            break
        open_items = rest.select(
            "source", F.floor(F.col("block") / block).alias("block"), F.col("item").withField("mass", F.col("left")).alias("item")
        )
        n_blocks = -(-n_blocks // block)
        level += 1
    return done.select("source", "item.*", (F.col("item.base") + F.col("one")).alias("total")).drop("mass", "base", "falling", "key")


def mix(documents: DataFrame, **rules) -> DataFrame:
    """doc_id, size, source_size, target, taken (words of all copies) of every document."""
    unit = rounded(documents, **rules)
    each, more = F.floor(F.col("total") / F.col("n")), F.col("total") % F.col("n")
    rows = unit.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
    copies = each + (F.col("i") <= more).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def mixed(documents: DataFrame, **rules) -> DataFrame:
    """The documents repeated by their copies, all columns kept."""
    total, copy, *key = (fresh(documents, n) for n in ("total", "copy", "row_hash", "id_text", "id_null"))

    def of(own: Column) -> list[Column]:
        parts = (own, F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull())
        return [part.alias(name) for part, name in zip(parts, key, strict=True)]

    unit = rounded(documents, **rules).filter("total > 0").select(F.col("total").alias(total), *of(F.col("row_hash")))
    # Rows that agree in all columns are one unit: keep one and repeat it for all.  The join and the
    # choice go by the same key without nulls, so texts are shuffled and sorted once for both.
    once = documents.select("*", *of(row_hash(documents))).join(unit, key).dropDuplicates(key)
    return once.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(total)))).select(*documents.columns)
