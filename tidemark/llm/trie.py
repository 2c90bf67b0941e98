"""Prefix trie of conversations over range partitions, joined by a skeleton of splitter paths.

A turn is a symbol, the SHA-256 of its role and text; a conversation is the path of its
symbols.  Paths, with the id as second key, are cut into ranges at splitters taken from a
sample.  All members of a node are neighbours in that order, so a node that is no prefix
of a splitter lies in one range: the sorted shard finishes it alone, streaming over its
items with a stack of open nodes.  The prefixes of the splitters are the skeleton, a trie
of at most ``(SECTION + 1) * shards`` nodes that every task receives; a shard gives only
partial aggregates for those, which are summed by node and then along the skeleton's
lines of ancestors.  Ids of conversations that end at a skeleton node are digested as a
sorted stream, since one digest over many ids has to be.

Paths are handled ``SECTION`` turns at a time.  Where several conversations share a whole
section, they go on in a next round under that section's key, and the subtrees' totals
are added back from the deepest round up.  A conversation that shares its section with
no other leaves: the rest of it is a chain, written straight from its rows.  So no task
ever holds a whole conversation, and the rounds follow the depth that is really shared.

Defined results: null role or text is empty; turns are ordered by turn (null first), then
role and text by code point; rows that repeat are turns that repeat; a null conv_id
is no conversation; an empty table gives no node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import stored

SECTION = 64
SAMPLE = 32  # sampled paths per shard
WIDTH = 32  # bytes of a symbol
TOP = bytes(WIDTH)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NOTHING = hashlib.sha256(b"").hexdigest()


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, symbol, size) of every turn: its place in its conversation, from 0, and its code points.

    Rows are range-partitioned in order, so a conversation of any length is spread over
    shards; a place is the row's number in its shard plus the rows of earlier shards.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
    order = ["conv_id", "turn", "role", "text"]
    once = rows.groupBy(order).agg(F.count("*").alias("n"))  # equal rows are interchangeable
    ranged = once.repartitionByRange(*order).sortWithinPartitions(*order)
    content = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    slim = ranged.select("conv_id", F.unhex(F.sha2(content, 256)).alias("symbol"), F.length("text").alias("size"), "n")
    placed = stored(slim.mapInArrow(_place, "conv_id long, symbol binary, size int, n long, shard int, at long"), "placed")
    shards = placed.groupBy("conv_id", "shard").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # only the first conversation of a shard can have begun before it: at most one row per shard
    begun = shards.withColumn("before", F.sum("n").over(earlier)).filter("before IS NOT NULL").select("conv_id", "shard", "before")
    found = placed.join(F.broadcast(begun), ["conv_id", "shard"], "left")
    first = F.col("at") + F.coalesce("before", F.lit(0))
    return found.select("conv_id", "symbol", "size", F.explode(F.sequence(first, first + F.col("n") - 1)).alias("pos")).select(
        "conv_id", "pos", "symbol", "size")


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, held, upto = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        at = []
        for conv_id, n in zip(batch.column("conv_id").to_pylist(), batch.column("n").to_pylist(), strict=True):
            held, upto = (held, upto) if conv_id == held else (conv_id, 0)
            at.append(upto)
            upto += n
        more = [pa.array([shard] * len(at), pa.int32()), pa.array(at, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "shard", "at"])


def rebuilt(turns: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Turns of conversations that begin like the first of their group.

    Conversation c takes the first h turns of conversation c - c % group (all, if fewer),
    then its own after its first h; h is the CRC-32 of its decimal id modulo ``heads``.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")
    sizes = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n", base.alias("base"), h), "sizes")
    lengths = sizes.filter("conv_id = base").select(F.col("conv_id").alias("b"), F.col("n").alias("base_n"))
    plan = sizes.join(lengths, F.col("base") == F.col("b"), "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    first = turns.filter((F.col("conv_id") == base) & (F.col("pos") < heads - 1)).select(
        F.col("conv_id").alias("b"), "pos", "symbol", "size")
    borrowed = plan.join(first, (F.col("base") == F.col("b")) & (F.col("pos") < F.col("taken"))).select(
        "conv_id", "pos", "symbol", "size")
    own = turns.join(plan, "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "symbol", "size")
    return borrowed.unionByName(own)


class _Node:
    __slots__ = ("symbol", "skeleton", "conv_id", "members", "children", "leaves", "saved", "size", "ends", "going", "below", "held")

    def __init__(self, symbol: bytes, skeleton: int, size: int):
        self.symbol, self.skeleton, self.size = symbol, skeleton, size
        self.conv_id = self.ends = None
        self.members = self.children = self.leaves = self.saved = self.going = 0
        self.below = False
        self.held: list[tuple] = []


_OUT = pa.schema([
    ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("skeleton", pa.int64()), ("above", pa.int64()), ("key", pa.binary()), ("line", pa.list_(pa.binary())),
    ("size", pa.int64()), ("going", pa.int64()), ("top", pa.binary()), ("ending", pa.bool_()),
])
_OUT_SQL = ("depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
            "ends_sha256 string, skeleton long, above long, key binary, line array<binary>, size long, going long, top binary, ending boolean")


class _Shard:
    """Nodes of sorted items: complete where no splitter passes through them, partial on the skeleton."""

    def __init__(self, skeleton: dict[tuple[int, bytes], int]):
        self.skeleton, self.stack, self.out = skeleton, [], []

    def close(self, to: int) -> None:
        while len(self.stack) > to:
            prefix = b"".join(n.symbol for n in self.stack)
            node = self.stack.pop()
            parent, depth = (self.stack[-1] if self.stack else None), len(self.stack)
            above, top = parent.skeleton if parent else -1, None if parent else node.symbol
            if node.skeleton >= 0:
                self.out.append((depth, node.conv_id, None, node.members, node.children, node.leaves, node.saved, None,
                                 node.skeleton, above, None, None, node.size, node.going, top, False))
                continue
            key = line = None
            if node.going > 1:  # its subtree goes on in the next round
                line = [hashlib.sha256(prefix[: WIDTH * k]).digest() for k in range(1, depth + 2)]
                node.below = True
            if node.below:
                key = hashlib.sha256(prefix).digest()
                if parent:
                    parent.below = True
            if node.going == 1:
                node.children = node.leaves = 1
            elif not node.children and not node.going:
                node.leaves = 1
            saved = node.saved + (node.members - 1) * node.size
            ends = node.ends.hexdigest() if node.ends else NOTHING
            record = (depth, node.conv_id, None, node.members, node.children, node.leaves, saved, ends,
                      -1, above, key, line, node.size, node.going, top, False)
            self.out += [(*r[:2], node.conv_id, *r[3:]) for r in node.held]
            if parent:
                parent.children += 1
                parent.leaves += node.leaves
                parent.saved += saved
            if parent and parent.skeleton < 0:
                parent.held.append(record)
            else:
                self.out.append(record)

    def add(self, path: bytes, sizes: list[int], conv_id: int, goes_on: bool) -> None:
        symbols = [path[i : i + WIDTH] for i in range(0, len(path), WIDTH)]
        common = 0
        while common < min(len(symbols), len(self.stack)) and self.stack[common].symbol == symbols[common]:
            common += 1
        self.close(common)
        for depth in range(common, len(symbols)):
            above = self.stack[-1].skeleton if self.stack else -1
            at = self.skeleton.get((above, symbols[depth]), -1) if above >= 0 or depth == 0 else -1
            self.stack.append(_Node(symbols[depth], at, sizes[depth - 1] if depth else 0))
        for node in self.stack:
            node.members += 1
            node.conv_id = conv_id if node.conv_id is None else min(node.conv_id, conv_id)
        last = self.stack[-1]
        if goes_on:
            last.going += 1
        elif last.skeleton >= 0:
            self.out.append((len(symbols) - 1, conv_id, *[None] * 6, last.skeleton, *[None] * 6, True))
        elif last.ends is None:
            last.ends = hashlib.sha256(str(conv_id).encode())
        else:
            last.ends.update(f",{conv_id}".encode())

    def rows(self) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) if self.out else [[]] * len(_OUT)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT)


def _splitters(items: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` items that cut the order of (path, id) into even ranges, from a sample by hash."""
    n = items.count()
    rate = SAMPLE * shards / max(n, 1)
    place = F.pmod(F.xxhash64("conv_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = sorted((bytes(r.path), r.conv_id) for r in items.filter(place < rate).select("path", "conv_id").collect())
    step = max(len(sample) / shards, 1)
    return sorted({sample[int(k * step)] for k in range(1, shards) if int(k * step) < len(sample)})


def _skeleton(splitters: list[tuple[bytes, int]]) -> tuple[dict[tuple[int, bytes], int], list[tuple]]:
    """The trie of splitter paths: its edges, and (node, parent, depth, ancestors with itself, key, top symbol) rows."""
    edges: dict[tuple[int, bytes], int] = {}
    rows: list[tuple] = []
    for path, _ in splitters:
        above, line = -1, []
        for i in range(0, len(path), WIDTH):
            edge = (above, path[i : i + WIDTH])
            node = edges.setdefault(edge, len(edges))
            line.append(node)
            if node == len(rows):
                key = hashlib.sha256(path[: i + WIDTH]).digest()
                rows.append((node, above, i // WIDTH, list(line), key, None if i else path[:WIDTH]))
            above = node
    return edges, rows


def _section(items: DataFrame) -> DataFrame:
    """All nodes of (path, conv_id, sizes, goes_on) items; see ``_OUT`` for the columns."""
    spark = items.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splitters = _splitters(items, shards)
    edges, structure = _skeleton(splitters)
    cut, known = spark.sparkContext.broadcast(splitters), spark.sparkContext.broadcast(edges)

    def deal(batches):
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            shard = pa.array([bisect_right(cut.value, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=[*batch.schema.names, "shard"])

    def local(batches):
        trie, shard = _Shard(known.value), None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "path", "sizes", "conv_id", "goes_on")]
            for at, path, sizes, conv_id, goes_on in zip(*columns, strict=True):
                if at != shard:
                    trie.close(0)
                    shard = at
                trie.add(path, sizes, conv_id, goes_on)
                if len(trie.out) >= 10_000:
                    yield trie.rows()
            yield trie.rows()
        trie.close(0)
        yield trie.rows()

    dealt = items.mapInArrow(deal, "path binary, conv_id long, sizes array<int>, goes_on boolean, shard int")
    ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = stored(ordered.mapInArrow(local, _OUT_SQL), "trie-shards")
    columns = [*NODE, "key", "line", "going", "top"]
    whole = found.filter("skeleton < 0")
    if not structure:
        return whole.select(columns)

    parts = found.filter("skeleton >= 0 AND NOT ending").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "going")],
        F.max("size").alias("size"))
    # as the skeleton itself, the tables of its nodes are bounded by the number of shards
    bones = spark.createDataFrame(structure, "skeleton long, above long, depth long, ancestors array<long>, key binary, top binary")
    inner = bones.groupBy(F.col("above").alias("skeleton")).agg(F.count("*").alias("inner"))
    children = F.col("n_children") + F.coalesce("inner", F.lit(0))
    own = stored(
        parts.join(F.broadcast(bones), "skeleton").join(F.broadcast(inner), "skeleton", "left").select(
            "skeleton", "above", "depth", "ancestors", "key", "top", "going", "conv_id", "n_convs",
            F.when(F.col("going") == 1, 1).otherwise(children).alias("n_children"),
            (F.col("n_leaves") + F.when((F.col("going") <= 1) & (children == 0), 1).otherwise(0)).alias("own_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("own_saved")),
        "skeleton")
    sums = own.select(F.explode("ancestors").alias("skeleton"), "own_leaves", "own_saved").groupBy("skeleton").agg(
        F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved_tokens"))
    ending = found.filter("ending").select("skeleton", "conv_id").repartition("skeleton").sortWithinPartitions("skeleton", "conv_id")
    ends = ending.mapInArrow(_digest, "skeleton long, ends_sha256 string")
    ids = own.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    keys = own.select(F.col("skeleton").alias("a"), F.col("key").alias("k"))
    lines = (
        own.filter("going > 1").select("skeleton", F.posexplode("ancestors").alias("place", "a")).join(F.broadcast(keys), "a")
        .groupBy("skeleton").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "k"))), lambda s: s["k"]).alias("line"))
    )
    trunk = (
        own.join(sums, "skeleton").join(ends, "skeleton", "left").join(F.broadcast(ids), "above", "left")
        .join(F.broadcast(lines), "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    )
    hanging = whole.filter("above >= 0").drop("parent_conv_id").join(F.broadcast(ids), "above")
    return whole.filter("above < 0").select(columns).unionByName(hanging.select(columns)).unionByName(trunk.select(columns))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each skeleton node, read as a sorted stream."""
    held = digest = None
    for batch in batches:
        for node, conv_id in zip(batch.column("skeleton").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if node != held:
                if digest is not None:
                    yield pa.RecordBatch.from_pydict({"skeleton": [held], "ends_sha256": [digest.hexdigest()]})
                held, digest = node, hashlib.sha256(str(conv_id).encode())
            else:
                digest.update(f",{conv_id}".encode())
    if digest is not None:
        yield pa.RecordBatch.from_pydict({"skeleton": [held], "ends_sha256": [digest.hexdigest()]})


def trie(turns: DataFrame, members: DataFrame, section: int = SECTION) -> DataFrame:
    """Every node of the trie of ``turns`` (conv_id, pos, symbol, size), by its smallest member and depth.

    ``members`` holds each conv_id once, also those without turns.
    """
    turns = stored(turns, "trie-turns")
    totals = turns.groupBy("conv_id").agg(F.count("*").alias("total"))
    going = stored(members.join(totals, "conv_id", "left").select(
        "conv_id", F.coalesce("total", F.lit(0)).alias("total"), F.lit(TOP).alias("chain")), "members")
    rounds: list[DataFrame] = []
    chains: list[DataFrame] = []
    while True:
        start = len(rounds) * section
        near = turns.filter((F.col("pos") >= start) & (F.col("pos") < start + section)).groupBy("conv_id").agg(
            F.sort_array(F.collect_list(F.struct("pos", "symbol", "size"))).alias("part"))
        joined = going.join(near, "conv_id", "left")
        path = F.aggregate(F.coalesce(F.transform("part", lambda t: t["symbol"]), F.array().cast("array<binary>")),
                           F.col("chain"), lambda path, symbol: F.concat(path, symbol))
        sizes = F.coalesce(F.transform("part", lambda t: t["size"]), F.array().cast("array<int>"))
        goes_on = F.col("total") > start + section
        items = stored(joined.select(path.alias("path"), "conv_id", sizes.alias("sizes"), goes_on.alias("goes_on"), "total"), "items")
        rounds.append(stored(_section(items.select("path", "conv_id", "sizes", "goes_on")).withColumn(
            "depth", F.col("depth") + start), "trie-nodes"))
        # several that go on from one node stay together; one alone leaves as a chain
        full = items.filter(F.col("total") >= start + section).withColumn("chain", F.unhex(F.sha2("path", 256)))
        ends = stored(full.groupBy("chain").agg(F.min("conv_id").alias("top_id"), F.count_if("goes_on").alias("n")).filter("n > 0"), "open")
        if ends.isEmpty():
            break
        split = stored(full.select("conv_id", "total", "goes_on", "chain").join(ends, "chain"), "split")
        alone = split.filter("n = 1 AND goes_on").select("conv_id", "total", "top_id")
        rest = turns.filter(F.col("pos") >= start + section).join(alone, "conv_id")
        last, one = F.col("pos") + 1 == F.col("total"), F.lit(1).cast("long")
        chains.append(rest.select(
            "conv_id", (F.col("pos") + 1).alias("depth"),
            F.when(F.col("pos") == start + section, F.col("top_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256")))
        # with those that end there, so that the next round knows the smallest member
        going = stored(split.filter("n > 1").select("conv_id", "total", "chain"), "members")
        if going.isEmpty():
            break
    nodes = rounds[-1]
    for k in range(len(rounds) - 1, 0, -1):
        # the top of a section is the last node of the one above: its totals go up the line
        chains.append(nodes.filter(F.col("depth") > k * section).select(NODE))
        nodes = stored(_raised(rounds[k - 1], nodes.filter(F.col("depth") == k * section)), "trie-raised")
    found = nodes.select(NODE)
    for more in chains:
        found = found.unionByName(more)
    return found


def _raised(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """``nodes`` with the totals of the subtrees that go on below them in the next section."""
    totals = tops.select(F.col("top").alias("key"), *[F.col(c).alias(f"more_{c}") for c in ("n_children", "n_leaves", "saved_tokens")])
    below = nodes.filter("going > 1").select("key", "line").join(totals, "key")
    ups = below.select(
        F.explode("line").alias("up"), "more_n_leaves", "more_saved_tokens",
        F.when(F.col("up") == F.col("key"), F.col("more_n_children")).otherwise(0).alias("more_n_children"),
    ).groupBy("up").agg(*[F.sum(f"more_{c}").alias(f"more_{c}") for c in ("n_children", "n_leaves", "saved_tokens")])
    changed = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("n_children", "n_leaves", "saved_tokens")}
    return nodes.join(ups, F.col("key") == F.col("up"), "left").withColumns(changed).select(nodes.columns)
