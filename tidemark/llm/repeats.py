"""Byte strings of a fixed length that occur twice, by column-wise suffix sorting.

A string of ``LENGTH`` bytes is a *window*.  Each window chooses an anchor, the
``GRAM``-byte piece inside it with the smallest hash (the leftmost of equals); windows that
are equal choose equal anchors at equal offsets, so only windows under one anchor
need comparing.  Neighbouring windows with one anchor are a *run*: the bytes they span.

1. Runs are hashed in one pass over the texts.  Runs that agree byte by byte are a class
   (aggregated before the shuffle, so copies of a document, however many, are one row); all
   windows of a class with two members are repeated.
2. Where an anchor has several classes, one run of each is cut into stretches of ``STRETCH``
   windows by the distance from the anchor.  The bytes that all windows of a stretch
   share are its *core*; what it has before and behind is shorter than a stretch.
   Stretches that agree are classes again.
3. Where a core has several classes, they are sent, by core, to tasks that build the
   suffix order of a bounded collection *column-wise*: each round puts one symbol in
   front of every member, which moves the collection's Burrows-Wheeler transform
   and its common prefixes on to the next column.  Both live in sequential files that
   a round reads once and writes anew.  The core, equal in a group, is one symbol that weighs
   its bytes.  A suffix whose common prefix with a neighbour has ``LENGTH`` bytes is a repeated
   window.
4. A core with more than ``CROWD`` classes (a phrase in very many different surroundings) is
   split first: half a stretch of the bytes before or behind it joins the core, what
   agrees then is a class again, and the parts are sorted like other cores or, where still
   crowded, split again.

Equality of runs and cores is that of 128 bits of hash (for runs, 64 of the anchor and 64
of the whole), all else is compared by bytes.

Defined results: null text is empty; texts shorter than a window lose nothing; text
repeated within a document counts; strings may not cross documents; repeated rows lose
all that is long enough and come out repeated; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.words import pieces, row_hash
from tidemark.operators.keys import splittable_groups
from tidemark.session import stored

LENGTH = 400
GRAM = 200
CROWD = 4096
STRETCH = 32  # a power of two
COLLECTION = 2048  # members of one suffix order, but for the rest of a core's classes
TASK = 4 * COLLECTION  # members that a task sorts, on average
MOST_TASKS = 1 << 15
SLICE = 1 << 20  # bytes of a text hashed at a time
_MULTIPLIER = 0x9E3779B97F4A7C15
_PLACE = np.uint64(0xFFFFFF)
_CORE = 257  # symbol of the first core; bytes are 1 to 256, 0 is "nothing in front"


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, base, np.uint64))))


class Runs:
    """Anchors of windows; tables of powers are made once per task."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.up = _powers(_MULTIPLIER, SLICE + length)
        self.down = _powers(pow(_MULTIPLIER, -1, 1 << 64), SLICE + length)

    def __call__(self, data: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(anchor hash, first window, number of windows, place of the anchor)."""
        for start in range(0, max(len(data) - self.length + 1, 0), SLICE):
            part = np.frombuffer(data, np.uint8)[start : start + SLICE + self.length - 1]
            yield from self._slice(part, start)

    def _slice(self, part: np.ndarray, start: int):
        n, width = len(part), self.length - self.gram + 1
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.up[:n])))
        hashed = (sums[self.gram :] - sums[: -self.gram]) * self.down[: n - self.gram + 1]
        hashed ^= hashed >> np.uint64(31)
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(29)
        # hash above, place below: the smallest is the leftmost of the smallest hashes
        key = (hashed & ~_PLACE) | np.arange(len(hashed), dtype=np.uint64)
        padded = np.concatenate((key, np.full(-len(key) % width, ~np.uint64(0)))).reshape(-1, width)
        before = np.minimum.accumulate(padded, axis=1).ravel()
        after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - self.length + 1
        chosen = (np.minimum(after[:windows], before[width - 1 : width - 1 + windows]) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(chosen, prepend=-1))
        number = np.diff(np.append(first, windows))
        at = chosen[first]
        return zip(
            hashed[at].view(np.int64).tolist(), (first + start).tolist(), number.tolist(), (at + start).tolist(), strict=True
        )


def _halves(data: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(data)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _bytes(scalar) -> bytes:
    return (scalar.as_py() or "").encode("utf-8", "surrogatepass")


def hashed_runs(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(length, gram)
        for piece in pieces(batches):
            row, columns = [], [[] for _ in range(5)]
            for i, text in enumerate(piece.column("text")):
                data = _bytes(text)
                for anchor, first, number, at in runs(data):
                    row.append(i)
                    whole = xxhash.xxh3_64_intdigest(data[first : first + number + length - 1])
                    values = (anchor, whole - (1 << 64) if whole >> 63 else whole, first, number, at)
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
            at_rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(at_rows), piece.column("row_hash").take(at_rows)]
                + [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "row_hash", "anchor", "whole", "first", "number", "at"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, row_hash long, anchor long, whole long, first long, number long, at long"
    )


def _cut_out(wanted: DataFrame, length: int, stretch: int) -> DataFrame:
    """Stretches of the wanted runs: hash of the core, and the bytes before and behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            row, columns = [], [[] for _ in range(6)]
            for i, (text, items) in enumerate(zip(piece.column("text"), piece.column("runs").to_pylist(), strict=True)):
                data = _bytes(text)
                for item in items:
                    at, first, last = item["at"], item["first"], item["first"] + item["number"] - 1
                    for block in range((at - last) // stretch, (at - first) // stretch + 1):
                        core = at - block * stretch  # last window of a whole stretch
                        behind = core - stretch + 1 + length
                        low, high = max(first, core - stretch + 1), min(last, core)
                        values = (
                            *_halves(data[core:behind]), low, high - low + 1, data[low:core], data[behind : high + length]
                        )
                        row.append(i)
                        for column, value in zip(columns, values, strict=True):
                            column.append(value)
            at_rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(at_rows), piece.column("row_hash").take(at_rows)]
                + [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.binary()) for c in columns[4:]],
                names=["doc_id", "row_hash", "c1", "c2", "first", "number", "before", "behind"],
            )

    kind = wanted.schema["doc_id"].dataType.simpleString()
    return wanted.mapInArrow(
        run, f"doc_id {kind}, row_hash long, c1 long, c2 long, first long, number long, before binary, behind binary"
    )


_RECORD = np.dtype([("bwt", np.uint16), ("lcp", np.uint16), ("run", np.int32), ("place", np.uint16)])


def repeated_places(
    members: list[tuple[int, bytes, bytes]], length: int, core_bytes: int, folder: str
) -> list[np.ndarray]:
    """Starts of the windows of each member that also stand elsewhere in the collection.

    A member is (number of its core, bytes before the core, bytes behind it).  The file of a
    round holds, in the order of the suffixes so far: the symbol in front, the common
    prefix with the suffix above (in bytes, ``length`` at most), the member and the place.
    """
    one = np.uint16(1)
    symbols = [
        np.concatenate((
            np.frombuffer(before, np.uint8).astype(np.uint16) + one, np.array([_CORE + core], np.uint16),
            np.frombuffer(behind, np.uint8).astype(np.uint16) + one,
        ))
        for core, before, behind in members
    ]
    m = len(symbols)
    sizes = np.array([len(s) for s in symbols])
    flat = np.concatenate(symbols)
    ends = np.cumsum(sizes)
    table = np.zeros(m, _RECORD)
    table["run"] = np.arange(m)
    table["place"] = sizes
    row_of = np.arange(m)  # where each run's newest suffix stands
    name = os.path.join(folder, "column")
    table.tofile(name)
    for column in range(sizes.max()):
        table = np.fromfile(name, _RECORD)
        active = np.flatnonzero(sizes > column)
        newest = row_of[active]
        symbol = flat[ends[active] - 1 - column]
        bwt, lcp = table["bwt"].copy(), table["lcp"]
        bwt[newest] = symbol
        fresh = np.zeros(len(table), bool)
        fresh[newest] = True
        # a stable sort by the symbol in front gives the order of all suffixes one symbol longer
        extended = np.argsort(bwt, kind="stable")
        extended = extended[len(table) - np.count_nonzero(bwt) :]
        at = np.flatnonzero(fresh[extended])  # of the new suffixes, behind the m empty ones
        run = table["run"][extended[at]]

        def common(k: np.ndarray) -> np.ndarray:
            """Common prefix of the suffixes k - 1 and k of ``extended``."""
            found = np.zeros(len(k), np.int64)
            inner = np.flatnonzero((k > 0) & (k < len(extended)))
            upper, lower = extended[k[inner] - 1], extended[np.minimum(k[inner], len(extended) - 1)]
            same = bwt[upper] == bwt[lower]
            inner, upper, lower = inner[same], upper[same], lower[same]
            if len(inner):
                order = np.argsort(upper)
                pairs = np.stack([upper[order] + 1, lower[order] + 1], axis=1).ravel()
                least = np.minimum.reduceat(np.append(lcp, np.uint16(0)), pairs)[::2]
                weight = np.where(bwt[upper[order]] >= _CORE, core_bytes, 1)
                found[inner[order]] = np.minimum(least.astype(np.int64) + weight, length)
            return found

        place = m + at
        grown = np.empty(len(table) + len(at), _RECORD)
        old = np.ones(len(grown), bool)
        old[place] = False
        table["bwt"] = bwt
        grown[old] = table
        new = np.zeros(len(at), _RECORD)
        new["lcp"], new["run"], new["place"] = common(at), run, sizes[run] - 1 - column
        grown[place] = new
        behind = at + 1
        behind = behind[behind < len(extended)]
        grown["lcp"][m + behind] = common(behind)
        row_of[run] = place
        grown.tofile(name)
    table = np.fromfile(name, _RECORD)
    close = table["lcp"] >= length
    hit = close | np.append(close[1:], False)
    found_run, found_place = table["run"][hit], table["place"][hit]
    order = np.argsort(found_run, kind="stable")
    splits = np.searchsorted(found_run[order], np.arange(1, m))
    return np.split(found_place[order].astype(np.int64), splits)


def _intervals(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Covered bytes of windows at sorted starts, merged where consecutive."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(s[0]), int(s[-1]) + length) for s in np.split(starts, cuts)]


def _sorted_collections(strings: DataFrame, length: int, stretch: int) -> DataFrame:
    """Repeated intervals among the stretches of each core; those of a core come together."""
    kind = to_arrow_type(strings.schema["doc_id"].dataType)

    def solve(held: list[dict]):
        cores: dict = {}
        members = [(cores.setdefault((h["c1"], h["c2"]), len(cores)), h["before"], h["behind"]) for h in held]
        with tempfile.TemporaryDirectory() as folder:
            places = repeated_places(members, length, length - stretch + 1, folder)
        for item, starts in zip(held, places, strict=True):
            for left, right in _intervals(np.unique(starts), length):
                yield item["doc_id"], item["row_hash"], item["first"] + left, item["first"] + right

    def collections(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        held, last = [], None
        for batch in batches:
            for item in batch.to_pylist():
                core = (item["c1"], item["c2"])
                if len(held) >= COLLECTION and core != last:
                    yield held
                    held = []
                held.append(item)
                last = core
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in collections(batches):
            found = list(solve(held))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], kind), *(pa.array([f[i] for f in found], pa.int64()) for i in (1, 2, 3))],
                names=["doc_id", "row_hash", "start", "end"],
            )

    name = strings.schema["doc_id"].dataType.simpleString()
    return strings.mapInArrow(run, f"doc_id {name}, row_hash long, start long, end long")


def repeats(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, stretch: int = STRETCH, crowd: int = CROWD
) -> DataFrame:
    """doc_id, row_hash, start, end: byte intervals covered by repeated windows (they may overlap)."""
    rows = documents.select("doc_id", row_hash(documents).alias("row_hash"), "text")
    runs = stored(hashed_runs(rows, length, gram), "runs")
    # most anchors stand once in the corpus: what goes on is the rest
    named = splittable_groups(runs, "anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    runs = stored(runs.join(named, "anchor"), "shared-runs")
    own = ["anchor", "whole"]
    classes = stored(
        runs.groupBy(*own).agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("doc_id", "row_hash", "first", "number", "at")).alias("run"),
        ), "run-classes"
    )
    several = classes.filter("copies > 1").select(*own)
    whole = runs.join(several, own).select(
        "doc_id", "row_hash", F.col("first").alias("start"), (F.col("first") + F.col("number") + (length - 1)).alias("end")
    )
    shared = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    chosen = classes.join(shared, "anchor").select(
        "run.doc_id", "run.row_hash",
        F.struct("run.first", "run.number", "run.at").alias("r"),
    )
    per_row = chosen.groupBy("doc_id", "row_hash").agg(F.collect_list("r").alias("runs"))
    keyed = per_row.select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), "runs")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_hash") == F.col("_hash"))
    wanted = rows.join(keyed, same).select("doc_id", "row_hash", "text", "runs")
    cut = stored(_cut_out(wanted, length, stretch), "stretches")
    return whole.unionByName(_among(cut, length, stretch, crowd))


def _among(cut: DataFrame, length: int, stretch: int, crowd: int) -> DataFrame:
    """Repeated intervals among stretches of at most ``stretch`` windows."""
    core, alike = ["c1", "c2"], ["c1", "c2", "before", "behind"]
    kinds = stored(
        cut.groupBy(*alike).agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "row_hash", "first", "number")).alias("run")
        ), "stretch-classes"
    )
    found = cut.join(kinds.filter("copies > 1").select(*alike), alike).select(
        "doc_id", "row_hash", F.col("first").alias("start"), (F.col("first") + F.col("number") + (length - 1)).alias("end")
    )
    groups = splittable_groups(kinds, *core).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(*core, "k")
    varied = stored(kinds.join(groups, core).select(*alike, "k", "run.*"), "varied-stretches")
    gathered, crowded = varied.filter(F.col("k") <= crowd).drop("k"), varied.filter(F.col("k") > crowd).drop("k")
    n_gathered = gathered.count()
    if n_gathered:
        # a stated number of tasks: by bytes the planner would put most of this dear, small input into one
        tasks = min(-(-n_gathered // TASK), MOST_TASKS)
        parts = gathered.drop("number").repartition(tasks, *core).sortWithinPartitions(*core)
        found = found.unionByName(_sorted_collections(parts, length, stretch))
    if crowded.isEmpty():
        return found
    return found.unionByName(_among(stored(_halved(crowded, stretch), "half-stretches"), length, stretch // 2, crowd))


def _halved(crowded: DataFrame, stretch: int) -> DataFrame:
    """The same windows under cores that are longer by half a stretch, before or behind.

    Of the ``stretch - 1`` bytes that a window has around its core, at least half a
    stretch lie before it or else at least half a stretch behind it, so that many
    neighbouring bytes become part of the core and a crowded core falls apart by them.
    """
    half = stretch // 2
    n_before, n_behind = F.length("before"), F.length("behind")

    def grown(side: str, near: Column) -> list[Column]:
        return [F.xxhash64(name, other, F.lit(side + name), near).alias(name) for name, other in (("c1", "c2"), ("c2", "c1"))]

    def part(value: Column, start, size) -> Column:
        return F.substring(value, start, size)

    # windows with at least half a stretch before the core
    front = crowded.filter(n_before >= half).select(
        "doc_id", "row_hash", *grown("before", part(F.col("before"), n_before - half + 1, F.lit(half))), "first",
        F.least("number", (n_before - half + 1).cast("long")).alias("number"),
        part(F.col("before"), F.lit(1), n_before - half).alias("before"),
        part(F.col("behind"), F.lit(1), F.lit(half - 1)).alias("behind"),
    )
    # the others: fewer before it, so at least half a stretch behind it
    skipped = F.greatest(n_before - (half - 1), F.lit(0))
    rear = crowded.filter(n_behind >= half).select(
        "doc_id", "row_hash", *grown("behind", part(F.col("behind"), F.lit(1), F.lit(half))),
        (F.col("first") + skipped).alias("first"), (F.col("number") - skipped).alias("number"),
        part(F.col("before"), skipped + 1, n_before).alias("before"),
        part(F.col("behind"), F.lit(half + 1), n_behind).alias("behind"),
    )
    return front.unionByName(rear).filter("number > 0")


def _removal(intervals: list[dict], data: bytes) -> tuple[int, int, str]:
    """Removed bytes, maximal removed runs, digest of the rest."""
    digest, removed, spans, last = hashlib.sha256(), 0, 0, 0
    open_end = -1
    for item in sorted(intervals or [], key=lambda x: (x["start"], x["end"])):
        start, end = item["start"], item["end"]
        if start > open_end:
            digest.update(data[last:start])
            spans += 1
            removed += end - start
            open_end = last = end
        elif end > open_end:
            removed += end - open_end
            open_end = last = end
    digest.update(data[last:])
    return removed, spans, digest.hexdigest()


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    found = repeats(documents).groupBy("doc_id", "row_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    keyed = found.select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), "spans")
    rows = documents.select("doc_id", row_hash(documents).alias("row_hash"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_hash") == F.col("_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            results = []
            for text, spans in zip(piece.column("text"), piece.column("spans").to_pylist(), strict=True):
                data = _bytes(text)
                results.append((len(data), *_removal(spans, data)))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array([r[i] for r in results], pa.int64()) for i in range(3)),
                 pa.array([r[3] for r in results], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    joined = rows.join(keyed, same, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
