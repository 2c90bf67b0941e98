"""Repair of conversation structure by iterative-deepening A*.

A sound conversation has the role initials ``(s?(ua)+)?``.  ``repair`` finds for each
conversation the cheapest edits (keep 0, rerole 2, delete 3, insert 2, and 1 for every
truncated row that is not deleted; blank and duplicate rows must go) that make it sound,
among equals the least string of edit initials.  The search goes depth first through the
edits in ASCII order (D, I, K, R) under a cost bound that rises by the least overshoot;
what all remaining rows must cost at least prunes it, and a table holds for every (row,
state) the largest budget that failed there.  So the first accepting path is the answer.

A conversation of more than ``STRETCH`` rows is cut into stretches.  The search then
gives the cheapest edits of a stretch for every pair of states before and after it, and
neighbouring stretches combine to the cheapest of their sums.  Conversations above
``LONG_ROWS`` rows or ``LONG_BYTES`` characters are never gathered: their rows are
range-partitioned in order, each shard folds its own stretches, shards combine up a
tree of ``FAN`` children, and the edits are replayed over the sorted rows as a stream.
(Edits and digest of one conversation are single values, so that last stream is
sequential by its definition; it holds one batch of rows and the edits.)

Defined results: null role or text is one space; rows are ordered by turn (null first),
then role and text by code point, so repeated rows stand together; a role whose first
character is not s, u or a, or that is empty, cannot be kept; null conv_id is a
conversation of its own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored

STRETCH = 8
LONG_ROWS = 4096
LONG_BYTES = 8 << 20
FAN = 32
PLAIN, TRUNCATED, DOOMED = 0, 1, 2
SPACES = " \t\n\v\f\r"
#: States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The only state that a new or changed row can lead to.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
ORDER = ["turn", "role", "text"]


@lru_cache(1 << 15)
def search(rows: tuple[tuple[str, int], ...], entry: int = START, exits: tuple[int, ...] = (START, ASSISTANT)) -> tuple[int, str]:
    """(cost, edits) that lead from ``entry`` over (initial, kind) rows to one of ``exits``."""
    n = len(rows)
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (3 if rows[i][1] == DOOMED else rows[i][1])

    def descend(i: int, state: int, budget: int):
        nonlocal over
        if i == n and state in exits:
            return ""
        if failed.get((i, state), -1) >= budget:
            return None
        moves = [("D", 3, i + 1, state)] if i < n else []
        moves.append(("I", 2, i, NEXT[state]))
        if i < n and rows[i][1] != DOOMED:
            initial, truncated = rows[i]
            if (state, initial) in KEPT:
                moves.append(("K", truncated, i + 1, KEPT[state, initial]))
            moves.append(("R", 2 + truncated, i + 1, NEXT[state]))
        for letter, cost, at, to in moves:
            left = budget - cost
            if least[at] > left:
                over = min(over, least[at] - left)
                continue
            rest = descend(at, to, left)
            if rest is not None:
                return letter + rest
        failed[i, state] = budget
        return None

    bound = least[0]
    while True:
        over, failed = 3 * n + 7, {}  # deleting all and inserting a pair is never dearer
        found = descend(0, entry, bound)
        if found is not None:
            return bound, found
        bound += over


@lru_cache(1 << 13)
def stretch_paths(rows: tuple[tuple[str, int], ...]) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest edits of a stretch for every state before and after it that some edits connect.

    Nothing leads back to the first two states, so only deletions keep them, and only one
    kept system row leads from the first to the second; the search does the rest.
    """
    n = len(rows)
    found = {(q, q): (3 * n, "D" * n) for q in (START, SYSTEM)}
    alone = [(3 * n - 3 + kind, "D" * i + "K" + "D" * (n - 1 - i))
             for i, (initial, kind) in enumerate(rows) if initial == "s" and kind != DOOMED]
    if alone:
        found[START, SYSTEM] = min(alone)
    return found | {(a, b): search(rows, a, (b,)) for a in range(4) for b in (USER, ASSISTANT)}


def joined(left: dict, right: dict) -> dict:
    """Paths over two neighbouring stretches: the cheapest sum over the states between, ties to the least edits."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for (a, b), (cost, edits) in left.items():
        for c in range(4):
            if (b, c) in right:
                more, rest = right[b, c]
                if (a, c) not in best or cost + more <= best[a, c][0]:
                    path = (cost + more, edits + rest)
                    best[a, c] = min(path, best.get((a, c), path))
    return best


def folded(paths: list[dict]) -> dict:
    """All of them joined in order, by pairs, so that edits are copied once per level."""
    while len(paths) > 1:
        paths = [joined(*paths[i : i + 2]) if i + 1 < len(paths) else paths[i] for i in range(0, len(paths), 2)]
    return paths[0] if paths else {(q, q): (0, "") for q in range(4)}


def _stretches(rows: list[tuple[str, int]]) -> list[dict]:
    return [stretch_paths(tuple(rows[i : i + STRETCH])) for i in range(0, len(rows), STRETCH)]


def cheapest(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, edits) of a whole conversation."""
    if len(rows) <= STRETCH:
        return search(tuple(rows))
    paths = folded(_stretches(rows))
    return min(paths[START, q] for q in (START, ASSISTANT) if (START, q) in paths)


def kind_of(text: str, seen: bool) -> tuple[int, str]:
    """What a row must bear in the search, and the name of its first fault."""
    last = text.rstrip(SPACES)[-1:]
    if not last:
        return DOOMED, "blank"
    if seen:
        return DOOMED, "duplicate"
    return (PLAIN, "") if last in ".!?" else (TRUNCATED, "truncated")


def edited(rows, edits: str):
    """(role, text) rows after the edits; ``rows`` is consumed as the edits go."""
    rows, state = iter(rows), START
    for letter in edits:
        if letter == "I":
            state = NEXT[state]
            yield ROLES[state], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = KEPT[state, role[:1]]
            yield role, text
        elif letter == "R":
            state = NEXT[state]
            yield ROLES[state], text


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults that a checksum of id and turn decides, for trying the repair on sound tables."""
    named = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    spot = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(spot.cast("binary")) % 20
    changed = named.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )
    return changed


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_REPORT = "gaps long, " + ", ".join(f"{name} long" for name in _COUNTS) + ", cost long, audit string"


def repair(
    conversations: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Report and repaired rows of every conversation of (conv_id, turn, role, text[, copies]).

    The report has a row per conv_id: gaps in the turns, faults by kind, illegal
    neighbours, cost and edits, and the SHA-256 of the repaired ``role:text`` lines.  The
    repaired rows are (conv_id, pos, role, text).  ``copies`` says how often a row stands
    in the conversation; 0 names a conversation without giving it a row.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    turn = conversations.schema["turn"].dataType.simpleString()
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
    named = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
                                 copies.cast("long").alias("copies"))
    kept = [F.when(F.col("copies") > 0, F.col(c)).alias(c) for c in ORDER]
    # equal rows are interchangeable: each is held once, with its number
    rows = stored(named.select("conv_id", *kept, "copies").groupBy("conv_id", *ORDER).agg(F.sum("copies").alias("copies")), "turns")
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.length("text")).alias("bytes"))
    long = stored(sizes.filter((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select(F.col("conv_id").alias("long_id")), "long")
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = rows.join(long, is_long, "left_anti").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(*ORDER, "copies"))).alias("rows"))
    row = "struct<role: string, text: string>"
    whole = stored(short.mapInArrow(_whole, f"conv_id {kind}, {_REPORT}, repaired array<{row}>"), "repaired")
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    report = whole.select("conv_id", "gaps", *_COUNTS, "cost", "audit", F.sha2(F.concat_ws("\n", lines), 256).alias("repaired_sha256"))
    repaired = whole.select("conv_id", F.posexplode("repaired").alias("pos", "row")).select(
        "conv_id", F.col("pos").cast("long").alias("pos"), "row.role", "row.text")
    if not long.isEmpty():
        more = rows.join(long, is_long, "left_semi").filter("copies > 0")
        found = stored(_long_report(more, kind, turn), "long-report")
        tail = _replayed(more, found, kind)
        digests = tail.mapInArrow(_digested, f"of {kind}, repaired_sha256 string")
        found = found.join(digests, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
        empty = F.lit(hashlib.sha256(b"").hexdigest())
        report = report.unionByName(found.withColumn("repaired_sha256", F.coalesce("repaired_sha256", empty)))
        repaired = repaired.unionByName(tail)
    return report, repaired


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repair conversations that are gathered whole."""
    for batch in batches:
        out = []
        for conv_id, held in zip(batch.column("conv_id").to_pylist(), batch.column("rows").to_pylist(), strict=True):
            rows = [(r["turn"], r["role"], r["text"]) for r in held for _ in range(r["copies"])]
            turns = {t for t, _, _ in rows if t is not None}
            gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
            counts, seen, kinds = dict.fromkeys(_COUNTS, 0), set(), []
            for _, role, text in rows:
                what, fault = kind_of(text, (role, text) in seen)
                seen.add((role, text))
                kinds.append((role[:1], what))
                if fault:
                    counts[fault] += 1
            counts["illegal"] = sum(a[0] + b[0] not in LEGAL for a, b in zip(kinds, kinds[1:], strict=False))
            cost, edits = cheapest(kinds)
            repaired = [{"role": r, "text": t} for r, t in edited([r[1:] for r in rows], edits)]
            out.append((conv_id, gaps, *counts.values(), cost, edits, repaired))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], batch.schema.field("conv_id").type)]
            + [pa.array([o[k] for o in out], pa.int64()) for k in range(1, 7)]
            + [pa.array([o[7] for o in out], pa.string()),
               pa.array([o[8] for o in out], pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))],
            names=["conv_id", "gaps", *_COUNTS, "cost", "audit", "repaired"],
        )


_PATHS = "array<struct<before: int, after: int, cost: long, edits: string>>"
_PART = "first string, last string, blank long, duplicate long, truncated long, illegal long, paths " + _PATHS


def _as_list(paths: dict) -> list[dict]:
    return [{"before": a, "after": b, "cost": c, "edits": e} for (a, b), (c, e) in paths.items()]


def _as_paths(rows: list[dict]) -> dict:
    return {(r["before"], r["after"]): (r["cost"], r["edits"]) for r in rows}


_PATHS_TYPE = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))


def _parts(conv_type: pa.DataType, out: list[tuple]) -> pa.RecordBatch:
    """Summaries (conv_id, shard, first, last, four counts, paths) as a batch."""
    columns = list(zip(*out, strict=True)) if out else [[]] * 9
    kinds = [conv_type, pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 4, _PATHS_TYPE]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
        names=["conv_id", "shard", "first", "last", *_COUNTS, "paths"],
    )


def _fold_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One summary per conversation of a sorted shard; holds one stretch of rows and the edits so far."""
    shard = TaskContext.get().partitionId()
    held: tuple | None = None
    kind = None

    def close():
        conv_id, first, last, counts, paths, rows = held
        return (conv_id, shard, first, last, *counts.values(), _as_list(folded(paths + _stretches(rows))))

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "seen", "copies")]
        for conv_id, role, text, seen, copies in zip(*columns, strict=True):
            if held is None or held[0] != conv_id:
                if held is not None:
                    done.append(close())
                held = (conv_id, role[:1], None, dict.fromkeys(_COUNTS, 0), [], [])
            _, first, last, counts, paths, rows = held
            for copy in range(copies):
                what, fault = kind_of(text, seen or copy > 0)
                if fault:
                    counts[fault] += 1
                counts["illegal"] += last is not None and last + role[:1] not in LEGAL
                last = role[:1]
                rows.append((last, what))
                if len(rows) == STRETCH:
                    paths.append(stretch_paths(tuple(rows)))
                    rows.clear()
                if len(paths) == 1024:
                    paths[:] = [folded(paths)]
            held = (conv_id, first, last, counts, paths, rows)
        if done:
            yield _parts(kind, done)
    if held is not None:
        yield _parts(kind, [close()])


def _fold_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring summaries of a conversation as one."""
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "shard", "parts")]
        for conv_id, shard, parts in zip(*columns, strict=True):
            counts = {c: sum(p[c] for p in parts) for c in _COUNTS}
            counts["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
            paths = _as_list(folded([_as_paths(p["paths"]) for p in parts]))
            out.append((conv_id, shard, parts[0]["first"], parts[-1]["last"], *counts.values(), paths))
        yield _parts(batch.schema.field("conv_id").type, out)


def _long_report(rows: DataFrame, kind: str, turn: str) -> DataFrame:
    """Report of conversations whose rows stay spread over shards."""
    known = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    content = F.sha2("text", 256)
    first = (
        rows.select("conv_id", "role", content.alias("content"), known.alias("at")).groupBy("conv_id", "role", "content")
        .agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), "content", "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (content == F.col("content"))
    marked = rows.join(first, same, "left").select(
        "conv_id", *ORDER, "copies", F.coalesce(known > F.col("first"), F.lit(False)).alias("seen"))
    # null ids and turns come first in both orders; a hot conversation is cut where the sampled bounds fall
    ranged = marked.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    parts = stored(ranged.mapInArrow(_fold_shard, f"conv_id {kind}, shard long, {_PART}"), "parts")
    while not parts.groupBy("conv_id").count().filter("count > 1").isEmpty():
        names = ["shard", "first", "last", *_COUNTS, "paths"]
        near = parts.groupBy("conv_id", F.expr(f"shard div {FAN}").alias("above")).agg(
            F.sort_array(F.collect_list(F.struct(*names))).alias("parts"))
        merged = near.withColumnRenamed("above", "shard").mapInArrow(_fold_parts, f"conv_id {kind}, shard long, {_PART}")
        parts = stored(merged, "parts")
    ends = F.filter("paths", lambda p: (p["before"] == START) & p["after"].isin(START, ASSISTANT))
    best = F.array_min(F.transform(ends, lambda p: F.struct(p["cost"].alias("cost"), p["edits"].alias("edits"))))
    gaps = rows.groupBy(F.col("conv_id").alias("c")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    return (
        parts.withColumn("best", best).join(gaps, F.col("conv_id").eqNullSafe(F.col("c")))
        .select("conv_id", "gaps", *_COUNTS, F.col("best.cost").alias("cost"), F.col("best.edits").alias("audit"))
    )


def _replayed(rows: DataFrame, report: DataFrame, kind: str) -> DataFrame:
    """Repaired rows of long conversations: the edits stand before the sorted rows they are replayed on."""
    lines = rows.select("conv_id", *ORDER, "copies", F.lit(1).alias("part"))
    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role")]
    edits = report.select("conv_id", *nothing, F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"), F.lit(0).alias("part"))
    ordered = edits.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", "part", *ORDER)
    return ordered.mapInArrow(_replay, f"conv_id {kind}, pos long, role string, text string")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream of sorted rows with their edits applied."""
    edits, at, state, pos = "", 0, START, 0
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "copies", "part")]
        for conv_id, role, text, copies, part in zip(*columns, strict=True):
            if part == 0:
                edits, at, state, pos = text, 0, START, 0
                copies = 0
            for _ in range(copies):
                letter = edits[at]
                at += 1
                if letter == "K":
                    state = KEPT[state, role[:1]]
                    out.append((conv_id, pos, role, text))
                elif letter == "R":
                    state = NEXT[state]
                    out.append((conv_id, pos, ROLES[state], text))
                pos += letter != "D"
                while at < len(edits) and edits[at] == "I":
                    state = NEXT[state]
                    out.append((conv_id, pos, ROLES[state], ""))
                    at, pos = at + 1, pos + 1
            while part == 0 and at < len(edits) and edits[at] == "I":  # before the first row
                state = NEXT[state]
                out.append((conv_id, pos, ROLES[state], ""))
                at, pos = at + 1, pos + 1
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "pos", "role", "text"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, read as a stream."""
    held, digest, kind = None, None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([held], kind), pa.array([digest.hexdigest()])], names=["of", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
        for conv_id, role, text in zip(*columns, strict=True):
            if digest is None or conv_id != held:
                if digest is not None:
                    yield row()
                held, digest = conv_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
    if digest is not None:
        yield row()
