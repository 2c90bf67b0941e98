"""Structure repair, prefix trie and text quality against brute force and held-out labels."""

import hashlib
import heapq
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import quality, structure, trie
from tidemark.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, n_convs string, audit string, path string"
ROLES = ["system", "user", "assistant", "user", "assistant", "tool", ""]
TEXTS = ["Yes.", "No", "  ", "", "Why?", "So!\n", "é", "A long one. " * 3]


def random_turns(seed, ids, longest):
    source = random.Random(seed)
    rows = [(c, source.choice([None, *range(longest)]), source.choice([*ROLES, None]), source.choice([*TEXTS, None]), "x", None, "y")
            for c in ids for _ in range(source.randrange(longest))]
    rows += [(None, 1, "user", "Hi.", None, None, None), (None, 2, "assistant", "Ho.", None, None, None), (-7, 3, "user", "Hi.", None, None, None)]
    return rows + rows[: len(rows) // 8]


# --- structure

def slow_repair(rows):
    """Dijkstra over (edits so far, row, state); rows are (role, text)."""
    kinds, seen = [], set()
    for role, text in rows:
        core = text.rstrip(" \t\n\v\f\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        kinds.append(fault)
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            initials = [r[:1] for r, _ in rows]
            return {
                "blank": kinds.count("blank"), "duplicate": kinds.count("duplicate"), "truncated": kinds.count("truncated"),
                "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": edits,
                "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
            }
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in ("user", "assistant"):
            if (state, role[0]) in after:
                heapq.heappush(heap, (cost + 2, edits + "I", i, role[0], (*out, (role, ""))))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, state, out))
            if kinds[i] not in ("blank", "duplicate"):
                more, (old, text) = int(kinds[i] == "truncated"), rows[i]
                if (state, old[:1]) in after:
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, old[:1], (*out, rows[i])))
                for role in ("user", "assistant"):
                    if (state, role[0]) in after:
                        heapq.heappush(heap, (cost + 2 + more, edits + "R", i + 1, role[0], (*out, (role, text))))


def slow_report(rows):
    found = {}
    for conv_id in {r[0] for r in rows}:
        own = [(r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in rows if r[0] == conv_id]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        found[conv_id] = {"gaps": gaps} | slow_repair([r[1:] for r in own])
    return found


@pytest.mark.parametrize("long_rows", [4096, 4])
def test_repair_by_brute_force(spark, long_rows):
    rows = random_turns(11, range(40), 14) + random_turns(12, [90], 70)
    report, repaired = structure.repair(spark.createDataFrame(rows, TURNS), long_rows=long_rows)
    got = {r.conv_id: {k: r[k] for k in report.columns if k != "conv_id"} for r in report.collect()}
    assert got == slow_report(rows)
    lines = defaultdict(list)
    for r in repaired.collect():
        lines[r.conv_id].append((r.pos, f"{r.role}:{r.text}"))
    for conv_id, row in got.items():
        text = "\n".join(t for _, t in sorted(lines[conv_id]))
        assert [p for p, _ in sorted(lines[conv_id])] == list(range(len(lines[conv_id])))
        assert hashlib.sha256(text.encode()).hexdigest() == row["repaired_sha256"]


def test_stretches_join_to_the_search_over_all_rows():
    source = random.Random(4)
    for _ in range(200):
        rows = [(source.choice("suuuaaa?"), source.choice([0, 0, 0, 1, 2])) for _ in range(source.randrange(22))]
        assert structure.cheapest(rows) == structure.search(tuple(rows))


def test_repair_names_conversations_without_rows(spark):
    frame = spark.createDataFrame([(1, None, None, None, 0), (2, 5, "user", "Hi.", 1), (2, 9, "assistant", "Ho", 2)],
                                  "conv_id long, turn long, role string, text string, copies int")
    rows = {r.conv_id: r for r in structure.repair(frame)[0].collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (rows[1].gaps, rows[1].cost, rows[1].audit, rows[1].repaired_sha256) == (0, 0, "", empty)
    assert (rows[2].gaps, rows[2].duplicate, rows[2].cost, rows[2].audit) == (3, 1, 4, "KKD")
    assert structure.repair(frame.limit(0))[0].count() == 0
    damaged = structure.damaged(spark.createDataFrame(random_turns(1, range(9), 9), TURNS))
    assert structure.repair(damaged)[0].select("conv_id").distinct().count() == damaged.select("conv_id").distinct().count()


# --- trie

def slow_trie(paths):
    """Rows of the trie of {conv_id: [(role, text)]}."""
    nodes = defaultdict(list)
    for conv_id, path in paths.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(conv_id)
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * (len(p[-1][1]) if p else 0)
    rows = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(paths[c]) == len(p)))
        rows.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p], leaves[p], saved[p],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def sorted_turns(rows):
    paths = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        paths[r[0]].append((r[2] or "", r[3] or ""))
    return paths


@pytest.mark.parametrize("section", [1, 3, 64])
def test_trie_by_brute_force(spark, section):
    source = random.Random(6)
    deep = [(c, t, "user", source.choice("aab")) for c in range(60) for t in range(source.randrange(9))]
    deep += [(c, t, "user", "same") for c in range(100, 130) for t in range(7)]
    deep += [(c, t, "user", "same") for c in (131, 132) for t in range(8 + 4 * (c == 131))]
    rows = random_turns(5, range(200, 220), 6) + [(*r, None, None, None) for r in deep]
    turns = trie.numbered(spark.createDataFrame(rows, TURNS))
    members = turns.select("conv_id").distinct().unionByName(spark.createDataFrame([(999,), (998,)], "conv_id long"))
    got = trie.trie(turns, members, section).collect()
    assert sorted((tuple(r) for r in got), key=str) == slow_trie(sorted_turns(rows) | {999: [], 998: []})


def test_rebuilt_conversations(spark):
    rows = random_turns(8, [*range(0, 30), *range(95, 105), 200, 201, 333], 9)
    own = sorted_turns(rows)
    paths = {}
    import zlib

    for c, path in own.items():
        base, h = c - int(math.fmod(c, 100)), zlib.crc32(str(c).encode()) % 6
        paths[c] = own.get(base, [])[:h] + path[h:]
    turns = trie.numbered(spark.createDataFrame(rows, TURNS))
    got = trie.trie(trie.rebuilt(turns), turns.select("conv_id").distinct()).collect()
    assert sorted((tuple(r) for r in got), key=str) == slow_trie(paths)
    none = trie.numbered(spark.createDataFrame([], TURNS))
    assert trie.trie(trie.rebuilt(none), none.select("conv_id").distinct()).count() == 0


# --- quality

def test_quality_finds_held_out_rows(spark):
    found = QUERIES["op13_quality"](spark, "/root/testdata/sf0.1").filter("held_out")
    rows = found.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    poor = [r for r in rows if not r.quality]
    assert sum(not r.predicted for r in poor) >= 0.9 * len(poor)


def test_quality_on_odd_rows(spark):
    kinds = "doc_id long, text string, quality string, score string"
    odd = spark.createDataFrame([(1, "Good words. " * 9, "x", "y"), (1, "b", None, None), (2, None, None, None), (3, "", "", ""),
                                 (None, "a a a", "", ""), (4, " \n\t", "", ""), (5, "alpha beta " * 30000, "", ""), (5, "alpha beta " * 30000, "", "")], kinds)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (None, 1), (5, None), (9, 0)], "doc_id long, quality int")
    for known in (labels, labels.filter("quality = 1"), labels.limit(0)):
        rows = quality.score(odd, quality.fit(odd, known)).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows}) == 1
    assert quality.score(odd.limit(0), quality.fit(odd.limit(0), labels)).count() == 0


def test_quality_measures_by_definition():
    texts = ["One two two. Three!\nOne two two. Three!\n\nshort", "Élan élan élan 12 -- #x#", "word"]
    got = quality.measures(pa.array([None, *texts, ""]))
    assert np.isnan(got[0, 1:]).sum() == np.isnan(got[-1, 1:]).sum() > 15
    name = quality.FEATURES.index
    for row, text in zip(got[1:], texts):
        words, lines = text.split(), [t.strip() for t in text.split("\n") if t.strip()]
        pairs = list(zip(words, words[1:]))
        raw = text.encode()
        assert row[name("words")] == pytest.approx(math.log1p(len(words)))
        assert row[name("word_length")] == pytest.approx(np.mean([len(w) for w in words]))
        assert row[name("distinct")] == pytest.approx(len(set(words)) / len(words) ** 0.8)
        assert row[name("commonest")] == pytest.approx(max(Counter(words).values()) / len(words))
        assert row[name("stutter")] == pytest.approx(sum(a == b for a, b in pairs) / len(words))
        assert row[name("pairs_again")] == pytest.approx((len(pairs) - len(set(pairs))) / len(words))
        assert row[name("lines")] == pytest.approx(len(lines) / len(words))
        assert row[name("lines_again")] == pytest.approx(
            (sum(map(len, lines)) - sum(map(len, set(lines)))) / sum(map(len, words)))
        assert row[name("ended_lines")] == pytest.approx(sum(bool(re.search(r"[.!?]$", t)) for t in lines) / len(lines))
        assert row[name("digits")] == pytest.approx(sum(48 <= b < 58 for b in raw) / len(raw))
        assert row[name("symbols")] == pytest.approx(sum(chr(b) in "#$%&*+/<=>@[\\]^_`{|}~" for b in raw) / len(raw))
        assert row[name("wordless")] == pytest.approx(sum(not re.search(r"[^\W\d_]", w) for w in words) / len(words))


def test_tables_learn_an_interaction():
    source = np.random.default_rng(2)
    x = source.random((4000, len(quality.FEATURES)))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    model = quality.train(x[:3000], y[:3000], np.ones(3000), 0.5)
    right = (model.margins(model.binned(x[3000:])) > 0) == (y[3000:] == 1)
    assert right.mean() > 0.95 and (7, 3) in model.pairs
