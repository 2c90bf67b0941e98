"""Corpus operators against brute force, exact round trips and held-out accuracy on small inputs."""

import base64
import bz2
import gzip
import hashlib
import lzma
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import compare, duck
from tests.conftest import SF_DIR
from tidemark.llm import (
    components, decontaminate, logbilinear, mixing, neighbours, repeats, secrets, simhash, tokens, toxicity, warc,
)
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.words import split

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, row_hash string"
LONG = "alpha beta " * 3000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeats, and columns with clashing names."""
    rows = [
        (1, "The quick brown fox jumps over it", "en", "a", 5, "x", "y"),
        (1, "The quick brown fox jumps over it", "en", "a", 5, "x", "y"),
        (2, "the QUICK brown fox jumps over it", "en", None, None, None, None),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, "x", None),
        (None, "token = abcdef123456", "en", "b", 0, "x", None),
        (None, None, None, None, None, None, None),
        (5, LONG, "de", "a", len(LONG), "x", "y"),
        (6, " \t\n", "de", "c", 3, "x", "y"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def clashing(spark):
    """Rows that differ in where a null stands, with columns named like the operators' own."""
    long = "x" * 450
    names = ["row_hash", "_row_hash", "bad_id", "kept_id", "kept_hash", "unit_id", "total", "copy", "_doc_id", "_copy"]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    rows = [(1, long, None, "s", 1), (1, None, long, "s", 1), (2, "fox", None, "s", None), (2, None, "fox", "s", None)]
    return spark.createDataFrame([(*r, *names) for r in rows], kinds)


def test_rows_that_differ_by_a_null_and_clashing_names(spark, clashing):
    removed = {(r.n_bytes, r.n_removed) for r in repeats.report(clashing).collect()}
    assert removed == {(450, 450), (0, 0), (3, 0)}
    items = spark.createDataFrame([(1, "fox")], "item_id long, text string")
    kept = decontaminate.clean(clashing, items)
    assert kept.columns == clashing.columns
    assert sorted((r.doc_id, r.text is None) for r in kept.collect()) == [(1, False), (1, True), (2, True)]
    once = simhash.one_per_group(clashing)
    assert once.columns == clashing.columns and once.count() == 3  # either null text is fingerprint zero
    mix = mixing.mixed(clashing.filter("text IS NOT NULL"), share=2.0)
    assert mix.columns == clashing.columns
    assert Counter(r.doc_id for r in mix.collect()) == {1: 2, 2: 2}


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def read(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    ok, message, _ = compare(spark, duck(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR)
    assert ok, message


# --- toxicity

def test_toxicity_finds_held_out_rows(spark):
    found = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1").filter("held_out")
    rows = found.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").select("predicted", "toxic").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits >= 0.6 * sum(r.toxic for r in rows)
    assert sum(r.predicted and not r.toxic for r in rows) <= 0.02 * len(rows)


def slow_ratio(taught, before, word):
    """log P_toxic - log P_ordinary of a word, from sets of (word before, word) by document."""
    seen = [Counter(pair for pairs, toxic in taught if toxic == c for pair in pairs) for c in (1, 0)]

    def shares(name):
        """Of every word (or stem): continuation count by class; with their sums."""
        by_class = [Counter(name(w) for _, w in counts) for counts in seen]
        capped = {k: min(by_class[0][k] + by_class[1][k], 3) for k in by_class[0] | by_class[1]}
        return by_class, capped, sum(capped.values())

    stems, words, logs = shares(lambda w: w[:5]), shares(lambda w: w), []
    of_pair = {p: min(seen[0][p] + seen[1][p], 3) for p in seen[0] | seen[1]}
    after = {p: n for p, n in of_pair.items() if p[0] == before}
    for c in (0, 1):
        total, lean = max(len(seen[c]), 1), 1.0
        for (by_class, capped, all_capped), key in ((stems, word[:5]), (words, word)):
            share = capped.get(key, 0.5) / all_capped
            p = max(by_class[c][key] - 0.75, 0) / total + 0.75 * (len(by_class[c]) + 1) / total * share * lean
            lean = p / share
        share = after.get((before, word), 0.5) / max(sum(after.values()), 1)
        own = {p: n for p, n in seen[c].items() if p[0] == before}
        n = sum(own.values())
        p = max(own.get((before, word), 0) - 0.75, 0) / n + 0.75 * len(own) / n * share * lean if n else share * lean
        logs.append(np.log(p))
    return logs[0] - logs[1]


def test_toxicity_ratios_by_a_slow_model(spark):
    source = random.Random(4)
    bits = ["vile", "vilest,", "You", "are", "kind", "kindly", "(a)", "the", "end.", "Rare1", "rare2"]
    rows = [(i, " ".join(source.choices(bits[i % 2 : len(bits) - i % 3], k=9)) + f" only{i}", i % 2) for i in range(60)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(documents, documents)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4))
    split = lambda text: [w.strip(toxicity.EDGES).lower() for w in text.split()]
    taught = []
    for r in documents.filter(fold != 0).collect():
        words = split(r.text)
        taught.append((set(zip([None, *words], words, strict=False)), r.toxic))
    for text in (rows[0][1], rows[1][1], "the vilely kind never seen vile", "only3 Rare1 rare2 only3"):
        words = split(text)
        _, before, word, stem = toxicity._expressions(pa.array([text]))
        expected = [slow_ratio(taught, a, w) for a, w in zip([None, *words], words, strict=False)]
        assert np.allclose(model.ratios(before, word, stem), expected, atol=1e-4)


def test_toxicity_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0
    assert toxicity.ordinary(odd, model).columns == odd.columns


# --- near duplicates

def slow_fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))] if words else []
    hashed = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def test_fingerprints_by_definition():
    for text in (None, "", " a ", "a b", "A b C d", "É a\x1cb c d e f " * 9, LONG[:500]):
        assert simhash.fingerprint(text) & (1 << 64) - 1 == slow_fingerprint(text)


def test_links_lose_no_pair(spark):
    source = random.Random(3)
    prints = {source.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:150]:
        for flips in (1, 3, 4, 5):
            prints.add(p ^ sum(1 << b for b in source.sample(range(64), flips)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    assert got == want


def test_links_broadcast_no_keys(spark, tmp_path):
    """A table of fingerprints below the planner's threshold becomes seventy times its rows when exploded."""
    path = str(tmp_path / "prints")
    spark.range(2000).select(F.xxhash64("id").alias("fp")).write.parquet(path)
    found = simhash.links(spark.read.parquet(path))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_near_dedup_stage_broadcasts_no_keys(spark, monkeypatch):
    plans, stored = [], components.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(components, "stored", seen)
    corpus_pipeline.drop_near_copies(spark, read(spark, "documents"), SF_DIR)
    assert re.search(r"SortMergeJoin \[key#\d+L?\]", plans[0]) and "Broadcast" not in plans[0]


def test_components_of_chains_and_repeats(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 100)]
    rows = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = Counter(r.root for r in rows)
    assert sorted(groups.values()) == [3, 41]


def test_near_duplicates_on_odd_rows(spark, odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id in (3, 4, 6)} == {3}
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    kept = simhash.one_per_group(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 3, 5]
    assert simhash.near_duplicates(empty).count() == 0


# --- token counts

def test_token_counts_agree_with_a_unigram_tokenizer():
    from tokenizers import Tokenizer, models

    import public_tokenizers

    vocabulary = tokens.load(str(public_tokenizers.path("piece_bpe_32k.model")))
    least = min(vocabulary.scores.values())
    other = Tokenizer(models.Unigram([("<unk>", least), *vocabulary.scores.items()], unk_id=0, byte_fallback=False))
    count = tokens.Counter(tokens.Vocabulary(vocabulary.scores, False))
    source = random.Random(1)
    texts = ["  two  spaces ", "é  ü x\n\n y", "日本語 テスト 😀😀 a", "a" * 200]
    texts += ["".join(source.choice("abcde fé😀n") for _ in range(60)) for _ in range(200)]
    for text in texts:
        assert count.text(text) == len(other.encode(tokens.MARK + text.replace(" ", tokens.MARK)).ids)


def test_token_counts_by_row(spark, odd, empty):
    vocabulary = tokens.Vocabulary({"▁": -1.0, "▁a": -2.0, "a": -3.0, "al": -2.5, "▁▁": -1.5}, True)
    count = tokens.Counter(vocabulary)
    got = tokens.count_tokens(odd, vocabulary).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted((r.doc_id or 0, count.text(r.text)) for r in odd.collect())
    assert tokens.count_tokens(empty, vocabulary).count() == 0


# --- nearest neighbours

def test_neighbours_reach_recall_and_exact_scores(spark):
    vectors = read(spark, "embeddings")
    rows = vectors.select("vec_id", "embedding").collect()
    ids, m = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = QUERIES["op4_nearest"](spark, SF_DIR).toPandas()
    hits = 0
    for q, part in found.groupby("query_id"):
        scores = m @ m[ids == q][0]
        scores[ids == q] = -9
        best = ids[np.lexsort((ids, -scores))[:20]]
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21))
        assert np.allclose(part["score"], [scores[ids == v][0] for v in part["vec_id"]])
        hits += len(set(best) & set(part["vec_id"]))
    assert hits >= 0.9 * len(found)


@pytest.mark.parametrize("longest", [1e5])
def test_neighbours_with_trees_and_a_long_vector(spark, longest):
    """Above one block: hyperplanes, NN-descent and search; one vector may be far longer than all others."""
    source = np.random.default_rng(3)
    centres = source.normal(size=(40, 24))
    m = centres[source.integers(0, 40, 1500)] + 0.6 * source.normal(size=(1500, 24))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m *= source.uniform(0.5, 1.0, (1500, 1))
    m[77] *= longest
    vectors = spark.createDataFrame([(i, r.tolist(), "x", 1) for i, r in enumerate(m)], "vec_id long, embedding array<double>, q string, node int")
    found = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).toPandas()
    hits = 0
    for q, part in found.groupby("query_id"):
        scores = m @ m[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(len(m)), -scores))[:20]
        assert np.allclose(part["score"], scores[part["vec_id"]], rtol=1e-9)
        hits += len(set(best) & set(part["vec_id"]))
    assert len(found) == 75 * 20 and hits >= 0.95 * len(found)


def test_neighbours_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(i, [1.0, 0.0]) for i in range(30)] + [(40, [0.5, 0.5]), (41, None), (42, [0.0, 0.0]), (43, [nan, 1.0]),
            (44, [inf, 1.0]), (45, [1.0]), (46, [None, 1.0]), (None, [1.0, 1.0]), (60, [0.0, 2.0])]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).collect()
    zero = [r.vec_id for r in sorted((r for r in got if r.query_id == 0), key=lambda r: r["rank"])]
    assert zero == list(range(1, 21))
    assert {r.query_id for r in got} == {0, 20, 40, 60}
    assert neighbours.nearest(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_meet_without_a_call_per_node(spark, monkeypatch):
    """Offers equal those of a slow loop, also when they are sent early."""
    monkeypatch.setattr(neighbours, "TOGETHER", 3)
    monkeypatch.setattr(neighbours, "OFFERS", 200)
    source = np.random.default_rng(5)
    base = 1 << 60  # ids that a float does not tell apart
    x = source.normal(size=(60, 5)).astype(np.float32)
    floor = source.uniform(-1, 3, 60)
    rows = [(base + u, base + v, bool(source.integers(2)), float(floor[v]), x[v].tobytes())
            for u in range(60) for v in source.choice(60, source.integers(1, 20), replace=False).tolist()]
    filled = spark.createDataFrame(rows, "u long, v long, fresh boolean, floor double, x binary")
    offers = neighbours._offers(filled)
    assert "GroupsIn" not in offers._jdf.queryExecution().toString()
    best: dict[int, dict[int, float]] = {}
    for u in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == u]
        for a in group:
            for b in group:
                s = float(x[a[1] - base] @ x[b[1] - base])
                if a[1] != b[1] and (a[2] or b[2]) and s > a[3]:
                    best.setdefault(a[1], {})[b[1]] = s
    got: dict[int, dict[int, float]] = {}
    for r in offers.collect():
        got.setdefault(r.u, {})[r.v] = r.s
    assert got.keys() == best.keys()
    for u, near in best.items():
        top = sorted(near, key=near.get, reverse=True)[: neighbours.DEGREE]
        assert set(top) <= set(got[u]) <= set(near)
        assert [got[u][v] for v in top] == pytest.approx([near[v] for v in top], rel=1e-5)


def test_neighbours_broadcast_no_edges_and_no_pairs(spark, monkeypatch):
    """Files of ids, and pairs with their vectors, look far smaller to the planner than they are."""
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    plans, stored = [], neighbours.stored

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def seen(df, name):
        plans.extend([plan(df)] if re.fullmatch(r"graph-[1-9]\d*", name) else [])
        return stored(df, name)

    monkeypatch.setattr(neighbours, "stored", seen)
    source = np.random.default_rng(4)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(source.normal(size=(200, 4)))], "vec_id long, embedding array<float>")
    points = stored(neighbours.nodes(vectors, "vec_id", "embedding", 5), "points")
    packed = neighbours._packed(points, "f4")
    edges, seeds, _ = neighbours.graph(packed, "f4")
    asked = points.filter("node % 20 = 0").select(F.col("node").alias("q"), "v")
    found = neighbours.search(points, packed, "f4", edges, asked, seeds)
    assert plans and all(re.search(r"SortMergeJoin \[u#\d+L, v#\d+L\]", p) for p in plans)
    assert plan(found).count("SortMergeJoin") == 2 and "Broadcast" not in plan(found)
    assert found.select("q").distinct().count() == 10


@pytest.mark.parametrize("meeting", [1, 7, 1000])
def test_neighbours_groups_go_over_the_ends_of_batches(monkeypatch, meeting):
    monkeypatch.setattr(neighbours, "MEETING", meeting)
    base = 1 << 60
    u = np.sort(np.random.default_rng(6).integers(0, 12, 90)) + base
    table = pa.RecordBatch.from_arrays([pa.array(u), pa.array(np.arange(90))], names=["u", "i"])
    batches = [table.slice(a, 4) for a in range(0, 90, 4)]
    groups = [t.slice(a, b - a) for t, first in neighbours._whole_groups(iter(batches), "u") for a, b in zip(first, first[1:])]
    assert [g.column("u")[0].as_py() for g in groups] == np.unique(u).tolist()
    assert [i for g in groups for i in g.column("i").to_pylist()] == list(range(90))
    assert list(neighbours._whole_groups(iter([]), "u")) == list(neighbours._whole_groups(iter([table.slice(0, 0)]), "u")) == []


def test_neighbours_of_a_table_of_doubles_with_long_ids(spark):
    """Ids above 2^53 and components that are no floats, with trees."""
    source = np.random.default_rng(9)
    m = source.normal(size=(700, 6)) + 1e-9
    ids = [(1 << 60) + i for i in range(700)]
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in zip(ids, m, strict=True)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).toPandas()
    hits = 0
    for q, part in found.groupby("query_id"):
        scores = m @ m[q - ids[0]]
        scores[q - ids[0]] = -np.inf
        assert np.allclose(part["score"], scores[part["vec_id"] - ids[0]], rtol=1e-12)
        hits += len(set(np.argsort(-scores)[:20] + ids[0]) & set(part["vec_id"]))
    assert len(found) == 20 * sum(i % 20 == 0 for i in ids) and hits >= 0.9 * len(found)


# --- archives

def test_archives_round_trip(spark, tmp_path):
    warc.register(spark)
    data = [(1, "u1", "same"), (2, "u2", "same"), (3, None, None), (4, "u\r\nx", ""), (None, "u", "é" * 9000), (5, "big", "x" * 300000)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    path = str(tmp_path / "archive")
    warc.as_records(pages).write.format("warc").mode("append").save(path)
    rows = {r.record_id: r for r in spark.read.format("warc").load(path).collect()}
    assert len(rows) == 6
    assert rows["<urn:page:1>"].warc_type == "revisit" and rows["<urn:page:1>"].refers_to == "<urn:page:2>"
    assert rows["<urn:page:1>"].payload is None and rows["<urn:page:1>"].payload_bytes == 4
    assert bytes(rows["<urn:page:5>"].payload) == b"x" * 300000
    assert bytes(rows["<urn:page:>"].payload).decode() == "é" * 9000
    assert rows["<urn:page:3>"].refers_to == "<urn:page:4>" and rows["<urn:page:4>"].target_uri == "u%0D%0Ax"
    assert all(r.payload_digest == warc.digest(bytes(r.payload)) for r in rows.values() if r.payload is not None)
    only = spark.read.format("warc").load(path).filter("warc_type = 'revisit' AND target_uri = 'u1'")
    assert [r.record_id for r in only.collect()] == ["<urn:page:1>"]
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_skip_what_headers_rule_out(tmp_path):
    members = [warc.record({"record_id": f"<urn:page:{i}>", "warc_type": t, "payload": b"p" * 5000}) for i, t in
               enumerate(["response", "revisit", "response"])]
    plain, own, foreign = tmp_path / "a.warc", tmp_path / "b.warc.gz", tmp_path / "c.warc.gz"
    plain.write_bytes(b"".join(members))
    own.write_bytes(b"".join(warc.member(m) for m in members))
    foreign.write_bytes(b"".join(gzip.compress(m) for m in members))
    for path in (plain, own, foreign):
        with open(path, "rb") as f:
            rows = list(warc.records(f, path.stat().st_size, path.suffix == ".gz", lambda r: r["warc_type"] == "response", True))
        assert [r["record_id"] for r in rows] == ["<urn:page:0>", "<urn:page:2>"]
        assert all(r["payload"] == b"p" * 5000 for r in rows)
    reader = warc.WarcReader({"path": str(tmp_path)}, spark_schema())
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("warc_type",), "response"), GreaterThan(("payload_bytes",), 3)]))
    assert [type(f) for f in left] == [GreaterThan] and len(reader.partitions()) == 3


def spark_schema():
    from pyspark.sql.types import StringType, StructField, StructType

    return StructType([StructField("record_id", StringType()), StructField("warc_type", StringType())])


# --- decontamination

def test_contamination_on_odd_rows(spark, odd, empty):
    items = spark.createDataFrame(
        [(10, "quick BROWN fox"), (9, "alpha " + "beta alpha " * 6), (7, None), (8, "!!"), (None, "quick brown fox"), (11, "fox")],
        "item_id long, text string",
    )
    rows = {r.doc_id: r for r in decontaminate.contamination(odd, items).collect()}
    assert (rows[2].n_words, rows[2].n_hit, rows[2]["items"]) == (7, 3, ["10", "11"])
    assert rows[5].n_hit == rows[5].n_words == 6000 and rows[5]["items"] == ["9"]
    assert rows[3].n_words == rows[4].n_hit == 0
    assert decontaminate.clean(odd, items).columns == odd.columns
    assert sorted(str(r.doc_id) for r in decontaminate.clean(odd, items).collect()) == ["3", "4", "6", "None", "None"]
    assert decontaminate.report(empty, items).count() == 0
    assert decontaminate.report(odd, items.limit(0)).filter("contaminated").count() == 0


# --- repeated strings

def slow_removal(texts, length):
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        yield bytes(gone)


@pytest.mark.parametrize("crowd", [1, 3, 4096])
def test_repeats_by_brute_force(spark, crowd):
    source = random.Random(5)
    word = lambda n: "".join(source.choice("abé ") for _ in range(n))
    shared = [word(n) for n in (60, 90, 200)]
    texts = [word(source.randrange(80)) + source.choice(shared) + word(source.randrange(60)) for _ in range(40)]
    texts += ["x" * 150, "x" * 80, None, "", shared[0], texts[0], texts[0], "ab" * 70]
    frame = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, start string")
    got = [bytearray(len((t or "").encode())) for t in texts]
    for r in repeats.repeats(frame, length=50, gram=25, stretch=8, crowd=crowd).collect():
        got[r.doc_id][r.start : r.end] = b"\1" * (r.end - r.start)
    assert [bytes(g) for g in got] == list(slow_removal([(t or "").encode() for t in texts], 50))


def test_repeats_report_on_odd_rows(spark, odd, empty):
    rows = repeats.report(odd).collect()
    five = next(r for r in rows if r.doc_id == 5)
    assert (five.n_bytes, five.n_removed, five.n_spans) == (len(LONG), len(LONG), 1)
    assert five.kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert len(rows) == odd.count() and repeats.report(empty).count() == 0


# --- language model

def slow_base(rows):
    """held_out, n_tokens, n_known, train_tokens, base_score of each row, token by token."""
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 == 2 for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(lower)), ""] for r in rows]
    count = Counter(w for words, out in zip(tokens, held, strict=True) if not out for w in words)
    total, whole = sum(count.values()), sum(count.values()) + len(count) + 1
    return [
        (out, len(words), sum(count[w] > 0 for w in words), total,
         sum(math.log10((count[w] + 1) / whole) for w in words))
        for words, out in zip(tokens, held, strict=True)
    ]


def test_log_bilinear_counts_and_held_out_likelihood(spark, odd, empty):
    documents = read(spark, "documents")
    found = logbilinear.score(documents).toPandas()
    rows = documents.collect()
    expected = dict(zip([r.doc_id for r in rows], slow_base(rows), strict=True))
    for r in found.itertuples():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:4]
        assert r.base_score == pytest.approx(expected[r.doc_id][4], rel=1e-9)
    held = found[found["held_out"]]
    assert held["score"].sum() > 0.98 * held["base_score"].sum()
    assert (found["score"] < 0).all() and logbilinear.score(empty).count() == 0
    strange = [tuple(r)[1:] for r in logbilinear.score(odd).collect()]
    expected = slow_base(odd.collect())
    assert sorted(r[:4] for r in strange) == sorted(r[:4] for r in expected)
    assert sorted(r[4] for r in strange) == pytest.approx(sorted(r[4] for r in expected))


def test_log_bilinear_probabilities_add_up_and_follow_context(spark):
    texts = ["red car blue sky", "red car", "blue sky red car"] * 40 + [f"odd{i}" for i in range(30)]
    documents = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    known = logbilinear.vocabulary(logbilinear.count_words(documents))
    assert known.total == sum(len(t.split()) + 1 for t in texts) and known.size == math.isqrt(known.total)
    learner = logbilinear.Learner(logbilinear.starting(known), 0.25)
    t = logbilinear._tokens(split(pa.array(texts)), known)
    group = logbilinear.grouped(t.token, t.two, t.one, known, mixed=True)
    assert group.n.sum() == known.total
    for _ in range(200):
        for two, one, row, token, inner in group.batches():
            learner.step(two, one, row, token, group.n[inner])
    model = learner.model
    names = known.words.to_pylist()
    red, car, sky = (names.index(w) for w in ("red", "car", "sky"))
    start = known.size + logbilinear.ENDINGS
    token = np.arange(start)  # every word with vectors, then every ending class
    def after(place):
        return 10 ** model.log_probabilities(token, np.full(start, start), np.full(start, place))
    assert after(red).sum() == pytest.approx(1, abs=1e-3) and after(start).sum() == pytest.approx(1, abs=1e-3)
    assert after(red)[car] > 0.5 > 0.1 > after(red)[sky]


def test_log_bilinear_moves_are_weighted_by_use(spark):
    """Two tasks with the same texts move the vectors as one of them does; order of tasks does not matter."""
    rows = [(i, "some words that come again and again") for i in range(50)]
    once = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    twice = once.union(once).repartition(2)
    known = logbilinear.vocabulary(logbilinear.count_words(once))
    model = logbilinear.starting(known)
    one, two = (logbilinear.train_round(d, model, 0.25).values for d in (once, twice))
    assert np.allclose(one, two, atol=1e-5) and not np.allclose(one, model.values, atol=1e-2)


def test_log_bilinear_groups_hold_little(spark):
    """What a piece is learned from is right, and made with little memory a token (over 100 bytes before)."""
    source = np.random.default_rng(4)
    texts = [" ".join(f"w{i}" for i in source.zipf(1.3, 100) % 5000) for _ in range(2000)]
    known = logbilinear.vocabulary(logbilinear.count_words(spark.createDataFrame([(t,) for t in texts], "text string")))
    words = split(pa.array(texts))
    tracemalloc.start()
    token, two, one, _ = logbilinear._numbered(words, known)
    group = logbilinear.grouped(token, two, one, known, mixed=True)
    held = tracemalloc.get_traced_memory()[1] / len(token)
    tracemalloc.stop()
    assert held < 75
    context = np.repeat(np.arange(len(group.two)), np.diff(group.edges))
    got = dict(zip(zip(group.two[context], group.one[context], group.token, strict=True), group.n, strict=True))
    assert got == Counter(zip(two.tolist(), one.tolist(), token.tolist(), strict=True))


def test_log_bilinear_bands_of_a_batch_are_learned_and_scored_together(spark, monkeypatch):
    """Steps and scores are those of each band on its own, with as many calls for any number of bands."""
    source = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in source.zipf(1.3, 60) % 900) for _ in range(300)]
    known = logbilinear.vocabulary(logbilinear.count_words(spark.createDataFrame([(t,) for t in texts], "text string")))
    assert known.bands > 9 and known.size % known.band  # the last band lacks words
    token, two, one, _ = logbilinear._numbered(split(pa.array(texts)), known)
    group = logbilinear.grouped(token, two, one, known, mixed=True)
    learner, plain = (logbilinear.Learner(logbilinear.starting(known), 0.25) for _ in range(2))
    calls, slopes = [], logbilinear._slopes
    monkeypatch.setattr(logbilinear, "_slopes", lambda *a: calls.append(1) or slopes(*a))
    batch = next(group.batches())
    two_, one_, row, follows, inner = batch
    n = group.n[inner]
    learner.step(two_, one_, row, follows, n)
    assert len(calls) == 2  # one more for each band before

    # the same step in plain sums: outputs are the bands and classes, then the words of each band
    q, (classes, words) = plain.model.contexts(two_, one_).astype(float), plain.model.targets()
    outer, kind = known.noise()[0], known.outer(follows)
    inside = known.noise()[1]
    gradient, back = np.zeros_like(plain.seen, dtype=float), np.zeros_like(q)
    _, first_class, first_word = plain.model.edges
    for context in range(len(q)):
        mine = row == context
        outputs = [(first_class, classes, outer, kind[mine], n[mine])]
        for band in set(kind[mine & (kind < known.bands)].tolist()):
            of = slice(band * known.band, min((band + 1) * known.band, known.size))
            here = mine & (kind == band)
            outputs.append((first_word + of.start, words[of], inside[of], follows[here] - of.start, n[here]))
        for start, targets, noise, wanted, times in outputs:
            data = 1 / (1 + logbilinear.NOISE * noise * np.exp(-(targets @ q[context])))
            slope = -logbilinear.NOISE * noise * data * times.sum()
            np.add.at(slope, wanted, times * (1 - data[wanted]))
            gradient[start : start + len(targets)] += slope[:, None] * q[context]
            back[context] += slope @ targets
    back[:, -1] = 0
    np.add.at(gradient, two_, back)
    np.add.at(gradient, one_ + plain.model.edges[0], back)
    expected = plain.model.values + 0.25 * gradient / np.sqrt(1 + gradient**2)
    assert np.allclose(learner.model.values, expected, atol=1e-4)

    model = learner.model
    classes, words = (x.astype(float) for x in model.targets())
    for at in range(0, len(token), 997):
        q = model.contexts(two[at : at + 1], one[at : at + 1])[0].astype(float)
        band = int(known.outer(token[at : at + 1])[0])
        log = classes[band] @ q - np.log(np.exp(classes @ q).sum())
        if band < known.bands:
            of = words[band * known.band : (band + 1) * known.band]
            log += words[token[at]] @ q - np.log(np.exp(of @ q).sum())
        assert model.log_probabilities(token[at : at + 1], two[at : at + 1], one[at : at + 1])[0] == pytest.approx(log / np.log(10), rel=1e-4)


def test_log_bilinear_vectors_grow_with_the_corpus(spark):
    documents = read(spark, "documents")
    whole = logbilinear.vocabulary(logbilinear.count_words(documents))
    part = logbilinear.vocabulary(logbilinear.count_words(documents.filter("doc_id % 8 = 0")))
    assert part.size == math.isqrt(part.total) < whole.size == math.isqrt(whole.total)


# --- mixing

def words_in(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def slow_targets(rows, weights=(5, 2, 1), share=1.5, most=2):
    """Size and target of each source: shares by weight, the excess over a limit given to the others, until none is left."""
    size = Counter()
    for r in rows:
        size[r.source] += words_in(r.text)
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        budget = share * sum(size.values()) - sum(most * size[s] for s in full)
        rest = [s for s in order if s not in full]
        level = {s: budget * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = {s for s in rest if level[s] > most * size[s]}
        if not above:
            return {s: (size[s], most * size[s] if s in full else level[s]) for s in order}
        full |= above


def test_mix_meets_targets_and_repeats(spark):
    documents = read(spark, "documents")
    first = {r.doc_id: r for r in mixing.mix(documents).collect()}
    again = {r.doc_id: r for r in mixing.mix(documents.repartition(7)).collect()}
    assert first == again
    assert all(r.taken <= 2 * r.size for r in first.values())
    expected = slow_targets(documents.collect())
    for r in documents.collect():
        row = first[r.doc_id]
        assert (row.size, row.source_size) == (words_in(r.text), expected[r.source][0])
        assert row.target == pytest.approx(expected[r.source][1], rel=1e-9)
    longest, taken = Counter(), Counter()
    for r in documents.collect():
        taken[r.source] += first[r.doc_id].taken
        longest[r.source] = max(longest[r.source], first[r.doc_id].size)
    assert all(abs(taken[s] - target) <= longest[s] for s, (_, target) in expected.items())


def test_mix_settles_large_documents_by_small_ones(spark):
    rows = [(i, "w " * (1 + i % 400), "a" if i < 800 else "b") for i in range(1600)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by_target = Counter()
    for r in found:
        by_target[r.target] += r.taken
    # far below the largest document (400 words)
    assert len(by_target) == 2 and all(abs(taken - target) <= 40 for target, taken in by_target.items())


def test_mix_on_odd_rows(spark, odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    assert mixing.mix(spark.createDataFrame([(i, "a b", "s") for i in range(500)] * 2, "doc_id long, text string, source string")).agg(
        F.sum("taken")).first()[0] == pytest.approx(3000, abs=2)


def test_mixed_shuffles_texts_once_and_repeats_what_mix_takes(spark):
    rows = [(i if i % 9 else None, "w " * (1 + i % 40) + str(i), "ab"[i % 2]) for i in range(300)]
    documents = spark.createDataFrame(rows + rows[:60] * 2, "doc_id long, text string, source string")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = mixing.mixed(documents)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = Counter()
        for r in out.collect():
            got[r.doc_id] += words_in(r.text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    # one shuffle of the documents, one of the copies; another between join and choice before
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    expected = Counter()
    for r in mixing.mix(documents).collect():
        expected[r.doc_id] += r.taken
    assert got == +expected


# --- secrets

def test_secrets_under_nested_layers():
    secret = "password=hunter2hunter2"
    once = base64.b64encode(secret.encode()).decode()
    packed = base64.b64encode(gzip.compress(f"see {once} here".encode())).decode()
    escaped = "".join(f"%{b:02X}" for b in secret.encode())
    unicode_ = "".join(f"\\u{ord(c):04x}" for c in secret)
    for hidden in (once, packed, escaped, unicode_, base64.b64encode(escaped.encode()).decode()):
        text = f"é before {hidden} after"
        base, every = secrets.spans(text)
        start = text.index(hidden)
        assert not base
        assert any(k == 0 and start <= s and e <= start + len(hidden) for s, k, e in every), hidden
        assert "before" in secrets.masked(text) and secrets.MASK in secrets.masked(text)
    quine = base64.b64encode(base64.b64encode(b"loop loop loop loop loop")).decode()
    assert secrets.spans(quine + " " + quine)[1] == []


def test_secrets_in_unusual_encodings():
    secret = "password=hunter2hunter2"
    raw = secret.encode()
    b64 = lambda data: base64.b64encode(data).decode()
    quoted = lambda data: "".join(f"%{b:02x}" for b in data)
    wide = "".join(f"\\u{ord(c):04x}" for c in secret)
    lines = base64.encodebytes(b"some words before it, to fill the first line; " * 2 + raw).decode().strip()
    for hidden in (
        b64(f"see\u00a0{secret}".encode()), b64(b"caf\xe9 " + raw), b64(b"\xef\xbb\xbf" + raw),
        b64(secret.encode("utf-16")), b64(secret.encode("utf-16-le")), b64(secret.encode("utf-16-be")),
        lines, lines.replace("\n", "\r\n"), "dir/x/" + b64(raw), "a/" + b64(raw), "key1/" + b64(gzip.compress(raw)),
        quoted(gzip.compress(raw)), quoted(raw + b"\xff" + raw), "\\ud800" + wide, wide + "\\udc01",
        b64(b"\x00\x01\x02" + raw), quoted(b64(b"\xa0" + raw).encode()),
    ):
        text = f"\u00e9 before {hidden} after"
        start = text.index(hidden)
        every = secrets.spans(text)[1]
        assert any(k == 0 and start <= s and e <= start + len(hidden) for s, k, e in every), hidden
        masked = secrets.masked(text)
        assert masked.startswith("\u00e9 before ") and masked.endswith(" after") and secrets.MASK in masked
    for plain in ("a long wordwithoutanyspaceatall here", b64(b"nothing to see in this text, at all"), "%41%42%ff", "dir/sub/another/file_name-2"):
        assert secrets.spans(plain)[1] == []


def test_secrets_in_compressed_layers_to_a_fixpoint():
    secret = b"password=hunter2hunter2"
    half = len(secret) // 2
    noise = random.Random(5).randbytes(30_000)
    run = base64.b64encode(base64.b64encode(noise) + b" " + secret)
    for data in (
        gzip.compress(gzip.compress(secret)),
        zlib.compress(bz2.compress(lzma.compress(secret))),
        gzip.compress(b"first ") + gzip.compress(secret),
        gzip.compress(secret[:half]) + gzip.compress(secret[half:]),
        bz2.compress(b"first ") + bz2.compress(secret),
        lzma.compress(b"first ") + bytes(4) + lzma.compress(secret),
        gzip.compress(b"") + bz2.compress(secret),
        zlib.compress(b"first ") + b"\xff\n" + secret,
        # an encoded run over the end of the first chunk
        gzip.compress(b"line of text\n" * ((1 << 20) // 13 - 1_000) + run + b"\n"),
        gzip.compress(gzip.compress(noise * 50 + b"\n" + secret)),
    ):
        text = "before " + base64.b64encode(data).decode() + " after"
        assert (7, 0, len(text) - 6) in secrets.spans(text)[1], data[:10]
        assert secrets.masked(text) == f"before {secrets.MASK} after"


def test_plain_secrets_by_definition():
    rule = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    source = random.Random(2)
    bits = ["secret", "ToKen", "=", ": ", "abc", "def123", "\"", " ", "api_key", "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2, "ſecret=abcdefg"]
    for _ in range(300):
        text = "".join(source.choice(bits) for _ in range(12))
        want = [(0, *m.span()) for m in rule.finditer(text) if len(m[2]) >= 6]
        want += [(1, *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(2, *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert sorted((k, s, e) for k, s, e in secrets.found(text)) == sorted(want)


def test_secrets_on_odd_rows(spark, odd, empty):
    rows = secrets.report(odd).collect()
    assert sum(r.n_assign for r in rows) == 1 and len(rows) == odd.count()
    masked = secrets.redacted(odd)
    assert masked.columns == odd.columns and masked.filter("text = '[REDACTED]' AND n_chars = 10").count() == 1
    assert secrets.report(empty).count() == 0


# --- pipeline

def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline

    docs = read(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: slow_fingerprint(t, 4) for i, t in texts.items()}
    label = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if label[b] < label[a] and (prints[a] ^ prints[b]).bit_count() <= 4:
                    label[a], changed = label[b], True
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR)
    assert {r.doc_id for r in kept.collect()} == set(label.values())
    clean = corpus_pipeline.drop_contaminated(spark, docs, SF_DIR)
    hit = {r.doc_id for r in QUERIES["op6_decontamination"](spark, SF_DIR).filter("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == set(texts) - hit
    final = corpus_pipeline.run(spark, SF_DIR)
    assert final.columns == docs.columns and final.count() > 0
    assert not any(list(secrets.found(r.text)) for r in final.collect())
