"""The registered corpus queries: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, logbilinear, mixing, neighbours, quality, repeats, secrets, simhash, structure, tokens, toxicity, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(*toxicity.training_rows(documents, table(spark, sf_dir, "labels")))
    return toxicity.score(documents, model)


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


_ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op6_decontamination",
    f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
             items AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
             item_windows AS (
               SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS win
               FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p FROM items WHERE len(w) > 0)),
             doc_windows AS (
               SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS win
               FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p
                     FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
             found AS (SELECT r, p, i.n, item_id FROM doc_windows d JOIN item_windows i ON d.win = i.win AND d.n = i.n),
             hit AS (SELECT r, count(DISTINCT q) AS n_hit
                     FROM (SELECT r, unnest(range(p, p + n)) AS q FROM found) GROUP BY r),
             named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query("op8_logbilinear")
def op8_logbilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logbilinear.score(table(spark, sf_dir, "documents"))


@query(
    "op5_warc",
    """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
            d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
            bits AS (SELECT page_id, n, h, max(page_id) OVER (PARTITION BY h) AS top,
                       array_to_string(list_transform(range(0, 40, 5), lambda i: (
                         WITH_BITS(substr(h, CAST(i + 1 AS INTEGER), 5)))), '') AS digest FROM d)
       SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
              CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
              CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to FROM bits""".replace(
        "WITH_BITS(substr(h, CAST(i + 1 AS INTEGER), 5))",
        "array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
        "CAST(((CAST('0x' || substr(h, CAST(i + 1 AS INTEGER), 5) AS BIGINT) >> s) & 31) + 1 AS INTEGER), 1)), '')",
    ),
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op7_repeats")
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


VOCABULARY = "piece_bpe_32k.model"


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = str(public_tokenizers.path(VOCABULARY))
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.load(vocabulary))


@query("op4_nearest")
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op13_quality")
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(*quality.training_rows(documents, table(spark, sf_dir, "labels")))
    return quality.score(documents, model)


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, byte by byte over a table made by its rule."""
    step = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    table = f"list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: {step}))"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    # the table is computed once per query, as a CTE named crc
    return (
        f"xor(list_reduce(list_concat([4294967295], {codes}), "
        "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"
    ), f"crc AS MATERIALIZED (SELECT {table} AS t)"


_CRC, _CRC_TABLE = _crc32_sql("k")


def _path(cost: str, audit: str, out: str) -> str:
    return f"struct_pack(c := {cost}, a := {audit}, o := {out})"


def _repair_sql() -> str:
    """Cheapest edits row by row: per state the least (cost, edits, text so far)."""

    def move(p, cost, letter, out="''"):
        return _path(f"{p}.c + {cost}", f"{p}.a || '{letter}'", f"{p}.o || {out}")

    def insert(p, role):
        return move(p, 2, "I", f"'{role}:' || chr(10)")

    def closed(p0, p1, p2, p3):
        u = f"least({p2}, {insert(p0, 'user')}, {insert(p1, 'user')}, {insert(p3, 'user')})"
        pair = ["user:' || chr(10) || 'assistant:' || chr(10)"]
        two = [_path(f"{p}.c + 4", f"{p}.a || 'II'", f"{p}.o || '{pair[0]}") for p in (p0, p1)]
        a = f"least({p3}, {insert(p2, 'assistant')}, {two[0]}, {two[1]})"
        return f"{p0} AS c0, {p1} AS c1, {u} AS c2, {a} AS c3"

    def kept(p, initial):
        fits = f"kind < 2 AND left(role, 1) = '{initial}'"
        return _path(f"{p}.c + CASE WHEN {fits} THEN kind ELSE 1000000000 END", f"{p}.a || 'K'", f"{p}.o || role || ':' || text || chr(10)")

    def changed(p, role):
        return _path(f"{p}.c + CASE WHEN kind < 2 THEN 2 + kind ELSE 1000000000 END", f"{p}.a || 'R'", f"{p}.o || '{role}:' || text || chr(10)")

    gone = [move(f"c{q}", 3, "D") for q in range(4)]
    user = ", ".join([kept(p, "u") for p in ("c0", "c1", "c3")] + [changed(p, "user") for p in ("c0", "c1", "c3")])
    never = _path("CAST(1000000000 AS BIGINT)", "''", "''")
    return rf"""WITH RECURSIVE {_CRC_TABLE},
        spots AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
        faults AS (SELECT spots.*, {_CRC} % 20 AS f FROM spots, crc),
        damaged AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
                      CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                      unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM faults),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
        named AS (SELECT *, CASE
                      WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
                    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS step FROM placed),
        rows_ AS (SELECT *, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 1 ELSE 2 END AS kind FROM named),
        counts AS (SELECT conv_id AS cc, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                     count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                     count(*) FILTER (fault = 'truncated') AS truncated,
                     count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id),
        walk AS (
          SELECT conv_id AS w, CAST(0 AS BIGINT) AS i, {_path("CAST(0 AS BIGINT)", "''", "''")} AS p0, {never} AS p1, {never} AS p2, {never} AS p3
          FROM (SELECT DISTINCT conv_id FROM conversations)
          UNION ALL
          SELECT w, i, {gone[0]}, least({gone[1]}, {kept("c0", "s")}), least({gone[2]}, {user}),
            least({gone[3]}, {kept("c2", "a")}, {changed("c2", "assistant")})
          FROM (SELECT w, walk.i + 1 AS i, role, text, kind, {closed("p0", "p1", "p2", "p3")}
                FROM walk JOIN rows_ ON w IS NOT DISTINCT FROM conv_id AND rows_.i = walk.i + 1)),
        ends AS (SELECT w, i, least(c0, c3) AS best FROM (SELECT w, i, {closed("p0", "p1", "p2", "p3")} FROM walk))
      SELECT w AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
        CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
        CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
        sha256(CASE WHEN best.o = '' THEN '' ELSE left(best.o, -1) END) AS repaired_sha256
      FROM ends LEFT JOIN counts ON w IS NOT DISTINCT FROM cc WHERE i = coalesce(n, 0)"""


@query("op11_structure", _repair_sql())
def op11_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = structure.repair(structure.damaged(table(spark, sf_dir, "conversations")))
    return report


@query(
    "op12_prefix_trie",
    f"""WITH {_CRC_TABLE},
        own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
                  ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
                FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        heads AS (SELECT own.*, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h
                  FROM (SELECT *, CAST(conv_id AS VARCHAR) AS k FROM own) AS own, crc),
        whole AS (SELECT a.conv_id, list_concat(coalesce(b.l, [])[1 : a.h], a.l[a.h + 1 :]) AS l
                  FROM heads a LEFT JOIN own b ON b.conv_id = a.base),
        prefixes AS (SELECT conv_id, d, l[1 : d] AS p, d = len(l) AS at_end FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM whole)),
        nodes AS (SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs,
                    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (at_end), '')) AS ends_sha256
                  FROM prefixes GROUP BY d, p),
        children AS (SELECT d - 1 AS d, p[1 : d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
        counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children,
                      CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(p[d].t) END AS saved
                    FROM nodes LEFT JOIN children USING (d, p)),
        sums AS (SELECT up AS d, p[1 : up] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
                 FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM counted) GROUP BY ALL)
      SELECT c.conv_id, CAST(c.d AS BIGINT) AS depth, above.conv_id AS parent_conv_id, CAST(c.n_convs AS BIGINT) AS n_convs,
        CAST(c.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
        CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
      FROM counted c JOIN sums USING (d, p) LEFT JOIN nodes above ON above.d = c.d - 1 AND above.p = c.p[1 : c.d - 1]""",
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.numbered(table(spark, sf_dir, "conversations"))
    members = turns.select("conv_id").distinct()
    return trie.trie(trie.rebuilt(turns), members)
