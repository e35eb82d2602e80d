"""The registered queries of the operators, over the whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import chat, decontamination, languages, neardup, negatives, packing, periodic, pii, quality, substrings, token_counts, toxicity, vectors
from ledgerlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build
    return wrap


@query("op1_token_counts")
def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def _joined(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kind(kind: str) -> F.Column:
    return F.size(F.filter("plain", lambda s: s["kind"] == kind)).cast("long")


@query("op2_personal_data")
def _personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """The counts and the hash are those of the plain spans; ``spans`` lists plain and added ones."""
    found = pii.find_personal_data(table(spark, folder, "documents"))
    order = F.array(*map(F.lit, pii.KINDS))
    ranked = F.transform(
        F.concat("plain", "added"),
        lambda s: F.struct(F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    counts = [_of_kind(k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("plain")), 256).alias("base_sha256"),
        _joined(F.array_sort(ranked)).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


@query("op3_packing")
def _packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op10_top_k", """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM (SELECT * FROM usable WHERE vec_id % 50 = 0) q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""")
def _top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return vectors.top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5, scale=256)


def _scored(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op4_toxicity")
def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(toxicity.toxic_scores(table(spark, folder, "documents"), table(spark, folder, "labels")))


@query("op9_quality")
def _quality(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels")))


@query("op7_decontamination")
def _decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row a contaminated pair; clean documents have none."""
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_substring_dedup")
def _substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, folder, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_near_duplicates")
def _near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, folder, "documents"), percent=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


ASK = {
    "ask": {
        "type": "object",
        "required": ["text", "words"],
        "additionalProperties": False,
        "properties": {"text": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 1, "maximum": 120}},
    }
}


def asked_as_calls(turns: DataFrame) -> DataFrame:
    """Conversations as tool use: a user's turn calls ``ask``, the turn after it is the result."""
    words = F.size(F.filter(F.split("text", "[ \\t\\n]+"), lambda w: w != ""))
    call = F.struct(
        F.concat(F.lit("t"), F.col("turn")).alias("id"), F.lit("ask").alias("name"), F.struct("text", words.alias("words")).alias("arguments"),
        F.array(F.concat(F.lit("t"), F.col("turn") - 2)).alias("after"),
    )
    result = F.struct(F.concat(F.lit("t"), F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content"))
    return turns.select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", F.to_json(F.struct(F.array(call).alias("tool_calls")))).when(F.col("role") == "assistant", F.to_json(result)).otherwise(F.col("text")).alias("text"),
    )


@query("op5_chat_calls")
def _chat_calls(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_calls(asked_as_calls(table(spark, folder, "conversations")), ASK)


@query("op11_hard_negatives", """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS anchor_id, c.vec_id AS id, q.label = c.label AS same,
        CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM (SELECT * FROM usable WHERE vec_id % 100 = 0) q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), positives AS (
    SELECT anchor_id, id, score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
    n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 5
""")
def _hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh label is a wrong one."""
    rows = table(spark, folder, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(moved, moved.filter(F.col("vec_id") % 100 == 0), positives=5, negatives=5, low=80, high=100, scale=256)


def repeating(docs: DataFrame) -> DataFrame:
    """Every tenth text (by the checksum of its id) repeats a stretch of its words up to its end.

    With h the checksum, g = h / 10 and n words: from word a = g % n on, word i is word a + (i - a) % p, where
    p = 1 + (n - a) / (3 + g % 8).
    """
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    found = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = (h % 10 == 0) & F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(chosen, found).alias("words")).withColumn("n", F.size("words"))
    cut = cut.withColumn("a", (F.col("g") % F.col("n")).cast("int")).withColumn("rest", F.col("n") - F.col("a"))
    cut = cut.withColumn("p", (1 + F.floor(F.col("rest") / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil(F.col("rest") / F.col("p")).cast("int")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    whole = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("rest")))
    return cut.select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs", r"""
WITH RECURSIVE bits AS (
    SELECT n, 0 AS k, n AS c FROM range(256) t(n)
    UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), bytes AS (SELECT n, c FROM bits WHERE k = 8),
checks AS (
    SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 1 AS k, CAST(4294967295 AS BIGINT) AS c FROM documents
    UNION ALL SELECT doc_id, s, k + 1, xor(b.c, checks.c >> 8) FROM checks JOIN bytes b ON b.n = xor(checks.c & 255, ascii(s[k])) WHERE k <= length(s)
), parts AS (
    SELECT d.doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS v, xor(c, 4294967295) AS h FROM documents d JOIN checks ON checks.doc_id = d.doc_id AND k > length(s)
), sizes AS (SELECT *, len(v) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(v) > 0 THEN (h // 10) % len(v) END AS a FROM parts),
moved AS (
    SELECT doc_id, n, CASE WHEN a IS NULL THEN v ELSE list_transform(range(n), lambda i: v[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS v FROM sizes
), spelt AS (SELECT doc_id, unnest(v) AS w, unnest(range(n)) AS i FROM moved),
alike AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM spelt x JOIN spelt y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i),
placed AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM alike),
stretches AS (SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM placed GROUP BY doc_id, q, island HAVING count(*) >= q AND count(*) + q >= 12),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL),
lists AS (
    SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(start, length, period), (length, -start, -period)) AS best,
        string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id
), gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM spelt ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period, 1000 * best.length // best.period AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM moved LEFT JOIN lists USING (doc_id) LEFT JOIN left_over USING (doc_id)
""")
def _periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(repeating(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = periodic.longest(F.col("runs"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query("op13_languages")
def _languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages.languages(table(spark, folder, "documents"))
