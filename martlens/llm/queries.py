"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlens.llm import bpe, chat, curves, host_rules, langid, packing, quality, repair, repeats, sharding, simhash, toxicity, whitening
from martlens.llm.common import fold, table
from martlens.session import work_dir

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


@query()
def op1_repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(repeats.without_repeats(table(spark, folder, "documents")))


@query()
def op2_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query()
def op3_bpe_coding(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), VOCABULARY)


@query(r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest([i, i + 1, i + 2]) AS u(p) GROUP BY doc_id),
rows AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) AS base_failed
  FROM d LEFT JOIN covered USING (doc_id)),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM rows GROUP BY source),
corpus AS (SELECT sum(f) / sum(n) AS m, greatest(sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2, 0) AS v FROM hosts),
prior AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1), 1e6) ELSE 1e6 END AS k FROM corpus),
rates AS (SELECT source, n, k, (f + m * k) / (n + k) AS r FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT r - 2 * sqrt(r * (1 - r) / (n + k + 1)) > 0.5 AS kept
FROM rows JOIN rates ON rows.source IS NOT DISTINCT FROM rates.source
""")
def op4_host_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.judged(table(spark, folder, "documents")).drop("host", "rate")


@query()
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), VOCABULARY)


@query()
def op6_curve_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return curves.neighbours(table(spark, folder, "embeddings"), "vec_id % 20 = 0", 20)


def unheld(labels: DataFrame) -> DataFrame:
    """The labelled rows that may be learned from: four fifths by a hash of the id."""
    return labels.where(fold("doc_id", 5) != 0)


def judged(scores: DataFrame, limit: float) -> DataFrame:
    return scores.select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.learn(docs, unheld(table(spark, folder, "labels")))
    return judged(toxicity.scored(docs, model), 0.5)


@query()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    model = langid.learn(docs.where(fold("doc_id", 4) != 2))
    return langid.identified(docs, model).select("doc_id", held, "lang_pred", "score", "ambiguous")


@query()
def op9_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.learn(docs, unheld(table(spark, folder, "labels")))
    return judged(quality.scored(docs, model), 0.3)


@query("""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(2 * length(text) - length(regexp_replace(text, '[\\\\<\\[]', '', 'g'))
                + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5
                       ELSE 16 + 2 * length(role) - length(regexp_replace(role, '[\\\\<\\[\\]]', '', 'g')) END) AS BIGINT)
         AS formatted_chars
FROM turns GROUP BY conv_id
""")
def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    events = chat.turns_as_events(table(spark, folder, "conversations"))
    hard = "</s>[INST] ok [/INST]"
    planted = [(-7, 0, 0, "message", "user", hard), (-7, 1, 1, "message", "assistant", hard)]
    return chat.reread(chat.formatted(events.unionByName(spark.createDataFrame(planted, chat.EVENTS))))


@query()
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return whitening.whitened(vectors, whitening.learn(vectors))


def _step(cost: int | str, op: str, rest: str, turn: str = "") -> str:
    """SQL of the repair that does `op` and then `rest`."""
    turns = f"list_prepend({turn}, {rest}.t)" if turn else f"{rest}.t"
    return f"{{'c': {rest}.c + {cost}, 'a': '{op}' || {rest}.a, 't': {turns}}}"


def _takes(initial: str, role: str, rest: str) -> str:
    """SQL of the cheapest way to let row r stand for a character of the pattern."""
    return f"""CASE WHEN r.fault IN ('blank', 'duplicate') THEN {{'c': 1000000, 'a': '', 't': []::VARCHAR[]}}
      WHEN r.initial = '{initial}' THEN {_step("r.kept", "K", rest, "r.role || ':' || r.text")}
      ELSE {_step("r.kept + 1", "R", rest, f"'{role}:' || r.text")} END"""


#: The pattern's automaton in SQL, from the last row back: x between pairs, y after a user's turn, w after the system's,
#: z at the start; each holds cost, audit and turns of the best repair of the rows from i on.
@query(rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS chars
  FROM conversations),
summed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(chars, lambda ch: [unicode(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                 lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 20 AS kind
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM summed, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS u(copy) WHERE kind <> 0),
placed AS (
  SELECT *, substring(role, 1, 1) AS initial, row_number() OVER o AS i, lag(substring(role, 1, 1)) OVER o || substring(role, 1, 1) AS pair,
         rtrim(text, E' 	

') AS said
  FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faulty AS (
  SELECT *, CASE WHEN said = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
turns AS (SELECT *, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS kept FROM faulty),
back AS (
  SELECT conv_id, max(i) + 1 AS i, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS x, {{'c': 5, 'a': 'I', 't': ['assistant:']}} AS y,
         {{'c': 10, 'a': 'II', 't': ['user:', 'assistant:']}} AS w, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS z
  FROM turns GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, least(x0, {_step(5, "I", "y0", "'user:'")}), least(y0, {_step(5, "I", "x0", "'assistant:'")}),
         least(w0, {_step(5, "I", "y0", "'user:'")}, {_step(10, "II", "x0").replace("x0.t", "list_concat(['user:', 'assistant:'], x0.t)")}),
         least(z0, {_step(5, "I", "y0", "'user:'")})
  FROM (SELECT r.conv_id, r.i, least({_step(2, "D", "b.x")}, {_takes("u", "user", "b.y")}) AS x0,
               least({_step(2, "D", "b.y")}, {_takes("a", "assistant", "b.x")}) AS y0,
               least({_step(2, "D", "b.w")}, {_takes("u", "user", "b.y")}) AS w0,
               least({_step(2, "D", "b.z")}, {_takes("u", "user", "b.y")},
                     CASE WHEN r.initial = 's' AND r.fault IN ('', 'truncated') THEN {_step("r.kept", "K", "b.w", "r.role || ':' || r.text")}
                          ELSE {{'c': 1000000, 'a': '', 't': []::VARCHAR[]}} END) AS z0
        FROM back b JOIN turns r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i - 1)),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(z.c, 0) AS BIGINT) AS cost,
       coalesce(z.a, '') AS audit, sha256(coalesce(array_to_string(z.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN (SELECT conv_id, z FROM back WHERE i = 1) f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
""")
def op12_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair.repair_report(conversations, repair.damaged(conversations))


@query()
def op13_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    stored, version = sharding.sharded(table(spark, folder, "documents"), 24, work_dir(spark, "shards"))
    text = F.col("doc.text")
    return stored.select(
        F.col("doc.doc_id").alias("doc_id"),
        sharding.size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("slot").alias("virtual_slot"),
        F.lit(version).alias("map_version"),
    )
