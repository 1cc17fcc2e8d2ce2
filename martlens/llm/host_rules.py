"""Quality rules per document and per host, in DataFrame expressions only.

Every document is measured by itself first.  The share of a host's documents that fail the rules is then
shrunk towards the corpus: the prior is a beta distribution fitted to all hosts' shares by their mean and
variance, each host weighing as many documents as it has.  A host is refused when even a cautious reading of its shrunk
rate, some standard deviations below, is over the limit, and its verdict is joined back to its documents.

A large host costs one row a task before the shuffle, and its documents are joined back by a join that may
split it.  The measures hold for texts of any length: repeated three-word windows are found by sorting a
document's own windows by their hash, so nothing is exploded into rows.

Defined cases: a null text has no words and fails the base rules; a null host is a host of its own;
repeated rows are measured and counted each; an empty table gives no row; other columns stay behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlens.llm.common import durable

# Separators of words, signs counted as symbols, and the two base rules.
SEPARATORS = r"[\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50

#: A host is refused when its shrunk failure rate less CAUTION standard deviations is over this share.
HOST_LIMIT, CAUTION = 0.5, 2.0


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column computed once a row: its users would otherwise each get a copy of the expression."""
    return df.withColumn(name, F.explode(F.array(value)))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None) -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    df = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.col("source") if host is None else host).alias("host"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    df = _once(df, "words", F.array_remove(F.split("text", SEPARATORS), ""))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = _once(df, "lines", lines)
    df = df.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "words",
    )
    # the windows' hashes with their places, in order of hash, then place
    count = F.size("words") - 2
    windows = F.transform(
        F.slice("words", 1, F.greatest(count, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")),
    )
    df = _once(df, "sorted", F.sort_array(windows))
    same_as = lambda x, k: F.coalesce(F.get("sorted", k)["h"] == x["h"], F.lit(False))
    twice = F.filter("sorted", lambda x, k: same_as(x, k - 1) | same_as(x, k + 1))
    df = _once(df, "places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # a window covers three words, or fewer if the next one begins earlier
    covered = F.aggregate(
        F.transform("places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda n, x: n + x,
    )
    return df.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words")
    )


def base_failed() -> Column:
    """Too short, or too much of it in windows that occur twice."""
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def host_verdicts(judged: DataFrame, limit: float = HOST_LIMIT, caution: float = CAUTION) -> DataFrame:
    """host, documents, failures, rate (shrunk) and refused, from rows with host and base_failed."""
    failed = F.sum(F.col("base_failed").cast("long")).alias("failures")
    hosts = judged.groupBy("host").agg(F.count("*").alias("documents"), failed)
    share = F.col("failures") * F.col("failures") / F.col("documents")
    # one row: all the driver ever sees
    n, f, squares = hosts.agg(F.sum("documents"), F.sum("failures"), F.sum(share)).first()
    mean = f / n if n else 0.0
    spread = max(squares / n - mean * mean, 0.0) if n else 0.0
    # a beta distribution with this mean and variance, weighing at least one document and at most a million
    weight = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6
    rate = (F.col("failures") + F.lit(mean * weight)) / (F.col("documents") + F.lit(weight))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("documents") + F.lit(weight + 1)))
    return hosts.withColumn("rate", rate).withColumn("refused", F.col("rate") - caution * deviation > limit)


def judged(docs: DataFrame, host: Column | None = None, limit: float = HOST_LIMIT, caution: float = CAUTION) -> DataFrame:
    """The measures of every document, base_failed, its host's shrunk failure rate and kept."""
    # written once: the hosts' counts and the join back both read it, and texts are measured one time only
    rows = durable(measured(docs, host=host).withColumn("base_failed", base_failed()))
    verdicts = host_verdicts(rows, limit, caution).select(F.col("host").alias("its_host"), "rate", "refused")
    joined = rows.join(verdicts, rows["host"].eqNullSafe(F.col("its_host")), "left").drop("its_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("refused")).drop("refused")
