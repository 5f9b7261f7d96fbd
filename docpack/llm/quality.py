"""Quality rules with host-level verdicts.

Rules fail single documents. Failures are counted by host (domain); each host's failure rates are shrunk towards those of the
other hosts by a beta prior fitted to them. A host that surely fails a rule for most of its documents, and far more often than
others do, is rejected with all its documents. Of the soft rules, a failure counts against a document as much as its host is
believed: where the host's shrunken rate is no higher than false alarms alone would give, its documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpack.session import sided, small_batches, written

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
HARD, SOFT = ["few_words", "repeats"], ["symbols", "dup_lines"]
RULES = [*HARD, *SOFT]
SURE = 1.645  # standard deviations: 95 per cent on one side


def repeat_words(words: list[bytes], size: int = 5) -> int:
    """Words inside windows of ``size`` words that the text holds twice or more, the first included.

    Windows are numbered exactly: equal numbers mean equal words. Windows are built from pairs of numbers, so that no
    number is larger than the square of the word count.
    """
    m = len(words) - size + 1
    if m < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    code, width = ids, len(seen)
    for k in range(1, size):
        n = len(code) - 1
        code = code[:n] * len(seen) + ids[k : k + n]
        if k < size - 1 and width * len(seen) > 1 << 31:
            unique, code = np.unique(code, return_inverse=True)
            width = len(unique)
        else:
            width *= len(seen)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = np.zeros(m, bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    if not twice.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    edges[at] += 1
    np.add.at(edges, at + size, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """``COUNTS`` of one whole text; null counts as empty."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at the six ASCII white spaces alone
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += bool(line.strip(SPACES))
        else:
            seen.add(line)
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup, repeat_words(words)


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = np.array([text_counts(t) for t in batch["text"]], np.int64).reshape(-1, len(COUNTS))
        yield pd.concat([batch[["key", "host"]].reset_index(drop=True), pd.DataFrame(counts, columns=COUNTS)], axis=1)


def measured(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source") -> DataFrame:
    """``key``, ``host``, ``COUNTS`` and a boolean for each rule, for every row of ``docs``."""
    small_batches(docs.sparkSession)
    schema = f"key {docs.schema[key].dataType.simpleString()}, host string, " + ", ".join(f"{c} long" for c in COUNTS)
    rows = docs.select(F.col(key).alias("key"), F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("text")).mapInPandas(_measure, schema)
    return rows.withColumns(
        {
            "few_words": F.col("n_words") < 10,
            "repeats": 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
            "symbols": 100 * F.col("n_symbols") > 10 * F.col("word_chars"),
            "dup_lines": F.col("n_dup_lines") >= 5,
        }
    )


def host_verdicts(rows: DataFrame, limit: float = 0.5, factor: float = 2.0, false_alarms: float = 0.02) -> DataFrame:
    """For each host and for the null host its shrunken rate by rule (``rate_...``), ``host_kept``, and ``believed_...`` by soft rule.

    The prior of a host is fitted to the rates of all other hosts, each host counting once, so that neither the host itself nor one
    with very many rows sets the measure: it has their mean and their variance less the variance that counting alone
    gives (method of moments); where they differ no more than by chance it is as strong as all their rows. Rejected: the lower
    95 per cent bound of the posterior (normal approximation) is above ``limit``, and its odds above ``factor`` times the
    odds of the others' mean. Believed: the shrunken rate is at least ``false_alarms``. A single host has nothing to be
    compared with and is kept; it and the null host take the mean over hosts for their rates.
    """
    fails = rows.where(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col(r).cast("int")).alias(r) for r in RULES])
    fails = written(fails, "host-fails")
    stats = [F.sum("n").alias("n"), F.count("*").alias("hosts"), F.coalesce(F.sum(1 / F.col("n")), F.lit(0.0)).alias("inv")]
    stats += [F.coalesce(F.sum(x), F.lit(0.0)).alias(a) for r in RULES for x, a in ((F.col(r) / F.col("n"), f"one_{r}"), ((F.col(r) / F.col("n")) * (F.col(r) / F.col("n")), f"two_{r}"))]
    all_ = fails.agg(*stats).first()  # one row
    others, n = all_["hosts"] - 1, F.col("n")
    kept, columns = F.lit(True), []
    for r in RULES:
        own = F.col(r) / n
        if others < 1:
            rate, bad = own, F.lit(False)
        else:
            mean = F.greatest((F.lit(all_[f"one_{r}"]) - own) / others, F.lit(0.0))
            chance = mean * (1 - mean) * (F.lit(all_["inv"]) - 1 / n) / others
            spread = F.greatest((F.lit(all_[f"two_{r}"]) - own * own) / others - mean * mean - chance, F.lit(0.0))
            rest = (F.lit(all_["n"]) - n).cast("double")
            strength = F.when(spread > 1e-12, F.least(F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0)), rest)).otherwise(rest)
            rate = (F.col(r) + mean * strength) / (n + strength)
            lower = F.greatest(rate - SURE * F.sqrt(rate * (1 - rate) / (n + strength + 1)), F.lit(0.0))
            bad = (lower > limit) & (lower * (1 - mean) > factor * mean * (1 - lower))
        columns.append(rate.alias(f"rate_{r}"))
        kept &= ~bad
    judged = fails.select("host", *columns, kept.alias("host_kept"))
    means = [F.lit(all_[f"one_{r}"] / all_["hosts"] if all_["hosts"] else 0.0).alias(f"rate_{r}") for r in RULES]
    judged = judged.unionByName(rows.sparkSession.range(1).select(F.lit(None).cast("string").alias("host"), *means, F.lit(True).alias("host_kept")))
    return judged.withColumns({f"believed_{r}": F.col(f"rate_{r}") >= false_alarms for r in SOFT})


def judged(rows: DataFrame, limit: float = 0.5) -> DataFrame:
    """``measured`` rows with ``base_failed``, ``host_kept`` and ``kept``."""
    verdicts = host_verdicts(rows, limit).withColumnRenamed("host", "_host")
    joined = rows.join(sided(written(verdicts, "host-verdicts")), F.col("host").eqNullSafe(F.col("_host")), "left")
    failed = F.col("few_words") | F.col("repeats")
    soft = F.lit(False)
    for r in SOFT:
        soft |= F.col(r) & F.col(f"believed_{r}")
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & F.col("host_kept") & ~soft)


def quality(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source", limit: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` (the key), ``host``, ``COUNTS``, ``base_failed``, ``host_kept``, ``kept``.

    ``base_failed``: fewer than ten words, or more than a fifth of the words in repeated five-word windows. ``kept``: not
    failed, the host not rejected, and no soft rule failed for which the host is believed. Null and empty texts have no words and
    fail. A null host has the mean rates of all hosts and is never rejected. Repeated rows count each. An empty table gives none.
    """
    rows = written(measured(docs, text, key, host), "quality")
    return judged(rows, limit).select(F.col("key").alias("doc_id"), "host", *COUNTS, "base_failed", "host_kept", "kept")


def drop_rejected(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows that ``quality`` rejects.

    Rows that share a key are told apart by a digest of text and host.
    """
    content = lambda *c: F.xxhash64(*c)
    marked = docs.withColumn("__dp_content", content(F.col(text).cast("string"), F.col(host).cast("string")))
    rows = written(measured(marked.withColumn("__dp_pair", F.struct(F.col(key).alias("key"), F.col("__dp_content").alias("content"))), text, "__dp_pair", host), "quality")
    lost = written(judged(rows, limit).where("NOT kept").select(F.col("key.key").alias("__dp_key"), F.col("key.content").alias("__dp_c")).distinct(), "quality-lost")
    return marked.join(sided(lost), F.col(key).eqNullSafe(F.col("__dp_key")) & (F.col("__dp_content") == F.col("__dp_c")), "left_anti").select(*docs.columns)


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality(docs).select("doc_id", *COUNTS, "base_failed", "kept")


def _rule_sql(r: str) -> str:
    """The posterior of one rule for every host; ``h`` holds the hosts' counts."""
    return f"""
h_{r} AS (SELECT source, n, k_{r} AS k, k_{r}::DOUBLE / n AS own, greatest((sum(k_{r}::DOUBLE / n) OVER () - k_{r}::DOUBLE / n) / (count(*) OVER () - 1), 0) AS mean,
    sum((k_{r}::DOUBLE / n) * (k_{r}::DOUBLE / n)) OVER () AS two, sum(1::DOUBLE / n) OVER () AS inv, count(*) OVER () - 1 AS others, (sum(n) OVER () - n)::DOUBLE AS rest FROM h),
s_{r} AS (SELECT *, greatest((two - own * own) / others - mean * mean - mean * (1 - mean) * (inv - 1::DOUBLE / n) / others, 0) AS spread FROM h_{r}),
t_{r} AS (SELECT *, CASE WHEN spread > 1e-12 THEN least(greatest(mean * (1 - mean) / spread - 1, 1), rest) ELSE rest END AS strength FROM s_{r}),
u_{r} AS (SELECT *, (k + mean * strength) / (n + strength) AS rate FROM t_{r}),
v_{r} AS (SELECT source, mean, rate, CASE WHEN others > 0 THEN greatest(rate - 1.645::DOUBLE * sqrt(rate * (1 - rate) / (n + strength + 1)), 0) ELSE 0 END AS lower FROM u_{r}),
a_{r} AS (SELECT coalesce(avg(own), 0) AS null_rate FROM h_{r})"""


OP5_SQL = (
    r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS word, generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
x AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS win FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM x WHERE win IS NOT NULL) WHERE n > 1),
p AS (SELECT doc_id, count(DISTINCT i + k.k) AS n_repeat_words FROM g, unnest([0, 1, 2, 3, 4]) AS k(k) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
e AS (SELECT doc_id, count(*) AS n_dup_lines FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS r FROM l) WHERE r > 1 AND regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM w GROUP BY doc_id),
m AS (SELECT d.doc_id, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN e ON e.doc_id = d.doc_id LEFT JOIN p ON p.doc_id = d.doc_id),
f AS (SELECT *, n_words < 10 AS few_words, 100 * n_repeat_words > 20 * n_words AS repeats, 100 * n_symbols > 10 * word_chars AS symbols, n_dup_lines >= 5 AS dup_lines FROM m),
h AS (SELECT source, count(*) AS n, """
    + ", ".join(f"count(*) FILTER ({r}) AS k_{r}" for r in RULES)
    + " FROM f WHERE source IS NOT NULL GROUP BY source),"
    + ",".join(map(_rule_sql, RULES))
    + "\nSELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words OR repeats AS base_failed,\n    NOT (few_words OR repeats OR "
    + " OR ".join(f"coalesce(v_{r}.lower > 0.5 AND v_{r}.lower * (1 - v_{r}.mean) > 2 * v_{r}.mean * (1 - v_{r}.lower), false)" for r in RULES)
    + " OR "
    + " OR ".join(f"{r} AND coalesce(v_{r}.rate, a_{r}.null_rate) >= 0.02" for r in SOFT)
    + ") AS kept\nFROM f "
    + " ".join(f"LEFT JOIN v_{r} ON v_{r}.source = f.source CROSS JOIN a_{r}" for r in RULES)
)
