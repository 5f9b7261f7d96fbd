"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash and queue one behind the other, up to ``max_repeats`` times over.
A copy's virtual finish time is the source's words up to its end, divided by the source's target. All copies are
sorted globally by ranges of finish time and the mix is cut where it reaches the total budget.

Only counters are sorted: per (source, hash bucket) sums give running totals, so a source that holds most of all rows is dealt
over as many tasks as buckets. The range of finish time that holds the cut is parted again until few copies are left to sort. As
copies of one source are taken in the order of round and hash, the cut is one bound for each source, and a document is taken as
often as its hash lies within it: no text is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docpack.llm.text import hash_bucket, key_hash, n_words
from docpack.session import sided, spread, written

KEYS = ["mix_none", "mix_source"]


def _queued(docs: DataFrame, text: str, source: str, key: str, seed: str, size: bool = True) -> dict[str, Column]:
    """Source, place in the queue (a hash of key and text) and, if asked for, size."""
    content = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
    return {
        "mix_none": F.col(source).isNull(),
        "mix_source": F.coalesce(F.col(source).cast("string"), F.lit("")),
        "mix_hash": key_hash(seed, F.col(key), content),
        **({"mix_size": n_words(F.col(text))} if size else {}),
    }


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, share: float = 1.0) -> DataFrame:
    """Targets of sources (``mix_none, mix_source, mix_total``): the budget by weight, stopping at ``max_repeats`` totals.

    Weights repeat over the sources in code-point order, null last. Sources are taken by total over weight: while
    the next one's share is above its stop it gets the stop, and the rest is shared again. One row per source.
    """
    order = W.orderBy("mix_none", "mix_source")
    ratio = W.orderBy(F.col("mix_total") / F.col("mix_weight"), "mix_none", "mix_source")
    before, after = ratio.rowsBetween(W.unboundedPreceding, -1), ratio.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(0))
    full = F.col("mix_total") * max_repeats
    return (
        sizes.withColumn("mix_weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int") + 1))
        .withColumn("budget", F.sum("mix_total").over(everything) * F.lit(share))
        .withColumn("capped_before", F.coalesce(F.sum(full).over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("mix_weight").over(after))
        .withColumn("capped", full.cast("double") * F.col("weight_left") < (F.col("budget") - F.col("capped_before")).cast("double") * F.col("mix_weight"))
        .withColumn("given", F.coalesce(F.sum(F.when(F.col("capped"), full)).over(everything), F.lit(0)))
        .withColumn("sharing", F.sum(F.when(~F.col("capped"), F.col("mix_weight"))).over(everything))
        .withColumn("mix_target", F.when(F.col("capped"), full.cast("double")).otherwise((F.col("budget") - F.col("given")).cast("double") * F.col("mix_weight") / F.col("sharing")))
        .select(*KEYS, "mix_total", "mix_weight", "mix_target")
    )


def _units(light: DataFrame, buckets: int) -> DataFrame:
    """Rows that share source and hash, as one."""
    units = light.groupBy(*KEYS, "mix_hash").agg(F.sum("mix_size").alias("mix_size"), F.count("*").alias("rows"))
    return written(units.withColumn("bucket", hash_bucket(F.col("mix_hash"), buckets)), "mix-units")


def _told_apart(rows: DataFrame, again: DataFrame, name: str) -> DataFrame:
    """``rows`` with a hash of their own for all but the first of those that share one (``again`` has these hashes).

    Rows that repeat are numbered in the order of a written table: counts by its parts say where each part's numbers begin, so
    however many repeat one row, no task has more of them than a part.
    """
    same = [*KEYS, "mix_hash"]
    several = written(rows.join(sided(again), same, "left_semi").withColumn("mix_id", F.monotonically_increasing_id()), name)
    several = several.withColumn("mix_part", F.shiftright("mix_id", 33))
    before = W.partitionBy(*same).orderBy("mix_part").rowsBetween(W.unboundedPreceding, -1)
    starts = several.groupBy(*same, "mix_part").agg(F.count("*").alias("n")).withColumn("mix_first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    nth = F.col("mix_first") + F.row_number().over(W.partitionBy(*same, "mix_part").orderBy("mix_id")) - 1
    numbered = several.join(starts, [*same, "mix_part"]).withColumn("mix_nth", nth)
    own = F.when(F.col("mix_nth") == 0, F.col("mix_hash")).otherwise(key_hash("again", F.col("mix_hash"), F.col("mix_nth")))
    return rows.join(sided(again), same, "left_anti").unionByName(numbered.withColumn("mix_hash", own).select(*rows.columns))


def _starts(units: DataFrame, goals: DataFrame) -> DataFrame:
    """Units with ``mix_end``: the words of its source's queue up to its end."""
    along = W.partitionBy(*KEYS).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = units.groupBy(*KEYS, "bucket").agg(F.sum("mix_size").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(along), F.lit(0))).drop("n")
    starts = written(starts.join(goals, KEYS), "mix-starts")
    queue = W.partitionBy(*KEYS, "bucket").orderBy("mix_hash").rowsBetween(W.unboundedPreceding, 0)
    return units.drop("rows").withColumn("up_to", F.sum("mix_size").over(queue)).join(sided(starts), [*KEYS, "bucket"]).withColumn("mix_end", F.col("start") + F.col("up_to")).drop("up_to", "start", "bucket")


def _finish(end: Column, round_: Column, total: Column, target: Column) -> Column:
    return (end + round_ * total).cast("double") / target


def _cut(copies: DataFrame, budget: float, few: int) -> tuple[float, DataFrame]:
    """The finish time before which all copies are taken, and those of the others that are: at most ``few``, in one range.

    Copies are taken in order while the middle of their words lies within the budget. Of 1024 ranges of finish time the one that
    the budget ends in is parted again, until it has at most ``few`` copies or one time only (copies of different sources).
    """
    ends = [F.min("finish").alias("low"), F.max("finish").alias("high"), F.count("*").alias("rows"), F.sum("mix_size").alias("words")]
    held, before = copies.agg(*ends).first(), 0
    inside = copies
    while held["rows"] > few and held["low"] < held["high"]:
        step = (held["high"] - held["low"]) / 1024
        place = F.least(F.floor((F.col("finish") - held["low"]) / step), F.lit(1023)).cast("int")
        start = before
        for r in inside.groupBy(place.alias("place")).agg(*ends).orderBy("place").collect():  # 1024 rows at most
            if start > budget:
                break
            held, before = r, start
            start += r["words"]
        inside = copies.where(F.col("finish").between(held["low"], held["high"]))
    sort = W.orderBy("finish", *KEYS, "round", "mix_hash").rowsBetween(W.unboundedPreceding, 0)
    ordered = inside.withColumn("mixed", F.sum("mix_size").over(sort) + before)
    return held["low"], ordered.where(2 * F.col("mixed") - F.col("mix_size") <= 2 * budget).drop("mixed")


def _mixed(docs: DataFrame, keep: list[str], text: str, source: str, key: str, weights: tuple[int, ...], max_repeats: int, share: float, seed: str, few: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """The table of sizes (with columns ``keep``), the bounds of sources, the queues of their units, and hashes that several rows had."""
    buckets = spread(docs.sparkSession)
    queued = _queued(docs, text, source, key, seed)
    light = written(docs.select(*keep, *[c.alias(n) for n, c in queued.items()]), "mix-sizes")
    totals = light.groupBy(*KEYS).agg(F.sum("mix_size").alias("mix_total"))
    goals = written(targets(totals, weights, max_repeats, share), "mix-targets")
    budget = (goals.agg(F.sum("mix_total")).first()[0] or 0) * share
    units, again = _units(light, buckets), None
    if not units.where("rows > 1").isEmpty():
        again = written(units.where("rows > 1").select(*KEYS, "mix_hash"), "mix-again")
        light = written(_told_apart(light, again, "mix-several"), "mix-sizes")
        units = _units(light, buckets)
    units = _starts(units, goals)
    begin = lambda e: (F.col("mix_end") - F.col("mix_size") + e * F.col("mix_total")).cast("double")
    rounds = F.filter(F.array(*[F.lit(e).cast("long") for e in range(max_repeats)]), lambda e: begin(e) < F.col("mix_target"))
    copies = units.where("mix_target > 0").select(*KEYS, "mix_hash", "mix_size", "mix_end", "mix_total", "mix_target", F.explode(rounds).alias("round"))
    copies = written(copies.select(*KEYS, "mix_hash", "mix_size", "round", _finish(F.col("mix_end"), F.col("round"), F.col("mix_total"), F.col("mix_target")).alias("finish")), "mix-copies")
    last = F.max(F.struct("round", "mix_hash")).alias("last")
    bounds = goals.withColumn("last", F.lit(None).cast("struct<round:long,mix_hash:long>"))
    if not copies.isEmpty():
        low, some = _cut(copies, budget, few)
        taken = copies.where(F.col("finish") < low).groupBy(*KEYS).agg(last).unionByName(some.groupBy(*KEYS).agg(last))
        bounds = goals.join(taken.groupBy(*KEYS).agg(F.max("last").alias("last")), KEYS, "left")
    return light, written(bounds, "mix-bounds"), units, again


def _times() -> Column:
    """How often a row is taken: once for each round before the last one of its source, and in that one up to the bound."""
    return F.when(F.col("last").isNull(), 0).otherwise(F.col("last.round") + (F.col("mix_hash") <= F.col("last.mix_hash")).cast("int")).cast("int")


def mix_sizes(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeats: int = 3,
    share: float = 1.0,
    seed: str = "mix-0",
    few: int = 50_000,
) -> DataFrame:
    """What the mix takes of each row: ``key, mix_size`` (words), ``mix_total, mix_target`` (of its source) and ``mix_copies`` (0 to ``max_repeats``).

    Reruns agree: sums are of whole numbers, and the order depends on keys and texts alone. Null or empty texts have
    size 0 and are taken with their neighbours in the queue; null sources are one source, last in order; null keys
    are one key, whose rows queue by their texts. Rows that repeat both key and text have places of their own in the queue.
    An empty table gives an empty result; other columns are ignored.
    """
    light, bounds, _, _ = _mixed(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(source).alias("source")), ["key"], "text", "source", "key", weights, max_repeats, share, seed, few)
    return light.join(sided(bounds), KEYS).select("key", "mix_size", "mix_total", "mix_target", _times().alias("mix_copies"))


def mixed_rows(
    docs: DataFrame,
    ordered: bool = False,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeats: int = 3,
    share: float = 1.0,
    seed: str = "mix-0",
    few: int = 50_000,
) -> DataFrame:
    """The rows of the mix: each row of ``docs`` as often as ``mix_sizes`` says, with its own columns only, whatever their names.

    Rows are chosen where they are, by the bounds of their sources. ``ordered`` sorts them by finish time over range
    partitions: the order in which a trainer would read them.
    """
    _, bounds, units, again = _mixed(docs, [], text, source, key, weights, max_repeats, share, seed, few)
    own = F.struct(*[c.alias(n) for n, c in _queued(docs, text, source, key, seed, size=False).items()])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("own")).select("row", "own.*")
    rows = _told_apart(rows, again, "mix-rows") if again is not None else rows
    rows = rows.join(sided(bounds), KEYS).withColumn("copies", _times()).where("copies > 0")
    rows = rows.select("row", *KEYS, "mix_hash", "mix_total", "mix_target", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("round"))
    if ordered:
        ends = units.select(*KEYS, "mix_hash", "mix_end")
        rows = rows.join(ends, [*KEYS, "mix_hash"]).withColumn("finish", _finish(F.col("mix_end"), F.col("round"), F.col("mix_total"), F.col("mix_target")))
        rows = rows.orderBy("finish", *KEYS, "round", "mix_hash")
    return rows.select("row.*")


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    taken = mix_sizes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return taken.select(F.col("key").alias("doc_id"), F.col("mix_size").alias("size"), F.col("mix_total").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS src,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5('mix-0:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 15) AS h
  FROM documents),
s AS (SELECT none, src, sum(size)::BIGINT AS total FROM d GROUP BY ALL),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY none, src) - 1) % 3 AS weight, sum(total) OVER ()::BIGINT AS budget FROM s),
f AS (SELECT *, 3 * total::DOUBLE * sum(weight) OVER (ORDER BY total / weight, none, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        < (budget - coalesce(sum(3 * total) OVER (ORDER BY total / weight, none, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE * weight AS capped FROM w),
t AS (SELECT none, src, total, budget, CASE WHEN capped THEN (3 * total)::DOUBLE
        ELSE (budget - coalesce(sum(CASE WHEN capped THEN 3 * total END) OVER (), 0))::DOUBLE * weight / sum(CASE WHEN NOT capped THEN weight END) OVER () END AS target FROM f),
q AS (SELECT d.*, total, budget, target, sum(size) OVER (PARTITION BY none, src ORDER BY h, doc_id::VARCHAR, size ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM d JOIN t USING (none, src)),
c AS (SELECT q.*, r, (e + r * total)::DOUBLE / target AS finish FROM q, unnest([0, 1, 2]) AS x(r) WHERE target > 0 AND (e - size + r * total)::DOUBLE < target),
o AS (SELECT *, sum(size) OVER (ORDER BY finish, none, src, r, h, e, size ROWS UNBOUNDED PRECEDING) AS mixed FROM c),
k AS (SELECT doc_id, count(*) AS copies FROM o WHERE 2 * mixed - size <= 2 * budget GROUP BY doc_id)
SELECT q.doc_id, q.size, q.total AS source_size, q.target, (coalesce(k.copies, 0) * q.size)::BIGINT AS taken FROM q LEFT JOIN k ON q.doc_id = k.doc_id
"""
