"""Ranked lexical search by pipelined term partitioning.

Documents are indexed in blocks of neighbouring rows: a row of the index has the documents of one term in one block and how often each
holds it. Terms are owned by stages: the first has those that few documents hold, the last those that most do. Items travel in
bundles: for each block a bundle carries its sparse accumulators (item, document, score so far) through the stages one after another,
each of which is a cogroup of the bundles with the postings that the stage owns and that adds whole-number contributions.

Between stages an item's bar is known: the score of its k-th best document so far. A document that cannot reach the bar with all
that the later stages could add is not carried on, and once a new document could not reach it, none is begun. Contributions are
never negative, so the result is that of adding everything. Blocks bound a group's documents, bundles its items, so a
term or a group of copies that a third of all documents share is dealt over all blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docpack.llm.text import SLICE
from docpack.llm.vectors import first_block
from docpack.session import sided, small_batches, written

# every byte below 128 that is no letter or digit parts terms; A-Z become a-z
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
UNIT = 1_000_000  # no contribution reaches this many times the term's weight
DOCS, POSTINGS = 4096, 1 << 20
BOUNDS = (0.01, 0.1, 0.3)
BUNDLE = 64


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of about ``SLICE`` bytes of text."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + SLICE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def _lists(rows: list[list], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([x for r in rows for x in r], kind))


def _invert(kind: pa.DataType, wanted: frozenset[bytes] | None):
    """Rows of documents as rows of the index; a block's first row has no term but the keys and numbers of terms of its documents."""

    def block(number: int, docs: list[tuple]) -> pa.RecordBatch:
        docs.sort(key=lambda d: (d[0] is None, d[0] if d[0] is not None else 0))  # so that places follow keys
        found: dict[bytes, tuple[list, list]] = {}
        for place, (_, _, own) in enumerate(docs):
            for t, n in own.items():
                places, counts = found.setdefault(t, ([], []))
                places.append(place)
                counts.append(n)
        names = sorted(found)
        size = 1 + len(names)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number] * size, pa.int64()),
                pa.array([None, *[t.decode("utf-8", "surrogatepass") for t in names]], pa.string()),
                _lists([[], *[found[t][0] for t in names]], pa.int32()),
                _lists([[d[1] for d in docs], *[found[t][1] for t in names]], pa.int64()),
                _lists([[d[0] for d in docs], *[[]] * len(names)], kind),
            ],
            names=["block", "term", "docs", "counts", "ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, docs, size = first_block(), [], 0
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                own: Counter = Counter()
                for part in terms(text.as_py()):
                    own.update(part)
                if not own:
                    continue
                n = own.total()
                if wanted is not None:
                    own = {t: own[t] for t in (own.keys() & wanted)}
                docs.append((key, n, own))
                size += len(own)
                if len(docs) == DOCS or size >= POSTINGS:
                    yield block(number, docs)
                    number, docs, size = number + 1, [], 0
        if docs:
            yield block(number, docs)

    return run


def lexical_index(docs: DataFrame, key: str = "doc_id", text: str = "text", wanted: frozenset[bytes] | None = None) -> DataFrame:
    """The index of all whole texts (or of the ``wanted`` terms in them): ``block, term, docs, counts, ids``.

    A block has up to 4096 documents with a term each, in the order of their keys; its row without a term has their keys (``ids``) and
    numbers of terms (``counts``). Null texts and texts without terms are in no block. It is written to the shared folder.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    return written(rows.mapInArrow(_invert(to_arrow_type(kind), wanted), f"block long, term string, docs array<int>, counts array<long>, ids array<{kind.simpleString()}>"), "search-index")


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, text in enumerate(batch.column("text")):
            seen: set[bytes] = set()
            for part in terms(text.as_py()):
                seen.update(part)
            names = pa.array([t.decode("utf-8", "surrogatepass") for t in sorted(seen)], pa.string())
            if len(names):
                yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array([k] * len(names))), names], names=["item", "term"])


def _visit(stage: int, k: int, shortest: int, per: int, last: bool):
    """A bundle at the stage that owns the right rows' terms; ``per`` is 90 times the number of documents, ``shortest`` all their terms."""

    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        own = bundle.to_pylist()[0]
        n = np.array(own["sizes"], np.int64)
        m = 10 + (per * n) // shortest if per * int(n.max()) < 1 << 63 else np.array([10 + per * int(x) // shortest for x in n], np.int64)
        rest, bar = np.array(own["rest"], np.int64), np.array(own["bar"], np.int64)
        score = np.zeros((len(rest), len(n)), np.int64)
        score[np.array(own["slots"], np.int64), np.array(own["docs"], np.int64)] = own["scores"]
        begun = score > 0
        closed = rest[:, stage:].sum(1) * UNIT < bar
        for at in range(postings.num_rows):
            docs = postings["docs"][at].values.to_numpy()
            tf = postings["counts"][at].values.to_numpy()
            slots = postings["slots"][at].values.to_numpy()
            score[np.ix_(slots, docs)] += postings["w"][at].as_py() * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
        score[closed] *= begun[closed]
        score[score + rest[:, stage + 1 :].sum(1)[:, None] * UNIT < bar[:, None]] = 0
        best = np.argsort(-score, axis=1, kind="stable")[:, :k]  # of equal scores the smaller key
        if last:
            kept = np.zeros_like(score)
            np.put_along_axis(kept, best, np.take_along_axis(score, best, 1), 1)
            score = kept
        slots, docs = np.nonzero(score)
        top_slots = np.repeat(np.arange(len(rest)), best.shape[1])
        top = np.take_along_axis(score, best, 1).ravel()
        one = lambda x, kind: pa.array([x.astype(kind)], pa.list_(pa.from_numpy_dtype(kind)))
        return pa.table(
            {
                "block": bundle["block"], "bundle": bundle["bundle"], "sizes": pa.array([[] if last else own["sizes"]], pa.list_(pa.int64())),
                "slots": one(slots, np.int32), "docs": one(docs, np.int32), "scores": one(score[slots, docs], np.int64),
                "top_slots": one(top_slots[top > 0], np.int32), "top": one(top[top > 0], np.int64),
            }
        )

    return run


CARRIED = "block long, bundle int, sizes array<long>, slots array<int>, docs array<int>, scores array<long>, top_slots array<int>, top array<long>"


def _rest(wants: DataFrame, stages: int) -> DataFrame:
    """For each bundle what each of its items has to come: the weights of its terms by stage, in the order of slots."""
    each = wants.select("bundle", F.explode("slots").alias("slot"), "owner", "w").groupBy("bundle", "slot")
    each = each.agg(F.array(*[F.coalesce(F.sum(F.when(F.col("owner") == s, F.col("w"))), F.lit(0)) for s in range(stages)]).alias("rest"))
    return each


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", bounds: tuple[float, ...] = BOUNDS, most_terms: int = 200_000) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best of all documents for each item, of those with a score above 0.

    Null or empty texts have no terms: such documents do not count and such items have no rows. Rows that repeat a key are documents of
    their own, each with a rank; rows of items with one key are one item with the terms of all; a null key is a key, and of
    documents of equal score the last. Empty tables give no rows; other columns are ignored. Keys must be of a type that Python orders.

    The terms of all items filter the documents as they are read if there are at most ``most_terms`` (they go with the tasks); else all
    terms are indexed and joined. ``bounds`` are the shares of documents that part the owners of terms.
    """
    spark = docs.sparkSession
    id_kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()
    asked = items.select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("text")).mapInArrow(_asked, f"item {item_kind}, term string")
    asked = written(asked.distinct(), "search-asked", narrow=True)
    n_items, n_terms = asked.agg(F.count_distinct(F.struct("item")), F.count_distinct("term")).first()
    wanted = frozenset(r["term"].encode("utf-8", "surrogatepass") for r in asked.select("term").distinct().collect()) if n_terms <= most_terms else None
    index = lexical_index(docs, key, text, wanted)
    heads = index.where("term IS NULL")
    n, length = heads.agg(F.sum(F.size("counts")), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x))).first()
    if not n or not n_items:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {id_kind}, score long")
    numbered = asked.select("item").distinct().withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(-(-n_items // BUNDLE))).cast("int"))
    numbered = written(numbered.withColumn("slot", F.row_number().over(W.partitionBy("bundle").orderBy("item")) - 1), "search-items", narrow=True)
    held = index.where("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    owner = sum(((F.col("df") / F.lit(float(n)) > b).cast("int") for b in bounds), F.lit(0))
    placed = asked.join(numbered.withColumnRenamed("item", "_item"), F.col("item").eqNullSafe(F.col("_item")))
    wants = placed.groupBy("bundle", "term").agg(F.sort_array(F.collect_list("slot")).alias("slots"))  # as many as a bundle has items
    wants = written(wants.join(held, "term").select("bundle", "term", "slots", weight.alias("w"), owner.alias("owner")), "search-wants", narrow=True)
    stages = len(bounds) + 1
    rest = written(_rest(wants, stages), "search-rest", narrow=True)
    # every bundle goes by every block
    empty = F.array().cast("array<int>")
    bundles = F.explode(F.sequence(F.lit(0), F.lit(-(-n_items // BUNDLE) - 1))).alias("bundle")
    carried = heads.select("block", bundles, F.col("counts").alias("sizes"), empty.alias("slots"), empty.alias("docs"), F.array().cast("array<long>").alias("scores"))
    bars = None
    for stage in range(stages):
        known = numbered.join(rest, ["bundle", "slot"], "left")
        known = known.join(bars, ["bundle", "slot"], "left") if bars is not None else known.withColumn("bar", F.lit(0).cast("long"))
        none = F.array(*[F.lit(0).cast("long")] * stages)
        row = F.struct("slot", F.coalesce("rest", none).alias("rest"), F.coalesce("bar", F.lit(0)).alias("bar"))
        known = known.groupBy("bundle").agg(F.sort_array(F.collect_list(row)).alias("rows")).select("bundle", F.col("rows.rest").alias("rest"), F.col("rows.bar").alias("bar"))
        left = carried.join(sided(written(known, "search-bars", narrow=True)), "bundle").select("block", "bundle", "sizes", "slots", "docs", "scores", "rest", "bar")
        right = index.where("term IS NOT NULL").join(sided(wants.where(F.col("owner") == stage)), "term").select(F.col("block").alias("of_block"), F.col("bundle").alias("of_bundle"), "w", "slots", "docs", "counts")
        visit = _visit(stage, k, length, 90 * n, stage == stages - 1)
        carried = written(left.groupBy("block", "bundle").cogroup(right.groupBy("of_block", "of_bundle")).applyInArrow(visit, CARRIED), "search-carried")
        best = carried.select("bundle", F.explode(F.arrays_zip("top_slots", "top")).alias("x")).select("bundle", F.col("x.top_slots").alias("slot"), "x.top")
        best = best.withColumn("place", F.row_number().over(W.partitionBy("bundle", "slot").orderBy(F.desc("top")))).where(F.col("place") <= k)
        if stage < stages - 1:
            bars = written(best.groupBy("bundle", "slot").agg(F.min("top").alias("bar"), F.count("*").alias("n")).where(F.col("n") == k).drop("n"), "search-bar", narrow=True)
    found = carried.select("block", "bundle", F.explode(F.arrays_zip("slots", "docs", "scores")).alias("x"))
    found = sided(written(found.select("block", F.col("x.docs").alias("place"), "bundle", F.col("x.slots").alias("slot"), F.col("x.scores").alias("score")), "search-found", narrow=True))
    keys = heads.select("block", F.posexplode("ids").alias("place", "doc_id")).join(found, ["block", "place"])
    order = W.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "block", "place")
    out = keys.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.join(sided(numbered), ["bundle", "slot"]).select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format("coalesce(text, '')")} AS t FROM documents),
s AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
p AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(s.n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({_TERMS.format("coalesce(text, '')")}) AS term FROM benchmark),
x AS (SELECT item_id, r, any_value(doc_id) AS doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * p.n * s.n) // s.l))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, r),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INTEGER AS rank, doc_id, score FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""
