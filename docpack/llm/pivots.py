"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Blocks of vectors hold a pivot inverted file each: for each pivot, the
vectors that have it among their ``prefix`` nearest, with its place. A query reads the lists of its own pivots. The footrule
distance of two such orders (a pivot that is not in one stands at place ``prefix``) is a constant less twice the sum, over pivots that both
have, of the lesser of what each place leaves to ``prefix``, so these sums from the lists rank as the distance does. Vectors
within a query's footrule bound are ranked again by their exact inner products.

Vectors get one more component that makes them equally long (queries a zero there), so that the nearest by angle are those of largest
inner product. Pivots are chosen farthest first from one half of a bounded sample; the other half tells the footrule
distance within which the wanted share of all vectors lies. All rows are indexed, ties of that bound included, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docpack.llm.vectors import chunks, first_block, matrix, rows_a_block, usable
from docpack.session import written

SAMPLE = 4096


def farthest_first(rows: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows (of equal length), each the one that is least like those before it."""
    rows = np.unique(rows, axis=0)
    best, out = np.full(len(rows), -np.inf), [0]
    while len(out) < min(n, len(rows)):
        best = np.maximum(best, rows @ rows[out[-1]])
        best[out[-1]] = np.inf
        out.append(int(np.argmin(best)))
    return rows[out]


def lifted(rows: np.ndarray, most: float) -> np.ndarray:
    """Rows with a component more, so that all have the squared length ``most``."""
    rows = rows.astype(np.float64)
    return np.column_stack([rows, np.sqrt(np.maximum(most - (rows * rows).sum(1), 0.0))])


def nearest_pivots(rows: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each row its ``prefix`` nearest pivots, nearest first."""
    like = rows @ pivots.T
    near = np.argpartition(-like, prefix - 1, axis=1)[:, :prefix] if prefix < len(pivots) else np.tile(np.arange(len(pivots)), (len(rows), 1))
    near.sort(axis=1)
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(like, near, 1), axis=1, kind="stable"), 1)


def inverted(near: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each pivot's list begins (one more at the end), and of its entries the row and the places left to the prefix."""
    flat = near.ravel()
    order = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[order], np.arange(pivots + 1))
    return starts.astype(np.int32), (order // near.shape[1]).astype(np.int16), (near.shape[1] - order % near.shape[1]).astype(np.int16)


def shared_places(queries: tuple, lists: tuple, n_queries: int, n_rows: int) -> np.ndarray:
    """For each query and row the sum, over pivots of both, of the lesser number of places left."""
    out = np.zeros((n_queries, n_rows), np.int16)
    for p in np.flatnonzero((np.diff(queries[0]) > 0) & (np.diff(lists[0]) > 0)):
        q, x = slice(*queries[0][p : p + 2]), slice(*lists[0][p : p + 2])
        out[np.ix_(queries[1][q], lists[1][x])] += np.minimum(queries[2][q][:, None], lists[2][x])
    return out


SHARES = (0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7, 1.0)


def needed_share(tested: np.ndarray, near: np.ndarray, pivots: np.ndarray, k: int, n: int, wanted: float = 0.93, most: int = 512) -> float:
    """The least of ``SHARES`` with which sampled vectors, asked for in the sample, find ``wanted`` of their nearest there.

    These are as many as take the place in the sample that ``k`` have among ``n``.
    """
    asked = np.column_stack([tested[:most, :-1], np.zeros(len(tested[:most]))])
    own = np.arange(len(asked))
    like = shared_places(inverted(nearest_pivots(asked, pivots, near.shape[1]), len(pivots)), inverted(near, len(pivots)), len(asked), len(tested))
    score = asked @ tested.T
    score[own, own], like[own, own] = -np.inf, -1
    nearest_ = np.argsort(-score, axis=1, kind="stable")[:, : max(1, round(k * len(tested) / n))]
    ordered = -np.sort(-like, axis=1)
    for share in SHARES:
        bound = ordered[:, min(len(tested), max(1, int(np.ceil(share * len(tested))))) - 1]
        if (np.take_along_axis(like, nearest_, 1) >= bound[:, None]).mean() >= wanted:
            return share
    return 1.0


def _index(pivots: np.ndarray, prefix: int, most: float, rows: int, width: np.dtype):
    """Blocks of vectors with their inverted files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in enumerate(chunks(batches, rows), first_block()):
            own = matrix(part["vector"].combine_chunks()).astype(width)
            starts, at, left = inverted(nearest_pivots(lifted(own, most), pivots, prefix), len(pivots))
            one = lambda x: pa.array([x.tobytes()], pa.binary())
            lists = lambda x, kind: pa.array([x.combine_chunks().to_pylist()], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), lists(part["id"], pa.int64()), lists(part["asked"], pa.bool_()), one(own), one(starts), one(at), one(left)],
                names=["block", "ids", "asked", "vectors", "starts", "rows", "places"],
            )

    return run


INDEX = "block long, ids array<long>, asked array<boolean>, vectors binary, starts binary, rows binary, places binary"


def _bundles(pivots: np.ndarray, prefix: int, tested: np.ndarray, share: float, dimension: int, width: np.dtype, size: int = 512):
    """Queries of a block: their vectors, inverted file and bound, which is what the sample's ``share`` best share with each."""
    shares = inverted(tested, len(pivots))
    kth = min(len(tested), max(1, int(np.ceil(share * len(tested))))) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                asked = np.flatnonzero(np.array(batch["asked"][k].as_py(), bool))
                own = np.frombuffer(batch["vectors"][k].as_py(), width).reshape(-1, dimension)
                for first in range(0, len(asked), size):
                    at = asked[first : first + size]
                    flat = np.column_stack([own[at].astype(np.float64), np.zeros(len(at))])  # the longest side of no query matters
                    starts, rows, places = inverted(nearest_pivots(flat, pivots, prefix), len(pivots))
                    like = shared_places((starts, rows, places), shares, len(at), len(tested))
                    bound = -np.partition(-like, kth, axis=1)[:, kth]
                    one = lambda x: pa.array([x.tobytes()], pa.binary())
                    keys = [batch["ids"][k].as_py()[i] for i in at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch["block"][k].as_py()]), pa.array([keys], pa.list_(pa.int64())), pa.array([at.tolist()], pa.list_(pa.int32())), one(own[at]), one(starts), one(rows), one(places), one(bound.astype(np.int16))],
                        names=["q_block", "q_ids", "q_at", "q_vectors", "q_starts", "q_rows", "q_places", "bound"],
                    )

    return run


BUNDLES = "q_block long, q_ids array<long>, q_at array<int>, q_vectors binary, q_starts binary, q_rows binary, q_places binary, bound binary"


def _nearest(dimension: int, width: np.dtype, k: int, pairs: int = 1 << 15):
    """For each (bundle, block): of the rows within each query's bound the ``k`` of largest inner product."""

    def near(row: dict) -> Iterator[tuple]:
        read = lambda name, kind: np.frombuffer(row[name], kind)
        own = read("vectors", width).reshape(-1, dimension).astype(np.float64)
        queries = read("q_vectors", width).reshape(-1, dimension).astype(np.float64)
        like = shared_places(
            (read("q_starts", np.int32), read("q_rows", np.int16), read("q_places", np.int16)), (read("starts", np.int32), read("rows", np.int16), read("places", np.int16)), len(queries), len(own)
        )
        found = like >= read("bound", np.int16)[:, None]
        if row["q_block"] == row["block"]:
            found[np.arange(len(queries)), row["q_at"]] = False
        q, x = np.nonzero(found)
        score = np.concatenate([(queries[q[a : a + pairs]] * own[x[a : a + pairs]]).sum(1) for a in range(0, len(q), pairs)] or [np.zeros(0)])
        null = np.array([i is None for i in row["ids"]])
        ids = np.array([0 if i is None else i for i in row["ids"]], np.int64)
        order = np.lexsort((ids[x], null[x], -score, q))
        q, x, score = q[order], x[order], score[order]
        best = np.arange(len(q)) - np.searchsorted(q, q) < k
        for a, b, s in zip(q[best].tolist(), x[best].tolist(), score[best].tolist(), strict=True):
            yield row["q_ids"][a], row["q_at"][a], row["ids"][b], s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = list(zip(*near(row), strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["q_block"]] * len(out[0]), pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[0], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.float64())],
                    names=["q_block", "q_at", "query_id", "vec_id", "score"],
                )

    return run


def nearest(rows: DataFrame, queries: Column | str, k: int = 20, key: str = "vec_id", vector: str = "embedding", pivots: int = 1024, prefix: int = 64, share: float | None = None, least: int = 500) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``queries`` holds its ``k`` nearest other rows by inner product, as the index finds them.

    ``share`` of all rows (at least ``least`` of them, so small tables are searched whole) is ranked again for each query; by default what the
    sample says is needed (``needed_share``: 0.15 at least, more where vectors are alike in many dimensions). Scores are the
    products of the original vectors in double precision; of equal ones the smaller key comes first, a null key last. Rows whose vector
    is null, empty, zero, of another length than most, or holds null or non-finite numbers take no part. Rows that repeat a key are rows of
    their own: only the query's own row is no candidate. A table with fewer rows gives what there is; an empty one nothing.
    Keys are whole numbers. Up to 4096 sampled vectors come to the driver.
    """
    spark = rows.sparkSession
    held = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(F.expr(queries) if isinstance(queries, str) else queries, F.lit(False)).alias("asked"))
    held, dimension, most = usable(held, "vector", zero=False)
    if not dimension:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = np.dtype(np.float32 if rows.schema[vector].dataType.elementType.typeName() == "float" else np.float64)
    sampled = held.select("vector", F.xxhash64("id", "vector").alias("h")).orderBy("h").limit(SAMPLE).collect()
    sample = lifted(np.array([r["vector"] for r in sampled]), most)
    chosen = farthest_first(sample[: (len(sample) + 1) // 2], pivots)
    prefix = min(prefix, len(chosen))
    n = len(sample) if len(sample) < SAMPLE else held.count()
    other = sample if n < SAMPLE else sample[len(sample) // 2 :]
    tested = nearest_pivots(other, chosen, prefix)
    share = needed_share(other, tested, chosen, k, n) if share is None else share
    per = rows_a_block(dimension)
    index = written(held.mapInArrow(_index(chosen, prefix, most, per, width), INDEX), "pivot-index")
    part = max(share, min(1.0, least / n))
    bundles = written(index.mapInArrow(_bundles(chosen, prefix, tested, part, dimension, width), BUNDLES), "pivot-queries")
    # each bundle of queries goes by each block once, in the lane that the block lies in
    lanes = index.count()
    placed = index.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int")).drop("asked")
    met = placed.join(bundles.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))), "lane").drop("lane")
    found = met.mapInArrow(_nearest(dimension, width, k), "q_block long, q_at int, query_id long, vec_id long, score double")
    order = W.partitionBy("q_block", "q_at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_nearest_vectors(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0")
