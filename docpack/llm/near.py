"""Near-duplicates by BagMinHash: weighted Jaccard similarity of multisets of five-word shingles.

Each shingle with count w owns the weights [0, w). Dyadic blocks [0, 1), [1, 2), [2, 4), ... each carry a Poisson
process of points with a time, a register and a level in the block; points whose level is below w belong to the
document. (BagMinHash splits such blocks further as it goes; fixed blocks give the same law, for counts.) A register's value is the time of its first point, so that two documents agree in a register with the probability of
their weighted Jaccard similarity. Registers are banded, bands that agree give candidates, and candidates are verified
by the exact overlap of their multisets.

Copies are collapsed before banding. In a band's bucket every member is first compared with the bucket's leader alone; after
the classes so found are joined, only members that are not in the leader's class are compared with members of other
classes in the bucket, where their distances to the leader (a metric) and their sizes are near enough and the shingles that
they alone have leave room for enough overlap. So a group of thousands of near copies costs little more than one comparison
each, and no link is left out. Many texts that resemble each other closely but nowhere enough are compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpack.llm.components import components
from docpack.llm.text import U, mix, shingles, word_hashes
from docpack.session import sided, small_batches, written

REGISTERS, BANDS = 64, 16
CHARS = 2 << 20


def bags(texts: list[str | None], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles (56-bit hashes, ascending) of each text, their counts, and where each text's begin; 256 texts at most."""
    found, starts = shingles(*word_hashes(texts), size)
    keys = np.repeat(np.arange(len(texts), dtype=U) << U(56), np.diff(starts)) | (found >> U(8))
    keys, counts = np.unique(keys, return_counts=True)
    return keys & U((1 << 56) - 1), counts, np.searchsorted(keys >> U(56), np.arange(len(texts) + 1))


def _unit(h: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((h >> U(11)).astype(np.float64) + 0.5) / float(1 << 53)


def bag_minhash(elements: np.ndarray, weights: np.ndarray, doc: np.ndarray, n_docs: int, registers: int = REGISTERS) -> np.ndarray:
    """The first times of all registers (one row per document) for multisets of hashed elements with whole weights.

    ``doc`` says which document an element belongs to; each document has at least one. Time is explored in steps:
    all points before a document's limit are drawn, and the limit is doubled until all its registers have a point. A
    block ends a step as soon as its next point lies beyond the limit, so the work is about one draw for each
    element and block and a few for each register.
    """
    block = np.zeros(len(elements), np.int64)
    owner = np.arange(len(elements))
    if int(weights.max()) > 1:
        levels = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64) + 1, 1)
        owner = np.repeat(owner, levels)
        block = np.arange(len(owner)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(block > 0, 1 << np.maximum(block - 1, 0), 0)
    width = np.maximum(low, 1)
    seed = mix(elements[owner] + U(0x632BE59BD9B4E019) * (block.astype(U) + U(1)))
    time = -np.log(_unit(seed)) / width
    home, most = doc[owner], weights[owner]
    out = np.full(n_docs * registers, np.inf)
    limit = registers * (np.log(registers) + 3.0) / np.bincount(doc, weights, n_docs)
    step = np.ones(len(owner), U)
    now = np.flatnonzero(time < limit[home])
    while True:
        while len(now):
            h = mix(seed[now] ^ (step[now] * U(0x9FB21C651E98DF25)))
            level = low[now] + (_unit(mix(h ^ U(0x5851F42D4C957F2D))) * width[now]).astype(np.int64)
            own = level < most[now]
            np.minimum.at(out, home[now][own] * registers + (h[own] % U(registers)).astype(np.int64), time[now][own])
            time[now] += -np.log(_unit(mix(h + U(0xD1342543DE82EF95)))) / width[now]
            step[now] += U(1)
            now = now[time[now] < limit[home[now]]]
        missing = ~np.isfinite(out.reshape(n_docs, registers)).all(axis=1)
        if not missing.any():
            return out.reshape(n_docs, registers)
        limit[missing] *= 2.0
        now = np.flatnonzero(missing[home] & (time < limit[home]))


def signatures(texts: list[str | None], size: int = 5, registers: int = REGISTERS, bands: int = BANDS):
    """For each text its number of shingles, two fingerprints of its multiset, and the hashes of its bands (none without words)."""
    elements, counts, starts = bags(texts, size)
    rows, per = registers // bands, np.diff(starts)
    full = np.flatnonzero(per)
    out = [(0, 0, 0, []) for _ in texts]
    if not len(full):
        return out
    doc = np.repeat(np.arange(len(full)), per[full])
    spice = mix(np.arange(1, registers + 1, dtype=U))
    mixed = mix(elements) * (counts.astype(U) * U(2) + U(1))
    one, two = np.add.reduceat(mixed, starts[full]), np.add.reduceat(mix(mixed + U(7)), starts[full])
    n = np.bincount(doc, counts, len(full)).astype(np.int64)
    times = bag_minhash(elements, counts, doc, len(full), registers).view(U)
    hashes = mix(np.sum(mix(times + spice).reshape(len(full), bands, rows), axis=2, dtype=U)).astype(np.int64)
    for k, row in enumerate(full):
        out[row] = int(n[k]), int(one[k].astype(np.int64)), int(two[k].astype(np.int64)), hashes[k].tolist()
    return out


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of the lesser counts; elements ascend in both."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return int(np.minimum(a[1][i], b[1][j]).sum())


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser counts over the sum of the greater."""
    both = overlap(a, b)
    return both / (int(a[1].sum() + b[1].sum()) - both) if len(a[0]) or len(b[0]) else 0.0


def _chunks(lengths: list[int], most: int = 256) -> Iterator[slice]:
    """Slices of at most ``most`` rows and, unless it is one row, ``CHARS`` characters."""
    first, total = 0, 0
    for k, n in enumerate(lengths):
        if k > first and (k - first == most or total + n > CHARS):
            yield slice(first, k)
            first, total = k, 0
        total += n
    if len(lengths) > first:
        yield slice(first, len(lengths))


def _lengths(*columns: pd.Series) -> list[int]:
    return [sum(len(t) if t else 0 for t in row) for row in zip(*columns, strict=True)]


def _sign(size: int, registers: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at in _chunks([len(t) if t else 0 for t in texts]):
                part = batch.slice(at.start, at.stop - at.start)
                rows = list(zip(*signatures(texts[at], size, registers, bands), strict=True))
                numbers = [pa.array(x, pa.int64()) for x in rows[:3]]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("content"), *numbers, pa.array(rows[3], pa.list_(pa.int64()))], names=["key", "content", "n", "fp1", "fp2", "bands"])

    return run


def _check(size: int, least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in _chunks(_lengths(batch["text_a"], batch["text_b"]), 128):
                part = batch.iloc[at]
                texts = list(dict.fromkeys([*part["text_a"], *part["text_b"]]))
                elements, counts, starts = bags(texts, size)
                bag = {t: (elements[starts[k] : starts[k + 1]], counts[starts[k] : starts[k + 1]]) for k, t in enumerate(texts)}
                n = {t: int(c.sum()) for t, (_, c) in bag.items()}
                both = [overlap(bag[x], bag[y]) for x, y in zip(part["text_a"], part["text_b"], strict=True)]
                same = [o >= least * (n[x] + n[y] - o) for o, x, y in zip(both, part["text_a"], part["text_b"], strict=True)]
                yield part[["a", "b"]].assign(o=both, same=same)

    return run


def _verified(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """``pairs`` (a, b) with the overlap ``o`` of their multisets and whether they are similar enough."""
    one = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    two = one.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return two.select("a", "b", "text_a", "text_b").mapInPandas(_check(size, least), "a long, b long, o long, same boolean")


def _own(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in _chunks(_lengths(batch["text"])):
                part = batch.iloc[at]
                elements, counts, starts = bags(part["text"].tolist(), size)
                yield pd.DataFrame({"id": np.repeat(part["id"].to_numpy(), np.diff(starts)), "element": elements.astype(np.int64), "w": counts})

    return run


def _room(texts: DataFrame, copies: DataFrame, size: int, least: float) -> DataFrame:
    """For each document of ``texts`` its n shingles, the u of them that no other one has, and what sizes may be similar enough.

    It shares n - u shingles with another at most, so the other has between ``least * n`` and ``(n - u) * (1 + least) / least - n``.
    """
    alone = texts.mapInPandas(_own(size), "id long, element long, w long").groupBy("element").agg(F.count("*").alias("docs"), F.min("id").alias("id"), F.sum("w").alias("w"))
    own = alone.where("docs = 1").groupBy("id").agg(F.sum("w").alias("u"))
    sizes = copies.select(F.col("rep").alias("id"), "n").join(texts.select("id"), "id").join(own, "id", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    most = F.floor((F.col("n") - F.col("u")) * ((1 + least) / least) - F.col("n") + 1e-6)
    return written(sizes.select("id", "n", "u", F.ceil(F.col("n") * least - 1e-6).alias("least_n"), most.alias("most_n")), "near-sizes", narrow=True)


def _outside_pairs(members: DataFrame, roots: DataFrame, compared: DataFrame, least: float) -> DataFrame:
    """Pairs of members of different classes of a bucket, one of them not in its leader's class, with room for enough overlap.

    Sizes are joined by bands of five per cent and distances to the leader by bands of ``1 - least``: one minus weighted Jaccard
    similarity is a metric, so similar members lie in the same band or the next. A document with many shingles of its own has no
    partner to be joined with. What two members can share is bounded by what each shares with the leader, and what each has besides
    that is not its own alone.
    """
    placed = members.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    led = roots.select(F.col("node").alias("leader"), F.col("root").alias("led"))
    placed = written(placed.join(led, "leader", "left").withColumn("out", F.col("root") != F.coalesce("led", "leader")).drop("led"), "near-placed", narrow=True)
    held = compared.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "o")
    placed = placed.where("id <> leader").join(held, (F.least("id", "leader") == F.col("_a")) & (F.greatest("id", "leader") == F.col("_b"))).drop("_a", "_b")
    sizes = members.where("id = leader").select("band", "hash", F.col("n").alias("n_led"))
    away = 1 - F.col("o") / (F.col("n") + F.col("n_led") - F.col("o"))
    placed = placed.join(sizes, ["band", "hash"]).withColumns({"free": F.col("n") - F.col("o") - F.col("u"), "away": away}).drop("n_led")
    placed = written(placed, "near-held", narrow=True)
    buckets = placed.groupBy("id").agg(F.collect_set(F.struct("band", "hash")).alias("own"))
    placed = placed.join(buckets, "id")
    outside = placed.where("out AND most_n >= least_n")
    step = lambda c: F.floor(F.log(F.col(c).cast("double")) / float(np.log(1.05))).cast("int")
    ring = lambda c, d=0.0: F.floor((F.col(c) + d) / (1 - least)).cast("int")
    left = outside.withColumn("step", F.explode(F.sequence(step("least_n"), step("most_n"))))
    left = left.withColumn("ring", F.explode(F.sequence(ring("away", least - 1 - 1e-9), ring("away", 1 - least + 1e-9))))
    left = left.select("band", "hash", "step", "ring", F.col("id").alias("a"), F.col("root").alias("root_a"), F.col("n").alias("n_a"), F.col("least_n").alias("least_a"), F.col("most_n").alias("most_a"), F.col("o").alias("o_a"), F.col("free").alias("free_a"), F.col("own").alias("own_a"))
    right = placed.select("band", "hash", step("n").alias("step"), ring("away").alias("ring"), F.col("id").alias("b"), "root", "n", "least_n", "most_n", "o", "free", "own", "out")
    shared = F.least("o_a", "o") + F.least("free_a", "free")
    room = shared >= least * (F.col("n_a") + F.col("n") - shared) - 1e-6
    # a pair is taken from the first bucket that both share, and once if both are outside
    first = F.array_min(F.array_intersect("own_a", "own")) == F.struct(left["band"], left["hash"])
    once = ~F.col("out") | (F.col("a") < F.col("b"))
    fits = once & room & F.col("n").between(F.col("least_a"), F.col("most_a")) & F.col("n_a").between(F.col("least_n"), F.col("most_n")) & (F.col("root_a") != F.col("root"))
    same = (left["band"] == right["band"]) & (left["hash"] == right["hash"]) & (left["step"] == right["step"]) & (left["ring"] == right["ring"])
    pairs = left.join(right, same & fits & first)
    return written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-pairs", narrow=True)


def _content(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


def _near_nodes(docs: DataFrame, text: str, key: str, least: float, size: int, registers: int, bands: int) -> DataFrame:
    """``key, content, id, root``: the members of classes of more than one document. A document is a key (or none) and a text, however many rows have both."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    known = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).withColumn("content", F.xxhash64("text"))
    signed = known.mapInArrow(_sign(size, registers, bands), f"key {kind}, content long, n long, fp1 long, fp2 long, bands array<long>")
    # ids are given as the table is written, and stay
    signed = written(signed.dropDuplicates(["key", "content"]).withColumn("id", F.monotonically_increasing_id()), "signatures")
    copies = signed.where("n > 0").groupBy("n", "fp1", "fp2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    copies = written(copies, "copies", narrow=True)
    # of copies only one goes on
    hashed = signed.join(copies.select(F.col("rep").alias("id")), "id").select("id", F.posexplode("bands").alias("band", "hash"))
    hashed = written(hashed, "bands", narrow=True)
    open_ = written(hashed.groupBy("band", "hash").agg(F.count("*").alias("members")).where("members > 1"), "bucket-open", narrow=True)
    shared = written(hashed.join(open_, ["band", "hash"]), "buckets-shared", narrow=True)
    wanted = shared.select("id").distinct().join(signed.select("id", "key", "content"), "id")
    wanted = written(wanted.select("id", F.col("key").alias("_key"), F.col("content").alias("_content")), "near-wanted", narrow=True)
    texts = known.join(sided(wanted), F.col("key").eqNullSafe(F.col("_key")) & (F.col("content") == F.col("_content")))
    texts = written(texts.select("id", "text").dropDuplicates(["id"]), "near-texts")
    sizes = _room(texts, copies, size, least)
    # a bucket's leader is the member that meets most others in all its bands: in a group of altered copies, the one nearest to the rest
    met = shared.groupBy("id").agg(F.sum("members").alias("met"))
    sized = written(shared.join(sizes.join(met, "id"), "id"), "buckets-sized", narrow=True)
    buckets = written(sized.groupBy("band", "hash").agg(F.min(F.struct(-F.col("met"), F.col("id"))).alias("first")).select("band", "hash", F.col("first.id").alias("leader")), "bucket-leaders", narrow=True)
    members = written(sized.join(buckets, ["band", "hash"]), "buckets", narrow=True)
    stars = written(members.where("id <> leader").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct(), "stars", narrow=True)
    compared = written(_verified(stars, texts, size, least), "near-compared")
    roots = components(compared.where("same"))
    pairs = _outside_pairs(members, roots, compared, least)
    more = written(_verified(pairs, texts, size, least).where("same").select("a", "b"), "near-more")
    twins = signed.where("n > 0").join(copies.where("copies > 1"), ["n", "fp1", "fp2"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    # copies hang on their representative; the classes of representatives are found without them
    final = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)) if not more.isEmpty() else roots
    of_twins = twins.join(final.withColumnRenamed("node", "b"), "b", "left").select(F.col("a").alias("node"), F.coalesce("root", "b").alias("root"))
    classes = final.unionByName(of_twins).distinct()
    named = classes.join(signed.select(F.col("id").alias("node"), "key", "content"), "node")
    return written(named.select("key", "content", F.col("node").alias("id"), "root"), "near-classes", narrow=True)


def near_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", least: float = 0.8, size: int = 5, registers: int = REGISTERS, bands: int = BANDS) -> DataFrame:
    """``doc_id`` and ``class_id`` of every row: the least key of its class of near-duplicates.

    Classes are the connected components of pairs with weighted Jaccard similarity of at least ``least``. Texts of fewer words
    than ``size`` are one shingle of all their words; null texts and texts without words are alike to none. A document is a key and a
    text: rows that repeat both are one, rows of one key with other texts are others and may be of other classes. A null key is a key
    like others but no class is named by it unless it has no other; a row that is alike to none has its own key. Empty tables give no rows.
    """
    nodes = _near_nodes(docs, text, key, least, size, registers, bands)
    names = nodes.groupBy("root").agg(F.min("key").alias("name"))
    classes = nodes.join(names, "root").select("key", "content", "name", F.lit(True).alias("alike"))
    rows = docs.select(F.col(key).alias("doc_id"), _content(text).alias("own"))
    out = rows.join(classes, F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("own") == F.col("content")), "left")
    return out.select("doc_id", F.when(F.col("alike"), F.col("name")).otherwise(F.col("doc_id")).alias("class_id"))


def drop_near(docs: DataFrame, text: str = "text", key: str = "doc_id", least: float = 0.8, size: int = 5, registers: int = REGISTERS, bands: int = BANDS) -> DataFrame:
    """``docs`` with one document of each class: the one with the least key, a null key being the last. Rows that repeat its key and text stay with it."""
    nodes = _near_nodes(docs, text, key, least, size, registers, bands)
    first = nodes.groupBy("root").agg(F.min(F.struct(F.col("key").isNull(), F.col("key"), F.col("id"))).alias("first")).select("root", F.col("first.id").alias("stays"))
    lost = nodes.join(first, "root").where("id <> stays").select(F.col("key").alias("__dp_key"), F.col("content").alias("__dp_content"))
    same = F.col(f"`{key}`").eqNullSafe(F.col("__dp_key")) & (_content(text) == F.col("__dp_content"))
    return docs.join(sided(written(lost, "near-lost", narrow=True)), same, "left_anti").select(*docs.columns)


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
