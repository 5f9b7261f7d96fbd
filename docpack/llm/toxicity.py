"""Toxic passages by maximum-scoring segments.

Every token gets the log-odds of its word between toxic and clean documents. A word's Dirichlet prior has the mean of the word's
share of all documents, dealt to the two classes as its longest prefix deals them; prefixes of four, five and six
characters have such priors in turn. Log-odds are shrunk towards those of the prefix by their significance, so that a word
that the labelled rows say nothing of has the score of its prefix, or none. A scan in linear time finds all maximal
scoring segments of a text; segments are calibrated by the extreme-value law of such scores, and a document's segments
together give its score, whose calibration is fitted to documents that did not choose the words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpack.llm.text import key_hash
from docpack.session import sided, written

# fixed values: ASCII marks that part words
MARKS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
TABLE = bytes.maketrans(MARKS, b" " * len(MARKS))
PREFIXES = (4, 5, 6)
FOLDS = 2


def words_of(text: str) -> list[bytes]:
    """Words in lower case, parted at ASCII white space and marks. A sentence in a script without spaces is one word, known by its prefixes at most."""
    return text.lower().encode("utf-8", "surrogatepass").translate(TABLE).split()


def features_of(word: str) -> list[str]:
    """The prefixes of a word, shortest first and marked by a star, and the word itself."""
    return [*(word[:n] + "*" for n in PREFIXES if len(word) >= n), word]


def decoded(words: set[bytes]) -> Iterator[str]:
    return (w.decode("utf-8", "replace") for w in words)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Labelled documents that hold a feature, by fold and label. Parts are given out as they grow."""
    parts: dict[str, list[int]] = {}

    def told() -> Iterator[pd.DataFrame]:
        names = list(parts)
        for at in range(0, len(names), 20_000):
            own = names[at : at + 20_000]
            yield pd.DataFrame([(n, *parts[n]) for n in own], columns=["feature", *COUNTS])
        parts.clear()

    for batch in batches:
        for text, label, fold in zip(batch["text"], batch["label"], batch["fold"], strict=True):
            if text:
                for f in {f for w in decoded(set(words_of(text))) for f in features_of(w)}:
                    parts.setdefault(f, [0] * (2 * FOLDS))[2 * fold + label] += 1
            if len(parts) > 300_000:
                yield from told()
    yield from told()


COUNTS = [f"{side}{fold}" for fold in range(FOLDS) for side in ("clean", "toxic")]


def training_rows(labels: DataFrame, key: str = "doc_id", label: str = "toxic", most: int = 50_000) -> DataFrame:
    """``id, label, fold`` of the labelled rows to learn from: crc32 of the key as text, mod 4, is not 2; at most ``most``, by hash. Keys with both labels count as 1."""
    rows = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) != 2))
    h = key_hash("toxic", F.col("id"))
    rows = rows.groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("label"))
    return rows.orderBy(h, "id").limit(most).withColumn("fold", F.pmod(h, F.lit(FOLDS)).cast("int"))


def ratio(toxic: np.ndarray, clean: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Twice the log-likelihood ratio of the counts against a toxic share of ``share``."""
    n = toxic + clean
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(toxic > 0, toxic * np.log(toxic / (n * share)), 0.0)
        b = np.where(clean > 0, clean * np.log(clean / (n * (1 - share))), 0.0)
    return 2 * np.maximum(a + b, 0.0)


def parents_of(feature: str) -> list[str]:
    """The prefixes of a feature that are not itself, longest first."""
    own = feature[:-1] if feature.endswith("*") else feature
    return [own[:n] + "*" for n in reversed(PREFIXES) if len(own) > n or (len(own) == n and not feature.endswith("*"))]


def chosen(counts: dict[str, tuple[float, float]], toxic: int, clean: int, threshold: float) -> dict[str, float]:
    """Features whose counts differ from what their nearest chosen prefix says by more than ``threshold``, with the ratio.

    ``counts`` holds (toxic, clean) by feature, with all prefixes of each feature.
    """
    base = toxic / (toxic + clean)
    out: dict[str, float] = {}
    shares: dict[str, float] = {}
    names = sorted(counts, key=lambda f: (not f.endswith("*"), len(f)))
    for level in [[f for f in names if f.endswith("*") and len(f) == n + 1] for n in PREFIXES] + [[f for f in names if not f.endswith("*")]]:
        if not level:
            continue
        from_ = np.array([next((shares[p] for p in parents_of(f) if p in shares), base) for f in level])
        t, c = np.array([counts[f] for f in level], float).T
        found = ratio(t, c, from_)
        for k in np.flatnonzero(found > threshold):
            out[level[k]] = float(found[k])
            shares[level[k]] = float((t[k] + base) / (t[k] + c[k] + 1))
    return out


def candidates(counts: DataFrame, sizes: list[tuple[int, int]], thresholds: list[float]) -> DataFrame:
    """Rows of ``counts`` that at least one of the models chooses. Model ``m`` leaves out fold ``m``; the last has all folds."""
    names = counts.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts)
        keep: set[str] = set()
        for m, ((t, c), threshold) in enumerate(zip(sizes, thresholds, strict=True)):
            toxic = sum(rows[f"toxic{f}"] for f in range(FOLDS) if f != m).to_numpy()
            clean = sum(rows[f"clean{f}"] for f in range(FOLDS) if f != m).to_numpy()
            if t and c:
                keep |= set(chosen(dict(zip(rows["feature"], zip(toxic, clean, strict=True), strict=True)), t, c, threshold))
        yield rows[rows["feature"].isin(keep)][names]

    stem = F.substring(F.col("feature"), 1, PREFIXES[0])  # all features under a shortest prefix come to one task
    return counts.repartition(stem).mapInPandas(run, counts.schema)


def corpus_shares(docs: DataFrame, text: str, wanted: set[str]) -> dict[str, float]:
    """The share of all documents that hold each wanted feature: as many numbers as features."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(wanted))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, n, known = Counter(), 0, Known(shared.value)
        for batch in batches:
            for t in batch["text"]:
                n += 1
                if t:
                    own.update({f for w in set(words_of(t)) for f in known[w]})
        yield pd.DataFrame([("", n), *own.items()], columns=["feature", "n"])

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInPandas(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = {r["feature"]: r["n"] for r in rows.collect()}
    n = found.pop("", 0)
    return {f: found.get(f, 0) / max(n, 1) for f in wanted}


class Cached(dict):
    """A dictionary that works values out as they are asked for, and begins anew when it has many."""

    most = 200_000

    def __missing__(self, word: bytes):
        if len(self) >= self.most:
            self.clear()
        self[word] = value = self.value(word.decode("utf-8", "replace"))
        return value


class Known(Cached):
    def __init__(self, features: frozenset[str]):
        super().__init__()
        self.features = features

    def value(self, word: str) -> tuple[str, ...]:
        return tuple(f for f in features_of(word) if f in self.features)


class Scores(Cached):
    """Scores of words: of the word if it is in the model, else of its longest prefix there, else 0; all less ``cost``."""

    def __init__(self, model: dict[str, float], cost: float):
        super().__init__()
        self.model, self.cost = model, cost

    def value(self, word: str) -> float:
        for f in reversed(features_of(word)):
            if f in self.model:
                return self.model[f] - self.cost
        return -self.cost


def log_odds(counts: dict[str, tuple[float, float]], shares: dict[str, float], toxic: int, clean: int, threshold: float, strength: float) -> dict[str, float]:
    """Shrunken log-odds of chosen features.

    The prior of a feature counts ``strength`` times its share of all documents, dealt to the classes as its
    nearest chosen prefix says. Log-odds move from the prefix's by their part beyond ``threshold``: ``1 - threshold / ratio``.
    """
    base = math.log(toxic / clean)
    picked = chosen(counts, toxic, clean, threshold)
    out: dict[str, float] = {}
    for f in sorted(picked, key=lambda f: (not f.endswith("*"), len(f))):
        above = next((out[p] for p in parents_of(f) if p in out), 0.0)
        q = 1 / (1 + math.exp(-(base + above)))
        weight = strength * shares.get(f, 0.0) + 1e-3
        t, c = counts[f]
        raw = math.log((t + weight * q) / (c + weight * (1 - q))) - base
        out[f] = above + (raw - above) * (1 - threshold / picked[f])
    return out


def segments(line: list[float] | np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of the words' scores.

    Every candidate is joined backwards with those it makes longer and better, each at most once, so the work is linear
    in the words; no other segment outside these scores higher in itself.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, nearest candidate below with a lesser sum before
    line = np.asarray(line, float)
    places = np.flatnonzero(line > 0)
    if not len(places):
        return []
    sums = np.cumsum(line)
    for place, total, left in zip(places.tolist(), sums[places].tolist(), (sums[places] - line[places]).tolist(), strict=True):
        first = place
        k = len(stack) - 1
        while True:
            while k >= 0 and stack[k][2] >= left:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= total:
                break
            first, left = stack[k][0], stack[k][2]
            del stack[k:]
            k -= 1
        stack.append((first, place, left, total, k))
    return [(a, b, after - before) for a, b, before, after, _ in stack]


def tail_rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The decay of the extreme-value law: the positive root of ``sum p exp(rate * s) = 1`` over the scores of clean words."""
    value = lambda x: float(np.sum(shares * np.exp(np.minimum(scores * x, 600.0)))) - 1.0
    if not len(scores) or np.sum(scores * shares) >= 0 or scores.max() <= 0:
        return 1.0
    low, high = 0.0, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


class Model:
    """Scores of features, the cost of a token, the extreme-value law, and the logistic calibration of a document's evidence."""

    def __init__(self, words: dict[str, float], cost: float = 0.1, rate: float = 1.0, size: float = 0.05, slope: float = 1.0, offset: float = 0.0):
        self.words, self.cost, self.rate, self.size, self.slope, self.offset = words, cost, rate, size, slope, offset
        self.known: Scores | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": None}

    def line(self, text: str | None) -> np.ndarray:
        if self.known is None:
            self.known = Scores(self.words, self.cost)
        words = words_of(text) if text else []
        return np.fromiter(map(self.known.__getitem__, words), float, len(words))

    def evidence(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The sum over significant segments of their scores less what chance gives in a text of this length, or the best if none is; and these segments."""
        line = self.line(text)
        chance = math.log1p(self.size * len(line))
        kept = [(a, b, self.rate * s - chance) for a, b, s in segments(line)]
        significant = [x for x in kept if x[2] > 0]
        best = max((x[2] for x in kept), default=-chance)
        x = sum(x[2] for x in significant) if significant else max(best, -20.0)
        return math.tanh(x / 20.0) * 20.0, significant

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        x, found = self.evidence(text)
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.slope * x + self.offset)))), found


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve (rows weighted by ``n``) by Newton steps with a weak prior."""
    n = np.ones(len(x)) if n is None else n
    a, b = 0.5, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -60, 60)))
        w = n * (p * (1 - p) + 1e-9)
        g = np.array([np.sum(n * (y - p) * x) - 0.1 * a, np.sum(n * (y - p)) - 0.01 * b])
        h = np.array([[np.sum(w * x * x) + 0.1, np.sum(w * x)], [np.sum(w * x), np.sum(w) + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = max(1e-3, a + step[0]), b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", most: int = 50_000, strength: float = 1000.0) -> Model:
    """Learns from at most ``most`` labelled rows; priors come from all documents. Without both labels every score is a half.

    A feature is chosen if its likelihood ratio exceeds ``2 ln`` of how many features there are. Three models are made: one
    without each of two folds, to calibrate on the documents of that fold, and the one of all rows that is returned.
    A neutral token costs the log-odds of no chosen word being met: ``ln((1 - h) / (1 - h'))`` for the rates ``h`` of positive tokens
    in toxic and in clean documents. Rows of ``docs`` that share a key count each, with the key's label; null keys have none.
    """
    spark = docs.sparkSession
    train = written(training_rows(labels, key, label, most), "toxic-train")
    source = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    rows = written(source.join(sided(train), "id").select("text", "label", "fold"), "toxic-rows")
    counts = written(rows.mapInPandas(_count, "feature string, " + ", ".join(f"{c} long" for c in COUNTS)).groupBy("feature").agg(*[F.sum(c).alias(c) for c in COUNTS]), "toxic-counts")
    by = {(r["fold"], r["label"]): r["count"] for r in rows.groupBy("fold", "label").count().collect()}  # two labels by two folds
    sizes = [tuple(sum(by.get((f, y), 0) for f in range(FOLDS) if f != m) for y in (1, 0)) for m in range(FOLDS + 1)]
    if not all(sizes[FOLDS]):
        return Model({}, slope=1e-3)
    n_features = counts.agg(*[F.sum((sum(F.col(f"{s}{f}") for s in ("clean", "toxic") for f in range(FOLDS) if f != m) > 0).cast("int")) for m in range(FOLDS + 1)]).first()
    thresholds = [2 * math.log(max(n or 0, 2)) for n in n_features]
    table = written(candidates(counts, sizes, thresholds), "toxic-candidates").collect()  # chosen features of at most ``most`` documents
    shares = corpus_shares(docs, text, {r["feature"] for r in table})
    models = []
    for m, ((t, c), threshold) in enumerate(zip(sizes, thresholds, strict=True)):
        own = {r["feature"]: (float(sum(r[f"toxic{f}"] for f in range(FOLDS) if f != m)), float(sum(r[f"clean{f}"] for f in range(FOLDS) if f != m))) for r in table}
        models.append(Model(log_odds(own, shares, t, c, threshold, strength) if t and c else {}, cost=0.0))
    shared = spark.sparkContext.broadcast(models)

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for batch in batches:
            for t, y, fold in zip(batch["text"], batch["label"], batch["fold"], strict=True):
                for m in (fold, FOLDS):
                    for s, n in zip(*(x.tolist() for x in np.unique(shared.value[m].line(t).round(2), return_counts=True)), strict=True):
                        found[m, int(y), s] += n
        yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["m", "y", "s", "n"])

    # as many numbers as there are scores of two places
    histogram = rows.mapInPandas(tokens, "m int, y int, s double, n long").groupBy("m", "y", "s").agg(F.sum("n").alias("n")).toPandas()
    for m, model in enumerate(models):
        own = histogram[histogram["m"] == m]
        total = {y: max(int(own[own["y"] == y]["n"].sum()), 1) for y in (0, 1)}
        hits = {y: int(own[(own["y"] == y) & (own["s"] > 0)]["n"].sum()) for y in (0, 1)}
        rates = {y: (hits[y] + 0.5) / (total[y] + 1) for y in (0, 1)}
        model.cost = max(0.01, math.log((1 - rates[0]) / (1 - rates[1])))
        clean = own[own["y"] == 0]
        top = max(model.words.values(), default=1.0)
        s = np.append(clean["s"].to_numpy(float), top) - model.cost  # the best score is taken as met once
        p = np.append(clean["n"].to_numpy(float), 1.0)
        model.rate, model.size = tail_rate(s, p / p.sum()), rates[0]
    shared.unpersist()
    fitted = spark.sparkContext.broadcast(models)

    def evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"y": batch["label"].astype(int), "x": [round(fitted.value[m].evidence(t)[0], 2) for t, m in zip(batch["text"], batch["fold"], strict=True)]})

    # at most 4001 values of either label
    found = rows.mapInPandas(evidence, "y int, x double").groupBy("y", "x").count().toPandas()
    model = models[FOLDS]
    model.slope, model.offset = logistic(found["x"].to_numpy(float), found["y"].to_numpy(float), found["count"].to_numpy(float))
    return model


def toxicity(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", limit: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, score`` (0 to 1), ``predicted`` and ``passages`` (first word, last word, evidence of each toxic passage).

    Null and empty texts have the score of a text without evidence, and so has one in a script without spaces whose sentences begin like none of the labelled ones. Repeated rows have one row each. Other columns are ignored;
    empty tables give no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            found = [m.score(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "score": [f[0] for f in found], "predicted": [int(f[0] >= limit) for f in found], "passages": [[{"first": a, "last": b, "evidence": s} for a, b, s in f[1]] for f in found]})

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInPandas(run, f"doc_id {kind}, score double, predicted int, passages array<struct<first:long,last:long,evidence:double>>")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
