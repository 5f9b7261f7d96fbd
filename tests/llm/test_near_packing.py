import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docpack.llm import near, packing
from docpack.llm.components import components
from docpack.llm.text import word_hashes
from tests.llm.helpers import all_null, awkward, nothing

SF = "/root/testdata/sf0.001"


def bag(text):
    words = (text or "").encode().split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    top = sum((a | b).values())
    return sum((a & b).values()) / top if top else 0.0


def brute_classes(texts: dict, least=0.8):
    bags, where, root = {k: bag(t) for k, t in texts.items()}, defaultdict(list), {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, b in bags.items():
        for s in b:
            where[s].append(k)
    for a, b in {(a, b) for group in where.values() for a in group for b in group if a < b}:
        if similarity(bags[a], bags[b]) >= least:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}


def test_word_hashes_are_of_words_alone():
    one, starts = word_hashes(["ab  c\n", None, "c ab", "", "x" * 3_000_000 + " c"])
    assert list(starts) == [0, 2, 2, 4, 4, 6]
    assert one[0] == one[3] and one[1] == one[2] == one[5] and len(set(one.tolist())) == 3


def test_bag_minhash_estimates_weighted_jaccard():
    rng, errors = np.random.default_rng(3), []
    for _ in range(25):
        e = rng.integers(1, 2**56, 150).astype(np.uint64)
        a, b = rng.integers(1, 12, 150), rng.integers(1, 12, 150)
        b = np.where(rng.random(150) < 0.6, a, b)
        m = near.bag_minhash(np.concatenate([e, e]), np.concatenate([a, b]), np.repeat([0, 1], 150), 2, 512)
        errors.append((m[0] == m[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.015


def test_classes_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r["doc_id"]: r["class_id"] for r in near.op7_near_dedup(spark, SF).collect()} == brute_classes(texts)


def test_a_large_group_and_a_chain(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 10_000, 300)]
    rows = {}
    for k in range(150):  # one word changed each: alike to the base, and nearly all to each other
        own = list(base)
        own[int(rng.integers(0, 300))] = f"new{k}"
        rows[k] = " ".join(own)
    for k in range(40):  # pairs that are alike to each other but not to the base
        own = list(base)
        for j in rng.integers(0, 300, 16):
            own[int(j)] = f"far{k}-{j}"
        rows[500 + 2 * k], rows[501 + 2 * k] = " ".join(own), " ".join([*own[:150], "odd", *own[150:]])
    chain = [f"c{k}" for k in range(400)]
    for k in range(6):  # each is alike to its neighbours only
        rows[1000 + k] = " ".join(chain[k * 30 : k * 30 + 250])
    rows |= {2000: rows[0], 2001: rows[0]}
    out = {r["doc_id"]: r["class_id"] for r in near.near_classes(spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(4)).collect()}
    assert out == brute_classes(rows)


def test_near_awkward(spark):
    out = near.near_classes(awkward(spark)).collect()
    assert len(out) == awkward(spark).count()
    by = {r["doc_id"]: r["class_id"] for r in out if r["doc_id"] is not None}
    assert by[1] == by[4] == by[5] == 1 and all(by[k] == k for k in (2, 3, 6, 7, 8, 9, 10))
    assert sorted((r["class_id"] for r in out if r["doc_id"] is None), key=str) == [1, None]  # a text that others have, and none
    assert near.near_classes(nothing(spark)).count() == 0 and near.near_classes(all_null(spark)).count() == 3
    kept = near.drop_near(awkward(spark))
    assert kept.columns == awkward(spark).columns and sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 3, 6, 7, 8, 9, 10]


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + k, 1001 + k) for k in range(40)]
    root = {x: x for e in links for x in e}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: find(k) for k in root if any(k in e and e[0] != e[1] for e in links)}


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("text", ["a", "a  b", "a \n\n b ", "\n x\n", "don't  we'll", "é 日本 😀　 x", "  y\x85z", "<|endoftext|> a", "a<|endoftext|>b  <|endoftext|>\n<|endoftext|", "<|endoftext|><|endoftext|>", "x\x1c y", "tab\t\tend  "])
def test_ids_are_those_of_the_vocabulary(tokenizer, text):
    assert packing.token_ids(text, "byte_bpe_50k.tiktoken", packing.SPECIAL).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_is_whole_and_tight(spark, tokenizer):
    rows = packing.op8_packing(spark, SF).collect()
    docs, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        at = 0
        for n, p in enumerate(sorted(docs[r["doc_id"]], key=lambda p: p["piece"])):
            assert (p["piece"], p["start"]) == (n, at) and (p["length"] == 2048 or n == 0)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-total // 2048) + 2


def test_fullest_combination_against_all_subsets():
    rng = np.random.default_rng(2)
    for _ in range(60):
        values = sorted({int(x) for x in rng.integers(1, 40, 5)}, reverse=True)
        counts = [int(x) for x in rng.integers(0, 4, len(values))]
        room = int(rng.integers(0, 90))
        found = packing.fullest(values, counts, room)
        sums = {0}
        for v, c in zip(values, counts, strict=True):
            sums = {s + k * v for s in sums for k in range(c + 1)}
        assert all(n <= c for n, c in zip(found, counts, strict=True))
        assert sum(n * v for n, v in zip(found, values, strict=True)) == max(s for s in sums if s <= room)


def test_packing_awkward(spark):
    docs = awkward(spark)
    out = packing.pack_documents(docs, with_ids=True)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert out.where("doc_id = 2").first()["length"] == 1 and out.where("doc_id = 5").count() == 2
    assert out.where("octet_length(ids) <> 4 * length OR crc32(ids) <> ids_crc32").count() == 0
    assert packing.pack_documents(nothing(spark)).count() == 0 and packing.pack_documents(all_null(spark)).count() == 3


def test_rows_of_one_key_are_dealt_evenly(spark):
    pieces = spark.range(3000).select(F.lit(None).cast("long").alias("key"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 == 0, 2048).otherwise(700).cast("long").alias("length"))
    out = packing.pack(pieces, pool=256)
    assert out.count() == 3000 and out.where("sequence_id < 0").count() == 1000
    bins = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("rows")).collect()
    assert all(r["n"] <= 2048 for r in bins) and sum(r["rows"] == 2 for r in bins) >= 990


def _text(seed, n=60):
    return " ".join(f"w{k}" for k in np.random.default_rng(seed).integers(0, 100_000, n))


def test_texts_of_one_key_are_judged_one_by_one(spark):
    rows = [(k, _text(k)) for k in range(12)] + [(k, _text(100 + k)) for k in range(12)] + [(50 + k, _text(100 + k) + " tail") for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = sorted(tuple(r) for r in near.drop_near(df).collect())
    assert kept == sorted(rows[:24])  # every unique text, and of each pair of copies the lesser key
    classes = sorted(tuple(r) for r in near.near_classes(df).collect())
    assert classes == sorted([(k, k) for k in range(12)] * 2 + [(50 + k, k) for k in range(12)])


def test_null_keys_take_part(spark):
    rows = [(None, _text(1)), (None, _text(1) + " a"), (7, _text(1) + " b"), (None, _text(2)), (None, _text(3)), (None, _text(3) + " a"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in near.near_classes(df).collect()), key=str) == sorted([(None, 7), (None, 7), (7, 7), (None, None), (None, None), (None, None), (None, None)], key=str)
    kept = [r["text"] for r in near.drop_near(df).collect()]
    assert len(kept) == 4 and {rows[2][1], rows[3][1], None} < set(kept)
    text_keys = df.selectExpr("cast(doc_id AS string) AS doc_id", "text")
    assert near.drop_near(text_keys).count() == 4


def test_repeated_rows_are_one_member_of_a_bucket(spark, monkeypatch):
    rows = [(1, _text(1))] * 300 + [(2, _text(1) + " tail")] * 300 + [(3, _text(5))]
    sizes, own = {}, near.written

    def seen(df, name, narrow=False):
        out = own(df, name, narrow)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(near, "written", seen)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert near.near_classes(df).where("class_id = 1").count() == 600
    assert sizes["signatures"] == 3 and max(v for k, v in sizes.items() if k.startswith(("bucket", "near"))) <= 32
    assert near.drop_near(df).groupBy("doc_id").count().orderBy("doc_id").collect() == [(1, 300), (3, 1)]
