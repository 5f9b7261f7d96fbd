import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docpack.llm import exact, lines, quality
from docpack.session import new_path
from tests.llm.helpers import LONG_LINE, all_null, awkward, nothing

SF = "/root/testdata/sf0.001"
RUN = re.compile(r"[\x20\x09-\x0D]+")


def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_exact_groups_with_whole_and_with_weak_digests(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    norm = {k: RUN.sub(" ", t or "") for k, t in texts(spark).items()}
    groups = defaultdict(list)
    for k, t in norm.items():
        groups[t].append(k)
    for digest in (exact.sha256, lambda c: F.substring(F.md5(c.cast("binary")), 1, 1)):
        rows = exact.exact_groups(docs, digest=digest).collect()
        assert len(rows) == len(norm)
        for r in rows:
            own = groups[norm[r["doc_id"]]]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (min(own), len(own), r["doc_id"] == min(own))


def test_exact_in_several_batches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    one = sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in exact.exact_groups(docs, files_per_batch=2).collect())
    assert one == sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in exact.exact_groups(docs).collect())


def test_exact_awkward(spark):
    rows = exact.exact_groups(awkward(spark)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert {r["keep_id"] for k in (1, 4) for r in by[k]} == {1} and by[1][0]["group_size"] == 3
    assert sorted(r["kept"] for r in by[5]) == [False, True]
    assert by[2][0]["keep_id"] == 2 and by[3][0]["keep_id"] == 2 and by[2][0]["group_size"] == 3
    assert not any(r["kept"] for r in by[None])
    assert exact.exact_groups(nothing(spark)).count() == 0
    assert sorted(r["kept"] for r in exact.exact_groups(all_null(spark)).collect()) == [False, False, True]
    once = spark.createDataFrame([(1, "a b", "x"), (1, "a  b", "y"), (1, "a b", "z"), (None, "c", "x"), (None, "c", "w")], "doc_id long, text string, note string")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in exact.drop_copies(once).collect()) in ([(0, "c"), (1, "a b")], [(0, "c"), (1, "a  b")])
    kept = exact.drop_copies(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5, 6, 7, 8, 9, 10]


@pytest.mark.parametrize("digest", [exact.sha256, lambda c: F.substring(F.md5(c.cast("binary")), 1, 1)], ids=["whole", "weak"])
def test_later_deliveries_are_held_against_earlier_ones(spark, digest):
    folder = new_path(spark, "deliveries")
    norm, held = {}, {}
    for n, rows in enumerate([[(k, f"text  {k % 30}") for k in range(20, 60)], [(k, f"text {k % 50}") for k in range(20)] + [(200, "text 7"), (None, "new")], [(300, "new"), (301, "text 55"), (302, "newer")]]):
        path = new_path(spark, "delivery")
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
        out = exact.exact_groups(spark.read.parquet(path), digest=digest, folder=folder).collect()
        assert len(out) == len(rows)
        for k, t in rows:
            norm.setdefault(RUN.sub(" ", t), []).append((n, k is None, k))
        held |= {t: min(v)[2] for t, v in norm.items()}
        text = dict(rows)
        for r in out:
            own = RUN.sub(" ", text[r["doc_id"]])
            assert r["keep_id"] == held[own] and r["group_size"] == len(norm[own])
            assert r["kept"] == (min(norm[own]) == (n, r["doc_id"] is None, r["doc_id"]))


def test_a_delivery_that_broke_off_is_not_counted(spark, monkeypatch):
    folder = new_path(spark, "deliveries")
    put = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")

    def delivered(rows):
        path = new_path(spark, "delivery")
        put(rows).write.parquet(path)
        return sorted(tuple(r)[:4] for r in exact.exact_groups(spark.read.parquet(path), folder=folder).select("doc_id", "keep_id", "group_size", "kept").collect())

    assert delivered([(1, "a"), (2, "b")]) == [(1, 1, 1, True), (2, 2, 1, True)]
    bad = put([(3, "a"), (4, "c")]).select(F.col("doc_id").alias("id"), F.col("text").alias("norm"), F.lit(0).cast("long").alias("content"), F.raise_error(F.lit("lost")).alias("locator"))
    with pytest.raises(Exception, match="lost"):
        exact.deliver(bad, folder)
    assert delivered([(5, "a"), (6, "c"), (7, "c")]) == [(5, 1, 2, False), (6, 6, 2, True), (7, 6, 2, False)]


def brute_lines(docs: dict, least=40, often=5):
    key = lambda x: re.sub("[A-Z]+", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    found = defaultdict(set)
    for k, t in docs.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                found[key(line)].add(k)
    out = {}
    for k, t in docs.items():
        own = (t or "").split("\n")
        kept = [x for x in own if len(found.get(key(x), ())) < often or max(found[key(x)]) == k]
        out[k] = (len(own), len(own) - len(kept), "\n".join(kept))
    return out


def test_lines_against_brute_force(spark):
    want = brute_lines(texts(spark))
    for options in ({}, {"bits": 1 << 12, "range_lines": 500}):
        rows = lines.dedup_lines(spark.read.parquet(f"{SF}/documents.parquet"), **options).collect()
        assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in rows} == want
    rows = lines.op2_line_dedup(spark, SF).collect()
    assert all(r["kept_sha256"] == hashlib.sha256(want[r["doc_id"]][2].encode()).hexdigest() for r in rows)


def test_filters_that_are_not_broadcast_say_the_same(spark, monkeypatch):
    want = brute_lines(texts(spark))
    monkeypatch.setattr(lines, "sided", lambda df: df)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = lines.dedup_lines(spark.read.parquet(f"{SF}/documents.parquet"), bits=1 << 12, range_lines=300).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in rows} == want


def test_common_line_stays_in_the_largest_key(spark):
    docs = spark.createDataFrame([(k, f"own {k}\n  {LONG_LINE.upper() if k % 2 else LONG_LINE}\t\n{LONG_LINE}") for k in range(9)], "doc_id long, text string")
    out = {r["doc_id"]: (r["n_dropped"], r["kept_text"]) for r in lines.dedup_lines(docs.repartition(3)).collect()}
    assert out[8][0] == 0 and all(out[k] == (2, f"own {k}") for k in range(8))
    assert all(r["n_dropped"] == 0 for r in lines.dedup_lines(docs, min_docs=10).collect())


def test_lines_awkward(spark):
    out = lines.dedup_lines(awkward(spark))
    assert out.count() == awkward(spark).count()
    assert {(r["n_lines"], r["kept_text"]) for r in out.where("text IS NULL").collect()} == {(1, "")}
    assert lines.dedup_lines(nothing(spark)).count() == 0


def test_ranges_find_what_is_seen_twice(spark):
    h = [k * 7919 for k in range(1, 5001)]
    df = spark.createDataFrame([([x],) for x in [*h, *h[:50], *h[:3]]], "hashes array<long>").repartition(7)
    for ranges in (10, 5053):
        found = [r["h"] for r in lines.suspected(df, 1 << 16, 5053 // ranges).collect()]
        times = Counter(found)  # each place of a suspected hash comes back
        assert all(times[x] == 2 + (x in h[:3]) for x in h[:50]) and len(times) < 150


def test_a_text_of_many_common_lines_is_linear(spark):
    common = [f"{LONG_LINE} number {k}" for k in range(20_000)]
    docs = spark.createDataFrame([(k, "\n".join(common)) for k in range(5)] + [(9, common[7] + "\nown")], "doc_id long, text string")
    out = {r["doc_id"]: (r["n_dropped"], len(r["kept_text"])) for r in lines.dedup_lines(docs.repartition(2)).collect()}
    assert out[9] == (0, len(common[7]) + 4) and out[4][0] == 1 and all(out[k] == (20_000, 0) for k in range(4))


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += line in seen and bool(line.strip(" \t\n\x0b\x0c\r"))
        seen.add(line)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


@pytest.mark.parametrize("text", [None, "", "a", "a b c d e", "a b c d e a b c d e", "x " * 30, "p q r s t u p q r s t v", "l\nl\n\nl\n \n ", "a b a b a b a b c", "é#\x85ü \x1c| <>&"])
def test_counts_of_small_texts(text):
    assert quality.text_counts(text) == brute_counts(text)


def test_quality_against_brute_force(spark):
    rows = quality.op5_quality_rules(spark, SF).collect()
    all_texts = texts(spark)
    assert len(rows) == len(all_texts)
    for r in rows:
        want = brute_counts(all_texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
    verdicts = brute_verdicts({r["doc_id"]: (r["source"], brute_counts(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()})
    assert {r["doc_id"]: r["kept"] for r in rows} == verdicts
    assert any(not r["kept"] and not r["base_failed"] for r in rows)  # symbols count, as hosts are believed


def rules_of(c):
    return {"few_words": c[0] < 10, "repeats": 100 * c[4] > 20 * c[0], "symbols": 100 * c[2] > 10 * c[1], "dup_lines": c[3] >= 5}


def brute_verdicts(docs):
    """Host verdicts reckoned host by host, each against a prior fitted to lists of the others' rates."""
    hosts = defaultdict(list)
    for source, c in docs.values():
        hosts[source].append(rules_of(c))
    rejected, believed = set(), set()
    for h, own in hosts.items():
        others = [v for k, v in hosts.items() if k != h]
        for rule in ("few_words", "repeats", "symbols", "dup_lines"):
            rates = [sum(x[rule] for x in v) / len(v) for v in others]
            mean = sum(rates) / len(rates)
            chance = sum(mean * (1 - mean) / len(v) for v in others) / len(others)
            spread = sum((x - mean) ** 2 for x in rates) / len(rates) - chance
            total = sum(map(len, others))
            strength = min(max(mean * (1 - mean) / spread - 1, 1), total) if spread > 1e-12 else total
            k, n = sum(x[rule] for x in own), len(own)
            rate = (k + mean * strength) / (n + strength)
            lower = max(rate - 1.645 * (rate * (1 - rate) / (n + strength + 1)) ** 0.5, 0)
            if lower > 0.5 and lower / (1 - lower + 1e-15) > 2 * mean / (1 - mean + 1e-15):
                rejected.add(h)
            if rate >= 0.02:
                believed.add((h, rule))
    out = {}
    for k, (source, c) in docs.items():
        r = rules_of(c)
        out[k] = not (r["few_words"] or r["repeats"] or source in rejected or any(r[x] and (source, x) in believed for x in ("symbols", "dup_lines")))
    return out


def test_a_hot_host_that_fails_throughout_goes_whatever_the_rest_do(spark):
    good, bad = " ".join(f"w{k}" for k in range(30)), "### $$$ %%% &&& " * 5 + good_tail
    rows = [(k, bad, "hot") for k in range(500)] + [(1000 + k, bad if k % 4 == 0 else good, f"h{k % 10}") for k in range(1000)]
    rows += [(5000 + k, bad if k % 2 else good, "half") for k in range(200)] + [(6000 + k, good, "clean") for k in range(300)] + [(7000, bad, "clean")]
    docs = {k: (h, brute_counts(t)) for k, t, h in rows}
    out = {r["doc_id"]: r["kept"] for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out == brute_verdicts(docs)
    assert not any(out[k] for k in range(500)) and all(out[5000 + k] == (k % 2 == 0) for k in range(200))
    assert all(out[6000 + k] for k in range(300)) and not out[1000] and out[1001]


def test_a_bad_host_goes_and_a_small_one_is_given_the_benefit(spark):
    good, bad = " ".join(f"w{k}" for k in range(30)), "### $$$ %%% &&& " * 5 + good_tail
    rows = [(k, good, f"h{k % 10}") for k in range(1000)] + [(2000 + k, bad if k % 20 else good, "junk") for k in range(200)] + [(3000, bad, "tiny"), (3001, good, "tiny"), (3002, good, None)]
    out = {r["doc_id"]: r["kept"] for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(out[k] for k in range(1000)) and not any(out[2000 + k] for k in range(200))
    assert out[3001] and out[3002]


good_tail = " ".join(f"t{k}" for k in range(12))


def test_quality_awkward(spark):
    docs = awkward(spark)
    assert quality.quality(docs).count() == docs.count()
    assert quality.quality(nothing(spark)).count() == 0
    assert not any(r["kept"] for r in quality.quality(all_null(spark)).collect())
    kept = quality.drop_rejected(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect() if r["doc_id"] is not None) == [(False, k) for k in (1, 4, 5, 5, 10)]
    assert quality.drop_rejected(nothing(spark)).count() == 0


@pytest.mark.parametrize("hosts", [["a"], ["a", None], [None], ["a", "b", "c", None]])
def test_quality_sql_with_null_and_single_hosts(spark, tmp_path, hosts):
    import duckdb

    bad, good = "# $ %\n" * 8 + "x", " ".join(f"word{k}" for k in range(30))
    rows = [(k, [good, good + " one", bad + good, "few", None][(k * 7 + k // 5) % 5], hosts[k % len(hosts)]) for k in range(60)]
    rows += [(100 + k, "bad", "c") for k in range(40 if "c" in hosts else 0)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(path)
    got = {r["doc_id"]: tuple(r) for r in quality.op5_quality_rules(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = {r[0]: r for r in con.sql(quality.OP5_SQL).fetchall()}
    assert got == want and len(got) == len(rows)
