import gzip
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docpack.llm import pii, toxicity, warc
from docpack.session import new_path, written
from docpack.sources.archive import file_system
from tests.llm.helpers import all_null, awkward, nothing

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    digits = lambda x: [int(c) for c in x if c.isdigit()]

    def luhn(d):
        return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d[::-1])) % 10 == 0

    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_base_spans_against_plain_patterns(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert pii.base_spans(r["text"] or "") == brute_spans(r["text"] or "")
    rng = random.Random(4)
    for _ in range(4000):
        text = "".join(rng.choice(["a", "Z", "@", ".", "-", "+", " ", "1", "25", "300", "4111 1111 1111 1111", "b@c.d", "192.168.0.1", "+1 (555) 123-4567", "(", ")", "\n", "é", "_%"]) for _ in range(rng.randint(1, 14)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_long_runs_stay_linear():
    for text in ("1" * 300_000, "1." * 100_000, "a" * 300_000 + "@", "@a" * 100_000, "+1 " * 100_000, "a.b@" * 50_000):
        pii.base_spans(text)
        pii.nodes_of(text)


def test_pii_rows(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in pii.op6_pii(spark, SF).collect():
        base = brute_spans(texts[r["doc_id"]])
        told = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert set(filter(None, told.split(","))) <= set(r["spans"].split(","))


def test_other_mentions_of_a_number_take_its_label(spark):
    rng, rows = random.Random(7), []
    for k in range(400):
        body = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(30)]
        body[5] = "4111-1111-1111-1111" if k % 2 else f"user{k}@mail.example.com"
        body[15] = str(rng.randint(1, 99))
        if k == 1:
            body[25] = "4111.1111.1111.1111"  # no pattern knows this form
        if k == 3:
            body[25] = "7222.3333.4444.5555"  # alone, and nothing like it elsewhere
        rows.append((k, " ".join(body)))
    out = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1]["added"].startswith("card:")
    _, a, b = out[1]["added"].split(":")
    assert rows[1][1][int(a) : int(b)] == "4111.1111.1111.1111"
    assert sum(bool(r["added"]) for r in out.values()) <= 2
    assert "<card>" in pii.masked(rows[1][1], out[1]["spans"]) and "4111" not in pii.masked(rows[1][1], out[1]["spans"])


def test_spaced_mentions_and_short_addresses_take_their_labels(spark):
    rng, rows = random.Random(8), []
    forms = ["4111 1111 1111 1111", "+1 415 555 2671", "10.0.0.1"]
    for k in range(600):
        body = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(30)]
        body[5] = body[20] = forms[k % 3]
        rows.append([k, " ".join(body)])
    other = {0: "4111.1111.1111.1111", 1: "1-415-555-2671", 2: "10-0-0-1", 3: "4111  1111  1111  1111"}
    for k, x in other.items():
        rows[k][1] += f" gamma {x} delta"
    rows[5][1] += " gamma 10001 delta"  # the digits of 10.0.0.1, but parted otherwise
    out = {r["doc_id"]: r["added"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = {k: ["".join((kind, ":", rows[k][1][int(a) : int(b)])) for kind, a, b in (x.split(":") for x in v.split(","))] for k, v in out.items() if v}
    assert found == {0: ["card:" + other[0]], 1: ["phone:" + other[1]], 2: ["ip:" + other[2]], 3: ["card:" + other[3]]}


def test_secrets_are_found_with_and_without_a_telling_word(spark):
    rng, rows = random.Random(9), []
    hex_ = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    for k in range(600):
        body = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(30)]
        body[5] = f"password={hex_(18)}" if k % 3 == 0 else f'token = "{hex_(40)}"' if k % 3 == 1 else "version 2.0, page 17 of 1999."
        rows.append((k, " ".join(body)))
    alone = hex_(40)
    rows.append((900, f"alpha beta {alone} gamma"))
    out = {r["doc_id"]: r["added"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[k].startswith("secret:") for k in range(600) if k % 3 < 2) and not any(out[k] for k in range(600) if k % 3 == 2)
    assert out[900] == f"secret:11:{11 + 40}"


def exhaustive(field, text, nodes, label, chain, skip):
    """Marginals by summing over all labellings."""
    L, free = len(pii.LABELS), [k for k in range(len(nodes)) if label[k] < 0]
    own = pii.np.zeros((len(nodes), L))
    for k in free:
        s, e, _, before = nodes[k]
        own[k] = sum(field.unary[f][v] for f, v in enumerate(pii.features(text[s:e], before)))
    p, y = pii.np.zeros((len(nodes), L)), [int(x) for x in label]
    for labels in itertools.product(range(L), repeat=len(free)):
        for k, v in zip(free, labels, strict=True):
            y[k] = v
        w = pii.np.exp(sum(own[k, y[k]] for k in free) + sum(field.chain[y[a], y[b]] for a, b in chain) + sum(field.skip[y[a], y[b]] for a, b in skip))
        for k in free:
            p[k, y[k]] += w
    return {k: p[k] / p[k].sum() for k in free}


@pytest.mark.parametrize("text", ["call 12345 678 or 4111-1111-1111-1111 and 4111.1111.1111.1111 then 9 8 7", "a@b 10.0.0.1 x 10-0-0-1 yy 77 66", "+1 415 555 2671 gamma 14155552671 beta 12 34"])
def test_messages_against_all_labellings(text):
    rng = pii.np.random.default_rng(5)
    field = pii.Field({})
    field.unary = [rng.normal(0, 0.7, u.shape) for u in field.unary]
    field.chain, field.skip = rng.normal(0, 0.7, field.chain.shape), pii.np.diag(rng.uniform(0.5, 2.5, len(pii.LABELS)))
    nodes, label, chain, skip = pii.graph(text, pii.base_spans(text))
    assert skip or chain
    found = field.marginals(text, nodes, label, chain, skip)
    for k, want in exhaustive(field, text, nodes, label, chain, skip).items():
        assert abs(found[k] - want).max() < 2e-3


def test_potentials_are_fitted_to_labels_and_neighbours():
    counts = Counter()
    for k in range(800):
        pii.observe(f"alpha {'4111-1111-1111-1111' if k % 2 else 7} and 4111-1111-1111-1111 gamma {k % 90}", counts)
    field = pii.Field(counts)
    card = pii.LABELS.index("card")
    assert field.skip[card, card] > 2.0  # mentions agree
    text = "4111-1111-1111-1111 or 12"
    p = field.marginals(text, *pii.graph(text, []))
    assert p[0].argmax() == card and p[1].argmax() == 0


def test_similar_mentions_are_joined():
    assert pii.alike("14155552671", "4155552671") and pii.alike("4111111111111111", "4111111111111112") and pii.alike("4111111111111111", "411111111111111")
    assert not pii.alike("4111111111111111", "4222222222222222") and not pii.alike("12345678", "2345678")
    text = "call +1 415 555 2671 or " + "x " * 200 + "4155552671"
    _, _, _, skip = pii.graph(text, pii.base_spans(text))
    assert skip == [(0, 1)]


def test_labels_go_past_any_number_of_mentions():
    n = 60
    field = pii.Field({})
    nodes, label = [(4 * k, 4 * k + 3, k > 0, "") for k in range(n)], pii.np.array([3] + [-1] * (n - 1))
    field.skip = pii.np.eye(len(pii.LABELS)) * 8
    p = field.marginals("123 " * n, nodes, label, [], [(k - 1, k) for k in range(1, n)])
    move = pii.np.exp(field.skip) / pii.np.exp(field.skip).sum(1, keepdims=True)
    assert abs(p[-1] - pii.np.linalg.matrix_power(move, n - 1)[3]).max() < 0.02


def test_field_is_fitted_to_all_documents(spark):
    docs = spark.range(4500).select(F.col("id").alias("doc_id"), F.lit("call 4111-1111-1111-1111").alias("text"))
    assert sum(n for k, n in pii.learn(docs, "text").items() if k[0] == 3) == 4500


def test_pii_awkward(spark):
    assert pii.find_pii(awkward(spark)).count() == awkward(spark).count()
    assert pii.find_pii(nothing(spark)).count() == 0
    assert {r["spans"] for r in pii.find_pii(all_null(spark)).collect()} == {""}


def test_warc_records_go_through_bytes(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r["key"]: r for r in warc.responses(pages).collect()}
    rows = warc.op9_warc(spark, SF).collect()
    assert len(rows) == 2 * len(source)
    data = gzip.decompress(b"".join(gzip.compress(warc.record_bytes(r["headers"], r["content"])) for r in rows))
    parsed = list(warc.parse_records(data))
    assert len(parsed) == len(rows) and len({r["record_id"] for r in rows}) == len(rows)
    for r, (fields, block) in zip(rows, parsed, strict=True):
        own = source[r["page_id"]]
        assert fields["WARC-Type"] == r["record_type"] and fields["WARC-Refers-To"] == own["record_id"] and fields["WARC-Target-URI"] == own["target_uri"]
        assert fields["WARC-Block-Digest"] == warc.digest(block) and block.decode() == r["content"] and int(fields["Content-Length"]) == len(block)
        assert r["payload_digest"] == warc.digest(own["payload"].encode())
        if r["record_type"] == "metadata":
            assert f"source-payload-digest: {own['payload_digest']}" in r["content"] and "http-header-content-type: text/html" in r["content"]


def test_warc_files(spark):
    body = "<title>Ünï</title><p>one <b>two</b>".encode("latin-1")
    packed = gzip.compress(body)
    chunked = b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in (packed[:10], packed[10:])) + b"0\r\n\r\n"
    http = b"HTTP/1.1 203 Fine\r\nServer: own/1\r\nContent-Type: text/html; charset=ISO-8859-1\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip"
    block = http + b"\r\n\r\n" + chunked
    head = lambda kind, own, block, *more: ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in (("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", "2024-02-03T04:05:06Z"), *more, ("Content-Length", len(block)))) + "\r\n").encode() + block + b"\r\n\r\n"
    mime = ("Content-Type", "application/http; msgtype=response")
    records = [head("warcinfo", "<urn:uuid:0>", b"software: x\r\n"), head("response", "<urn:uuid:1>", block, ("WARC-Target-URI", "http://a/"), mime), head("request", "<urn:uuid:2>", b"GET / HTTP/1.1"), head("response", "<urn:uuid:3>", b"HTTP/1.1 200 OK\r\n\r\n", mime)]
    folder = new_path(spark, "warc")
    fs, inner = warc.file_system(folder)
    fs.create_dir(inner, recursive=True)
    with open(f"{inner}/a.warc.gz", "wb") as f:
        f.write(b"".join(map(gzip.compress, records)))
    with open(f"{inner}/b.warc", "wb") as f:
        f.write(records[1].replace(b"uuid:1", b"uuid:9"))
    read = {r["record_id"]: r for r in warc.read_warc(spark, folder).collect()}
    assert set(read) == {"<urn:uuid:1>", "<urn:uuid:3>", "<urn:uuid:9>"}
    own = read["<urn:uuid:1>"]
    assert own["payload"] == body.decode("latin-1") and own["http_headers"] == http.decode() and own["warc_date"] == "2024-02-03T04:05:06Z" and own["payload_digest"] == warc.digest(chunked)
    derived = warc.derivatives(warc.read_warc(spark, folder))
    out = new_path(spark, "derived")
    files = warc.write_warc(derived.repartition(3), out).collect()
    assert sum(r["records"] for r in files) == 6
    found = {}
    for r in files:
        with gzip.open(warc.file_system(r["path"])[1]) as f:
            found |= {(x["WARC-Type"], x["WARC-Refers-To"]): (x, b) for x, b in warc.parse_records(f.read())}
    assert len(found) == 6
    fields, content = found["conversion", "<urn:uuid:1>"]
    assert content.decode() == "one two" and fields["WARC-Date"] == "2024-02-03T04:05:06Z" and fields["Source-Payload-Digest"] == warc.digest(chunked) and fields["WARC-Payload-Digest"] == warc.digest(content) == fields["WARC-Block-Digest"]
    meta = found["metadata", "<urn:uuid:1>"][1].decode()
    assert "http-header-server: own/1" in meta and "title: Ünï" in meta and "source-payload-digest: " + warc.digest(chunked) in meta


def test_pages_go_through_files(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").limit(50)
    rows = [warc.response_record(*[r[c] for c in warc.RESPONSE_COLUMNS]) for r in warc.responses(pages).collect()]
    out = new_path(spark, "pages")
    warc.write_warc(spark.createDataFrame(rows, "headers string, content string"), out).collect()
    back = {r["record_id"]: (r["payload"], r["payload_digest"], r["target_uri"]) for r in warc.read_warc(spark, out).collect()}
    assert back == {r["record_id"]: (r["payload"], r["payload_digest"], r["target_uri"]) for r in warc.responses(pages).collect()}


def test_rows_that_repeat_have_identifiers_of_their_own(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x"), (1, "u", "<p>x"), (2, "u", "<p>x")], "page_id long, url string, html string")
    assert warc.responses(pages).select("record_id").distinct().count() == 3


def test_page_text():
    text, found = warc.page_text('<html lang=de><head><title>A &amp; B</title><style>p{}</style><script>x="</p>";<b></script></head><body><!-- no <p> --><h1>H</h1><p>one<br>two &lt;3<p>a <b>b</b>c <a href="/x?a=1&amp;b">l</a><script>open')
    assert text == "H\none\ntwo <3\na bc l" and found == {"title": "A & B", "lang": "de", "charset": "", "links": ["/x?a=1&b"]}
    assert warc.page_text("<title>A</title><noscript>seen</noscript> <template><p>not</template>here <svg><title>B</title></svg><template>open <p>text")[0] == "seen here\nB\nopen\ntext"
    for bad in ("", "<", "<<<" * 50_000, "<!--" * 20_000, "<script>" * 20_000, "<template>" * 20_000, "a < b > c"):
        warc.page_text(bad)


def test_identifiers_of_repeated_pages_are_the_same_in_every_run(spark):
    rows = [(1, "u", "<p>a</p>")] * 40 + [(2, "u", "<p>a</p>"), (None, None, None), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    ids = lambda df: sorted(r["record_id"] for r in warc.responses(df).collect())
    first = ids(pages.repartition(3))
    assert len(set(first)) == 43 and first == ids(pages.coalesce(1)) == ids(pages.repartition(9))
    assert ids(spark.createDataFrame([rows[0]], pages.schema))[0] in first


def _http(headers, body):
    return b"HTTP/1.1 200 OK\r\n" + headers.encode() + b"\r\n\r\n" + body


@pytest.mark.parametrize(
    "headers, body, text, reason",
    [
        ("Content-Encoding: gzip", b"plain", "plain", "not gzip"),
        ("Content-Encoding: gzip", gzip.compress(b"abc" * 50)[:-12], None, "gzip breaks off"),
        ("Content-Encoding: gzip", gzip.compress(b"one ") + gzip.compress(b"two"), "one two", None),
        ("Content-Encoding: deflate", zlib.compress(b"abc"), "abc", None),
        ("Content-Encoding: deflate", zlib.compress(b"abc")[2:-4], "abc", None),
        ("Content-Encoding: deflate, gzip", gzip.compress(zlib.compress(b"abc")), "abc", None),
        ("Content-Encoding: br", b"x", "x", "content coding br is not known"),
        ("Transfer-Encoding: chunked", b"3\r\nabc\r\nzz\r\n", "abc", "bad chunk size"),
        ("Transfer-Encoding: chunked", b"no chunks", "no chunks", "bad chunk size"),
        ("Transfer-Encoding: chunked", b"-3\r\nabc\r\n", "", None),
        ("Content-Type: text/html; charset=idna", b"a", "a", "charset idna cannot be used"),
        ("Content-Type: text/html; charset=base64", b"a", "a", "charset base64 cannot be used"),
        ("Content-Encoding: gzip", b"", "", None),
    ],
)
def test_bodies_that_are_not_what_their_headers_say(headers, body, text, reason):
    _, payload, found, why = warc.http_parts(_http(headers, body))
    assert payload == body and why == reason and (found == text or text is None)


def test_bodies_without_headers():
    assert warc.http_parts(b"HTTP/1.1 200 OK")[3] == "no end of headers" and warc.http_parts(b"")[1:3] == (b"", "")


def test_damaged_files_are_read_as_far_as_they_go(spark):
    path = new_path(spark, "damaged")
    fs, inner = file_system(path)
    fs.create_dir(inner, recursive=True)

    def record(k, body):
        block = _http("Content-Type: text/html", body)
        return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:{k}>\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    files = {
        "a.warc": record(1, b"one") + record(2, b"two")[:-20],
        "b.warc": record(3, "é".encode()) + b"nonsense\r\n" + record(4, b"four"),
        "c.warc.gz": gzip.compress(record(5, b"five")) + gzip.compress(record(6, b"six" * 100))[:-40],
        "d.warc": b"WARC/1.1\r\nWARC-Type: response\r\n\r\n",
        "e.warc": b"",
    }
    for name, data in files.items():
        with open(f"{inner}/{name}", "wb") as f:
            f.write(data)
    read = warc.read_warc(spark, path)
    rows = read.collect()
    good = {r["record_id"]: (r["payload"], r["payload_length"], r["reason"]) for r in rows if r["record_id"]}
    assert good == {"<urn:1>": ("one", 3, None), "<urn:3>": ("é", 2, None), "<urn:5>": ("five", 4, None)}
    bad = sorted(r["reason"] for r in rows if not r["record_id"])
    assert len(bad) == 4 and all(f"{n}.warc" in x for n, x in zip("abcd", bad, strict=True))
    derived = warc.derivatives(read)
    assert derived.count() == 6
    assert "source-payload-length: 2\r\n" in derived.where("refers_to = '<urn:3>' AND record_type = 'metadata'").first()["content"]


def test_warc_awkward(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "http://x/\r\nEvil: 1", ""), (2, "http://y", "<p>퟿\U0001f600" + "z" * 100_000)], "page_id long, url string, html string").withColumns({"key": F.lit("k"), "payload": F.lit("p"), "record_id": F.lit("r")})
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 6
    assert len(list(warc.parse_records(b"".join(warc.record_bytes(r["headers"], r["content"]) for r in rows)))) == 6
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_segments_against_all_intervals(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 25)
    scores = [rng.choice([None, 1.0, 2.5, 0.4]) if rng.random() < 0.5 else None for _ in range(n)]
    line = [-0.45 if s is None else s for s in scores]
    found = toxicity.segments(line)

    def split(lo, hi):  # the best interval first, then what lies on both sides of it
        best = max(((sum(line[a:b]), -(b - a), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        return [*split(lo, best[2]), (best[2], best[3] - 1, best[0]), *split(best[3], hi)]

    want = split(0, n)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
    assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(found, want, strict=True))


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = toxicity.op10_toxicity(spark, sf).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    own = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels and r["held_out"]]
    hit = sum(p and y for p, y in own)
    # 5 of the 14 toxic rows hold no word that any training row tells of
    assert hit >= 0.6 * sum(y for _, y in own) and hit >= 0.85 * sum(p for p, _ in own)


def test_words_are_chosen_by_their_likelihood_ratio():
    counts = {"vile": (25, 0), "vile*": (25, 0), "even": (20, 80), "even*": (20, 80), "lowe*": (300, 2), "lowei*": (300, 0), "lowell": (0, 2), "lowell*": (0, 2), "kind": (0, 900), "kind*": (0, 900)}
    picked = toxicity.chosen(counts, 1000, 4000, 20.0)
    assert set(picked) == {"vile*", "lowe*", "kind*"}  # nothing more is told by what lies below them
    odds = toxicity.log_odds(counts, {f: sum(c) / 5000 for f, c in counts.items()}, 1000, 4000, 20.0, 1000.0)
    assert odds["vile*"] > 1 and odds["lowe*"] > 3 and odds["kind*"] < -1
    scores = toxicity.Scores(odds, 0.1)
    assert scores["lowening".encode()] == odds["lowe*"] - 0.1 and scores["neutral".encode()] == -0.1


def test_odds_against_a_direct_reckoning():
    t, c, toxic, clean, share = 30, 10, 100, 400, 0.05
    n, q = t + c, toxic / (toxic + clean)
    ratio = 2 * (t * math.log(t / (n * q)) + c * math.log(c / (n * (1 - q))))
    raw = math.log((t + 1000 * share * q + 1e-3 * q) / (c + 1000 * share * (1 - q) + 1e-3 * (1 - q))) - math.log(toxic / clean)
    got = toxicity.log_odds({"word": (t, c)}, {"word": share}, toxic, clean, 12.0, 1000.0)["word"]
    assert abs(got - raw * (1 - 12.0 / ratio)) < 1e-9


def test_tail_rate_solves_its_equation():
    import numpy as np

    s, p = np.array([5.0, 1.0, -0.1, -2.0]), np.array([0.001, 0.01, 0.889, 0.1])
    rate = toxicity.tail_rate(s, p)
    assert abs(np.sum(p * np.exp(rate * s)) - 1) < 1e-6 and rate > 0


def test_unseen_words_take_the_score_of_their_prefix(spark):
    rng = random.Random(3)
    rows = [(k, " ".join([f"w{rng.randint(0, 500)}" for _ in range(20)] + ([f"grobi{rng.randint(0, 10**6)}"] if k % 5 == 0 else []))) for k in range(1000)]
    docs = spark.createDataFrame([*rows, (5000, "w1 w2 grobixyz w3"), (5001, "w1 w2 w3")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(1000)], "doc_id long, toxic int"))
    out = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, model).collect()}
    assert out[5000] > 0.5 > 0.3 > out[5001]


def test_a_sentence_without_spaces_is_one_word():
    assert toxicity.words_of("これは文です") == ["これは文です".encode()]
    model = toxicity.Model({"これは文*": 6.0, "vile": 5.0})
    assert model.score("これは文ではない")[0] == model.score("これは文です")[0] > model.score("別の文です")[0] == model.score("neutral")[0]


def test_toxicity_awkward(spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (7, None), (7, 1)], "doc_id long, toxic int")
    model = toxicity.fit(awkward(spark), labels)
    out = toxicity.toxicity(awkward(spark), model)
    assert out.count() == awkward(spark).count() and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    empty = toxicity.fit(nothing(spark), labels.limit(0))
    assert toxicity.toxicity(nothing(spark), empty).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], SF), name))
    assert all(k.columns == docs.columns for k in kept[:-1])
    rules, exact, near, mixed, packed = kept[1:]
    assert rules.join(exact, "doc_id", "left_anti").count() > 0 or exact.count() == rules.count()
    norm = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    assert exact.select(norm).distinct().count() == exact.count() == rules.select(norm).distinct().count()
    from tests.llm.test_near_packing import brute_classes

    classes = brute_classes({r["doc_id"]: r["text"] for r in exact.collect()})
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(k for k, v in classes.items() if k == v)
    assert mixed.groupBy("doc_id").count().where("count > 3").count() == 0 and mixed.count() > 0
    assert packed.where("piece = 0").count() == mixed.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(map(tuple, packed.select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_every_similar_key_is_joined():
    from docpack.llm import pii

    # the similar key is not the last one with these first or last characters
    text = "415555012345 is one, 415577777777 and 888888012345 are others, 415555012346 is like the first"
    nodes, _, _, skip = pii.graph(text, [])
    at = {text[s:e]: n for n, (s, e, _, _) in enumerate(nodes)}
    assert (at["415555012345"], at["415555012346"]) in skip
    rng = random.Random(5)
    keys = {"".join(rng.choice("ab1") for _ in range(rng.randrange(7, 14))) for _ in range(300)} | {"x" * n for n in range(5, 20)} | {"é" * 9, "é" * 8 + "1"}
    found = pii.kin(keys)
    assert {(a, b) for a, own in found.items() for b in own} == {(a, b) for a in keys for b in keys if a != b and pii.alike(a, b)}
