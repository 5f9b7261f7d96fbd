"""Personal data: patterns, and a skip-chain conditional random field that adds spans.

Patterns find the base spans. Base spans and the other tokens with a digit or an ``@`` are nodes of a random field over the
labels none, email, ip, card, phone and secret; neighbouring tokens that together have the letters and digits of a base span
are one node. Neighbours are joined by chain edges; nodes of equal or similar letters and digits, however far apart, by
skip edges. Base spans are observed. Loopy message passing spreads labels over the document until messages stay, so that a
number written in another form than the patterns know takes the label of its other mentions.

Potentials are fitted by pseudo-likelihood to the nodes of all documents: each node given its features and the labels of its
neighbours, and once more with its features hidden, so that chain and skip edges are learned also where features tell enough.
Labels to learn from are the base spans, passwords and keys that stand in a well-known form (``SEEDS``; they are taught only, never
looked up when spans are found), and none for short tokens; nodes that may be either are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpack.llm.text import SPACES

KINDS = ["email", "ip", "card", "phone"]
NAMES = [*KINDS, "secret"]
LABELS = ["none", *NAMES]
SECRET, UNKNOWN = 5, 6
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
# a match begins at the first digit of a run, so looking behind changes no match and keeps long runs linear
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NODE = re.compile(r"[0-9@]+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
BLANK = str.maketrans(SPACES, " " * len(SPACES))
GROUP = re.compile(r"(?:[^\W_]|@)+")
# fixed values: words before a secret, and forms of keys that services give out
SECRET_WORDS = frozenset("password passwd pwd secret token key apikey api_key access_key secret_key auth bearer".split())
SEEDS = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{35}")
LEFT = re.compile(r"[A-Za-z][A-Za-z_.-]*[=:][\"']?(?=[^=:]{8})")
CUES = 64
RUN = 64


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all base spans, leftmost and non-overlapping per kind, in order."""
    out = []
    if "@" in text:
        last = 0
        for m in HOST.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < m.start():
                out.append((start, 0, m.end()))
                last = m.end()
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def nodes_of(text: str) -> list[tuple[int, int, bool, str]]:
    """(start, end, joined to the node before, word before) of each token with a digit or an ``@``, trimmed of outer marks."""
    plain, out, last = text.translate(BLANK), [], 0
    for m in NODE.finditer(plain):
        if m.start() < last:
            continue
        a = plain.rfind(" ", last, m.start()) + 1 or last
        b = plain.find(" ", m.end())
        b = len(plain) if b < 0 else b
        gap = plain[last:a]
        before = [w for w in gap[-40:].split() if any(map(str.isalpha, w))][-1:]
        joined = bool(out) and not gap.strip()
        s, e = a, b
        while s < e and plain[s] in "\"'([{<,;:":
            s += 1
        while e > s and plain[e - 1] in "\"')]}>.,;:!?*#$&%":
            e -= 1
        if m2 := LEFT.match(plain, s, e):  # what stands before = or : is the word before
            before, s = [plain[s : m2.end()].rstrip("\"'=:")], m2.end()
        if s < e:
            out.append((s, e, joined, "" if not before or (joined and not m2) else before[0].lower()))
        last = b
    return out


def _step(n: int, bounds: tuple[int, ...]) -> int:
    return sum(n >= x for x in bounds)


def features(token: str, before: str) -> tuple[int, ...]:
    """Bounded features: digits, letters, marks, changes between digits and letters, case, Luhn's sum, and a hash of the word before."""
    digits, letters = sum(map(str.isdigit, token)), sum(map(str.isalpha, token))
    marks = sum(1 << k for k, c in enumerate("@.-+") if c in token)
    plain = [c.isdigit() for c in token if c.isalnum()]
    changes = sum(x != y for x, y in zip(plain, plain[1:], strict=False))
    case = 0 if not letters else 1 if token.islower() else 2 if token.isupper() else 3
    sum_ = 0 if letters or not 14 <= digits <= 19 else 1 if luhn("".join(c for c in token if c.isdigit())) else 2
    cue = int(hashlib.md5(before.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) % CUES if before else CUES
    return _step(digits, (1, 4, 8, 10, 14, 17, 20)), _step(letters, (1, 3, 8, 16)), marks, _step(changes, (2, 5)), case, sum_, cue


WIDTHS = (8, 5, 16, 3, 4, 3, CUES + 1)


def taught(token: str, before: str) -> int:
    """The label to learn from of a node that is no base span: secret, none, or unknown where it may be either."""
    digits, letters = sum(map(str.isdigit, token)), sum(map(str.isalpha, token))
    if SEEDS.fullmatch(token) or (before in SECRET_WORDS and len(token) >= 12 and digits >= 2 and letters >= 2):
        return SECRET
    if "@" in token or (digits and letters and len(token) >= 16):
        return UNKNOWN
    if digits < 9:
        return UNKNOWN if token.count(".") == 3 or token.count("-") == 3 else 0
    return 0 if features(token, before)[5] == 2 else UNKNOWN


def similar(token: str) -> str:
    """What nodes must share to be joined by a skip edge: letters, digits and ``@``.

    Fewer than 7 of them must also be parted alike, in four groups (an address such as 10.0.0.1) or with an ``@``; other short
    ones are joined to none.
    """
    return shared(GROUP.findall(token.lower()))


def shared(groups: list[str]) -> str:
    key = "".join(groups)
    if len(key) >= 7:
        return key
    return ".".join(groups) if len(groups) >= 4 or "@" in key else ""


def alike(a: str, b: str) -> bool:
    """Keys of 9 characters or more of which one ends with the other, or that differ by one edit."""
    if min(len(a), len(b)) < 9:
        return False
    if a.endswith(b) or b.endswith(a):
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k + 1 :] == b[k:] or a[k:] == b[k + 1 :]


BASE, UNDO = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def kin(keys: Iterable[str]) -> dict[str, list[str]]:
    """Of each key all others it is ``alike``, with work in proportion to the keys' characters and to the pairs.

    Keys that differ by one edit are equal when a character is left out of one or of both at the same place, so hashes of keys
    without each of their characters meet; keys that end with others are neighbours when sorted from their ends.
    """
    long = sorted({k for k in keys if len(k) >= 9})
    if len(long) < 2:
        return {}
    pairs: set[tuple[str, str]] = set()
    met: dict[tuple[int, int, int], list[str]] = {}
    whole: dict[int, list[str]] = {}
    without: list[tuple[str, np.ndarray]] = []
    for k in long:
        code = np.array([ord(c) for c in k], np.uint64) + np.uint64(1)
        powers = np.full(len(k), BASE, np.uint64)
        powers[0] = 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * np.multiply.accumulate(powers), dtype=np.uint64)])
        less = sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(UNDO)
        for place, h in enumerate(less.tolist()):
            met.setdefault((len(k), place, h), []).append(k)
        whole.setdefault(int(sums[-1]), []).append(k)
        without.append((k, less))
    for group in met.values():
        if len(group) > 1:
            pairs.update((a, b) for n, a in enumerate(group) for b in group[n + 1 :] if alike(a, b))
    for k, less in without:
        for h in set(less.tolist()) & whole.keys():
            pairs.update((min(k, x), max(k, x)) for x in whole[h] if x != k and alike(k, x))
    above: list[str] = []
    for k in sorted(long, key=lambda x: x[::-1]):
        while above and not k.endswith(above[-1]):
            above.pop()
        pairs.update((min(k, x), max(k, x)) for x in above)
        above.append(k)
    out: dict[str, list[str]] = {}
    for a, b in sorted(pairs):
        out.setdefault(a, []).append(b)
        out.setdefault(b, []).append(a)
    return out


def units(text: str, base: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, bool, str]], np.ndarray, list[str]]:
    """Nodes as those of ``nodes_of``, their observed labels (-1: none) and keys, in order.

    Each base span is one node (of two that overlap and share a key, the first). Of the tokens that touch no base span,
    the longest run of neighbours that has the key of a base span is one node, for keys of up to ``RUN`` characters; each
    other token is a node.
    """
    tokens, spans = nodes_of(text), sorted(base)
    out: list[tuple[int, int, bool, str, int, str]] = []
    free, k, reach = [], 0, 0
    keys: set[str] = set()
    last: dict[str, int] = {}
    for n, (s, e, joined, before) in enumerate(tokens):
        first = True
        while k < len(spans) and spans[k][0] < e:
            a, kind, b = spans[k]
            key = similar(text[a:b])
            if not key or last.get(key, 0) <= a:
                inner = not first or reach > s
                out.append((a, b, inner or joined, "" if inner else before, kind + 1, key))
                first = False
            last[key] = max(last.get(key, 0), b)
            keys.add(key)
            reach = max(reach, b)
            k += 1
        if reach <= s:
            free.append(n)
    keys.discard("")
    heads = {x[:4] for x in keys if len(x) <= RUN}
    groups = [GROUP.findall(text[tokens[n][0] : tokens[n][1]].lower()) for n in free]
    at = 0
    while at < len(free):
        s, e, joined, before = tokens[free[at]]
        end, key, own = at, shared(groups[at]), list(groups[at])
        size = sum(map(len, own))
        j = at + 1
        while heads and j < len(free) and free[j] == free[j - 1] + 1 and tokens[free[j]][2]:
            own += groups[j]
            size += sum(map(len, groups[j]))
            if size > RUN or (size >= 7 and "".join(own)[:4] not in heads):
                break
            if (found := shared(own)) in keys:
                end, key = j, found
            j += 1
        out.append((s, tokens[free[end]][1], joined, before, -1, key))
        at = end + 1
    out.sort(key=lambda x: x[:2])
    return [x[:4] for x in out], np.array([x[4] for x in out], int), [x[5] for x in out]


def graph(text: str, base: list[tuple[int, int, int]]):
    """Nodes, their observed labels (-1: none) and chain and skip edges.

    Each mention is joined to the one before it, and to the last observed one before it or else to the first after it. A
    mention is joined also to the last one, and to the last observed one, of every similar key (``kin``) that came after the
    mention of its own key before it; what came earlier is joined to that one.
    """
    nodes, label, keys = units(text, base)
    chain = [(n - 1, n) for n in range(1, len(nodes)) if nodes[n][2]]
    seen: dict[str, int] = {}
    observed: dict[str, int] = {}
    waiting: dict[str, list[int]] = {}
    near = kin(keys)
    skip = []
    for n, key in enumerate(keys):
        if not key:
            continue
        if key in seen:
            skip.append((seen[key], n))
        if label[n] >= 0:
            skip += [(x, n) for x in waiting.pop(key, []) if x != seen[key]]
            observed[key] = n
        elif key not in observed:
            waiting.setdefault(key, []).append(n)
        elif observed[key] != seen[key]:
            skip.append((observed[key], n))
        own = seen.get(key, -1)
        skip += [(m, n) for m in sorted({m for k in near.get(key, ()) for m in (seen.get(k, -1), observed.get(k, -1)) if m > own})]
        seen[key] = n
    return nodes, label, chain, skip


def observe(text: str, counts: Counter) -> None:
    """Adds to ``counts`` the nodes to learn from: label, labels of the neighbours before and behind and of two similar ones, features."""
    base = base_spans(text)
    nodes, label, chain, skip = graph(text, base)
    y = [int(label[n]) if label[n] >= 0 else taught(text[s:e], before) for n, (s, e, _, before) in enumerate(nodes)]
    last, following = {b: a for a, b in chain}, dict(chain)
    linked: dict[int, list[int]] = {}
    for a, b in skip:
        linked.setdefault(a, []).append(y[b])
        linked.setdefault(b, []).append(y[a])
    for n, (s, e, _, before) in enumerate(nodes):
        if y[n] != UNKNOWN:
            others = sorted(linked.get(n, []))[:2]
            around = (y[last[n]] if n in last else UNKNOWN, y[following[n]] if n in following else UNKNOWN, *others, *[UNKNOWN] * (2 - len(others)))
            counts[(y[n], *around, *features(text[s:e], before))] += 1


class Field:
    """Log potentials: of features, of neighbours, and of similar nodes that agree."""

    def __init__(self, counts: dict[tuple[int, ...], int], steps: int = 300, prior: float = 1.0):
        """Fitted to ``counts`` (as of ``observe``) by pseudo-likelihood with weak Gaussian priors, whose mean is ``prior`` for agreement and 0 else."""
        L = len(LABELS)
        self.unary = [np.zeros((w, L)) for w in WIDTHS]
        self.chain, agree = np.zeros((L, L)), np.full(L, prior)
        if counts:
            rows = np.array(sorted(counts), int)
            n = np.array([counts[tuple(r)] for r in rows.tolist()], float)
            self._fit(rows, n / n.sum(), agree, steps, prior, 1.0 / n.sum())
        self.skip = np.diag(agree)

    def _fit(self, rows: np.ndarray, n: np.ndarray, agree: np.ndarray, steps: int, prior: float, weak: float) -> None:
        L = len(LABELS)
        y, before, behind, f = rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 5:]
        links = np.stack([(rows[:, [c]] == np.arange(L)).astype(float) for c in (3, 4)]).sum(0)
        truth = np.eye(L)[y]
        a, b = before != UNKNOWN, behind != UNKNOWN
        edges = np.flatnonzero(a | b | links.any(1))  # rows with neighbours are learned from once more without features
        parts = [*self.unary, self.chain, agree]
        moment, square = [np.zeros_like(x) for x in parts], [np.zeros_like(x) for x in parts]
        for t in range(1, steps + 1):
            around = links * agree
            around[a] += self.chain[before[a]]
            around[b] += self.chain[:, behind[b]].T
            own = sum(u[f[:, k]] for k, u in enumerate(self.unary))
            seen = (_softmax(own + around) - truth) * n[:, None]
            hidden = np.zeros_like(seen)
            hidden[edges] = (_softmax(around[edges]) - truth[edges]) * n[edges, None]
            both = seen + hidden
            slopes = []
            for k, u in enumerate(self.unary):
                g = weak * u
                np.add.at(g, f[:, k], seen)
                slopes.append(g)
            g = weak * self.chain
            np.add.at(g, before[a], both[a])
            np.add.at(g.T, behind[b], both[b])
            slopes += [g, (both * links).sum(0) + weak * (agree - prior)]
            for x, g, m, v in zip(parts, slopes, moment, square, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
            np.maximum(agree, 0.0, out=agree)

    def marginals(self, text: str, nodes, label, chain, skip, rounds: int | None = None) -> np.ndarray:
        """Beliefs of all nodes by damped loopy message passing, until no message changes, or for ``rounds``.

        Without ``rounds`` there are two for each node and 20 more at most: damped messages pass the longest path in them.
        Observed nodes send the same messages always, and only messages with changed sources are reckoned again.
        """
        n, L = len(nodes), len(LABELS)
        own = np.zeros((n, L))
        for k, (s, e, _, before) in enumerate(nodes):
            if label[k] < 0:
                for f, v in enumerate(features(text[s:e], before)):
                    own[k] += self.unary[f][v]
        edges = chain + skip
        if edges:
            a, b = np.array(edges).T
            pot = np.concatenate([np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)])
            src, dst = np.concatenate([a, b]), np.concatenate([b, a])
            pot = np.concatenate([pot, pot.transpose(0, 2, 1)])
            known = label[src] >= 0
            np.add.at(own, dst[known], pot[np.flatnonzero(known), label[src[known]]])
            both = np.flatnonzero((label[a] < 0) & (label[b] < 0))
            keep = np.concatenate([both, both + len(a)])
            src, dst, pot = src[keep], dst[keep], pot[keep]
            back = np.concatenate([np.arange(len(both)) + len(both), np.arange(len(both))])
            sent = np.zeros((len(src), L))
            live = np.arange(len(src))
            for _ in range(20 + 2 * n if rounds is None else rounds):
                if not len(live):
                    break
                out = (own[src[live]] - sent[back[live]])[:, :, None] + pot[live]
                top = out.max(1, keepdims=True)
                new = (top + np.log(np.exp(out - top).sum(1, keepdims=True)))[:, 0]
                new -= new.max(1, keepdims=True)
                step = 0.5 * (new - sent[live])
                sent[live] += step
                np.add.at(own, dst[live], step)
                moved = live[np.abs(step).max(1) >= 5e-4]
                changed, again = np.zeros(n, bool), np.zeros(len(src), bool)
                changed[dst[moved]] = True
                again[moved] = True
                live = np.flatnonzero(again | changed[src])
        own -= own.max(1, keepdims=True)
        p = np.exp(own)
        p /= p.sum(1, keepdims=True)
        p[label >= 0] = np.eye(L)[label[label >= 0]]
        return p

    def added(self, text: str, base: list[tuple[int, int, int]], least: float = 0.9) -> list[tuple[int, int, int]]:
        """Spans of nodes whose belief in a kind is at least ``least`` and that touch no base span; neighbours of one kind are one span, but for secrets."""
        nodes, label, chain, skip = graph(text, base)
        if not (label < 0).any():
            return []
        p = self.marginals(text, nodes, label, chain, skip)
        out: list[tuple[int, int, int]] = []
        for n in np.flatnonzero((label < 0) & (p[:, 1:].max(1) >= least)):
            s, e, joined, _ = nodes[n]
            kind = int(p[n, 1:].argmax())
            if joined and out and out[-1][1] == kind != SECRET - 1 and out[-1][2] >= nodes[n - 1][1]:
                out[-1] = (out[-1][0], kind, e)
            else:
                out.append((s, kind, e))
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def learn(docs: DataFrame, text: str, most: int = 100_000) -> dict[tuple[int, ...], int]:
    """Counts of the nodes of all documents by label, neighbours and features: the ``most`` frequent combinations are fitted to.

    Combinations rarer than these teach nothing (of equal ones, those that sort later); nodes that have them are labelled like all others.
    """

    def told(counts: Counter) -> pd.DataFrame:
        out = pd.DataFrame({"node": [list(k) for k in counts], "n": list(counts.values())})
        counts.clear()
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch["text"]:
                if t and NODE.search(t):
                    observe(t, counts)
            if len(counts) > 100_000:
                yield told(counts)
        if counts:
            yield told(counts)

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInPandas(run, "node array<int>, n long")
    found = rows.groupBy("node").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "node").limit(most)
    return {tuple(r["node"]): r["n"] for r in found.collect()}


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in spans)


def find_pii(docs: DataFrame, text: str = "text", key: str = "doc_id", most: int = 100_000, least: float = 0.9) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``added`` (spans as text), and the count of base spans by kind.

    Offsets are code points of the whole text, end exclusive. Null and empty texts have no spans; repeated rows have one row
    each, with the same spans. The field is fitted to all documents (``learn``); base spans are never changed. An empty table
    gives an empty result, and other columns are ignored.
    """
    field_ = Field(learn(docs, text, most))
    shared = docs.sparkSession.sparkContext.broadcast(field_)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = shared.value
        for batch in batches:
            rows = []
            for t in batch["text"]:
                base = base_spans(t) if t else []
                added = field.added(t, base, least) if t and NODE.search(t) else []
                n = Counter(k for _, k, _ in base)
                rows.append((*[n[k] for k in range(4)], told(base), told(added), told(sorted(base + added))))
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "added", "spans"])], axis=1)

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInPandas(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base string, added string, spans string")


def masked(text: str, spans: str) -> str:
    """``text`` with each span of ``spans`` replaced by its kind in angle brackets; overlapping spans are masked as one."""
    out, at = [], 0
    for kind, a, b in sorted(((k, int(a), int(b)) for k, a, b in (x.split(":") for x in spans.split(",") if x)), key=lambda x: x[1]):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op6_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
