"""Personal data: base patterns, then a skip-chain conditional random field.

Base spans come from four fixed patterns (leftmost, non-overlapping per kind;
matches that fail their test are dropped, not retried).  They are written so
that no text makes them slow: repeats that cannot give way are possessive,
and an e-mail is looked for from its ``@``.

The random field then labels the other *candidates* of a document: tokens
with a digit or ``@``, and runs of digit groups.  Nodes are the base spans
(clamped to their kind) and the candidates (free); a token without digit or
``@`` is outside the field.  Potentials:

* unary: log-linear in the shape of the token;
* chain: between neighbouring nodes;
* skip: between consecutive nodes, however far apart, that share a key: the
  same text without case and punctuation, the same last nine digits, or the
  same four numbers.  A key with many occurrences gives a path, not a clique,
  so edges grow with nodes.

Loopy sum-product passes messages until they settle.  A free node whose
marginal for one kind exceeds ``THRESHOLD`` becomes a span of that kind; so a
phone number written once with and once without its ``+`` is found twice.  The
field runs over every document with a candidate, with or without base spans.

Training is piecewise: unary weights by multinomial logistic regression, the
two pair tables by smoothed log odds.  Base spans are the labels; a candidate
is negative unless it shares a key with a base span (then it is unlabelled).
The patterns see only what carries their mark, so each base span also stands
for its ``variants`` without it (no ``+`` and country code, ``(at)`` for ``@``).
A number that fails its kind's test (check digit, octets) has a feature of its
own, and each card and address stands for a spoilt one as a negative, so that
repeats of such a number do not confirm each other.
It uses the nodes of at most ``SAMPLE`` documents of at most ``SAMPLE_CHARS``
characters (smallest hashes of their ids); inference reads every whole text.

Null text is empty; empty texts have no spans; repeated rows stay; a corpus
without a base span gives a field that adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import ship, strings

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SAMPLE_CHARS, SAMPLE_NODES = 4000, 20_000, 64
THRESHOLD = 0.8
ROUNDS, DAMPING = 30, 0.5

_HAS = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"(?<!\S)(?:\(?[0-9][0-9().-]*+(?:\x20[0-9(][0-9().-]*+)*+(?=[\s,;:!?]|$)"
                        r"|[^\s0-9@]*+[0-9@]\S*+)")
_DIGITS = re.compile(r"[0-9]+")
_OTHER = re.compile(r"[^0-9\x20().+-]")  # what no card, address or phone number has inside
_DATE = re.compile(r"(?:19|20)[0-9]{2}([-/.])[0-9]{1,2}\1[0-9]{1,2}(?:\x20|(?![^\s,;:!?]))")
_SOLID = re.compile(r"(?<![^\x20])[0-9]{12,}(?![^\x20.,;:!?])")
_PREFIX = re.compile(r"\+[0-9]{1,3}[\x20.-]+")
_EDGE = ".,;:!?()[]{}<>\"'|\x20"


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end), by start, then kind."""
    if not _HAS.search(text):
        return []
    out, free = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, 0, m.end()))
            free = m.end()
    for m in _IP.finditer(text):
        if all(map(_small, m.groups())):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _tokens(text: str):
    """Candidate tokens; a solid number as long as a card's is a token of its
    own, whatever numbers stand beside it."""
    for m in _CANDIDATE.finditer(text):
        at = m.start()
        if "\x20" in m[0]:
            for long in _SOLID.finditer(text, at, m.end()):
                yield from ((at, long.start()),) if at < long.start() else ()
                yield long.span()
                at = long.end()
        if at < m.end():
            yield at, m.end()


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Free nodes: trimmed candidate tokens that overlap no base span."""
    out, k = [], 0
    reach = sorted((s, e) for s, _, e in base)
    merged: list[list[int]] = []
    for s, e in reach:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in _tokens(text):
        start = s
        while s < e and text[s] in _EDGE:
            s += 1
        while (date := _DATE.match(text, s, e)):  # "2019-05-06 10:30": the date is not part of a number
            s = date.end()
        while e > s and text[e - 1] in _EDGE:
            e -= 1
        if ")" in text[s:e] and "(" not in text[s:e] and s > start and text[s - 1] == "(":
            s -= 1
        while k < len(merged) and merged[k][1] <= s:
            k += 1
        if s < e and not (k < len(merged) and merged[k][0] < e):
            out.append((s, e))
    return out


def shape(token: str) -> list[float]:
    """Features of a node's text."""
    groups = _DIGITS.findall(token)
    n = sum(map(len, groups))
    letters = sum(map(str.isalpha, token))
    numeric = not _OTHER.search(token)
    return [1.0, float("@" in token), float(n == 0), float(0 < n <= 4), float(5 <= n <= 8), float(9 <= n <= 11),
            float(12 <= n <= 15), float(16 <= n <= 19), float(n > 19), float(numeric), float(token[:1] == "+"),
            float(len(groups) == 4 and numeric and token.count(".") == 3), float(len(groups) == 1 and numeric),
            float(numeric and len(groups) > 1 and "." not in token), float(letters > 0 and n > 0),
            float("." in token and letters > 0), float("=" in token or "/" in token), float("(" in token),
            *_checks(groups, n, numeric, numeric and token.count(".") == 3)]


def _checks(groups: list[str], n: int, numeric: bool, dotted: bool) -> list[float]:
    """Whether the token, read as a card or an address, passes its test, and
    whether it fails it.  A number that fails is no weak evidence of the kind
    but evidence against it."""
    card = numeric and 12 <= n <= 19
    valid = card and luhn("".join(groups))
    quad = dotted and len(groups) == 4 and n <= 12
    octets = quad and all(map(_small, groups))
    return [float(card and valid), float(card and not valid), float(quad and octets), float(quad and not octets)]


def variants(token: str, kind: int) -> list[tuple[str, int]]:
    """Ways to write a base span that its pattern does not match, with its
    label; and a like number that fails the test of its kind, labelled 0."""
    if kind == 0:
        return [(token.replace("@", "(at)"), 1), (token.replace("@", "[at]"), 1)]
    if kind == 1:
        return [("300" + token[token.index("."):], 0)]
    if kind == 2:
        return [(token[:-1] + str((int(token[-1]) + 1) % 10), 0)]
    plain = _PREFIX.sub("", token)
    return [(plain, 4)] if sum(map(str.isdigit, plain)) >= 9 else []


def keys(token: str) -> set[str]:
    """What two similar nodes share."""
    plain = "".join(ch for ch in token.lower().replace("(at)", "@").replace("[at]", "@") if ch.isalnum())
    out = {"t" + plain} if len(plain) >= 5 else set()
    groups = _DIGITS.findall(token)
    digits = "".join(groups)
    if len(digits) >= 9:
        out.add("d" + digits[-9:])
    if len(groups) == 4 and not any(map(str.isalpha, token)):
        out.add("q" + ".".join(groups))
    return out


def skip_edges(tokens: list[str]) -> list[tuple[int, int]]:
    last: dict[str, int] = {}
    edges = set()
    for i, t in enumerate(tokens):
        for k in keys(t):
            if k in last:
                edges.add((last[k], i))
            last[k] = i
    return sorted(edges)


def nodes_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all nodes (start, label or -1, end) by start."""
    base = base_spans(text)
    return base, sorted(base + [(s, -1, e) for s, e in (candidates(text, base) if _HAS.search(text) else [])])


def marginals(unary: np.ndarray, edges: list[tuple[int, int]], tables: list[np.ndarray]) -> np.ndarray:
    """Loopy sum-product in log space: node marginals [nodes, labels]."""
    if not edges:
        belief = unary
    else:
        a = np.array([e[0] for e in edges])
        b = np.array([e[1] for e in edges])
        src, dst = np.concatenate([a, b]), np.concatenate([b, a])
        table = np.concatenate([np.stack(tables), np.stack([t.T for t in tables])])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        msg = np.zeros((len(src), unary.shape[1]))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, dst, msg)
            out = (belief[src] - msg[back])[:, :, None] + table
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            new = DAMPING * msg + (1 - DAMPING) * new
            settled = np.abs(new - msg).max() < 1e-3
            msg = new
            if settled:
                break
        belief = unary.copy()
        np.add.at(belief, dst, msg)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(text: str, nodes: list[tuple[int, int, int]], model: dict | None) -> list[tuple[int, int, int]]:
    """Spans the field finds among the free nodes.  Label 0 is "other"."""
    if model is None or not any(n[1] < 0 for n in nodes):
        return []
    tokens = [text[s:e] for s, _, e in nodes]
    unary = np.array([shape(t) for t in tokens]) @ model["unary"]
    unary -= unary.max(axis=1, keepdims=True)
    for i, (_, k, _) in enumerate(nodes):
        if k >= 0:
            unary[i] = -60.0
            unary[i, k + 1] = 0.0
    skip = skip_edges(tokens)
    chain = [(i, i + 1) for i in range(len(nodes) - 1)]
    p = marginals(unary, chain + skip, [model["chain"]] * len(chain) + [model["skip"]] * len(skip))
    return [(s, int(p[i].argmax()) - 1, e) for i, (s, k, e) in enumerate(nodes)
            if k < 0 and p[i].argmax() > 0 and p[i].max() > THRESHOLD]


def _sample(docs: DataFrame) -> DataFrame:
    """At most SAMPLE documents: those with the smallest hashes of their ids."""
    h = F.xxhash64("doc_id")
    small = docs.filter(F.length("text") <= SAMPLE_CHARS).filter(F.col("text").rlike("[0-9@]"))
    last = small.select(h.alias("h")).orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    return small.filter(F.lit(False) if last is None else h <= F.lit(last)).limit(2 * SAMPLE)


def train(docs: DataFrame) -> dict | None:
    """Piecewise training on the sample (``docs``: doc_id, text).

    Executors send the nodes of the sample, at most ``SAMPLE_NODES`` of a
    document; the driver fits some hundred weights."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            label, feats, pairs, sizes = [], [], [], []
            for t in strings(b.column(0)):
                _, nodes = nodes_of(t)
                nodes = nodes[:SAMPLE_NODES]
                tokens = [t[s:e] for s, _, e in nodes]
                known = set().union(*(keys(x) for x, n in zip(tokens, nodes) if n[1] >= 0), set())
                # 0 other, 1.. the kinds, -1 unlabelled
                y = [n[1] + 1 if n[1] >= 0 else -1 if keys(x) & known else 0 for x, n in zip(tokens, nodes)]
                more = [v for x, n in zip(tokens, nodes) if n[1] >= 0 for v in variants(x, n[1])]
                label.append(y + [k for _, k in more])
                feats.append([v for x in tokens + [x for x, _ in more] for v in shape(x)])
                sizes.append(len(y))
                pairs.append([v for e in skip_edges(tokens) for v in e])
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.list_(pa.int32())), pa.array(feats, pa.list_(pa.float64())),
                 pa.array(pairs, pa.list_(pa.int32())), pa.array(sizes, pa.int32())], ["label", "feats", "pairs", "size"])

    rows = (_sample(docs).select("text")
            .mapInArrow(run, "label array<int>, feats array<double>, pairs array<int>, size int")
            .filter(F.size("label") > 0).collect())
    width, n_labels = len(shape("")), len(KINDS) + 1
    chain, skip = np.full((n_labels, n_labels), 1.0), np.full((n_labels, n_labels), 1.0)
    skip += 24.0 * np.eye(n_labels)  # prior: similar tokens agree
    x, y = [], []
    for label, feats, pairs, size in rows:
        x.append(np.array(feats).reshape(-1, width))
        y.append(np.array(label))
        label = label[:size]  # without the variants, which stand nowhere
        for a, b in zip(label, label[1:]):
            if a >= 0 and b >= 0:
                chain[a, b] += 1
        for i, j in zip(pairs[::2], pairs[1::2]):
            if label[i] >= 0 and label[j] >= 0:
                skip[label[i], label[j]] += 1
                skip[label[j], label[i]] += 1
    if not rows or max(map(max, y)) < 1:
        return None
    x, y = np.concatenate(x), np.concatenate(y)
    x, y = x[y >= 0], y[y >= 0]
    w, truth = np.zeros((width, n_labels)), np.eye(n_labels)[y]
    for _ in range(400):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w -= 2.0 * (x.T @ (p - truth) / len(x) + 1e-4 * w)

    def odds(t: np.ndarray, most: float) -> np.ndarray:
        share = t / t.sum()
        return np.clip(np.log(share / np.outer(share.sum(1), share.sum(0))), -most, most)

    return {"unary": w, "chain": odds(chain, 0.5), "skip": odds(skip, 3.0)}


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: dict | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_email, n_ip, n_card, n_phone`` (base
    spans), ``base_sha256``, ``spans`` (all), ``n_added``.  Without ``model``
    one is trained on ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ship(docs.sparkSession)
    field = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def run(batches):
        for b in batches:
            counts: dict[int, list[int]] = defaultdict(list)
            digests, spans, added = [], [], []
            for t in strings(b.column(1)):
                base, nodes = nodes_of(t)
                more = added_spans(t, nodes, field.value)
                for k in range(len(KINDS)):
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(sorted(base + more)))
                added.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(counts[k], pa.int64()) for k in range(len(KINDS))),
                 pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                "base_sha256 string, spans string, n_added long")
