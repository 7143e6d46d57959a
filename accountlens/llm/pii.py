"""Personal data by patterns and a skip-chain conditional random field.

The patterns find e-mail addresses, IP addresses, card and phone numbers (``base_spans``). The field then looks for
mentions that no pattern matches but that repeat one, such as a phone number without its country code or an address
with a masked dot. Its nodes are the words with a digit, ``@``, ``+`` or a masked sign such as ``(at)`` or ``[.]``, where a
pattern's match that reaches over blanks and a group of plain digit words that has the digits of a match are one node
each; all other words are other-label by definition, so the chain breaks there. Chain edges join neighbouring nodes, skip
edges join each node to the next one, however distant, of the same key (last 7 digits, letters and digits alone, or the
address of an IP, shorter ones too), which makes them linear in the nodes. Words under a pattern's match are observed; loopy sum-product passing gives the others their label probabilities. A word gains a
span if a label other than ``other`` has at least half of the probability and a chain of skip edges leads to an
observed word of that label; other labels are ruled out. So a text without a pattern match never gains one.

Weights are fitted by pseudo-likelihood on the words of a bounded sample of documents, labelled by the patterns.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import ship_package, table

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0: other
#: The fit's bound: that many documents with a digit or @, least id hash first, of at most so many characters each.
TRAIN_DOCS = 1500
TRAIN_CHARS = 20_000
STEPS, RATE, DECAY = 300, 0.5, 1e-3
#: What mentions of one key gain by agreeing, before the sample says more or less.
AGREE = 3.0
ROUNDS, DAMPING, TOLERANCE = 30, 0.3, 1e-4

WHITE = " \t\n\x0b\f\r"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# the possessive runs and the look-behind change no match; they keep long runs of digits linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NODE = re.compile(r"(?:[0-9@+]|[(\[{](?:[Aa][Tt]|[Dd][Oo][Tt]|\.)[)\]}])[^ \t\n\x0b\f\r]*")
#: Words of digits, and what may join them to one number.
_NUMBER = re.compile(r"\+?[(]?[0-9][0-9().-]*[,;:!?]?")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_NOT_PLAIN = re.compile(r"[^a-z0-9]+")
_AT = re.compile(r"[(\[{]at[)\]}]")
_DOT = re.compile(r"[(\[{](?:dot|\.)[)\]}]")


class Span(NamedTuple):
    kind: int
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield Span(0, start, m.end())
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The patterns' spans by kind, then start; code points, end exclusive."""
    spans = list(_emails(text))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
                spans.append(Span(1, *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 37 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                spans.append(Span(2, *m.span()))
        if "+" in text:
            spans += [Span(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


class Graph(NamedTuple):
    """Nodes of one text: places, observed labels (0: none), features, chain edges and skip edges (node, later node)."""
    spans: list[tuple[int, int]]
    observed: np.ndarray
    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _words(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _NODE.finditer(text):
        start = m.start()
        while start > done and text[start - 1] not in WHITE:
            start -= 1
        done = m.end()
        yield start, done


def _nodes(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """The words, and in place of several neighbouring ones: those under one match, and those of digits that together
    have the key of a match. The longest such group counts."""
    words = list(_words(text))
    starts = [a for a, _ in words]
    spans = sorted({(s.start, s.end) for s in base if s.kind >= 2})
    keys = {k for a, b in spans if (k := _key(text[a:b]))}
    if not keys:
        return words
    joined = [False] * len(words)  # to the word before it, by a match
    for a, b in spans:
        i = max(bisect_right(starts, a) - 1, 0)
        for k in range(i + 1, bisect_left(starts, b)):
            joined[k] = words[k - 1][1] > a
    out, i = [], 0
    while i < len(words):
        j = i + 1
        while j < len(words) and joined[j]:
            j += 1
        if j == i + 1 and _NUMBER.fullmatch(text, *words[i]):
            digits, k = "", i
            while (k < len(words) and len(digits) < 19 and not (k > i and joined[k]) and _NUMBER.fullmatch(text, *words[k])
                   and (k == i or text[words[k - 1][1]:words[k][0]] in (" ", "\t", "\n") and text[words[k - 1][1] - 1] not in ",;:!?")):
                if k + 1 < len(words) and joined[k + 1]:
                    break
                digits += _NOT_DIGIT.sub("", text[words[k][0]:words[k][1]])
                k += 1
                if 7 <= len(digits) <= 19 and digits[-7:] in keys:
                    j = k
        out.append((words[i][0], words[j - 1][1]))
        i = j
    return out


def _key(word: str) -> str | None:
    plain = word.strip("\"'.,;:!?()[]{}<>")
    dotted = _DOT.sub(".", plain.lower())
    if _IP.fullmatch(dotted):
        return "ip" + ".".join(p.lstrip("0") or "0" for p in dotted.split("."))
    plain = _NOT_PLAIN.sub("", _AT.sub("@", _DOT.sub(".", word.lower())))
    if plain.isdigit():
        return plain[-7:] if len(plain) >= 7 else None
    return plain if len(plain) >= 8 else None


def _features(word: str) -> list[float]:
    digits = _NOT_DIGIT.sub("", word)
    n, dots = len(digits), word.strip(".,;:!?").count(".")
    letters = any(c.isalpha() for c in word)
    octets = dots == 3 and not letters and all(p and int(p[:6]) <= 255 for p in map(
        lambda x: _NOT_DIGIT.sub("", x), word.strip(".,;:!?").split(".")))
    sizes = [n == 0, 1 <= n <= 3, 4 <= n <= 6, n == 7, 8 <= n <= 12, 13 <= n <= 19, n > 19]
    return [1.0, *sizes, "@" in word, bool(_AT.search(word.lower())), dots == 0, dots == 3, octets, letters,
            word[:1] == "+", "(" in word, "-" in word, "=" in word, '"' in word,
            13 <= n <= 19 and not letters and luhn(digits), letters and dots > 0]


N_FEATURES = len(_features("1"))


def graph(text: str, base: list[Span]) -> Graph:
    places = _nodes(text, base)
    observed = np.zeros(len(places), np.int64)
    starts = np.array([a for a, _ in places], np.int64)
    for s in reversed(base):  # the first kind listed stays where two kinds meet
        i = max(int(np.searchsorted(starts, s.start, "right")) - 1, 0)
        while i < len(places) and places[i][0] < s.end:
            if places[i][1] > s.start:
                observed[i] = s.kind + 1
            i += 1
    words = [text[a:b] for a, b in places]
    chain = [(i, i + 1) for i in range(len(places) - 1) if not text[places[i][1]:places[i + 1][0]].strip(WHITE)]
    last: dict[str, int] = {}
    skip = []
    for i, w in enumerate(words):
        if key := _key(w):
            if key in last:
                skip.append((last[key], i))
            last[key] = i
    return Graph(places, observed, np.array([_features(w) for w in words], float).reshape(-1, N_FEATURES),
                 np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2))


class Field(NamedTuple):
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # left label x right label
    skip: np.ndarray  # symmetric


def fit(texts: list[str]) -> Field:
    """Pseudo-likelihood weights by gradient ascent; the labels are the patterns' own. A word without a match that
    repeats a matched one has no known label and teaches nothing. Without texts the prior is left."""
    graphs = [graph(t, base_spans(t)) for t in texts]
    graphs = [g for g in graphs if len(g.spans)]
    unary, chain, skip = np.zeros((N_FEATURES, LABELS)), np.zeros((LABELS, LABELS)), AGREE * np.eye(LABELS)
    if not graphs:
        return Field(unary, chain, skip)
    shifts = np.cumsum([0, *(len(g.spans) for g in graphs)])
    x, y = np.concatenate([g.features for g in graphs]), np.concatenate([g.observed for g in graphs])
    one = np.eye(LABELS)[y]
    unknown = [i + s for g, s in zip(graphs, shifts) for i in _linked_labels(g)]
    one[unknown] = 0
    edges = [np.concatenate([e + s for e, s in zip((g[k] for g in graphs), shifts)]) for k in (3, 4)]
    left, right, near = (np.zeros((len(y), LABELS)) for _ in range(3))
    left[edges[0][:, 1]] = one[edges[0][:, 0]]
    right[edges[0][:, 0]] = one[edges[0][:, 1]]
    np.add.at(near, edges[1][:, 0], one[edges[1][:, 1]])
    np.add.at(near, edges[1][:, 1], one[edges[1][:, 0]])
    for _ in range(STEPS):
        score = x @ unary + left @ chain + right @ chain.T + near @ skip
        score -= score.max(1, keepdims=True)
        p = np.exp(score)
        error = (one - p / p.sum(1, keepdims=True)) / np.sqrt(len(y))
        error[unknown] = 0
        step = near.T @ error
        unary += RATE * (x.T @ error / np.sqrt(len(y)) - DECAY * unary)
        chain += RATE * ((left.T @ error + error.T @ right) / np.sqrt(len(y)) - DECAY * chain)
        skip += RATE * ((step + step.T) / np.sqrt(len(y)) - DECAY * (skip - AGREE * np.eye(LABELS)))
    return Field(unary, chain, skip)


def marginals(g: Graph, field: Field, allowed: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities of every node by damped loopy sum-product; observed nodes are fixed, and others have only
    the allowed labels (nodes x labels, boolean) if given."""
    own = g.features @ field.unary
    if allowed is not None:
        own[~allowed] = -1e9
    seen = g.observed > 0
    own[seen] = -1e9
    own[seen, g.observed[seen]] = 0.0
    source = np.concatenate([g.chain[:, 0], g.chain[:, 1], g.skip[:, 0], g.skip[:, 1]])
    target = np.concatenate([g.chain[:, 1], g.chain[:, 0], g.skip[:, 1], g.skip[:, 0]])
    a, b = len(g.chain), len(g.skip)
    back = np.concatenate([np.arange(a, 2 * a), np.arange(a), np.arange(2 * a + b, 2 * (a + b)), np.arange(2 * a, 2 * a + b)])
    pair = np.concatenate([np.repeat(field.chain[None], a, 0), np.repeat(field.chain.T[None], a, 0),
                           np.repeat(field.skip[None], 2 * b, 0)])
    sent = np.zeros((len(source), LABELS))
    belief = own
    for _ in range(ROUNDS):
        belief = own.copy()
        np.add.at(belief, target, sent)
        from_ = (belief[source] - sent[back])[:, :, None] + pair
        top = from_.max(1, keepdims=True)
        new = (top + np.log(np.exp(from_ - top).sum(1, keepdims=True)))[:, 0]
        new -= new.max(1, keepdims=True)
        change = np.abs(new - sent).max(initial=0.0)
        sent = DAMPING * sent + (1 - DAMPING) * new
        if change < TOLERANCE:
            break
    belief = belief - belief.max(1, keepdims=True)
    p = np.exp(belief)
    return p / p.sum(1, keepdims=True)


def _linked_labels(g: Graph) -> dict[int, set[int]]:
    """For each unobserved node with skip edges: the observed labels that its chain of skip edges reaches."""
    head = list(range(len(g.spans)))
    for i, j in g.skip.tolist():  # edges run from each mention to the next, so heads are settled in order
        head[j] = head[i]
    labels: dict[int, set[int]] = {}
    for i, y in enumerate(g.observed.tolist()):
        if y:
            labels.setdefault(head[i], set()).add(y)
    return {i: labels[head[i]] for i, y in enumerate(g.observed.tolist()) if not y and head[i] in labels}


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """What the field adds to the patterns' spans; never touches one of them."""
    if not base:
        return []
    g = graph(text, base)
    linked = _linked_labels(g) if len(g.skip) else {}
    if not linked:
        return []
    allowed = np.zeros((len(g.spans), LABELS), bool)
    allowed[:, 0] = True
    for i, labels in linked.items():
        allowed[i, list(labels)] = True
    p, found = marginals(g, field, allowed), []
    for i, labels in linked.items():
        y = int(p[i].argmax())
        if y in labels and p[i, y] >= 0.5:
            a, b = g.spans[i]
            while a < b and not (text[a].isalnum() or text[a] == "+"):
                a += 1
            while b > a and not text[b - 1].isalnum():
                b -= 1
            if a < b and not any(s.start < b and a < s.end for s in base):
                found.append(Span(y - 1, a, b))
    return found


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    rows = docs.where(F.col(text_col).rlike("[0-9@]") & (F.length(text_col) <= TRAIN_CHARS))
    rows = rows.select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("t"))
    # the sample's largest hash first, from hashes alone: then only the sampled texts travel
    last = rows.select("h").orderBy("h").limit(TRAIN_DOCS).agg(F.max("h")).first()[0]
    if last is None:
        return []
    rows = rows.where(F.col("h") <= last).orderBy("h", "t").limit(TRAIN_DOCS)
    return [r["t"] for r in rows.collect()]


def find_personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """doc_id, the patterns' counts, base_sha256, n_added and ``spans`` (kind:start:end, all) of every row.

    Without ``field`` one is fitted on a bounded sample of ``docs``. A null text is empty: counts of 0, no spans.
    Repeated rows stay. Other columns are not looked at. An empty table gives an empty result.
    """
    field = field or fit(training_sample(docs, id_col, text_col))

    ship_package(docs.sparkSession)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, n_added long, spans string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                base = base_spans(text) if text else []
                added = added_spans(text, base, field) if base else []
                rows.append((*(sum(s.kind == k for s in base) for k in range(len(KINDS))),
                             hashlib.sha256(_joined(base).encode()).hexdigest(), len(added), _joined(base + added)))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "n_added", "spans"])

    return docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col)).alias("f")).select("doc_id", "f.*")


def private_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op4: personal data in every document."""
    return find_personal_data(table(spark, sf_dir, "documents"))
