"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel of two strings counts their common subsequences of three letters, each occurrence weighted by
LAMBDA ** (characters it spans, at most SPAN); what is not a letter only lengthens spans. So i.d-i.o_t, id iot and idixot
are still close to idiot. A text is read as letters and gaps (a run of other characters, whatever its length, is one
gap), and its strings are overlapping windows that cross white space and punctuation: from the start of every word
(run of letters) to the end of that word and of each later one, as long as they take at most UNIT characters. A text is as toxic as its
strongest window, which is also how its label is read (a toxic text has at least one toxic window, others none: a
multiple-instance support vector machine).

Landmark strings give the Nystroem map K(., L) K(L, L) ** -1/2, in which the machine is linear. As the kernel is an inner
product of subsequence weights, the whole decision folds into one weight per letter triple. Running sums of those weights
over a text, one for each span, give every window's value by differences.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import ship_package, table

LAMBDA, SPAN = 0.7, 9
#: Letters a-z, 14 classes for all other letters, and the gap symbol.
BASE = 41
GAP = BASE - 1
#: Characters of a window at most. A longer word is read in overlapping windows of this size.
UNIT = 20
#: The fit's bound: labelled rows per class, least id hash first, of at most so many characters each.
TRAIN_ROWS = 1500
TRAIN_CHARS = 20_000
LANDMARKS, ROUNDS, COST = 160, 4, 4.0
#: Texts of label 1 that must hold a word for it to be a first witness.
SUPPORT = 3
#: Windows of each text of label 0 that come out strongest, and of all texts, which each round adds to the negatives.
HARD, HARD_ALL = 3, 2000
THRESHOLD = 0.7
#: Characters of texts read together, and places whose windows are scored at once.
CHUNK = 1 << 20
PIECE = 1 << 15
EMPTY = -3.0

#: The symbol of every character; those beyond the table are gaps.
_SYMBOL = np.array([ord(c) - 97 if "a" <= c <= "z" else 26 + i % 14 if c.isalpha() else GAP
                    for i, c in enumerate(map(chr, range(0x32400)))] + [GAP], np.int32)
#: One character of each symbol, so that windows can be written as text.
_CHARACTER = np.array([chr(int(np.flatnonzero(_SYMBOL == k)[0])) if k != GAP else " " for k in range(BASE)])
_PAIRS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
_VALID = np.ones((BASE,) * 3, np.float32)
_VALID[GAP], _VALID[:, GAP], _VALID[:, :, GAP] = 0, 0, 0
_VALID = _VALID.ravel()


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Reading(NamedTuple):
    """Texts as one line of symbols without two gaps in a row, the number of each symbol's text, and the words' borders."""
    symbols: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def window(self, start: int, end: int) -> str:
        return "".join(_CHARACTER[self.symbols[start:end]])


def read(texts: list[str | None]) -> Reading:
    lower = [(t or "").lower() for t in texts]
    symbols = _SYMBOL[np.minimum(_points("\n".join([*lower, ""])), len(_SYMBOL) - 1)]
    letter = symbols != GAP
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    symbols = symbols[keep]
    text = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in lower])[keep]
    edge = np.diff((symbols != GAP).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    half = UNIT // 2
    parts = np.where(ends - starts > UNIT, -(-(ends - starts - half) // half), 1)
    if len(parts) and parts.max() > 1:
        word = np.repeat(np.arange(len(parts)), parts)
        starts = starts[word] + half * (np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts))
        ends = np.minimum(starts + UNIT, ends[word])
    return Reading(symbols, text, starts, ends)


def windows(reading: Reading, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, start, end, decision value) of every window with a three-letter subsequence, as arrays, in pieces ordered by
    start. The value is the kernel's: the window's own subsequences only, scaled."""
    symbols, text, starts, ends = reading
    lo = 0
    while lo < len(starts):
        first = starts[lo]
        hi = int(np.searchsorted(starts, first + PIECE))
        line = symbols[first:starts[hi - 1] + UNIT].astype(np.int64)
        n = len(line)
        letters = np.zeros(n + 1, np.int32)
        np.cumsum(line != GAP, out=letters[1:])
        is_letter, left, middle = line != GAP, line * (BASE * BASE), line * BASE
        # sums by span of what starts before a place; over all spans: at a place, and for what ends before a place
        sums = np.zeros((2, SPAN, n + 1))
        begun, ended = np.zeros((2, n + 1)), np.zeros((2, n + 1))
        for j in range(2, min(SPAN, n)):
            m = n - j
            at_j = left[:m] + line[j:]
            here = weights.take(at_j + middle[1:1 + m], mode="clip")
            for i in range(2, j):
                here += weights.take(at_j + middle[i:i + m], mode="clip")
            between = (letters[j:m + j] - letters[1:m + 1]) * (is_letter[:m] & is_letter[j:])
            np.cumsum(here * np.float32(LAMBDA ** (j + 1)), out=sums[0, j, 1:m + 1], dtype=np.float64)
            np.cumsum(between * LAMBDA ** (2 * (j + 1)), out=sums[1, j, 1:m + 1])
            begun += sums[:, j]
            ended[:, j:] += sums[:, j, :m + 1]
        last = min(len(starts), hi + UNIT)
        for more in range(UNIT):
            k = np.arange(lo, min(hi, last - more))
            a, b = starts[k], ends[k + more]
            k = k[(b - a <= UNIT) & (b - a > 2) & (text[a] == text[b - 1])]
            if not len(k):
                if not more:
                    continue
                if not (b - a <= UNIT).any():
                    break
                continue
            a, b = starts[k] - first, ends[k + more] - first
            value, scale = both = ended[:, b] - begun[:, a]
            short = np.flatnonzero(b - a < SPAN - 1)
            if len(short):
                i, to = a[short], b[short]
                both[:, short] = sum(sums[:, j, np.maximum(to - j, i)] - sums[:, j, i] for j in range(2, SPAN))
            known = scale > 1e-9
            k, a, b = k[known], a[known] + first, b[known] + first
            yield text[a], a, b, value[known] / np.sqrt(scale[known])
        lo = hi


def units(text: str | None) -> set[str]:
    """The distinct windows of a text that hold a three-letter subsequence, as text (letters that share a symbol: as one)."""
    reading = read([text])
    return {reading.window(i, k) for _, a, b, _ in windows(reading, np.zeros(BASE ** 3, np.float32)) for i, k in zip(a, b)}


def _codes(words: list[str], size: int) -> np.ndarray:
    """Symbols of words of one length, a row each."""
    return _SYMBOL[np.minimum(_points("".join(words)), len(_SYMBOL) - 1)].reshape(len(words), size)


def _triples(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Triple numbers at every place, and their weight, for each pair of distances."""
    size = codes.shape[1]
    for i, j in _PAIRS:
        if j < size:
            n = size - j
            yield (codes[:, :n] * BASE + codes[:, i:i + n]) * BASE + codes[:, j:], LAMBDA ** (j + 1)


def _by_length(words: Iterable[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        groups.setdefault(len(w), []).append(k)
    return groups


def kernel_sums(words: list[str], weights: np.ndarray) -> np.ndarray:
    """For words of at most UNIT characters, the inner product of their scaled subsequence weights with each column of
    ``weights`` (triples x columns); 0 for words without three letters."""
    out = np.zeros((len(words), weights.shape[1]), np.float32)
    for size, at in _by_length(words).items():
        codes = _codes([words[k] for k in at], size)
        total, scale = np.zeros((len(at), weights.shape[1]), np.float32), np.full(len(at), 1e-12, np.float32)
        for numbers, weight in _triples(codes):
            scale += weight * weight * _VALID[numbers].sum(1)
            total += weight * (weights[numbers, 0].sum(1)[:, None] if weights.shape[1] == 1 else weights[numbers].sum(1))
        out[at] = total / np.sqrt(scale)[:, None]
    return out


def feature_table(words: list[str]) -> np.ndarray:
    """The scaled subsequence weights of the words, a column each (triples x words)."""
    out = np.zeros((BASE ** 3, len(words)), np.float32)
    for k, w in enumerate(words):
        codes, scale = _codes([w], len(w)), 1e-12
        for numbers, weight in _triples(codes):
            np.add.at(out[:, k], numbers[0], weight * _VALID[numbers[0]])
            scale += weight * weight * float(_VALID[numbers].sum())
        out[:, k] /= np.sqrt(scale)
    return out


def _groups(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """The texts in groups of about ``CHUNK`` characters, each with the number of its first text."""
    low, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK or k == len(texts) - 1:
            yield low, texts[low:k + 1]
            low, size = k + 1, 0


class Model(NamedTuple):
    weights: np.ndarray  # one per letter triple
    slope: float
    shift: float

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """The decision value of every text: its strongest window's (``EMPTY`` without a window)."""
        out = np.full(len(texts), EMPTY)
        for low, some in _groups(texts):
            for text, _, _, value in windows(read(some), self.weights):
                first = np.flatnonzero(np.diff(text, prepend=-1))
                if len(first):
                    at = low + text[first]
                    out[at] = np.maximum(out[at], np.maximum.reduceat(value, first))
        return out

    def strings(self, words: list[str]) -> np.ndarray:
        """The decision value of windows given as text."""
        return kernel_sums(words, self.weights[:, None])[:, 0]

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(value, float) + self.shift, -30, 30)))


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps on the active rows; last weight: bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        active = y * (x @ w) < 1
        a = x[active] * cost[active, None]
        new = np.linalg.solve(ridge + a.T @ x[active], a.T @ y[active])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def _platt(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift with a small ridge."""
    x, w = np.stack([value, np.ones_like(value)], 1).astype(float), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), x.T @ (label - p) - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _words(text: str) -> list[str]:
    """The distinct words of a text, longer ones in windows."""
    reading = read([text])
    return sorted({reading.window(a, b) for a, b in zip(reading.starts, reading.ends)})


def _strongest(texts: list[str], weights: np.ndarray, top: int) -> list[tuple[float, int, str]]:
    """(value, text number, window) of the ``top`` strongest windows of each text."""
    best = []
    for low, group in _groups(texts):
        reading = read(group)
        found = list(windows(reading, weights))
        if not found:
            continue
        text, a, b, value = map(np.concatenate, zip(*found))
        order = np.lexsort((b, a, -value, text))
        rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        best += [(float(value[k]), low + int(text[k]), reading.window(a[k], b[k])) for k in order[rank < top]]
    return best


def fit(texts: list[str], labels: list[int]) -> Model:
    """Multiple-instance machine on labelled texts. Without both classes: a model that gives every text the share of
    label 1 (0 if there is no text)."""
    label = np.array(labels, np.int64)
    bags = [_words(t) for t in texts]
    if len(set(labels)) < 2:
        share = min(max(float(label.mean()) if len(label) else 0.0, 1e-6), 1 - 1e-6)
        return Model(np.zeros(BASE ** 3, np.float32), 0.0, float(np.log(share / (1 - share))))
    seen = [Counter(w for b, y in zip(bags, labels) if y == c for w in b) for c in (0, 1)]
    words = sorted(set(seen[0]) | set(seen[1]))
    number = {w: k for k, w in enumerate(words)}
    n = [len(label) - label.sum(), label.sum()]
    odds = np.array([np.log((seen[1][w] + 0.1) / (n[1] + 1)) - np.log((seen[0][w] + 0.1) / (n[0] + 1)) for w in words])
    clean_texts = [t for t, y in zip(texts, labels) if not y]
    members = [np.array([number[w] for w in b], np.int64) for b in bags]
    # a text labelled 1 without a string that others confirm may be labelled wrongly: it teaches nothing
    support = np.array([seen[1][w] for w in words])
    value = np.where(support >= min(SUPPORT, support.max()), odds, -np.inf).astype(np.float32)
    least = -np.inf
    clean = np.unique(np.concatenate([m for m, y in zip(members, labels) if not y] or [np.empty(0, np.int64)]))
    by_hash = np.array(sorted(clean.tolist(), key=lambda k: zlib.crc32(words[k].encode())), np.int64)
    across: list[str] = []  # windows of clean texts that came out strong, most of them over several words
    model = Model(np.zeros(BASE ** 3, np.float32), 1.0, 0.0)
    for _ in range(ROUNDS):
        picked = Counter(int(m[value[m].argmax()]) for m, y in zip(members, labels) if y and len(m) and value[m].max() > least)
        if not picked:
            break
        hard = clean[np.argsort(-value[clean], kind="stable")[:2000]]
        negative = np.setdiff1d(np.union1d(hard, by_hash[:4000]), np.array(list(picked)))
        positive = np.array([k for k, _ in picked.most_common()], np.int64)
        marks = [*(words[k] for k in [*positive[:LANDMARKS // 2], *hard[:LANDMARKS // 4], *by_hash[:LANDMARKS // 4]]),
                 *across[:LANDMARKS // 4]]
        features = feature_table(sorted(set(marks)))
        gram = features.T.astype(float) @ features
        root, vectors = np.linalg.eigh(gram)
        keep = root > 1e-6 * root.max(initial=1e-6)
        whiten = vectors[:, keep] / np.sqrt(root[keep])
        others = sorted({words[k] for k in negative}.union(across))
        x = kernel_sums([*(words[k] for k in positive), *others], features).astype(float) @ whiten
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(others))])
        counts = np.array([picked[int(k)] for k in positive], float)
        cost = np.concatenate([COST * np.minimum(counts, 20), np.full(len(others), COST)])
        w = _machine(x, y, cost)
        weights = (features.astype(float) @ (whiten @ w[:-1])).astype(np.float32)
        model = Model(weights, 1.0, 0.0)
        value, least = model.strings(words), -w[-1]
        taught = {words[int(k)] for k in positive}
        strong = dict.fromkeys(window for _, _, window in sorted(_strongest(clean_texts, weights, HARD), reverse=True))
        across = [w for w in dict.fromkeys([*list(strong)[:HARD_ALL], *across]) if w not in taught]
    return model._replace(**dict(zip(("slope", "shift"), _platt(model.texts(texts), label))))


def is_held_out(id_text: Column) -> Column:
    return F.crc32(id_text.cast("string").cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[tuple]:
    """(text, toxic) of at most TRAIN_ROWS rows of each class that are not held out; ids are drawn from the labels
    before any text is read. Null labels and null ids teach nothing; a row labelled twice counts by its larger label."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    known = known.where(~is_held_out(F.col(id_col)))
    drawn = None
    for y in (0, 1):
        part = known.where(F.col("toxic") == y).orderBy(F.xxhash64(id_col), id_col).limit(TRAIN_ROWS)
        drawn = part if drawn is None else drawn.unionByName(part)
    # at most 2 * TRAIN_ROWS ids: small enough to broadcast whatever the size of the labels
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).where(F.length("text") <= TRAIN_CHARS)
    rows = rows.join(F.broadcast(drawn), F.col("__id") == F.col(id_col)).select("__id", "text", "toxic")
    return sorted({(r["__id"], r["text"], r["toxic"]) for r in rows.collect()})


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.7) of every row.

    A text is read whole, whatever its length. A null or blank text is scored like one without a three-letter string. A null id is not held out. Repeated rows
    stay. Other columns are not looked at. An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.probability(model.texts(texts.tolist())))

    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(is_held_out(F.col(id_col)), F.lit(False)).alias("held_out"),
                       scored(F.col(text_col)).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op9: every document's toxicity."""
    docs = table(spark, sf_dir, "documents")
    rows = training_rows(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, fit([t for _, t, _ in rows], [y for _, _, y in rows]))
