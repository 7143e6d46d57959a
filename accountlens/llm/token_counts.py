"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a byte trie. Every node has a failure link and the number of pieces that the link gives away: at
node v (string s), the longest piece that starts s is popped, and so on, until what is left of s is itself a node;
that node is the link. Reading a word then needs one step or failure move per byte, no backtracking, and only
counts: no piece is ever built. A word is read with the vocabulary's word-start mark (a space) in front.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import ship_package, table

ROOT = 0
WHITE = frozenset(b" \t\n\v\f\r")
#: Remembered word lengths of a Python worker; beyond that many the memory is emptied. Longer words are not kept.
MEMO_WORDS = 400_000
MEMO_BYTES = 48


class Automaton:
    """Counts the greedy longest-match pieces of byte strings in time linear in their length."""

    def __init__(self, pieces: Iterable[bytes]):
        child: dict[int, int] = {}  # node * 256 + byte -> node
        ends, order, parent, last = {ROOT: False}, [ROOT], {ROOT: ROOT}, {ROOT: 0}
        for piece in pieces:
            node = ROOT
            for b in piece:
                nxt = child.get(node << 8 | b)
                if nxt is None:
                    nxt = child[node << 8 | b] = len(ends)
                    ends[nxt], parent[nxt], last[nxt] = False, node, b
                    order.append(nxt)
                node = nxt
            ends[node] = node != ROOT or ends[node]
        depth = [0] * len(ends)
        for v in order[1:]:  # a parent is created before its children
            depth[v] = depth[parent[v]] + 1
        link: list[int] = [-1] * len(ends)  # -1: no piece starts the node's string
        popped = [0] * len(ends)
        for v in sorted(order[1:], key=depth.__getitem__):
            if ends[v]:
                link[v], popped[v] = ROOT, 1
                continue
            u, count, b = link[parent[v]], popped[parent[v]], last[v]
            while u >= 0 and child.get(u << 8 | b) is None:
                u, count = (link[u], count + popped[u]) if u != ROOT else (-1, 0)
            if u >= 0:
                link[v], popped[v] = child[u << 8 | b], count
        self._child, self._link, self._popped = child, link, popped

    def count(self, word: bytes) -> int:
        """Pieces of the word; 1 (one unknown piece) if the vocabulary cannot spell it, 0 if it is empty."""
        child, link, popped = self._child, self._link, self._popped
        node = count = 0
        for b in word:
            while (nxt := child.get(node << 8 | b)) is None:
                if node == ROOT or link[node] < 0:
                    return 1
                count += popped[node]
                node = link[node]
            node = nxt
        while node != ROOT:
            if link[node] < 0:
                return 1
            count += popped[node]
            node = link[node]
        return count


def read_pieces(path: str) -> list[bytes]:
    """The byte strings of a rank file (base64 piece and rank on each line), without pieces that hold white space
    behind their first byte: they never lie inside one word."""
    with open(path, "rb") as f:
        pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    return [p for p in pieces if p and not WHITE & set(p[1:])]


@lru_cache(maxsize=2)
def load(path: str) -> Automaton:
    return Automaton(read_pieces(path))


def count_text(automaton: Automaton, text: str | None, memo: dict[bytes, int]) -> tuple[int, int, int]:
    """Words, pieces and bytes in words of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    get, total, size = memo.get, 0, 0
    for w in words:
        n = get(w)
        if n is None:
            n = automaton.count(b" " + w)
            if len(w) <= MEMO_BYTES:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                memo[w] = n
        total += n
        size += len(w)
    return len(words), total, size


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_pieces and n_word_bytes (long) of every row.

    ``path`` names a rank file that every machine has at that place. Null and blank texts have 0 of each. Repeated
    rows stay; other columns are not looked at. An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("n_words long, n_pieces long, n_word_bytes long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton, memo = load(path), {}
        for texts in batches:
            yield pd.DataFrame([count_text(automaton, t, memo) for t in texts],
                               columns=["n_words", "n_pieces", "n_word_bytes"], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), counted(F.col(text_col)).alias("c")).select("doc_id", "c.*")


def counted_documents(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Query op1: word-piece counts of every document."""
    import public_tokenizers
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(vocabulary))
