"""Token ids in a binary format: frequency-ranked, byte-aligned, with separate control bytes.

Documents, in ascending id order, fill segments of about a million ids. Each segment ranks its own ids by frequency
(ties: smaller id first) and stores ranks in 1 to 4 bytes, little-endian; the lengths, 2 bits each, stand apart in
control bytes, four ranks to a byte. A segment describes itself, so it can be read alone:

    magic "TIDS", version u32, documents u32, ranked ids u32, ids u64
    | ids of each document u32[] | id of each rank u32[] | control bytes | data bytes

Reading looks up each control byte in a 256 x 4 table of lengths; sums of lengths give every rank's place.
Segments are the rows of a Parquet table (segment number, document ids, payload), so that Spark commits them as a
whole or not at all on any file system, and a lost executor's files are written again.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import running_offsets, ship_package, table
from accountlens.session import scratch_path

END_ID = 0
SEGMENT_IDS = 1 << 20
MAGIC, VERSION = b"TIDS", 1
HEADER = struct.Struct("<4sIIIQ")
#: The four lengths that a control byte holds, first rank in the lowest bits.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)
#: Pieces in each of the two generations that a Python worker remembers. Longer pieces (bytes) are not kept.
MEMO_PIECES = 600_000
MEMO_BYTES = 48
#: Pieces that are encoded as one text, and characters of texts whose distinct pieces are looked up at once.
JOINED_PIECES = 200
CHUNK_CHARS = 1 << 22
PART_BITS = 24
#: Signs that a byte-level vocabulary's splitting always parts from a letter before them.
SIGNS = ".,;:!?$%&*#"

_BLANKS = "\t\n\v\f\r "
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECES = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: White space that is not ASCII: texts that have it are cut by the expression.
_ODD_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SIGNED = re.compile(f"[A-Za-z][{re.escape(SIGNS)}]")
#: The kind of each byte: white space, letter, sign, or any other (0).
_BLANK, _LETTER, _SIGN = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS.encode())] = _BLANK
_KIND[list(string.ascii_letters.encode())] = _LETTER
_KIND[list(SIGNS.encode())] = _SIGN


class Encoder:
    """Ids of whole texts. The tokenizer splits a text before each run of white space that follows another character
    and handles what lies between alone, so pieces cut there are encoded once and remembered.

    A sign after an ASCII letter is split off too, where the vocabulary's splitting does so, so a word is encoded once with and
    without it. Texts are cut together, on their bytes, and Arrow numbers the distinct pieces, so that only these are looked up
    one by one; the ids of all pieces are then gathered by number. New pieces that are white space and a word are encoded many at
    once, as one text, which costs less than one call for each: the ids are cut where the bytes of their vocabulary entries end.
    If those ends do not meet the pieces' own (a vocabulary that is not one of bytes), the pieces are encoded one by one. Pieces
    are remembered in two generations: when the younger is full it becomes the older, from which pieces in use come back, so a
    worker never starts from nothing.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self._tokenizer = Tokenizer.from_file(path)
        self._memo: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        added = {i: t.content for i, t in self._tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        #: whether a text is split by the usual expression of byte-level vocabularies, between letters and signs too
        splitter = json.loads(self._tokenizer.to_str()).get("pre_tokenizer") or {}
        self._parts_signs = (splitter.get("type") == "ByteLevel" and splitter.get("use_regex") is True
                             and not splitter.get("add_prefix_space") and not any(map(_SIGNED.search, added.values())))
        #: bytes of each id's entry, one character of which stands for a byte
        self._bytes = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        for entry, i in vocabulary.items():
            self._bytes[i] = len(added[i].encode()) if i in added else len(entry)

    def ids(self, text: str | None) -> np.ndarray:
        return self.all_ids([text])[0]

    def all_ids(self, texts: list[str | None]) -> list[np.ndarray]:
        encoded = [(t or "").encode() for t in texts]
        data, text_ends = b"".join(encoded), np.cumsum([len(e) for e in encoded])
        if not data:
            return [np.empty(0, "<u4") for _ in texts]
        starts = self._starts(texts, data, text_ends)
        bounds = np.append(starts, len(data))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        found = self._found(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        number, known = pieces.indices.to_numpy(), np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        places = np.cumsum(sizes) - sizes
        counts = sizes[number]
        ends = np.cumsum(counts)
        ids = known[np.repeat(places[number] - ends + counts, counts) + np.arange(ends[-1])]
        cut = np.append(0, ends)[np.searchsorted(starts, text_ends)]
        return np.split(ids, cut[:-1])

    def _starts(self, texts: list[str | None], data: bytes, text_ends: np.ndarray) -> np.ndarray:
        """Where in the bytes of all texts the pieces begin; none lies in two texts."""
        kind = _KIND[np.frombuffer(data, np.uint8)]
        blank = kind == _BLANK
        first = np.zeros(len(kind) + 1, bool)
        first[1:-1] = blank[1:] & ~blank[:-1]
        if self._parts_signs:
            first[1:-1] |= (kind[1:] == _SIGN) & (kind[:-1] == _LETTER)
        for i, text in enumerate(texts):
            if text and _ODD_SPACE.search(text):
                begin = text_ends[i - 1] if i else 0
                first[begin:text_ends[i]] = False
                first[begin + np.cumsum([len(p.encode()) for p in _PIECES.findall(text)])] = True
        first[0] = True
        first[text_ends] = True
        return np.flatnonzero(first[:-1])

    def _found(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each of these distinct pieces, four bytes an id."""
        memo, older = self._memo, self._older
        found = list(map(memo.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in missing:
            ids = older.get(pieces[i])
            if ids is None:
                new.append(i)
            else:
                found[i] = ids
        if new:
            for i, ids in zip(new, self._encoded([pieces[i].decode() for i in new])):
                found[i] = ids
        memo.update([(pieces[i], found[i]) for i in missing if len(pieces[i]) <= MEMO_BYTES])
        if len(memo) > MEMO_PIECES:
            self._older, self._memo = memo, {}
        return found

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(pieces)
        words = [i for i, p in enumerate(pieces) if p[0] in _BLANKS and not p[-1].isspace()]
        groups = [words[k:k + JOINED_PIECES] for k in range(0, len(words), JOINED_PIECES)]
        joined = ["".join([pieces[i] for i in group]) for group in groups]
        for group, e in zip(groups, self._tokenizer.encode_batch_fast(joined, add_special_tokens=False) if joined else ()):
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum(self._bytes[ids])
            due = np.cumsum([len(pieces[i].encode()) for i in group])
            at = np.searchsorted(ends, due)
            if at[-1] != len(ids) - 1 or (ends[at] != due).any():
                continue
            raw, cut = ids.tobytes(), [0, *((at + 1) * 4).tolist()]
            for i, a, b in zip(group, cut, cut[1:]):
                out[i] = raw[a:b]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self._tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False) if rest else ()):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts of a batch, some texts at a time: as many as pass ``CHUNK_CHARS`` together."""
    ids, texts, chars = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        ids.append(doc_id)
        texts.append(text.as_py())
        chars += len(texts[-1] or "")
        if chars >= CHUNK_CHARS:
            yield ids, texts
            ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(documents: list[np.ndarray]) -> bytes:
    """The payload of a segment with these documents' ids (unsigned, under 2 ** 32)."""
    ids = np.concatenate(documents) if documents else np.empty(0, np.uint32)
    if not len(ids) or ids.max() < 1 << 20:
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        index = ids  # a table of all ids up to the largest
    else:
        values, index, counts = np.unique(ids, return_inverse=True, return_counts=True)
        counts = np.bincount(index)
    used = counts[counts > 0]
    order = np.lexsort((values, -used))
    rank_of = np.zeros(len(counts), "<u4")
    rank_of[np.flatnonzero(counts)[order]] = np.arange(len(order), dtype="<u4")
    ranks = rank_of[index]
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[:len(ranks)] = extra
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return b"".join((HEADER.pack(MAGIC, VERSION, len(documents), len(values), len(ids)),
                     np.array([len(d) for d in documents], "<u4").tobytes(), values[order].astype("<u4").tobytes(),
                     control.tobytes(), data.tobytes()))


def unpack(payload: bytes) -> list[np.ndarray]:
    """The documents' ids of a segment."""
    magic, version, n_docs, n_values, n = HEADER.unpack_from(payload)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token id segment")
    at = HEADER.size
    sizes = np.frombuffer(payload, "<u4", n_docs, at)
    values = np.frombuffer(payload, "<u4", n_values, at := at + 4 * n_docs)
    n_control = -(-n // 4)
    control = np.frombuffer(payload, np.uint8, n_control, at := at + 4 * n_values)
    data = np.frombuffer(payload, np.uint8, offset=at + n_control)
    lengths = LENGTHS[control].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    ranks = np.zeros(n, np.uint32)
    for byte in range(4):
        some = np.flatnonzero(lengths > byte)
        ranks[some] |= data[starts[some] + byte].astype(np.uint32) << (8 * byte)
    return np.split(values[ranks], np.cumsum(sizes, dtype=np.int64)[:-1]) if n_docs else []


def write_token_ids(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                    segment_ids: int = SEGMENT_IDS, partitions: int | None = None) -> None:
    """Write all rows of ``docs``, in ascending id order (null first; equal ids by text hash), as segments to ``path``.

    Each document ends with id 0; a null text is empty, its only id is 0. ``tokenizer_path`` names a file that every
    machine has at that place. Repeated rows are written as often as they occur. Other columns are not looked at.
    """
    ship_package(docs.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        held_ids, held, n = [], [], 0
        end = np.array([END_ID], "<u4")

        def segment():
            return pa.RecordBatch.from_arrays(
                [pa.array([part << PART_BITS | seq], pa.int64()), pa.array([held_ids], pa.list_(pa.int64())),
                 pa.array([n], pa.int64()), pa.array([pack(held)], pa.binary())],
                names=["segment", "doc_ids", "n_ids", "payload"])

        for batch in batches:
            for doc_ids, texts in _chunks(batch):
                for doc_id, ids in zip(doc_ids, encoder.all_ids(texts)):
                    ids = np.concatenate((ids, end))
                    held_ids.append(doc_id)
                    held.append(ids)
                    n += len(ids)
                    if n >= segment_ids:
                        yield segment()
                        held_ids, held, n, seq = [], [], 0, seq + 1
        if held:
            yield segment()

    spark = docs.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(count, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    segments = ordered.mapInArrow(encoded, "segment long, doc_ids array<long>, n_ids long, payload binary")
    segments.write.option("compression", "none").parquet(path)


def read_token_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 (of the little-endian unsigned 32-bit
    ids) of every document in the files; ``ids`` (array of long) as well if asked for."""
    ship_package(spark)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, doc_ids, payload in zip(*(batch.column(i) for i in range(3))):
                found = unpack(payload.as_py())
                sizes = np.array([len(d) for d in found], np.int64)
                columns = [pa.array([segment.as_py()] * len(found), pa.int64()), pa.array(doc_ids.as_py(), pa.int64()),
                           pa.array(np.cumsum(sizes) - sizes), pa.array(sizes),
                           pa.array([zlib.crc32(np.ascontiguousarray(d, "<u4").tobytes()) for d in found], pa.int64())]
                if with_ids:
                    columns.append(pa.array([d.astype(np.int64) for d in found], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["segment", "doc_id", "inside", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    files = spark.read.schema("segment long, doc_ids array<long>, n_ids long, payload binary").parquet(path)
    rows = files.select("segment", "doc_ids", "payload").mapInArrow(
        decoded, "segment long, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    starts = running_offsets(files.select("segment", "n_ids"), "segment", "n_ids", "before", fan=1 << PART_BITS)
    return rows.join(starts.select("segment", "before"), "segment").select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), *names[3:])


def tokenized_documents(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Query op10: every document's ids written and read back; start, length and checksum."""
    import public_tokenizers
    path = scratch_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(vocabulary))
    return read_token_ids(spark, path)
