"""Packing documents into sequences of a fixed window, by best fit decreasing.

Texts are encoded once, in the tasks; an end id closes each document. A document is cut into full windows and one rest,
and each piece goes into a sequence whole. What best fit decreasing does depends on the lengths alone, and there are no
more lengths than ids in a window. So the corpus is first reduced to a histogram of piece lengths (at most ``window``
numbers, whatever its size); the driver packs the histogram, moving runs of equal pieces into runs of equal open
windows; the resulting plan (``Plan``) says for the k-th piece of a length where it lies. Its size depends on the
window, not on the data. The tasks number the pieces of each length and look their places up.

The packing is that of best fit decreasing over all pieces at once. Nothing is packed per partition, so padding does
not grow with the number of tasks.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from paystrata.llm import hashing
from paystrata.llm.common import pick, stored, text_blocks
from paystrata.llm.pretokens import PieceCache, gather, library

WINDOW = 2048
END_ID = 1
#: Pieces of one length are numbered in this many independent groups, so that a frequent length is no single group.
SALTS = 256

PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                       T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                       T.StructField("doc_tokens", T.LongType())])

#: White space beyond ASCII; a text that holds some is left to the library as a whole.
OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_LEADS = np.zeros(256, bool)
_LEADS[[0x1c, 0x1d, 0x1e, 0x1f, 0xc2, 0xe1, 0xe2, 0xe3]] = True


def piece_encoder(tokenizer_path: str, ranks_path: str | None):
    """An encoder of lists of pieces. ``ranks_path`` names the same vocabulary as ranks, which encodes faster."""
    whole = library(tokenizer_path)
    specials = [t.content for t in whole.get_added_tokens_decoder().values()]
    if not ranks_path:
        return lambda texts: [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)], whole
    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        return [whole.encode(t, add_special_tokens=False).ids if any(s in t for s in specials)
                else fast.encode_ordinary(t) for t in texts]

    return encode, whole


def encoded(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, ranks_path: str | None,
            window: int, end_id: int) -> DataFrame:
    """The pieces of each document: full windows, then the rest."""

    def run(batches):
        encode, whole = piece_encoder(tokenizer_path, ranks_path)
        cache = PieceCache(encode)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for first, last, data, offsets in text_blocks(texts):
                yield _pieces(doc_ids.slice(first, last - first), data, offsets, cache, whole, window, end_id)

    return pick(docs, id_col, text_col).mapInArrow(run, PIECES)


def _pieces(doc_ids, data, offsets, cache, whole, window, end_id) -> pa.RecordBatch:
    n = len(offsets) - 1
    _, word_ends, words_before = hashing.word_bounds(data, offsets)
    # a document's pieces end with its words, and with the document itself
    ends = np.insert(word_ends, words_before[1:], offsets[1:])
    before = words_before + np.arange(n + 1)
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1]
    starts[:1] = 0
    at, size = cache.look_up(hashing.spans(data, hashing.EXACT, starts, ends), data, starts, ends)
    ids = gather(cache.pool, at, size)
    tokens_before = np.concatenate([[0], np.cumsum(size)])[before]
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LEADS[data], out=odd[1:])
    suspect = odd[offsets[1:]] - odd[offsets[:-1]] > 0
    out_doc, out_start, out_length, out_crc, out_total = [], [], [], [], []
    for i in range(n):
        own = ids[tokens_before[i]:tokens_before[i + 1]]
        if suspect[i]:
            text = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
            if OTHER_SPACE.search(text):
                own = np.asarray(whole.encode(text, add_special_tokens=False).ids, np.uint32)
        total = len(own) + 1
        raw = own.astype("<u4").tobytes() + end_id.to_bytes(4, "little")
        for start in range(0, total, window):
            length = min(window, total - start)
            out_doc.append(i)
            out_start.append(start)
            out_length.append(length)
            out_crc.append(zlib.crc32(raw[4 * start:4 * (start + length)]))
            out_total.append(total)
    return pa.RecordBatch.from_arrays(
        [doc_ids.take(pa.array(out_doc, pa.int64())), pa.array(out_start, pa.int64()), pa.array(out_length, pa.int64()),
         pa.array(out_crc, pa.int64()), pa.array(out_total, pa.int64())], names=PIECES.names)


class OpenWindows:
    """Runs of open windows by remaining capacity, under a segment tree that finds the tightest one that fits."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = [False] * (2 * self.leaves)       # a node tells whether any window below it is open
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.leaves)]

    def _mark(self, capacity: int) -> None:
        node = capacity + self.leaves
        self.filled[node] = bool(self.runs[capacity])
        while node > 1:
            node //= 2
            self.filled[node] = self.filled[2 * node] or self.filled[2 * node + 1]

    def add(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.runs[capacity].append((first, count))
            self._mark(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        run = self.runs[capacity].pop()
        self._mark(capacity)
        return run

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that some window has."""
        node = length + self.leaves
        if self.filled[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.filled[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.filled[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


class Plan:
    """Rows (length, first piece, first sequence, pieces to a sequence, offset), sorted by length and first piece."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]], sequences: int):
        self.rows = np.asarray(sorted(rows), np.int64).reshape(-1, 5)
        self.sequences = sequences
        self.lengths, self.first = np.unique(self.rows[:, 0], return_index=True)
        self.last = np.append(self.first[1:], len(self.rows))

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the piece with this rank among the pieces of this length."""
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for value in np.unique(length):
            k = int(np.searchsorted(self.lengths, value))
            rows = self.rows[self.first[k]:self.last[k]]
            own = np.flatnonzero(length == value)
            run = rows[np.searchsorted(rows[:, 1], rank[own], side="right") - 1]
            nth = rank[own] - run[:, 1]
            sequence[own] = run[:, 2] + nth // run[:, 3]
            offset[own] = run[:, 4] + nth % run[:, 3] * value
        return sequence, offset


def best_fit_decreasing(counts: dict[int, int], window: int) -> Plan:
    """Place ``counts[length]`` pieces of each length, longest first, each into the open window it fills best.

    A window that took one piece and has room for another of that length is then the tightest, so it is filled up
    before the next: a run of windows of one capacity takes ``capacity // length`` pieces each.
    """
    open_windows, rows, sequences = OpenWindows(window), [], 0
    for length in sorted(counts, reverse=True):
        placed, left = 0, counts[length]
        while left:
            capacity = open_windows.tightest(length)
            if capacity is None:
                capacity = window
                first, count = sequences, -(-left // (window // length))
                sequences += count
            else:
                first, count = open_windows.take(capacity)
            each = capacity // length
            full = min(count, left // each)
            rest = left - full * each if full < count else 0
            rows.append((length, placed, first, each, window - capacity))
            open_windows.add(capacity - each * length, first, full)
            if rest:
                rest = min(rest, each)
                open_windows.add(capacity - rest * length, first + full, 1)
            open_windows.add(capacity, first + full + bool(rest), count - full - bool(rest))
            placed += full * each + rest
            left -= full * each + rest
    return Plan(rows, sequences)


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens.

    A null or empty text is one piece that holds the end id. Equal documents, and rows that repeat an id, are packed
    each. A null id stays null. An empty table gives no rows.
    """
    pieces = stored(encoded(docs, id_col, text_col, tokenizer_path, ranks_path, window, end_id), "pieces")
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS)).alias("salt")
    sizes = pieces.groupBy("length", salt).count()
    histogram = {row["length"]: row["n"] for row in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = best_fit_decreasing(histogram, window)
    # at most window * SALTS rows: how many pieces of the length are in the groups before
    before = sizes.select("length", "salt", (F.sum("count").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("count")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = (pieces.withColumn("salt", salt).withColumn("nth", nth).join(before, ["length", "salt"])
              .select(*PIECES.names, (F.col("nth") + F.col("before")).cast("long").alias("rank")))
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    schema = T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches):
        for batch in batches:
            sequence, offset = shared.value.places(batch.column(2).to_numpy(zero_copy_only=False),
                                                   batch.column(5).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=schema.names)

    return ranked.mapInArrow(place, schema)
