"""Counting the tokens of each document, map-side, through two tiers of known lengths.

The tokenizer in use drops white space and never joins characters across it, so the tokens of a text are those of its
words (runs without ASCII white space), summed. A first pass over all texts counts the frequent words: each task
counts lossily (a word must occur twice within a megabyte to be counted there, so memory stays bounded) and hands on
its most frequent words only; what is shuffled are these summaries, never the words of the texts. The driver encodes
the most frequent words of all summaries and broadcasts their token counts as a compact hash table, by the hash of the
word's bytes. The second pass looks all words up in the table; misses are encoded by the library, through a cache that
each worker keeps. Which words are in the table changes the time only, never a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.llm import hashing
from paystrata.llm.common import pick, text_blocks
from paystrata.llm.pretokens import PieceCache, library

#: Slots of the broadcast table (10 bytes each) and words that one task hands on.
TABLE_SLOTS = 1 << 18
TASK_WORDS = 8192
#: Words a task counts before it drops the rare ones.
COUNTED_WORDS = 200_000
TOKEN_LIMIT = 2048


def _words(data, offsets):
    starts, ends, before = hashing.word_bounds(data, offsets)
    return starts, ends, before, hashing.spans(data, hashing.EXACT, starts, ends)


def frequent_words(texts: DataFrame) -> DataFrame:
    """(word, n): how often the words that are frequent within some task occur, by the summaries of all tasks."""

    def run(batches):
        counts: dict[int, list] = {}
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(1)):
                starts, ends, _, hashes = _words(data, offsets)
                found, first, n = np.unique(hashes, return_index=True, return_counts=True)
                often = np.flatnonzero(n > 1)
                raw = data.tobytes()
                for h, i, c in zip(found[often].tolist(), first[often].tolist(), n[often].tolist()):
                    if h in counts:
                        counts[h][0] += c
                    else:
                        counts[h] = [c, raw[starts[i]:ends[i]]]
            if len(counts) > COUNTED_WORDS:
                keep = sorted((c for c, _ in counts.values()), reverse=True)[COUNTED_WORDS // 2]
                counts = {h: v for h, v in counts.items() if v[0] > keep}
        top = sorted(counts.values(), key=lambda v: (-v[0], v[1]))[:TASK_WORDS]
        yield pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for _, w in top], pa.string()),
                                          pa.array([c for c, _ in top], pa.int64())], names=["word", "n"])

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def length_table(words: list[str], tokenizer_path: str, slots: int = TABLE_SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Hash keys and token counts by slot; of two words in one slot the earlier one in the list stays."""
    keys, sizes = np.zeros(slots, np.uint64), np.zeros(slots, np.uint16)
    if not words:
        return keys, sizes
    raw = [w.encode() for w in words]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in raw])]).astype(np.int64)
    hashes = hashing.spans(np.frombuffer(b"".join(raw), np.uint8), hashing.EXACT, offsets[:-1], offsets[1:])
    n_ids = [len(e) for e in library(tokenizer_path).encode_batch_fast(words, add_special_tokens=False)]
    fits = np.array([n < 65536 for n in n_ids])
    slot = (hashes & np.uint64(slots - 1)).astype(np.int64)
    for k in np.flatnonzero(fits)[::-1].tolist():
        keys[slot[k]], sizes[slot[k]] = hashes[k], n_ids[k]
    return keys, sizes


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = TOKEN_LIMIT, table_slots: int = TABLE_SLOTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows and null ids are counted each. Special strings
    inside a text count as the library counts them. An empty table gives no rows.
    """
    texts = pick(docs, id_col, text_col)
    # the table's size bounds what is collected
    words = [r["word"] for r in frequent_words(texts).orderBy(F.desc("n"), "word").limit(table_slots // 2).collect()]
    table = docs.sparkSession.sparkContext.broadcast(length_table(words, tokenizer_path, table_slots))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches):
        keys, lengths = table.value
        mask = np.uint64(len(keys) - 1)
        coder = library(tokenizer_path)
        cache = PieceCache(lambda words: [e.ids for e in coder.encode_batch_fast(words, add_special_tokens=False)])
        for batch in batches:
            n_bytes, n_tokens = [], []
            for _, _, data, offsets in text_blocks(batch.column(1)):
                starts, ends, before, hashes = _words(data, offsets)
                slot = (hashes & mask).astype(np.int64)
                size = lengths[slot].astype(np.int64)
                missing = np.flatnonzero(keys[slot] != hashes)
                size[missing] = cache.look_up(hashes[missing], data, starts[missing], ends[missing])[1]
                upto = np.concatenate([[0], np.cumsum(size)])[before]
                n_bytes.append(np.diff(offsets))
                n_tokens.append(np.diff(upto))
            counted = np.concatenate([*n_tokens, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([*n_bytes, np.zeros(0, np.int64)])), pa.array(counted),
                 pa.array(counted > limit)], names=schema.names)

    return texts.mapInArrow(run, schema)
