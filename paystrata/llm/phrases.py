"""Collocations by SON partitioning: phrases mined shard by shard, then counted exactly over everything.

Everything is per language. A shard is a run of consecutive rows of a task, at most ``SHARD_BYTES`` of text (a longer text is a
shard alone). A phrase that occurs ``support`` times in all occurs, in one shard at least, as often as that shard's share of the
language's words calls for; so mining each shard completely at its proportional support finds every frequent phrase.

Lengths follow each other. For each length k:

1. **Mine.** In each shard: all k-word runs inside a piece whose first and last k - 1 words are frequent phrases, as a bit
   filter of those tells, that occur at least ``ceil(support * words of the shard / words of the language)`` times.
2. **Unite** what all shards found. A shard that did not report a phrase holds it less often than its support; where the counts
   reported and these bounds together stay below the support of all, the phrase goes. The rest are the candidates.
3. **Count** the candidates, told by a bit filter, in all shards; sums below the support go.

The filters (``bits``) are sized by the number of phrases, up to a bound; they let through some phrases too many and lose
none, and equal phrases pass alike in all shards, so sums are exact. Inside a shard phrases are told apart by the exact ids
of their words. Where a shard's support comes to 1 (a corpus of over ``support`` shards), mining lets all runs of frequent
parts through: then the step from length to length is what bounds the rows that are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.llm import hashing
from paystrata.llm.bits import Filter, filter_of
from paystrata.llm.common import byte_view, discard, ship, stored

SUPPORT = 100
LONGEST = 5
FIRST = 2000
NO_LANGUAGE = "und"
SHARD_BYTES = 1 << 25
#: Languages whose number of words is sent to the tasks, the largest; others are mined at a support of 1.
TOTALS = 4096
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True
_SPACE = np.zeros(256, bool)
_SPACE[32] = True


class Words:
    """The words of some texts of one language, and which of them follow each other in one piece."""

    def __init__(self, texts: pa.Array, lang: str):
        data, ends = byte_view(texts)
        self.data, offsets = _FOLD[data[ends[0]:ends[-1]]], ends - ends[0]
        self.starts, self.ends, before = hashing.word_bounds(self.data, offsets, _GAP)
        self.salt = salt(lang)
        breaks = np.flatnonzero(_BREAK[self.data])
        # word i + 1 is in the piece of word i
        self.follows = np.searchsorted(breaks, self.starts[1:]) == np.searchsorted(breaks, self.ends[:-1])
        edges = before[1:-1]
        edges = edges[(edges > 0) & (edges < len(self.starts))]
        self.follows[edges - 1] = False
        self._hashes = None

    def __len__(self):
        return len(self.starts)

    def hashes(self, size: int) -> np.ndarray:
        """The hash of each run of ``size`` words."""
        if self._hashes is None:
            self._hashes = hashing.spans(self.data, hashing.EXACT, self.starts, self.ends)
        return hashing.windows(self._hashes, size) ^ self.salt

    def runs(self, size: int) -> np.ndarray:
        """For each word whether ``size`` words from it on lie in one piece."""
        n = len(self) - size + 1
        whole = np.ones(max(n, 0), bool)
        for k in range(size - 1):
            whole &= self.follows[k:k + len(whole)]
        return whole

    def array(self, which: np.ndarray) -> pa.Array:
        """The words with these numbers."""
        upto = np.zeros(len(which) + 1, np.int64)
        np.cumsum(self.ends[which] - self.starts[which], out=upto[1:])
        inside = np.zeros(len(self.data) + 1, np.int8)      # a byte for each byte of text, where an index would take eight
        inside[self.starts[which]] += 1
        inside[self.ends[which]] -= 1
        own = self.data[np.cumsum(inside[:-1], dtype=np.int8, out=inside[:-1]).view(bool)]
        return pa.Array.from_buffers(pa.large_binary(), len(which), [None, pa.py_buffer(upto), pa.py_buffer(own)])

    def counted(self, at: np.ndarray, size: int, least: int) -> tuple[pa.Array, np.ndarray]:
        """The different runs of ``size`` words that begin at the words ``at`` and occur ``least`` times, and how often."""
        used = np.zeros(len(self), bool)
        for k in range(size):
            used[at + k] = True
        numbers = np.flatnonzero(used)
        coded = self.array(numbers).dictionary_encode()
        if size == 1:
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            return coded.dictionary.filter(pa.array(n >= least)), n[n >= least]
        ids = np.zeros(len(self), np.int64)
        ids[numbers] = coded.indices.to_numpy()
        code = ids[at]
        for k in range(1, size):        # exact: the number of runs so far, times the words, stays far below 2**63
            code = np.unique(code, return_inverse=True)[1] * len(coded.dictionary) + ids[at + k]
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        keep = n >= least
        parts = [coded.dictionary.take(pa.array(ids[at[first[keep]] + k])) for k in range(size)]
        return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())), n[keep]


def salt(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode("utf-8", "surrogateescape"), np.uint8)
    return hashing.spans(raw, hashing.EXACT, np.array([0]), np.array([len(raw)]))[0]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows (lang, text) of bounded size."""
    held, size = [], 0

    def whole():
        table = pa.Table.from_batches(held).combine_chunks()
        return table.to_batches()[0] if table.num_rows else table

    for batch in batches:
        _, ends = byte_view(batch.column(1))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, ends[first] + SHARD_BYTES - size, side="right")) - 1
            if last <= first and not held:
                last = first + 1
            last = min(last, batch.num_rows)
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(ends[last] - ends[first])
            if last < batch.num_rows or size >= SHARD_BYTES:
                yield whole()
                held, size = [], 0
            first = last
    if held:
        yield whole()


def _in_shards(texts: DataFrame, count: Callable[[Words, str], tuple[pa.Array, np.ndarray, int]]) -> DataFrame:
    """(lang, phrase, f) with the sums of what ``count`` finds in the words of each shard and language.

    ``count`` returns phrases, their numbers, and a number that is added up under the phrase null.
    """

    def run(batches):
        for shard in _shards(batches):
            langs = shard.column(0).dictionary_encode()
            order = langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = shard.column(1).filter(pa.array(order == k))
                found, n, beside = count(Words(own, lang), lang)
                if beside:
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.nulls(1, pa.binary()), pa.array([beside], pa.int64())],
                                                     names=["lang", "phrase", "f"])
                for at in range(0, len(found), 1 << 16):
                    part = found.slice(at, 1 << 16).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), part, pa.array(n[at:at + len(part)].astype(np.int64))],
                        names=["lang", "phrase", "f"])

    return (texts.mapInArrow(run, "lang string, phrase binary, f long")
            .groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("f").alias("f")))


def filter_of_phrases(phrases: DataFrame, size: int) -> Filter:
    """The filter of phrases (lang, phrase) of ``size`` words."""

    def run(batches):
        for batch in batches:
            data, ends = byte_view(batch.column(1))
            own = data[ends[0]:ends[-1]]
            starts, word_ends, before = hashing.word_bounds(own, ends - ends[0], _SPACE)
            found = hashing.windows(hashing.spans(own, hashing.EXACT, starts, word_ends), size)[before[:-1]]
            langs = batch.column(0).dictionary_encode()
            salts = np.array([salt(v) for v in langs.dictionary.to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((found ^ salts[langs.indices.to_numpy()]).view(np.int64))], names=["h"])

    return filter_of(phrases.select("lang", "phrase").mapInArrow(run, "h long"), phrases.count())


def frequent_phrases(texts: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f, size) of all phrases of up to ``longest`` words that occur ``support`` times, (lang, n) of all words)."""
    share = texts.sparkSession.sparkContext.broadcast
    words = stored(_in_shards(texts, lambda own, lang: (*own.counted(np.arange(len(own)), 1, 1), 0)), "phrases-words")
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrases-totals")
    known = share({r["lang"]: r["n"] for r in totals.orderBy(F.desc("n"), "lang").limit(TOTALS).collect()})
    levels = [words.filter(F.col("f") >= support)]
    for size in range(2, longest + 1):
        parts = filter_of_phrases(levels[-1], size - 1)
        if parts.empty():
            break
        shared = share(parts)

        def mine(own: Words, lang: str, size=size, shared=shared):
            inner = shared.value.holds(own.hashes(size - 1))
            n = max(len(own) - size + 1, 0)
            at = np.flatnonzero(own.runs(size) & inner[:n] & inner[1:n + 1])
            total = known.value.get(lang)
            least = -(-support * len(own) // total) if total else 1
            found, f = own.counted(at, size, least)
            return found, f - (least - 1), least - 1

        # how far the shards that report a phrase are above what those that don't may have; and that, of all shards
        mined = stored(_in_shards(texts, mine), "phrases-mined")
        unseen = mined.filter("phrase IS NULL").select("lang", F.col("f").alias("unseen"))
        candidates = stored(mined.filter("phrase IS NOT NULL").join(unseen, "lang", "left")
                            .filter(F.col("f") + F.coalesce("unseen", F.lit(0)) >= support).select("lang", "phrase"),
                            "phrases-candidates")
        discard(mined)
        chosen = share(filter_of_phrases(candidates, size))

        def count(own: Words, lang: str, size=size, chosen=chosen):
            return *own.counted(np.flatnonzero(own.runs(size) & chosen.value.holds(own.hashes(size))), size, 1), 0

        levels.append(stored(_in_shards(texts, count).filter(F.col("f") >= support), "phrases-frequent"))
        discard(candidates)
    every = None
    for size, level in enumerate(levels, 1):
        level = level.select("lang", "phrase", "f", F.lit(size).alias("size"))
        every = level if every is None else every.union(level)
    return every, totals


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): each phrase of several words with its lowest-scoring cut.

    The products are decimals of 38 digits and the division is a whole one, so scores are exact.
    """
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    words = F.split("phrase", " ", -1)
    cuts = (phrases.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), words.alias("words"), "size",
                                              F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
            .select("lang", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("left"),
                    F.array_join(F.slice("words", F.col("cut") + 1, F.col("size") - F.col("cut")), " ").alias("right")))
    part = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    both = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
    product = (F.lit(1000).cast("decimal(4,0)") * exact("a")).cast("decimal(22,0)")
    both = both.withColumn("above", (product * exact("n")).cast("decimal(38,0)")).withColumn(
        "below", (exact("l") * exact("r")).cast("decimal(38,0)"))
    both = both.withColumn("score", F.expr("above div below").cast("long"))
    return (both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
            .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score"))


def not_inside(phrases: DataFrame) -> DataFrame:
    """(lang, phrase) of the phrases that no longer phrase as frequent holds.

    If a longer one as frequent holds a phrase, so does one that is longer by a word, as nothing between is rarer.
    """
    words = F.split("phrase", " ", -1)
    longer = phrases.filter("size > 2").select("lang", "f", "size", words.alias("words"))
    inner = longer.select("lang", "f", F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.col("size") - 1), " "),
        F.array_join(F.slice("words", F.lit(2), F.col("size") - 1), " "))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    return (phrases.filter("size > 1").join(most, ["lang", "phrase"], "left")
            .filter("most IS NULL OR most < f").select("lang", "phrase"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                 longest: int = LONGEST, first: int = FIRST) -> DataFrame:
    """The ``first`` phrases of each language by score, count and text: lang, rank, phrase, a, l, r, n, score.

    A-Z are folded, pieces end at ``. , ; : ! ?`` and line ends, words at spaces and tabs. A null language is ``und``, a null
    text empty. Repeated rows count each, other columns are ignored; bytes that are no UTF-8 are kept as they are. A language
    without a phrase of ``support`` occurrences has no rows, as has an empty table.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                        docs[text_col].cast("string").alias("text"))
    phrases, totals = frequent_phrases(texts, support, longest)
    best = scored(phrases, totals).join(not_inside(phrases), ["lang", "phrase"], "left_semi")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
