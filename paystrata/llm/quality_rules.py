"""Line-first cleaning: each line is judged by itself, failing lines go, and a text that loses too much goes as a whole.

Rules on a line (lines without a word pass):

* punctuation: more than a fifth of its solid characters are marks other than ``. , ' " -``; or it has 50 words or
  more and no mark of a sentence;
* navigation: two words or more are separators, and they are a fifth or more of its words;
* boilerplate: 20 words or less, with a phrase of ``PHRASES``.

Before that, a text fails outright if it has fewer than 50 words, or if more than half of its words lie in 3-word
windows that occur twice or more in it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.llm import hashing
from paystrata.llm.common import annotate, field, free_name, pick

MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50
MOST_MARKS_PERCENT = 20
LONG_LINE_WORDS = 50
SEPARATOR_SHARE = 5
BOILERPLATE_WORDS = 20
MOST_LOST_PERCENT = 50

SYMBOLS = b"#*$%&|<>"
SENTENCE_MARKS = b".,;:!?"
MARKS = b"!#$%&()*+/:;<=>?@[\\]^_`{|}~"
SEPARATORS = ("|", ">", "/", "-", "–", "»", "•", "·")
PHRASES = ("all rights reserved", "licensed under", "released under the", "terms of use", "terms of service",
           "privacy policy", "cookie policy", "accept cookies", "enable javascript", "lorem ipsum", "click here",
           "read more", "sign up", "log in", "subscribe to", "share this", "back to top", "powered by")

FIELDS = [field(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    field("base_failed", T.BooleanType()), field("kept", T.BooleanType()), field("lost_chars", T.LongType())]


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_IS_SYMBOL, _IS_SENTENCE, _IS_MARK = _table(SYMBOLS), _table(SENTENCE_MARKS), _table(MARKS)
_OPENS_CHARACTER = (np.arange(256) & 0xC0) != 0x80


def _sum_by(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def repeated_words(windows: np.ndarray) -> int:
    """Words that lie in a 3-word window that occurs twice or more, given the hash of each window."""
    _, back, n = np.unique(windows, return_inverse=True, return_counts=True)
    twice = n[back] > 1
    covered = np.zeros(len(windows) + 2, bool)
    for shift in range(3):
        covered[shift:shift + len(windows)] |= twice
    return int(covered.sum())


def line_verdicts(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray, words: np.ndarray,
                  solid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, solid characters before each, and whether it fails a rule."""
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], breaks + 1)
    starts = starts[starts < len(data)] if len(data) else starts[:0]
    ends = np.append(starts[1:], len(data))[:len(starts)]      # no text, no line
    ends -= data[ends - 1] == 10 if len(ends) else 0
    n_words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
    chars = solid[ends] - solid[starts]
    marks, sentence = _sum_by(_IS_MARK[data]), _sum_by(_IS_SENTENCE[data])
    marked = 100 * (marks[ends] - marks[starts]) > MOST_MARKS_PERCENT * chars
    unbroken = (n_words >= LONG_LINE_WORDS) & (sentence[ends] == sentence[starts])
    parts = _sum_by(np.isin(words, _separators()))
    first_word = np.searchsorted(word_starts, starts)
    n_separators = parts[first_word + n_words] - parts[first_word]
    navigation = (n_separators >= 2) & (SEPARATOR_SHARE * n_separators >= n_words)
    boilerplate = np.zeros(len(starts), bool)
    lowered = data.tobytes().lower()
    for phrase in PHRASES:
        raw, at = phrase.encode(), -1
        while (at := lowered.find(raw, at + 1)) >= 0:
            line = int(np.searchsorted(starts, at, side="right")) - 1
            boilerplate[line] |= at + len(raw) <= ends[line]
    boilerplate &= n_words <= BOILERPLATE_WORDS
    return starts, ends, chars, (n_words > 0) & (marked | unbroken | navigation | boilerplate)


def _separators() -> np.ndarray:
    raw = [s.encode() for s in SEPARATORS]
    ends = np.cumsum([len(r) for r in raw])
    return hashing.spans(np.frombuffer(b"".join(raw), np.uint8), hashing.EXACT, ends - [len(r) for r in raw], ends)


def judge(data: np.ndarray, offsets: np.ndarray, cleaned: bool = False) -> list:
    """The columns of ``FIELDS`` for a block of texts, and the cleaned texts if asked for."""
    n = len(offsets) - 1
    word_starts, word_ends, before = hashing.word_bounds(data, offsets)
    words = hashing.spans(data, hashing.EXACT, word_starts, word_ends)
    grams = hashing.windows(words, 3)
    n_words = np.diff(before)
    solid = _sum_by(~hashing.IS_SPACE[data] & _OPENS_CHARACTER[data])
    symbols = _sum_by(_IS_SYMBOL[data])
    starts, ends, chars, failed = line_verdicts(data, offsets, word_starts, words, solid)
    line_hashes = hashing.spans(data, hashing.EXACT, starts, ends)
    line_of = np.searchsorted(starts, offsets)
    lost_upto = np.concatenate([[0], np.cumsum(chars * failed)])
    duplicates, repeated = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        own = slice(line_of[i], line_of[i + 1])
        with_words = line_hashes[own][chars[own] > 0]
        duplicates[i] = len(with_words) - len(np.unique(with_words))
        if n_words[i] >= 3:
            repeated[i] = repeated_words(grams[before[i]:before[i + 1] - 2])
    word_chars = np.diff(solid[offsets])
    lost = np.diff(lost_upto[line_of])
    base_failed = (n_words < MIN_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)
    kept = ~base_failed & (100 * lost <= MOST_LOST_PERCENT * word_chars)
    columns = [n_words, word_chars, np.diff(symbols[offsets]), duplicates, repeated, base_failed, kept, lost]
    if cleaned:
        raw = data.tobytes()
        columns.append(["\n".join(raw[starts[k]:ends[k]].decode("utf-8", "replace")
                                  for k in range(line_of[i], line_of[i + 1]) if not failed[k]) for i in range(n)])
    return columns


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    lost_chars (solid characters in failing lines).

    A null or empty text has no words and fails. Rows are judged each by itself, repeated rows and null ids alike.
    An empty table gives no rows.
    """
    return annotate(pick(docs, id_col, text_col), "text", lambda: judge, FIELDS).drop("text")


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns, their text without the failing lines."""
    kept, cleaned = free_name(docs.columns, "kept"), free_name(docs.columns, "cleaned")
    fields = [field(kept, T.BooleanType()), field(cleaned, T.StringType())]

    def compute():
        def block(data, offsets):
            columns = judge(data, offsets, cleaned=True)
            return [columns[6], columns[8]]
        return block

    judged = annotate(docs, text_col, compute, fields).filter(F.col(kept))
    return judged.withColumn(text_col, F.col(cleaned)).select(*docs.columns)
