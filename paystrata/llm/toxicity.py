"""Toxicity from subword bags: embeddings of character n-grams, averaged, into a linear softmax.

A word is a run of folded letters and digits. Its features are itself and its runs of 3 to 5 bytes, with marks for its
ends, hashed into buckets; an unseen misspelling shares most of them. The embeddings of the features of a passage of
``PASSAGE`` words are averaged, and a softmax over two classes reads the average. Embeddings and softmax are trained
together, with numpy. A text scores as its most toxic passage does: a few words count in a long text as in a short one.

Labels are of whole texts. So training goes in rounds: at first every passage carries its text's label; then only the
passages of a toxic text that the last round scored highest are taken as toxic, and the highest of clean texts are
repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.llm import hashing
from paystrata.llm.common import annotate, field, fold, pick

BUCKETS = 1 << 16
WIDTH = 8
PASSAGE = 6
GRAMS = (3, 4, 5)
#: Labelled texts of each class that are learned from: the training bound.
LEARN_FROM = 700
#: Words a worker keeps the values of.
KNOWN_WORDS = 1 << 18

_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = False
_GAP[128:] = False


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words one after the other, and how many each word has."""
    lengths = ends - starts
    # every word between two marks, in one array
    marked = np.full(int(lengths.sum()) + 2 * len(starts), ord("<"), np.uint8)
    begin = np.cumsum(lengths + 2) - (lengths + 2)
    inside = np.ones(len(marked), bool)
    inside[begin] = inside[begin + lengths + 1] = False
    position = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    marked[inside] = data[np.repeat(starts, lengths) + position]
    marked[begin + lengths + 1] = ord(">")
    sums = hashing.running(marked, hashing.FOLDED)
    found = [hashing.ranges(sums, begin, begin + lengths + 2)]
    owner = [np.arange(len(starts))]
    for size in GRAMS:
        n = np.maximum(lengths + 3 - size, 0)
        word = np.repeat(np.arange(len(starts)), n)
        at = begin[word] + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        found.append(hashing.ranges(sums, at, at + size))
        owner.append(word)
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(BUCKETS)).astype(np.int64), np.bincount(owners, minlength=len(starts))


def passages(data: np.ndarray, offsets: np.ndarray):
    """Words of all texts, and how the passages part them: starts, ends, first word of each passage, its text."""
    starts, ends, before = hashing.word_bounds(data, offsets, _GAP)
    n_words = np.diff(before)
    n_passages = -(-n_words // PASSAGE)
    text = np.repeat(np.arange(len(n_words)), n_passages)
    nth = np.arange(int(n_passages.sum())) - np.repeat(np.cumsum(n_passages) - n_passages, n_passages)
    return starts, ends, before[:-1][text] + nth * PASSAGE, text


@dataclass
class Model:
    """What a trained model comes down to: one number per bucket, for the average is linear, and an offset."""
    values: np.ndarray
    offset: float

    def scores(self, data: np.ndarray, offsets: np.ndarray, known: dict) -> np.ndarray:
        starts, ends, first, text = passages(data, offsets)
        out = np.full(len(offsets) - 1, _sigmoid(self.offset))
        if not len(first):
            return out
        hashes = hashing.spans(data, hashing.FOLDED, starts, ends)
        value, size = self._words(hashes, data, starts, ends, known)
        logits = np.add.reduceat(value, first) / np.add.reduceat(size, first) + self.offset
        best = np.full(len(offsets) - 1, -np.inf)
        np.maximum.at(best, text, logits)
        filled = np.isfinite(best)
        out[filled] = _sigmoid(best[filled])
        return out

    def _words(self, hashes, data, starts, ends, known):
        if not known:
            known.update(keys=np.zeros(KNOWN_WORDS, np.uint64), value=np.zeros(KNOWN_WORDS), size=np.zeros(KNOWN_WORDS))
        slot = (hashes & np.uint64(KNOWN_WORDS - 1)).astype(np.int64)
        value, size = known["value"][slot], known["size"][slot]
        missing = np.flatnonzero(known["keys"][slot] != hashes)
        if len(missing):
            new, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            rows = missing[first]
            buckets, n = word_features(data, starts[rows], ends[rows])
            sums = np.add.reduceat(self.values[buckets], np.cumsum(n) - n)
            value[missing], size[missing] = sums[back], n[back]
            at = slot[rows]
            known["keys"][at], known["value"][at], known["size"][at] = new, sums, n
        return value, size


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(texts: list[str], toxic: list[int], rounds: int = 3, epochs: int = 4, batch: int = 256, rate: float = 0.5,
          seed: int = 7) -> Model:
    """Fit embeddings and softmax to texts labelled 0 or 1."""
    if len(set(toxic)) < 2:
        return Model(np.zeros(BUCKETS), 30.0 if toxic and toxic[0] else -30.0)
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    starts, ends, first, text = passages(data, offsets)
    hashes = hashing.spans(data, hashing.FOLDED, starts, ends)
    _, at, word = np.unique(hashes, return_index=True, return_inverse=True)
    buckets, n = word_features(data, starts[at], ends[at])
    begin = np.cumsum(n) - n
    last = np.append(first[1:], len(starts))
    last = np.minimum(last, first + PASSAGE)
    label = np.asarray(toxic)[text]
    random = np.random.default_rng(seed)
    embed = random.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    softmax = random.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = np.full(embed.shape, 1e-6, np.float32)
    chosen = np.arange(len(first))
    for turn in range(rounds):
        if turn:
            logits = _passage_logits(embed, softmax, bias, word, buckets, begin, n, first)
            best = np.full(len(texts), -np.inf)
            np.maximum.at(best, text, logits)
            top = logits >= best[text]
            hard = np.flatnonzero(top & (label == 0))
            chosen = np.concatenate([np.flatnonzero(top | (label == 0)), np.repeat(hard, 2)])
        share = label[chosen].mean()
        weight = np.where(label == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)).astype(np.float32)
        for _ in range(epochs):
            order = random.permutation(chosen)
            for k in range(0, len(order), batch):
                rows = order[k:k + batch]
                n_words = last[rows] - first[rows]
                own = word[np.repeat(first[rows] - (np.cumsum(n_words) - n_words), n_words) + np.arange(n_words.sum())]
                n_features = n[own]
                which = np.repeat(begin[own] - (np.cumsum(n_features) - n_features), n_features) + np.arange(n_features.sum())
                features = buckets[which]
                per_row = np.add.reduceat(n_features, np.cumsum(n_words) - n_words)
                mean = np.add.reduceat(embed[features], np.cumsum(per_row) - per_row, axis=0) / per_row[:, None]
                z = mean @ softmax + bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(rows)), label[rows]] -= 1
                p *= (weight[rows] / len(rows))[:, None]
                into = (p @ softmax.T / per_row[:, None]).astype(np.float32)
                softmax -= rate * (mean.T @ p)
                bias -= rate * p.sum(axis=0)
                touched, where = np.unique(features, return_inverse=True)
                row_of = np.repeat(np.arange(len(rows)), per_row)
                for d in range(WIDTH):
                    slope = np.bincount(where, into[row_of, d], len(touched)).astype(np.float32)
                    seen[touched, d] += slope * slope
                    embed[touched, d] -= rate * slope / np.sqrt(seen[touched, d])
    direction = softmax[:, 1] - softmax[:, 0]
    return Model((embed @ direction).astype(np.float64), float(bias[1] - bias[0]))


def _passage_logits(embed, softmax, bias, word, buckets, begin, n, first):
    direction = softmax[:, 1] - softmax[:, 0]
    sums = np.add.reduceat((embed @ direction)[buckets], begin)
    return np.add.reduceat(sums[word], first) / np.add.reduceat(n[word], first) + bias[1] - bias[0]


def learned(docs: DataFrame, labels: DataFrame, train_on, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "toxic", bound: int = LEARN_FROM) -> Model:
    """A model from at most ``bound`` labelled texts of each class, those with the smallest hashes of their id.

    ``train_on`` is a condition on ``labels``. An id with several labels counts as toxic if one is 1.
    """
    marked = (labels.filter(train_on & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("toxic")))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marked.filter("toxic = 0").orderBy(*by_hash).limit(bound).union(
        marked.filter("toxic = 1").orderBy(*by_hash).limit(bound))
    # at most 2 * bound ids
    rows = (pick(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").filter("text IS NOT NULL")
            .select("doc_id", "text", "toxic").collect())
    rows = sorted({(r["doc_id"], r["text"], r["toxic"]) for r in rows})
    return train([r[1] for r in rows], [r[2] for r in rows])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted.

    A null text, or one without a word, scores as the model's offset does. Equal texts score alike; null ids are kept.
    An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute():
        known: dict = {}
        return lambda data, offsets: [shared.value.scores(data, offsets, known)]

    scored = annotate(pick(docs, id_col, text_col), "text", compute, [field("score", T.DoubleType())]).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(id_col: str = "doc_id"):
    return fold(id_col, 5) == 0
