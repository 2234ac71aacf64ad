"""Document fingerprints from closed syncmers.

Every run of ``K`` bytes holds ``K - S + 1`` runs of ``S`` bytes. It is an anchor if the smallest hash among those is that of
the first or of the last. Whether a run is an anchor depends on its own bytes only, so an edit changes anchors near it and
no others. A fingerprint lists the anchors' hashes with the distance to the anchor before, in text order.

Runs of ``K`` bytes are too long for short texts. A text under ``SHORT`` bytes has the anchors of runs of ``SHORT_K`` bytes (and
``SHORT_S``), one of ``LONG`` bytes or more those of ``K``, and one between has both, so that texts on either side of a bound
still share anchors. Of any ``k - s`` runs on end one at least is an anchor.

Two fingerprints are compared by position: each hash they share gives a shift (where it is here, less where it is there),
and shared anchors count when at least two have the same shift, or one does and a fingerprint has under ``FEW`` anchors. The likeness is twice the number of
anchors matched so, one to one, by the number of anchors of both.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.llm import hashing
from paystrata.llm.common import pick, ship

K = 32
S = 8
SHORT_K = 8
SHORT_S = 4
#: Bytes of text from which on there are anchors of K, and below which there are anchors of SHORT_K.
LONG = 128
SHORT = 256
FEW = 8
#: Ranges of ids to a shuffle partition; several, so that hashing them to partitions deals evenly.
PARTS_PER_PARTITION = 4

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType())])

Anchors = tuple[np.ndarray, np.ndarray]


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def _syncmers(data: np.ndarray, sums, k: int, s: int) -> Anchors:
    at = np.arange(len(data) - s + 1)
    inner = hashing.ranges(sums, at, at + s)
    least = _smallest(inner, k - s + 1)
    chosen = np.flatnonzero((inner[:len(least)] == least) | (inner[k - s:k - s + len(least)] == least))
    return chosen, (hashing.ranges(sums, chosen, chosen + k) >> np.uint64(32)).astype(np.uint32)


def anchors(text: bytes, k: int = K, s: int = S) -> Anchors:
    """Positions and 32-bit hashes of the closed syncmers; a text without one is its own anchor, an empty text has none."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    sizes = [size for size, held in (((k, s), len(data) >= LONG), ((SHORT_K, SHORT_S), len(data) < SHORT))
             if held and len(data) >= size[0]]
    if sizes:
        sums = hashing.running(data, hashing.EXACT)
        found = [_syncmers(data, sums, *size) for size in sizes]
        at, hashes = found[0] if len(found) == 1 else (np.concatenate(x) for x in zip(*found))
        if len(at):
            order = np.argsort(at, kind="stable")
            return (at, hashes) if len(found) == 1 else (at[order], hashes[order])
    whole = int.from_bytes(hashlib.sha256(text).digest()[:4], "big")
    return np.zeros(1, np.int64), np.array([whole], np.uint32)


def written(found: Anchors) -> str:
    """The fingerprint as text: distance and hash of each anchor, in hexadecimal."""
    at, hashes = found
    steps = np.diff(at, prepend=0).tolist()
    return ",".join([f"{d:x}:{h:08x}" for d, h in zip(steps, hashes.tolist())])


def read(fingerprint: str) -> Anchors:
    """The anchors of a written fingerprint."""
    parts = [p.split(":") for p in fingerprint.split(",")] if fingerprint else []
    return (np.cumsum([int(d, 16) for d, _ in parts]).astype(np.int64).reshape(-1),
            np.array([int(h, 16) for _, h in parts], np.uint32))


def likeness(one: Anchors, other: Anchors) -> float:
    """From 0 to 1; 1 for equal fingerprints, also empty ones."""
    (at, h), (at2, h2) = one, other
    if len(h) == len(h2) and np.array_equal(h, h2) and np.array_equal(at, at2):
        return 1.0
    if not len(h) or not len(h2):
        return 0.0
    # the nth occurrence of a hash here meets the nth there
    keys, keys2 = _numbered(h), _numbered(h2)
    _, mine, theirs = np.intersect1d(keys, keys2, assume_unique=True, return_indices=True)
    if not len(mine):
        return 0.0
    shifts = at[mine] - at2[theirs]
    _, back, n = np.unique(shifts, return_inverse=True, return_counts=True)
    matched = int((n[back] > 1).sum()) or (1 if min(len(h), len(h2)) < FEW else 0)
    return 2 * matched / (len(h) + len(h2))


def _numbered(hashes: np.ndarray) -> np.ndarray:
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    nth = np.arange(len(ordered)) - np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))
    out = np.empty(len(hashes), np.uint64)
    out[order] = ordered.astype(np.uint64) << np.uint64(24) | nth.astype(np.uint64)
    return out


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the text that follows."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def in_id_order(docs: DataFrame) -> DataFrame:
    """(part, doc_id, text, own): rows in parts that are ranges of ids, each part with the first row of the next part.

    That extra row has ``own`` false; the last part gets the first row of all. The ranges are those Spark finds for the
    ids alone; what comes to the driver is one id per range, and texts are shuffled once.
    """
    spark = docs.sparkSession
    n_parts = PARTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    begins = sorted(r["first"] for r in rows.select("doc_id").repartitionByRange(n_parts, "doc_id")
                    .groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("first")).collect())
    shared = spark.sparkContext.broadcast(np.array(begins, np.int64))

    def deal(batches):
        first = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            part = np.searchsorted(first, ids, side="right") - 1
            leads = np.flatnonzero(first[part] == ids)
            for rows, parts, own in ((None, part, True), (leads, (part[leads] - 1) % len(first), False)):
                taken = batch if rows is None else batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.int32()), *taken.columns, pa.array([own] * len(parts), pa.bool_())],
                    names=["part", "doc_id", "text", "own"])

    return (rows.mapInArrow(deal, "part int, doc_id long, text string, own boolean").repartition("part")
            .sortWithinPartitions("part", F.desc("own"), "doc_id", "text"))


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """One row per document: the fingerprints of its text and of its edited text, and how alike they and the next are.

    The next document is that with the next higher id; the last is followed by the first, a lone one by itself. A null
    text is an empty one, bytes that are no UTF-8 count as U+FFFD. Rows that repeat an id follow each other in the order of their texts. A row without an id has
    no next document: an empty text takes its place. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    texts = pick(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))

    def one(doc_id, text, found, following, next_found):
        changed = edited(text, following)
        changed_found = found if changed == text else anchors(changed.encode(), k, s)
        return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), written(found), written(changed_found),
                likeness(found, changed_found), likeness(found, next_found))

    def run(batches):
        held, part = None, None
        for doc_part, doc_id, text, own in _rows(batches):
            found = anchors(text.encode(), k, s)
            if held is not None and part == doc_part:
                yield one(*held, text, found)
            held, part = ((doc_id, text, found) if own else None), doc_part

    def alone(batches):
        for batch in batches:
            rows = [one(i, t, anchors(t.encode(), k, s), "", anchors(b""))
                    for i, t in zip(batch.column(0).to_pylist(), _decoded(batch.column(1)))]
            yield _batch(rows)

    with_next = in_id_order(texts).mapInArrow(lambda batches: _batched(run(batches)), SCHEMA)
    without_id = texts.filter("doc_id IS NULL").mapInArrow(alone, SCHEMA)
    return with_next.union(without_id)


def _rows(batches):
    for batch in batches:
        part, doc_id, text, own = batch.columns
        yield from zip(part.to_pylist(), doc_id.to_pylist(), _decoded(text), own.to_pylist())


def _decoded(texts) -> list[str]:
    """The texts of a column; bytes that are no UTF-8 are read as U+FFFD."""
    return [t.decode("utf-8", "replace") for t in texts.view(pa.binary()).to_pylist()]


def _batched(rows, size: int = 500):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns = list(zip(*rows)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=SCHEMA.names)
