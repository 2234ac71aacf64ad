"""Similarity join of documents on word shingles: T-occurrence search over inverted lists, with DivideSkip.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their shingle sets. The result is exact; what is
returned per document is its component under the links, so copies are never expanded into all pairs.

1. **Scan.** Each text becomes its set of shingle hashes. Documents of one set form a class, named by its smallest id;
   only one text per class goes on. The same scan counts shingles into a sketch of fixed size.
2. **Order.** Shingles are ordered by (magnitude of the sketch count, hash): rare first, so passages that many documents
   share come last. Linked sets of n and m shingles share at least ``T = ceil(0.75 n)``, so the first ``n - T + l`` of
   each have l in common. Only these go into the inverted lists, with ``l = n / 10 + 1``. The order decides how many
   candidates there are, never the result.
3. **Short lists** (at most ``SHORT`` documents) are merged: all their pairs are counted, and a pair stays that occurs
   ``l`` times, less the long lists it may share. **Long lists** are not expanded. Documents in fewer than l of them
   leave them (a pair they are in would show in short lists). Each list gives its smallest member against the others,
   once; what then is in one component needs no more pairs. If a list holds several components, the documents outside the
   largest are indexed in blocks of bounded size, and all documents that lists connect with them are searched in each
   block: links come out, never pairs. This costs what the undecided documents cost times those of their group.
4. **T-occurrence search.** Candidates of a query, or the documents of a block, are held as inverted lists. For a query's
   shingles, short lists are heap-merged and long ones probed by binary search.
5. **Components** by star contraction, with each step stored in the shared scratch folder.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.llm import hashing
from paystrata.llm.common import pick, stored, text_blocks
from paystrata.llm.components import components

WORDS = 5
PERCENT = 75
SHORT = 16
#: Shared first shingles asked for, beyond one, as a part of the set: a tenth.
EXTRA = 10
#: Counters of the sketch, sent in rows of ``SKETCH_ROW``.
SKETCH = 1 << 23
SKETCH_ROW = 1 << 16
#: Postings to a block of inverted lists, shingles to a chunk of candidates, bits of the filter on ids.
BLOCK_POSTINGS = 400_000
CHUNK_SHINGLES = 100_000
#: Postings that a heap merges; beyond, all lists but the fewest are long ones.
HEAP_POSTINGS = 4_000
FILTER_BITS = 1 << 23


def least_overlap(n: np.ndarray | int, percent: int = PERCENT):
    """Shingles that a set of n must share with any set it links with."""
    return -(-n * percent // 100)


def first_shingles(n: int, percent: int = PERCENT) -> int:
    """How many shingles of a set of n go into the lists."""
    return min(n, n - int(least_overlap(n, percent)) + n // EXTRA + 1)


def links(overlap, n, m, percent: int = PERCENT):
    return 100 * overlap >= percent * (n + m - overlap)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words none."""
    starts, ends, before = hashing.word_bounds(data, offsets)
    hashes = hashing.spans(data, hashing.FOLDED, starts, ends)
    grams = hashing.windows(hashes, words)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a:b - words + 1]))
        elif b > a:
            out.append(hashing.windows(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    one, two = hashing.mix(shingles), hashing.mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    return int(one.sum(dtype=np.uint64).view(np.int64)), int(two.sum(dtype=np.uint64).view(np.int64))


def _scan(texts: DataFrame, words: int) -> DataFrame:
    """Rows (doc_id, n, d1, d2) for documents and (part, counts) for the sketch of each task."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
                           T.StructField("part", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def run(batches):
        counts = np.zeros(SKETCH, np.uint32)
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            sizes, ones, twos = [], [], []
            for _, _, data, offsets in text_blocks(batch.column(1)):
                for shingles in shingle_sets(data, offsets, words):
                    digest = _digest(shingles)
                    sizes.append(len(shingles))
                    ones.append(digest[0])
                    twos.append(digest[1])
                    if digest not in seen:      # copies within a task count once
                        seen.add(digest)
                        np.add.at(counts, (shingles & np.uint64(SKETCH - 1)).astype(np.int64), 1)
            rows = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64()),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=schema.names)
        if counts.any():
            parts = SKETCH // SKETCH_ROW
            small = np.minimum(counts, 255).astype(np.uint8).reshape(parts, SKETCH_ROW)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(parts, pa.int64()), *[pa.nulls(parts, pa.int64())] * 3, pa.array(range(parts), pa.int32()),
                 pa.array([zlib.compress(row.tobytes(), 1) for row in small], pa.binary())], names=schema.names)

    return texts.mapInArrow(run, schema)


def _magnitudes(scanned: DataFrame) -> np.ndarray:
    """The power of two of each counter, summed over all tasks: ``SKETCH`` bytes, whatever the data."""

    def add(batches):
        part, total = None, None
        for batch in batches:
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if row != part:
                    if part is not None:
                        yield _sketch_row(part, total)
                    part, total = row, np.zeros(SKETCH_ROW, np.int64)
                total += np.frombuffer(zlib.decompress(raw.as_py()), np.uint8)
        if part is not None:
            yield _sketch_row(part, total)

    rows = (scanned.filter("part IS NOT NULL").select("part", "counts").repartition("part")
            .sortWithinPartitions("part").mapInArrow(add, "part int, magnitudes binary"))
    out = np.zeros(SKETCH, np.uint8)
    for row in rows.collect():
        out[row["part"] * SKETCH_ROW:(row["part"] + 1) * SKETCH_ROW] = np.frombuffer(row["magnitudes"], np.uint8)
    return out


def _sketch_row(part: int, total: np.ndarray) -> pa.RecordBatch:
    level = np.log2(np.maximum(total, 1)).astype(np.uint8)
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([level.tobytes()], pa.binary())],
                                      names=["part", "magnitudes"])


def _inverted_lists(texts: DataFrame, magnitudes, words: int, percent: int, blocks: int, huge: float) -> DataFrame:
    """Rows (query, query_n, doc_id, n, k): pairs that occur in k short lists; and (shingle, doc_id, n): the long lists.

    Postings travel as arrays, one row per task and block of hashes. Shingles of the highest magnitude are spread over
    blocks of their own by document, so that no block holds a list with a large part of all documents.
    """
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("shingles", T.BinaryType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("sizes", T.BinaryType())])

    def run(batches):
        levels = magnitudes.value
        seen: set[tuple[int, int]] = set()
        held, kept = 0, []
        for batch in batches:
            doc_ids = batch.column(0)
            for first, last, data, offsets in text_blocks(batch.column(1)):
                for i, shingles in enumerate(shingle_sets(data, offsets, words), first):
                    n = len(shingles)
                    digest = _digest(shingles)
                    if not n or digest in seen or not doc_ids[i].is_valid:
                        continue
                    seen.add(digest)
                    level = levels[(shingles & np.uint64(SKETCH - 1)).astype(np.int64)]
                    own = np.argsort(level, kind="stable")[:first_shingles(n, percent)]
                    kept.append((shingles[own], level[own] >= huge, doc_ids[i].as_py(), n))
                    held += len(own)
                if held > 200_000:
                    yield from _blocks(kept, blocks, schema)
                    held, kept = 0, []
        yield from _blocks(kept, blocks, schema)

    def join(batches):
        block, parts = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                if batch.column(0)[k].as_py() != block:
                    yield from _listed(block, parts, percent)
                    block, parts = batch.column(0)[k].as_py(), []
                parts.append([np.frombuffer(batch.column(c)[k].as_buffer(), kind)
                              for c, kind in ((1, np.uint64), (2, np.int64), (3, np.int32))])
        yield from _listed(block, parts, percent)

    return (texts.mapInArrow(run, schema).repartition(blocks, "block").sortWithinPartitions("block")
            .mapInArrow(join, LISTED))


def _blocks(kept: list, blocks: int, schema: T.StructType):
    if not kept:
        return
    shingles = np.concatenate([k[0] for k in kept])
    huge = np.concatenate([k[1] for k in kept])
    lengths = [len(k[0]) for k in kept]
    ids = np.repeat(np.array([k[2] for k in kept], np.int64), lengths)
    sizes = np.repeat(np.array([k[3] for k in kept], np.int32), lengths)
    block = ((shingles >> np.uint64(32)) % np.uint64(blocks)).astype(np.int32)
    block[huge] = -1 - (ids[huge] % blocks).astype(np.int32)
    order = np.argsort(block, kind="stable")
    shingles, ids, sizes, block = shingles[order], ids[order], sizes[order], block[order]
    found, first = np.unique(block, return_index=True)
    last = np.append(first[1:], len(block))
    yield pa.RecordBatch.from_arrays(
        [pa.array(found, pa.int32())] + [pa.array([column[a:b].tobytes() for a, b in zip(first, last)], pa.binary())
                                         for column in (shingles, ids, sizes)], names=schema.names)


LISTED = T.StructType([T.StructField(name, T.LongType()) for name in ("shingle", "query", "query_n", "doc_id", "n", "k")])


def _listed(block: int | None, parts: list, percent: int):
    """What the inverted lists of one block give."""
    if block is None:
        return
    shingles, ids, sizes = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = np.lexsort((ids, shingles))
    shingles, ids, sizes = shingles[order], ids[order], sizes[order].astype(np.int64)
    new = np.append(True, (shingles[1:] != shingles[:-1]) | (ids[1:] != ids[:-1]))
    shingles, ids, sizes = shingles[new], ids[new], sizes[new]
    _, members, count = np.unique(shingles, return_inverse=True, return_counts=True)
    members = count[members]
    is_long = (members > SHORT) if block >= 0 else np.ones(len(ids), bool)
    yield from _rows(shingle=shingles[is_long].view(np.int64), doc_id=ids[is_long], n=sizes[is_long])
    a, b = [], []
    for step in range(1, SHORT):
        first = np.flatnonzero((shingles[step:] == shingles[:-step]) & ~is_long[step:])
        fit = similar_sizes(sizes[first], sizes[first + step], percent)
        a.append(first[fit])
        b.append(first[fit] + step)
    a, b = np.concatenate(a), np.concatenate(b)
    if len(a):
        order = np.lexsort((ids[b], ids[a]))
        a, b = a[order], b[order]
        new = np.flatnonzero(np.append(True, (ids[a][1:] != ids[a][:-1]) | (ids[b][1:] != ids[b][:-1])))
        k = np.diff(np.append(new, len(a)))
        a, b = a[new], b[new]
        yield from _rows(query=ids[a], query_n=sizes[a], doc_id=ids[b], n=sizes[b], k=k)


def _rows(**columns: np.ndarray):
    total = len(columns["doc_id"])
    for start in range(0, total, 100_000):
        n = min(100_000, total - start)
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[name][start:start + n], pa.int64()) if name in columns else pa.nulls(n, pa.int64())
             for name in LISTED.names], names=LISTED.names)


def similar_sizes(n, m, percent: int = PERCENT):
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


class InvertedLists:
    """Sets of shingles, held as the sorted list of set numbers of each shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        where = np.repeat(np.arange(len(sets)), self.sizes)
        values = np.concatenate([*sets, np.zeros(0, np.uint64)])
        order = np.lexsort((where, values))
        values, self.where = values[order], where[order]
        self.shingles, self.first, self.length = np.unique(values, return_index=True, return_counts=True)
        # every posting as one number: its list, then its set
        self.postings = np.repeat(np.arange(len(self.shingles)), self.length) * len(sets) + self.where

    def search(self, query: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
        """The sets that may link with the query, and their overlaps, by DivideSkip.

        A set must occur in at least ``t`` of the query's lists. The longest lists are set aside: what occurs in t lists
        occurs in t less their number of the others. Those are merged with a heap that jumps over sets too rare to count,
        and the survivors are looked for in the long lists.
        """
        t = int(least_overlap(len(query), percent))
        slot = np.searchsorted(self.shingles, query)
        slot[slot == len(self.shingles)] = 0
        lists = slot[self.shingles[slot] == query] if len(self.shingles) else slot[:0]
        if len(lists) < max(t, 1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists = lists[np.argsort(-self.length[lists], kind="stable")]
        n_long = min(t - 1, int(t / (0.01 * np.log2(self.length[lists[0]] + 1) + 1)))
        if self.length[lists[n_long:]].sum() > HEAP_POSTINGS:
            n_long = t - 1
        found, counts = self._merge(lists[n_long:], t - n_long)
        if n_long and len(found):
            counts = counts + self._probe(lists[:n_long], found)
        return found[counts >= t], counts[counts >= t]

    def _merge(self, lists: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Sets that occur in at least ``need`` of the lists, and in how many."""
        if need == 1:
            return np.unique(np.concatenate([self.where[self.first[k]:self.first[k] + self.length[k]]
                                             for k in lists.tolist()]), return_counts=True)
        own = [self.where[self.first[k]:self.first[k] + self.length[k]].tolist() for k in lists.tolist()]
        at = [0] * len(own)
        heap = [(values[0], k) for k, values in enumerate(own)]
        heapq.heapify(heap)
        found, counts = [], []
        while len(heap) >= need:
            candidate, popped = heap[0][0], []
            while heap and heap[0][0] == candidate:
                popped.append(heapq.heappop(heap)[1])
            if len(popped) >= need:
                found.append(candidate)
                counts.append(len(popped))
                target = candidate + 1
            else:
                # with need - 1 lists out of the heap, nothing below its top can occur often enough
                while heap and len(popped) < need - 1:
                    popped.append(heapq.heappop(heap)[1])
                if not heap:
                    break
                target = max(heap[0][0], candidate + 1)
            for k in popped:
                i = at[k] = bisect_left(own[k], target, at[k])
                if i < len(own[k]):
                    heapq.heappush(heap, (own[k][i], k))
        return np.array(found, np.int64), np.array(counts, np.int64)

    def _probe(self, lists: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """In how many of the lists each candidate is, by binary search."""
        wanted = (np.sort(lists) * len(self.sizes))[:, None] + candidates[None, :]      # in order, so quick to find
        place = np.searchsorted(self.postings, wanted)
        place[place == len(self.postings)] = 0
        return (self.postings[place] == wanted).sum(axis=0)

    def linked(self, query: np.ndarray, percent: int = PERCENT) -> np.ndarray:
        """The sets that link with the query."""
        found, overlap = self.search(query, percent)
        return found[links(overlap, len(query), self.sizes[found], percent)]


def _searched(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) of the pairs (query, doc_id) that link."""
    sets = _sets(texts, pairs.select("query").union(pairs.select("doc_id")).toDF("doc_id"), words)
    load = pairs.groupBy("query").agg(F.sum("n").alias("load"))
    chunk = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.ceil(F.col("load") / CHUNK_SHINGLES))).cast("int")
    dealt = pairs.join(load, "query").select("query", "doc_id", chunk.alias("chunk"))
    queries = dealt.select("query", F.col("query").alias("doc_id"), "chunk").distinct()
    members = (dealt.union(queries).join(sets, "doc_id")
               .select("query", "chunk", (F.col("doc_id") != F.col("query")).alias("other"), "doc_id", "shingles"))

    def run(batches):
        key, query, ids, candidates = None, None, [], []

        def search():
            if query is None or not candidates:
                return
            good = InvertedLists(candidates).linked(query, percent)
            if len(good):
                found = np.array(ids, np.int64)[good]
                own = np.full(len(good), key[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(own, found)), pa.array(np.maximum(own, found))],
                                                 names=["a", "b"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:4]]
            for k in range(batch.num_rows):
                if (columns[0][k], columns[1][k]) != key:
                    yield from search()
                    key, query, ids, candidates = (columns[0][k], columns[1][k]), None, [], []
                shingles = np.frombuffer(batch.column(4)[k].as_buffer(), np.uint64)
                if not columns[2][k]:
                    query = shingles
                else:
                    ids.append(columns[3][k])
                    candidates.append(shingles.copy())
        yield from search()

    return (members.repartition("query", "chunk").sortWithinPartitions("query", "chunk", "other")
            .mapInArrow(run, "a long, b long"))


def _sets(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles) of the wanted documents and some others: a bit filter of fixed size keeps most texts out."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    word = (wanted.select(bit.cast("long").alias("bit"))
            .selectExpr("CAST(bit div 32 AS INT) AS word", "shiftleft(1L, CAST(bit % 32 AS INT)) AS bits"))
    rows = word.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()      # FILTER_BITS / 32 rows at most
    filled = np.zeros(FILTER_BITS // 32, np.uint32)
    for row in rows:
        filled[row["word"]] = row["bits"]
    share = texts.sparkSession.sparkContext.broadcast(filled)

    def run(batches):
        for batch in batches:
            bits = batch.column(2).to_numpy(zero_copy_only=False)
            keep = (share.value[bits >> 5] >> (bits & 31).astype(np.uint32)) & np.uint32(1) == 1
            batch = batch.filter(pa.array(keep))
            for first, last, data, offsets in text_blocks(batch.column(1)):
                found = shingle_sets(data, offsets, words)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first),
                                                  pa.array([s.tobytes() for s in found], pa.binary())],
                                                 names=["doc_id", "shingles"])

    return (texts.filter("doc_id IS NOT NULL").select("doc_id", "text", bit.alias("bit"))
            .mapInArrow(run, "doc_id long, shingles binary"))


def similar(small: str, large: str, percent: int = PERCENT):
    """Sets of these sizes can link at all."""
    return 100 * F.least(F.col(small), F.col(large)) >= percent * F.greatest(F.col(small), F.col(large))


def shingle_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                 percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, representative.

    Words are runs without ASCII white space, A-Z folded. A document's set holds its distinct ``words``-word shingles,
    or its whole sequence if it has fewer words. A null text or one without words has no shingles, links with nothing
    and is its own component. ``component_id`` is the smallest id reachable by links; ``representative`` is true for
    the rows with the smallest id of their component. Ids name documents: rows that repeat an id count as linked with
    each other, and one of their texts stands for them all in links with others. A null id links with nothing and has
    a null component. An empty table gives no rows.
    """
    texts = pick(docs, id_col, text_col)
    scanned = stored(_scan(texts, words), "shingle-scan")
    sized = scanned.filter("part IS NULL").select("doc_id", "n", "d1", "d2")
    magnitudes = texts.sparkSession.sparkContext.broadcast(_magnitudes(scanned))
    classes = (sized.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2")
               .agg(F.min("doc_id").alias("node")))
    named = stored(sized.join(classes, ["n", "d1", "d2"], "left")
                   .select("doc_id", "n", F.when(F.col("doc_id").isNotNull(),
                                                 F.coalesce("node", "doc_id")).alias("node")), "shingle-classes")
    total = named.agg(F.sum("n")).first()[0] or 0
    # the magnitude of a counter that, beside its average load, may hold a list that fills a block
    huge = np.log2(max(BLOCK_POSTINGS, 16 * total / SKETCH))
    blocks = max(8, int(total * ((100 - percent) / 100 + 1 / EXTRA) / BLOCK_POSTINGS) + 1)
    listed = stored(_inverted_lists(texts, magnitudes, words, percent, blocks, huge), "shingle-lists")
    in_long = listed.filter("shingle IS NOT NULL").select("shingle", "doc_id", "n")
    held = in_long.groupBy("doc_id", "n").agg(F.count("*").alias("held"))
    counted = (listed.filter("query IS NOT NULL").groupBy("query", "query_n", "doc_id", "n").agg(F.sum("k").alias("k"))
               .join(held.select(F.col("doc_id").alias("query"), F.col("held").alias("query_held")), "query", "left")
               .join(held.select("doc_id", "held"), "doc_id", "left"))
    shared = F.least(F.coalesce("query_held", F.lit(0)), F.coalesce("held", F.lit(0)))
    counted = counted.filter(F.col("k") >= F.floor(F.least("query_n", "n") / EXTRA) + 1 - shared)
    nodes = named.filter("node IS NOT NULL").select("doc_id", "node").distinct()
    # who meets others in long lists only must meet them in l of these; others are found by their short lists
    least = F.floor(F.ceil(F.col("n") * percent / 100) / EXTRA) + 1
    many = held.filter(F.col("held") >= least).select("doc_id").distinct()
    # classes in place of documents
    long_lists = stored(in_long.join(many, "doc_id", "left_semi").join(nodes, "doc_id").select("shingle", F.col("node").alias("doc_id"), "n").distinct(),
                        "shingle-long")
    heads = long_lists.groupBy("shingle").agg(F.min_by(F.struct("doc_id", "n"), "doc_id").alias("head"))
    first = (long_lists.join(heads, "shingle").filter("doc_id <> head.doc_id").filter(similar("n", "head.n", percent))
             .select(F.col("head.doc_id").alias("query"), "doc_id", "n"))
    every = (counted.select("query", "doc_id", "n").join(nodes, "doc_id").select("query", F.col("node").alias("b"), "n")
             .join(nodes.withColumnRenamed("doc_id", "query"), "query").filter("node <> b")
             .select(F.least("node", "b").alias("query"), F.greatest("node", "b").alias("doc_id"), "n"))
    pairs = stored(first.union(every).groupBy("query", "doc_id").agg(F.max("n").alias("n")), "shingle-pairs")
    found = stored(_searched(pairs, texts, words, percent), "shingle-links")
    # whoever shares an id is one document
    named_once = named.filter("node IS NOT NULL").select(F.col("node").alias("a"), F.col("doc_id").alias("b")).distinct()
    shared_ids = named_once.groupBy("b").agg(F.count("*").alias("k")).filter("k > 1").select("b")
    edges = found.union(named_once.join(shared_ids, "b").select("a", "b"))
    labels = _finish_long_lists(edges, long_lists, texts, words, percent)
    labelled = named.join(labels.withColumnRenamed("doc_id", "node"), "node", "left")
    component = F.coalesce("component_id", "node")
    return labelled.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                           (component == F.col("doc_id")).alias("representative"))


def _finish_long_lists(edges: DataFrame, long_lists: DataFrame, texts: DataFrame, words: int, percent: int):
    """Search on where a long list holds several components; returns the components in the end."""
    labels = components(edges)
    members = (long_lists.join(labels, "doc_id", "left")
               .select("shingle", "doc_id", "n", F.coalesce("component_id", "doc_id").alias("component")))
    parts = members.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                           F.min("doc_id").alias("head")).filter("low <> high")
    undecided = stored(members.join(parts.select("shingle", "head"), "shingle"), "shingle-open")
    if undecided.isEmpty():
        return labels
    # lists connect their documents to groups; links lie within groups
    groups = components(undecided.select(F.col("head").alias("a"), F.col("doc_id").alias("b")))
    docs = undecided.select("doc_id", "n", "component").distinct().join(groups, "doc_id", "left").select(
        "doc_id", "n", "component", F.coalesce("component_id", "doc_id").alias("group"))
    shares = docs.groupBy("group", "component").agg(F.sum("n").alias("load"))
    loads = shares.groupBy("group").agg(F.max_by("component", F.struct("load", "component")).alias("largest"),
                                        F.sum("load").alias("load"), F.max("load").alias("most"))
    blocks = lambda load: F.greatest(F.lit(1), F.ceil(load / CHUNK_SHINGLES)).cast("int")
    placed = docs.join(loads, "group").select(
        "doc_id", "group", "component", (F.col("component") != F.col("largest")).alias("outside"),
        blocks(F.col("load")).alias("chunks"), blocks(F.col("load") - F.col("most")).alias("blocks"))
    found = stored(_searched_blocks(stored(placed, "shingle-groups"), texts, words, percent), "shingle-links")
    return components(edges.union(found))


def _searched_blocks(placed: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links between the outside documents of each group and all its documents of other components."""
    held = placed.join(_sets(texts, placed.select("doc_id"), words), "doc_id")
    indexed = held.filter("outside").select(
        "group", "component", "doc_id", "shingles", F.lit(0).alias("role"),
        F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    asked = held.select(
        "group", "component", "doc_id", "shingles", F.lit(1).alias("role"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("chunks")).cast("int").alias("chunk"))

    def run(batches):
        key, ids, own, sets, index = None, [], [], [], None
        a, b = [], []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:6]]
            for row, (group, block, chunk, role, doc_id, component) in enumerate(zip(*columns)):
                if (group, block, chunk) != key:
                    key, ids, own, sets, index = (group, block, chunk), [], [], [], None
                shingles = np.frombuffer(batch.column(6)[row].as_buffer(), np.uint64)
                if role == 0:
                    ids.append(doc_id)
                    own.append(component)
                    sets.append(shingles.copy())
                    continue
                if index is None:
                    index = InvertedLists(sets)
                for k in index.linked(shingles, percent).tolist():
                    if own[k] != component:
                        a.append(min(ids[k], doc_id))
                        b.append(max(ids[k], doc_id))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []

    keys = ["group", "block", "chunk"]
    return (indexed.select(*keys, "role", "doc_id", "component", "shingles")
            .union(asked.select(*keys, "role", "doc_id", "component", "shingles"))
            .repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(run, "a long, b long").distinct())
