"""Near-duplicate documents by MinHash: banding, signature verification, exact confirmation, star components.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their shingle sets.

1. **Signatures.** ``BANDS * ROWS`` universal hash functions ``(a * x + b) mod 2**64`` of the shingles, the smallest value of each.
   What goes on are the keys of the bands and a byte of each of the first ``SIGNATURE`` minima. Documents of one set form a
   class, named by its smallest id; only classes go on.
2. **Bands.** Each band of ``ROWS`` minima is a key; classes with a common key form a list. A pair of a likeness of just 0.85
   misses all 36 bands of 6 about once in 25 million, others that link less often; unlike texts seldom meet.
3. **Pairs.** A list of at most ``SHORT`` classes gives all its pairs. A longer one gives its *pivot* against the others, once; the
   pivot is the class that meets most others in all its lists, so that of an original and its copies it is the original.
4. **Verification.** A pair goes on if its signatures agree often enough (links fall below with a probability of 10^-7), and is
   then confirmed on both whole shingle sets, which are made from the texts for such pairs only: a bit filter on ids,
   sized by their number, tells the texts.
5. **Long lists that still hold several components** form groups by their members. The most met member of a group is compared with
   all others. What then lies outside the group's largest component is a set of queries, in blocks of bounded size; all members
   of the group come to each block, are compared by signatures, and the rest on whole sets. Links come out, one for two
   components, never pairs. This costs what the undecided members cost times those of their group; nothing is left undecided.
6. **Components** by alternating large-star and small-star; each round is stored in the shared scratch folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.llm import hashing
from paystrata.llm.bits import filter_of
from paystrata.llm.common import discard, pick, stored, text_blocks

WORDS = 5
PERCENT = 85
BANDS = 36
ROWS = 6
#: Minima of which a byte is kept for verification.
SIGNATURE = 128
#: Classes of a list of which all pairs are looked at.
SHORT = 8
#: Standard deviations below the expected number of agreeing minima at which a pair is given up.
SLACK = 5.2
#: Queries, and members asked for them, to one block.
QUERIES_TO_A_BLOCK = 1024
MEMBERS_TO_A_BLOCK = 4096
MEMBER = ["node", "n", "component"]

_random = np.random.default_rng(20250611)
_A = _random.integers(0, 1 << 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, 1024, dtype=np.uint64)

SCANNED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                        T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
                        T.StructField("bands", T.BinaryType()), T.StructField("signature", T.BinaryType())])


def least_agreeing(minima: int, percent: int = PERCENT) -> int:
    p = percent / 100
    return max(1, int(minima * p - SLACK * (minima * p * (1 - p)) ** 0.5))


def text_shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS):
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words none."""
    starts, ends, before = hashing.word_bounds(data, offsets)
    hashes = hashing.spans(data, hashing.FOLDED, starts, ends)
    grams = hashing.windows(hashes, words)
    for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
        if b - a >= words:
            yield np.unique(grams[a:b - words + 1])
        elif b > a:
            yield hashing.windows(hashes[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray, minima: int = BANDS * ROWS) -> np.ndarray:
    """The smallest value of each hash function, its upper 32 bits; of no shingle, no minima."""
    if not len(shingles):
        return np.zeros(0, np.uint32)
    least = np.full(minima, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 256):                     # 256 x 128 products at once stay in the cache
        part = hashing.mix(shingles[at:at + 256])
        np.minimum(least, (part[None, :] * _A[:minima, None] + _B[:minima, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key for each band."""
    weights = np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) | np.uint64(1)
    mixed = hashing.mix(minima.astype(np.uint64).reshape(bands, rows))
    return hashing.mix((mixed * weights).sum(axis=1, dtype=np.uint64) ^ hashing.mix(np.arange(1, bands + 1, dtype=np.uint64)))


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    one, two = hashing.mix(shingles), hashing.mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    return int(one.sum(dtype=np.uint64).view(np.int64)), int(two.sum(dtype=np.uint64).view(np.int64))


def _scan(texts: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    def one(shingles):
        minima = signature(shingles, bands * rows)
        keys = band_keys(minima, bands, rows).tobytes() if len(minima) else b""
        return len(shingles), *_digest(shingles), keys, minima[:SIGNATURE].astype(np.uint8).tobytes()

    def run(batches):
        for batch in batches:
            found = []
            for _, _, data, offsets in text_blocks(batch.column(1)):
                found += [one(s) for s in text_shingles(data, offsets, words)]
            columns = zip(*found) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.binary()] * 2)]],
                names=SCANNED.names)

    return texts.mapInArrow(run, SCANNED)


def _banded(classes: DataFrame, bands: int) -> DataFrame:
    """(list, node, n, component): one row for each band of each class; each is a component of its own as yet."""

    def run(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(np.repeat(batch.column(0).to_numpy(), bands)),
                 pa.array(np.repeat(batch.column(1).to_numpy(), bands))], names=["list", "node", "n"])

    return (classes.select("node", "n", "bands").mapInArrow(run, "list long, node long, n long")
            .withColumn("component", F.col("node")))


def _sets(texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the named documents and some others; rows that repeat an id have a row each."""
    hashed = stored(nodes.select(F.xxhash64("node").alias("h")), "minhash-wanted")      # counted, then read again
    wanted = texts.sparkSession.sparkContext.broadcast(filter_of(hashed, hashed.count()))
    discard(hashed)

    def run(batches):
        for batch in batches:
            hashes = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            batch = batch.filter(pa.array(wanted.value.holds(hashes)))
            for first, last, data, offsets in text_blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     pa.array([s.tobytes() for s in text_shingles(data, offsets, words)], pa.binary())],
                    names=["node", "shingles"])

    return (texts.filter("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id").alias("h"))
            .mapInArrow(run, "node long, shingles binary").filter("length(shingles) > 0"))


def _live(lists: DataFrame) -> DataFrame:
    """(list, node, n, component, size, pivot) of the lists with several classes; pivot is a row of the first three."""
    sizes = lists.groupBy("list").agg(F.count("*").alias("size")).filter("size > 1")
    live = stored(lists.join(sizes, "list"), "minhash-lists")
    met = live.groupBy("node").agg(F.sum("size").alias("met"))
    pivots = (live.filter(F.col("size") > SHORT).join(met, "node").groupBy("list")
              .agg(F.max_by(F.struct(*MEMBER), F.struct("met", -F.col("node"))).alias("pivot")))
    found = stored(live.join(pivots, "list", "left").select("list", *MEMBER, "size", "pivot"), "minhash-live")
    discard(live)
    return found


def _pairs(live: DataFrame, percent: int) -> DataFrame:
    """(a, b), once each: pairs of short lists, and pivots of long ones with the others."""
    member = F.struct(*MEMBER)
    short = (live.filter("pivot IS NULL").groupBy("list").agg(F.sort_array(F.collect_list(member)).alias("own"))
             .select(F.posexplode("own").alias("k", "one"), "own")
             .select("one", F.explode(F.expr("slice(own, k + 2, size(own))")).alias("two")))
    long_ = live.filter("pivot IS NOT NULL").select(F.col("pivot").alias("one"), member.alias("two"))
    alike = 100 * F.least("one.n", "two.n") >= percent * F.greatest("one.n", "two.n")
    # what is in one component already needs no link more
    return (short.union(long_).filter(alike & F.expr("one.component <> two.component"))
            .select(F.col("one.node").alias("a"), F.col("two.node").alias("b")).distinct())


def _with_both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """``pairs`` with the value of a and of b (``a_<name>``, ``b_<name>``).

    A pivot may be in very many pairs: it is the a of them, and the join on a comes last, so that AQE deals its pairs to several
    tasks and only its one value is copied.
    """
    of = lambda side: values.select(F.col("node").alias(side), F.col(name).alias(f"{side}_{name}"))
    return pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", f"a_{name}", f"b_{name}")


def _verified(pairs: DataFrame, classes: DataFrame, minima: int, percent: int) -> DataFrame:
    """The pairs whose signatures agree often enough."""
    least = least_agreeing(minima, percent)

    def run(batches):
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, minima) for k in (2, 3))
            keep = np.count_nonzero(one == two, axis=1) >= least
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return _with_both(pairs, classes, "signature").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link by their whole shingle sets."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return _with_both(pairs, sets, "shingles").mapInArrow(run, "a long, b long")


def _searched(open_: DataFrame, classes: DataFrame, sets: DataFrame, minima: int, percent: int) -> DataFrame:
    """(a, b): links between the members outside the largest component of each group and its members of other components."""
    least = least_agreeing(minima, percent)
    shares = open_.groupBy("list", "component").agg(F.count("*").alias("k"))
    loads = shares.groupBy("list").agg(F.max_by("component", F.struct("k", "component")).alias("largest"),
                                       F.sum("k").alias("all"), F.max("k").alias("most"))
    blocks = lambda k, size: F.greatest(F.lit(1), F.ceil(k / size)).cast("int")
    held = (open_.join(loads, "list").select(
        "list", "node", "component", (F.col("component") != F.col("largest")).alias("outside"),
        blocks(F.col("all") - F.col("most"), QUERIES_TO_A_BLOCK).alias("rows"), blocks(F.col("all"), MEMBERS_TO_A_BLOCK).alias("columns"))
        .join(classes.select("node", "signature"), "node").join(sets, "node"))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    one_of = lambda k, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(k)).cast("int")
    queries = held.filter("outside").withColumn("i", one_of("rows", 0)).withColumn("j", every("columns"))
    members = held.withColumn("i", every("rows")).withColumn("j", one_of("columns", 1))
    keys = ["list", "i", "j"]
    columns = [*keys, "role", "node", "component", "signature", "shingles"]

    def run(batches):
        key, block, seen = None, None, set()
        for batch in batches:
            links = []
            fixed = [c.to_pylist() for c in batch.columns[:6]]
            for row, (*own, role, node, component) in enumerate(zip(*fixed)):
                if own != key:
                    key, block, seen = own, _Block(), set()
                minima_, shingles = (np.frombuffer(batch.column(k)[row].as_buffer(), kind)
                                     for k, kind in ((6, np.uint8), (7, np.uint64)))
                if role == 0:
                    block.add(node, component, minima_, shingles)
                else:
                    for other, its in block.linked(component, minima_, shingles, least, percent, seen):
                        seen |= {(component, its), (its, component)}
                        links.append((node, other))
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (queries.withColumn("role", F.lit(0)).select(columns).union(members.withColumn("role", F.lit(1)).select(columns))
            .repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(run, "a long, b long"))


class _Block:
    """A bounded number of queries, asked for those that link with one set after the other."""

    def __init__(self):
        self.nodes, self.components, self.signatures, self.sets, self.table = [], [], [], [], None

    def add(self, node, component, minima, shingles):
        self.nodes.append(node)
        self.components.append(component)
        self.signatures.append(minima)
        self.sets.append(shingles.copy())

    def linked(self, component, minima, shingles, least, percent, seen):
        """(node, component) of linked queries, none for two components in ``seen``."""
        if self.table is None:
            self.table = np.array(self.signatures).reshape(-1, len(minima))
            self.sizes = np.array([len(s) for s in self.sets])
            self.own = np.array(self.components)
        n = len(shingles)
        alike = ((self.own != component) & (100 * np.minimum(self.sizes, n) >= percent * np.maximum(self.sizes, n))
                 & (np.count_nonzero(self.table == minima, axis=1) >= least))
        found = set()
        for k in np.flatnonzero(alike).tolist():
            its = self.components[k]
            if (component, its) in seen or its in found:
                continue
            both = len(np.intersect1d(self.sets[k], shingles, assume_unique=True))
            if 100 * both >= percent * (n + len(self.sets[k]) - both):
                found.add(its)
                yield self.nodes[k], its


def _in_several(lists: DataFrame, labels: DataFrame, *others: str) -> DataFrame:
    """The rows of the lists that hold several components, with ``component``."""
    named = (lists.join(labels, "node", "left")
             .select("list", "node", "n", F.coalesce("component", "node").alias("component"), *others))
    several = (named.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high"))
               .filter("low <> high").select("list"))
    return named.join(several, "list", "left_semi")


def _groups(open_: DataFrame) -> DataFrame:
    """Open lists joined by their members to groups, each as one list with its most met member as pivot."""
    groups = star_components(open_.select(F.col("pivot.node").alias("a"), F.col("node").alias("b")))
    members = (open_.groupBy(*MEMBER).agg(F.sum("size").alias("met")).join(groups.withColumnRenamed(
        "component", "group"), "node", "left").withColumn("list", F.coalesce("group", "node")))
    heads = members.groupBy("list").agg(F.max_by(F.struct(*MEMBER), F.struct("met", -F.col("node"))).alias("pivot"),
                                        F.count("*").alias("size"))
    return members.select("list", *MEMBER).join(heads, "list").select("list", *MEMBER, "size", "pivot")


def star_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    Rounds of large-star (each node hands its larger neighbours to the smallest of its neighbourhood) and small-star (its
    smaller ones and itself) turn every component into one star around its smallest node. A hot node's neighbours are never
    gathered: the smallest is an aggregate, and the join on it is split by AQE where skewed.
    """
    oriented = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = stored(oriented, "minhash-stars")
    while True:
        around = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = around.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
        # in a star, a node with a smaller neighbour has no other
        if not near.filter("low < u AND low < high").agg(F.count("*")).first()[0]:
            labels = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            labels.scratch_path = current.scratch_path
            return labels
        before = current
        # large star: every larger neighbour of a node goes to the smallest of the node and its neighbours
        least = near.select(F.col("u").alias("at"), F.least("low", "u").alias("m"))
        large = current.select("u", F.col("v").alias("at")).join(least, "at").select("u", F.col("m").alias("v"))
        # small star: every smaller neighbour of u, and u, goes to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select("m", F.explode(F.array("u", "v")).alias("node")).filter("node <> m")
                 .select(F.col("node").alias("u"), F.col("m").alias("v")).distinct())
        current = stored(small, "minhash-stars")
        discard(before)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (the row's id is its component's).

    Words are runs without ASCII white space, A-Z folded. A document's set holds its distinct ``words``-word shingles, or its
    whole sequence if it has fewer words. A null text or one without words has no shingles, links with nothing and is its
    own component. ``component_id`` is the smallest id reachable by links. Ids name documents: rows that repeat an id count as
    linked with each other, whatever their texts. A null id links with nothing and has null as component and ``kept``. Other
    columns are ignored. An empty table gives no rows.
    """
    texts = pick(docs, id_col, text_col)
    minima = min(SIGNATURE, bands * rows)
    scanned = stored(_scan(texts, words, bands, rows), "minhash-scan")
    classes = (scanned.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("node")))
    first = F.col("node") == F.col("doc_id")
    named = stored(scanned.join(classes, ["n", "d1", "d2"], "left").select(
        "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")).alias("node"),
        F.when(first, F.col("bands")).alias("bands"), F.when(first, F.col("signature")).alias("signature")), "minhash-classes")
    discard(scanned)
    single = named.filter("signature IS NOT NULL").select("node", "n", "bands", "signature")
    # a repeated row, or an id with two texts that are both the first of their class, has several rows here
    ids = named.filter("node IS NOT NULL").select("doc_id", "node").distinct()
    twice = ids.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("doc_id", "a")
    edges = stored(ids.join(twice, "doc_id").select("a", F.col("node").alias("b")), "minhash-links")

    def settle(live, edges):
        """The components of ``edges`` and the links found among the pairs of ``live``, the lists still open, the sets.

        Components are stars of edges themselves: they take the place of all links found so far.
        """
        verified = stored(_verified(_pairs(live, percent), single, minima, percent), "minhash-pairs")
        wanted = verified.select(F.explode(F.array("a", "b")).alias("node")).union(
            live.filter("pivot IS NOT NULL").select("node")).distinct()
        sets = stored(_sets(texts, wanted, words), "minhash-sets")
        labels = star_components(edges.union(_confirmed(verified, sets, percent)))
        rest = live.filter("pivot IS NOT NULL").drop("component")
        open_ = stored(_in_several(rest, labels, "size", "pivot"), "minhash-open")
        discard(verified, edges)
        return labels, open_, sets

    def links(labels):
        named_edges = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        named_edges.scratch_path = labels.scratch_path
        return named_edges

    # stored once: the lists and their sizes are two reads of it
    banded = stored(_banded(single, bands).distinct(), "minhash-bands")
    live = _live(banded)
    discard(banded)
    labels, open_, sets = settle(live, edges)
    discard(live)
    if not open_.isEmpty():
        groups = stored(_groups(open_), "minhash-groups")
        discard(sets, open_)
        labels, open_, sets = settle(groups, links(labels))
        discard(groups)
    if not open_.isEmpty():
        found = stored(_searched(open_, single, sets, minima, percent), "minhash-links")
        before, labels = labels, star_components(links(labels).union(found))
        discard(before, found)
    discard(open_, sets)

    component = F.coalesce("component", "node")
    return named.join(labels, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        (component == F.col("doc_id")).alias("kept"))
