"""Encoding and decoding with a vocabulary of scored pieces: the segmentation with the highest sum of scores.

Pieces lie in a double-array trie over characters: the child of state s by character code c is ``base[s] + c`` if
``check`` of that slot is s. All texts' words walk the trie together, one character a step, as array operations; then the
Viterbi pass runs over the words of one length at once, end by end.

White space is marked: a space is U+2581, and a text starts with one. If no piece holds a mark after another character
(``PieceTable.by_word``), the best segmentation of a text is that of its words, each with the marks before it; words are
then encoded once per worker. Otherwise whole texts are walked.

A character that no piece covers costs ``unknown`` and becomes the byte pieces of its UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paystrata.llm import hashing
from paystrata.llm.common import annotate, field, pick
from paystrata.llm.pretokens import PieceCache, gather

MARK = "▁"
#: Words that go through the Viterbi pass together, by number of their characters times pieces' length.
CELLS = 4_000_000


@dataclass
class PieceTable:
    """Pieces by id: text ('' for control pieces), score, the ids of the 256 byte pieces, and the id for the unknown."""
    pieces: list[str]
    scores: np.ndarray
    byte_ids: list[int]
    unknown_id: int
    dummy_prefix: bool = True

    def __post_init__(self):
        # multiples of 2**-16 add up without rounding, so equal sums are equal whatever is added first
        self.scores = np.round(np.asarray(self.scores, float) * 65536) / 65536
        self.unknown = float(self.scores[[i for i, p in enumerate(self.pieces) if p]].min()) - 10.0
        self.by_word = all(MARK not in p.lstrip(MARK) for p in self.pieces) and all(
            p.strip(MARK) or len(p) for p in self.pieces if p)
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.longest = max(map(len, self.pieces))
        characters = sorted({c for p in self.pieces for c in p})
        #: character code: 0 is none
        self.codes = np.zeros(max(map(ord, characters)) + 2, np.int32)
        self.codes[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.base, self.check, self.piece = double_array(
            {tuple(self.codes[ord(c)] for c in p): i for i, p in enumerate(self.pieces) if p}, len(characters) + 1)

    def code(self, points: np.ndarray) -> np.ndarray:
        return self.codes[np.minimum(points, len(self.codes) - 1)]


def double_array(keys: dict[tuple[int, ...], int], alphabet: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a double-array trie; state 0 is the root, value -1 means that no key ends there."""
    root: dict = {}
    for key, value in keys.items():
        node = root
        for c in key:
            node = node.setdefault(int(c), {})
        node[-1] = value
    size = sum(len(k) for k in keys) + 4 * alphabet + 4096
    base, check, values = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    free = np.ones(size, bool)
    free[0] = False
    lowest = 1
    # states with many children are placed first, while there is room
    pending = [(-len(root), 0, 0, root)]
    number = 0
    while pending:
        _, _, state, node = heapq.heappop(pending)
        values[state] = node.get(-1, -1)
        children = np.array(sorted(c for c in node if c >= 0), np.int64)
        if not len(children):
            continue
        while not free[lowest]:
            lowest += 1
        base[state] = at = _fit(free, lowest, children)
        free[at + children] = False
        check[at + children] = state
        for c in children.tolist():
            number += 1
            heapq.heappush(pending, (-len(node[c]), number, at + c, node[c]))
    end = int(np.flatnonzero(~free)[-1]) + alphabet + 2
    return _first(base, end, 0), _first(check, end, -1), _first(values, end, -1)


def _fit(free: np.ndarray, lowest: int, children: np.ndarray) -> int:
    """The lowest base whose slots for all children are free."""
    start, span = max(lowest, int(children[0])), 1024
    while True:
        slots = start + np.flatnonzero(free[start:start + span])
        bases = slots - children[0]
        bases = bases[bases + children[-1] < len(free)]
        fitting = bases[free[bases[:, None] + children[None, :]].all(axis=1)]
        if len(fitting):
            return int(fitting[0])
        start += span
        if start + children[-1] - children[0] >= len(free):
            raise ValueError("the array is too small")


def _first(array: np.ndarray, end: int, fill: int) -> np.ndarray:
    return np.append(array, np.full(max(0, end - len(array)), fill))[:end]


def load(path: str, zipf: bool | None = None) -> PieceTable:
    """The pieces of a sentencepiece model file.

    Scores of a unigram model are logarithms of probabilities and are taken as they are. A BPE model holds the ranks of
    its merges (0, -1, -2, ...) instead; ``zipf`` (default: if all scores are whole numbers) turns rank r into the
    logarithm of a probability in proportion to 1 / (r + 1).
    """
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces, scores, byte_ids = [""] * n, np.zeros(n), [-1] * 256
    for i in range(n):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[i], scores[i] = text, model.get_score(i)
    real = [i for i in range(n) if pieces[i]]
    if zipf is None:
        zipf = bool((scores[real] == np.round(scores[real])).all())
    if zipf:
        # pieces given by the user come with rank 0 or far below all; they keep their place in the file
        rank = np.empty(len(real))
        rank[np.argsort([-scores[i] if scores[i] > -1e8 else 1e9 + i for i in real], kind="stable")] = np.arange(len(real))
        scores[real] = -np.log(rank + 1) - np.log(np.sum(1 / np.arange(1, len(real) + 1)))
    return PieceTable(pieces, scores, byte_ids, model.unk_id())


def _matches(table: PieceTable, codes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Entry (i, d): the id of the piece of d + 1 characters that starts at i, else -1. ``room``: characters up to the end."""
    out = np.full((len(codes), table.longest), -1, np.int32)
    state = np.zeros(len(codes), np.int64)
    active = np.arange(len(codes))
    for d in range(table.longest):
        active = active[room[active] > d]
        code = codes[active + d]
        slot = table.base[state[active]] + code
        good = (code > 0) & (table.check[slot] == state[active])
        active, slot = active[good], slot[good]
        if not len(active):
            break
        state[active] = slot
        out[active, d] = table.piece[slot]
    return out


def segment(table: PieceTable, words: list[str]) -> list[list[int]]:
    """The ids of each word (marks in place of spaces)."""
    out: list[list[int]] = [[] for _ in words]
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        by_length.setdefault(len(word), []).append(k)
    for length, members in by_length.items():
        if length:
            step = max(1, CELLS // (length * table.longest))
            for a in range(0, len(members), step):
                _segment_equal(table, words, members[a:a + step], length, out)
    return out


def _segment_equal(table: PieceTable, words: list[str], members: list[int], length: int, out: list[list[int]]) -> None:
    """Viterbi over words of one length; among equal sums the longer last piece wins."""
    n = len(members)
    points = np.frombuffer("".join(words[k] for k in members).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    room = np.tile(np.arange(length, 0, -1), n)
    found = _matches(table, table.code(points), room).reshape(n, length, table.longest)
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    taken, piece = np.zeros((n, length + 1), np.int32), np.full((n, length + 1), -1, np.int32)
    for end in range(1, length + 1):
        for d in range(min(end, table.longest), 0, -1):
            ids = found[:, end - d, d - 1]
            total = best[:, end - d] + np.where(ids >= 0, table.scores[ids], -np.inf)
            if d == 1:      # any character may stand alone
                total = np.where(ids >= 0, total, best[:, end - 1] + table.unknown)
            better = total > best[:, end]
            best[better, end], taken[better, end], piece[better, end] = total[better], d, ids[better]
    for row, k in enumerate(members):
        end, ids = length, []
        while end:
            d, i = int(taken[row, end]), int(piece[row, end])
            if i >= 0:
                ids.append(i)
            else:
                raw = words[k][end - d:end].encode("utf-8", "surrogatepass")
                ids.extend(table.byte_ids[b] if table.byte_ids[b] >= 0 else table.unknown_id for b in reversed(raw))
            end -= d
        out[k] = ids[::-1]


def decode(table: PieceTable, ids) -> str:
    """The text of ids: byte pieces join to characters, marks become spaces, the first space goes."""
    raw = bytearray()
    for i in ids:
        byte = table.byte_of.get(int(i))
        if byte is None:
            raw += table.pieces[int(i)].replace(MARK, " ").encode()
        else:
            raw.append(byte)
    text = raw.decode("utf-8", "replace")
    return text[1:] if table.dummy_prefix and text.startswith(" ") else text


class Coder:
    """Encodes blocks of texts, with a cache of words."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.cache = PieceCache(lambda words: segment(table, [w.replace(" ", MARK) for w in words]))

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin. An empty text has none."""
        n = len(offsets) - 1
        data, offsets = _with_prefix(data, offsets) if self.table.dummy_prefix else (data, offsets)
        if self.table.by_word:
            starts, ends, before = _word_pieces(data, offsets)
        else:
            starts, ends, before = offsets[:-1], offsets[1:], np.arange(n + 1)
        hashes = hashing.spans(data, hashing.EXACT, starts, ends)
        at, size = self.cache.look_up(hashes, data, starts, ends)
        return gather(self.cache.pool, at, size), np.concatenate([[0], np.cumsum(size)])[before]


def _with_prefix(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space before each text that is not empty."""
    filled = np.diff(offsets) > 0
    return (np.insert(data, offsets[:-1][filled], 32).astype(np.uint8),
            offsets + np.concatenate([[0], np.cumsum(filled)]))


def _word_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts before each space that follows another character, and between texts. U+2581 in a text counts as a space."""
    space = data == 32
    three = np.zeros(len(data), bool)
    if len(data) > 2:
        three[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
    opens = space | three
    tail = np.zeros(len(data), bool)
    tail[1:] |= three[:-1]
    tail[2:] |= three[:-2]
    inside = opens | tail
    cut = opens.copy()
    cut[1:] &= ~inside[:-1]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


FIELDS = [field("ids", T.ArrayType(T.IntegerType()))]


def encode(docs: DataFrame, table: PieceTable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids. A null or empty text has no ids; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def compute():
        coder = Coder(shared.value)

        def block(data, offsets):
            ids, begin = coder.block(data, offsets)
            return [pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids.astype(np.int32)))]
        return block

    return annotate(pick(docs, id_col, text_col), "text", compute, FIELDS).drop("text")


def decoded(encoded: DataFrame, table: PieceTable, ids_col: str = "ids", text_name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids. Null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([*encoded.schema.fields, T.StructField(text_name, T.StringType())])
    at = encoded.columns.index(ids_col)

    def run(batches):
        for batch in batches:
            texts = [None if ids is None else decode(shared.value, ids) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def digests(docs: DataFrame, table: PieceTable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_ids, n_byte_ids, ids_crc32, round_trip (decoding gives the text back).

    A null text counts as an empty one. Rows are encoded each, repeated ones and null ids alike. A text does not come
    back if it holds U+2581, which is the mark of a space. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)
    fields = [field(n, T.LongType()) for n in ("n_ids", "n_byte_ids", "ids_crc32")] + [field("round_trip", T.BooleanType())]

    def compute():
        own = shared.value
        coder, decoder = Coder(own), Decoder(own)
        is_byte = np.zeros(len(own.pieces), bool)
        is_byte[list(own.byte_of)] = True

        def block(data, offsets):
            ids, begin = coder.block(data, offsets)
            raw = ids.astype("<u4")
            n_bytes = np.concatenate([[0], np.cumsum(is_byte[ids])])
            back, ends = decoder.block(ids, begin)
            texts, given = back.tobytes(), data.tobytes()
            same = [texts[ends[i]:ends[i + 1]] == given[offsets[i]:offsets[i + 1]] for i in range(len(offsets) - 1)]
            return [np.diff(begin), np.diff(n_bytes[begin]),
                    [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(begin[:-1], begin[1:])], same]
        return block

    return annotate(pick(docs, id_col, text_col), "text", compute, fields).drop("text")


class Decoder:
    """Decodes blocks of ids to UTF-8 as arrays. Invalid bytes stay as they are; ``decode`` replaces them."""

    def __init__(self, table: PieceTable):
        texts = [bytes([table.byte_of[i]]) if i in table.byte_of else p.replace(MARK, " ").encode()
                 for i, p in enumerate(table.pieces)]
        self.size = np.array([len(t) for t in texts], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.prefix = table.dummy_prefix

    def block(self, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.size[ids]
        text = gather(self.bytes, self.at[ids], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])[begin]
        if self.prefix:
            first = ends[:-1][np.diff(ends) > 0]
            first = first[text[first] == 32]
            text = np.delete(text, first)
            ends = ends - np.searchsorted(first, ends, side="left")
        return text, ends
