"""Operators against plain-Python versions of what they compute, and against the libraries."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import frame, link_components, rows, sentence, shingles, texts
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as driver
from compare import connect, spark_rows, sql_rows
from paystrata.llm import components, fingerprints, hashing, language_id, packing, quality_rules, secret_scan
from paystrata.llm import sentence_pieces, sharding, shingle_join, toxicity
from paystrata.llm.queries import ORACLE, vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert spark_rows(driver.queries()[name](spark, SF_DIR)) == sql_rows(connect(SF_DIR), ORACLE[name])


def given_texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


# packing

def brute_capacities(counts, window):
    open_ = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fitting = [k for k, c in enumerate(open_) if c >= length]
        if fitting:
            open_[min(fitting, key=lambda k: open_[k])] -= length
        else:
            open_.append(window - length)
    return sorted(open_)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), max_size=12))
def test_plan_is_best_fit_decreasing(counts):
    plan = packing.best_fit_decreasing(counts, 40)
    length = np.array([x for x in counts for _ in range(counts[x])], np.int64)
    rank = np.array([k for x in counts for k in range(counts[x])], np.int64)
    filled = defaultdict(int)
    for sequence, offset, size in sorted(zip(*plan.places(length, rank), length)):
        assert filled[sequence] == offset
        filled[sequence] += size
    assert sorted(filled) == list(range(plan.sequences))
    assert sorted(40 - n for n in filled.values()) == brute_capacities(counts, 40)


def check_packed(found, ids):
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        own = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(own) == r["length"] <= 2048 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert zlib.crc32(struct.pack(f"<{len(own)}I", *own)) == r["ids_crc32"]
        covered[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in list(sequences.values()) + list(covered.values()):
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
    assert {i: sum(n for _, n in spans) for i, spans in covered.items()} == {i: len(x) for i, x in ids.items()}


def test_packing_holds_all_ids(spark):
    whole = packing.library(vocabulary("byte_bpe_50k.json"))
    ids = {i: whole.encode(t, add_special_tokens=False).ids + [1] for i, t in given_texts(spark).items()}
    check_packed(driver.queries()["op1_packing"](spark, SF_DIR).collect(), ids)
    values = {i: t or "" for i, t in enumerate(texts())}
    docs = spark.createDataFrame(list(values.items()), "doc_id long, text string")
    ids = {i: whole.encode(t, add_special_tokens=False).ids + [1] for i, t in values.items()}
    for ranks in (vocabulary("byte_bpe_50k.tiktoken"), None):
        check_packed(packing.pack(docs, vocabulary("byte_bpe_50k.json"), ranks).collect(), ids)


# shingle join

def test_components_of_awkward_documents(spark):
    sets = {r[0]: shingles(r[1]) for r in rows() if r[0] is not None}
    found = shingle_join.shingle_join(frame(spark)).filter("doc_id IS NOT NULL").collect()
    assert {r["doc_id"]: r["n_shingles"] for r in found} == {i: len(s) for i, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in found} == link_components(sets)


def family(r, size, words, edits):
    base = [f"w{r.randrange(10**9)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = base[:]
        for _ in range(r.randint(0, edits)):
            copy[r.randrange(len(copy))] = f"e{r.randrange(10**9)}"
        out.append(" ".join(copy))
    return out


def test_large_groups_and_frequent_passages(spark):
    """Groups of near copies far beyond a short list, one passage in many unrelated documents, chains of edits."""
    r = random.Random(11)
    passage = " ".join(f"p{k}" for k in range(60))
    values = family(r, 90, 80, 6) + family(r, 60, 80, 9)
    values += [" ".join(family(r, 1, 40, 0)) + " " + passage for _ in range(60)]
    values += [passage + f" end{k}" for k in range(20)]
    chain = [f"c{k}" for k in range(100)]
    for k in range(25):
        values.append(" ".join(chain))
        chain[4 * k:4 * k + 2] = [f"d{k}", f"f{k}"]
    values += family(r, 1, 4, 0) * 3 + ["x y"]
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(6)
    found = {x["doc_id"]: x["component_id"] for x in shingle_join.shingle_join(docs).collect()}
    assert found == link_components({i: shingles(t) for i, t in enumerate(values)})


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1, max_size=30), st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=40),
                                                                    min_size=1, max_size=8))
def test_divide_skip_counts_overlaps(query, others):
    query_, sets = np.array(sorted(query), np.uint64), [np.array(sorted(o), np.uint64) for o in others]
    found = dict(zip(*[x.tolist() for x in shingle_join.InvertedLists(sets).search(query_)]))
    least = shingle_join.least_overlap(len(query))
    assert found == {k: len(query & other) for k, other in enumerate(others) if len(query & other) >= least}


def test_star_contraction(spark):
    r = random.Random(2)
    edges = [(a, a + 1) for a in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(r.randrange(200, 240), r.randrange(200, 240)) for _ in range(25)]
    found = {x["doc_id"]: x["component_id"] for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert found == {k: v for k, v in root.items() if k != v}


# language and toxicity

def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = driver.queries()["op3_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = [r for r in found.collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in held)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in held)


def test_families_and_pairs():
    x = np.eye(6, language_id.FEATURES, dtype=np.float32).repeat(4, axis=0)
    labels = [k for k in ("de", "en", "fr", "es", "xx", "nl") for _ in range(4)]
    model = language_id.train(x, labels)
    assert model.families == [["de", "en", "nl"], ["es", "fr"], ["xx"]]
    assert set(model.pairs) == {("de", "en"), ("de", "nl"), ("en", "nl"), ("es", "fr")}
    assert model.predict(x)[0] == labels


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = driver.queries()["op8_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in found if r["held_out"] and r["toxic"] is not None]
    caught = [r["predicted"] for r in held if r["toxic"] == 1]
    spared = [1 - r["predicted"] for r in held if r["toxic"] == 0]
    assert sum(caught) / len(caught) > 0.9 and sum(spared) / len(spared) > 0.9


def test_misspellings_share_features():
    word = lambda w: set(toxicity.word_features(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0].tolist())
    assert len(word("pathetic") & word("patheticc")) > 10 > len(word("pathetic") & word("together"))
    buckets, n = toxicity.word_features(np.frombuffer(b"ab cde", np.uint8), np.array([0, 3]), np.array([2, 6]))
    assert n.tolist() == [1 + 2 + 1, 1 + 3 + 2 + 1] and len(buckets) == n.sum()


# secrets

def brute_spans(text):
    base = [("assign", m.start(), m.end()) for m in re.finditer(secret_scan.ASSIGN[4:], text, re.I | re.A)
            if len(m.group(2)) >= 8]
    base += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    base += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    more = []
    for kind in secret_scan.CLASSES:
        for m in re.finditer(f"[{kind.characters}]+", text):
            c = m.group()
            if (len(c) < kind.window or re.search("|".join(secret_scan.ALLOWED), c, re.I | re.A)
                    or not all(re.search(n, c) for n in kind.needs)):
                continue
            runs = []
            for i in range(len(c) - kind.window + 1):
                counts = Counter(c[i:i + kind.window]).values()
                if -sum(n / kind.window * math.log2(n / kind.window) for n in counts) >= kind.bits - 1e-9:
                    if runs and i <= runs[-1][1]:
                        runs[-1][1] = i + kind.window
                    else:
                        runs.append([i, i + kind.window])
            more += [(kind.kind, m.start() + a, m.start() + z) for a, z in runs]
    more = [x for x in more if not any(b[1] < x[2] and x[1] < b[2] for b in base)]
    write = lambda spans: ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=lambda s: (s[1], secret_scan.KINDS.index(s[0]))))
    return write(base), write(base + more)


def test_secret_spans(spark):
    r = random.Random(5)
    letters = "ABCDEFabcdef0123456789ghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/"
    makers = [lambda: "token: secret = ", lambda: "password=", lambda: "".join(r.choice(letters) for _ in range(r.randint(1, 60))),
              lambda: "AKIA" + "".join(r.choice("AB12") for _ in range(r.randint(8, 20))), lambda: " é😀 ", lambda: "\n",
              lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.randint(20, 50))), lambda: "API_KEY\": '",
              lambda: "".join(r.choice("0123456789ABCDEF") for _ in range(r.randint(20, 50))), lambda: "example",
              lambda: "a" * 30 + "".join(r.choice(letters) for _ in range(40)) + "b1A" * 20]
    values = texts() + ["".join(r.choice(makers)() for _ in range(r.randint(0, 12))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    for row in secret_scan.scan(docs).collect():
        base, every = brute_spans(values[row["doc_id"]] or "")
        assert row["spans"] == every and row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(
            base.count(k + ":") for k in secret_scan.BASE_KINDS)
    plan = secret_scan.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("LocalTableScan", "")


# quality

def test_quality_counts(spark):
    for row in quality_rules.quality(frame(spark)).filter("doc_id IS NOT NULL").collect():
        text = texts()[row["doc_id"]] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        counts = Counter(grams)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row["n_words"] == len(words) and row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len({i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)})


# sentence pieces

@pytest.fixture(scope="module")
def table():
    return sentence_pieces.load(vocabulary("piece_bpe_32k.model"))


def coded(table, values):
    raw = [v.encode() for v in values]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, begin = sentence_pieces.Coder(table).block(data, np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))
    return [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])]


def brute_viterbi(table, text):
    known = {p: i for i, p in enumerate(table.pieces) if p}
    best = [(0.0, [])] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for d in range(min(end, table.longest), 0, -1):
            piece = text[end - d:end]
            i = known.get(piece)
            if i is None and d > 1:
                continue
            score = best[end - d][0] + (table.scores[i] if i is not None else table.unknown)
            if best[end] is None or score > best[end][0]:
                ids = [i] if i is not None else [table.byte_ids[b] for b in piece.encode()]
                best[end] = (score, best[end - d][1] + ids)
    return best[-1][1]


def test_segmentation_is_the_best(table):
    values = [t for t in texts() if t and len(t) < 2000] + ["", "  two  spaces ", "ǅ unusual \U0001f9ff"]
    for text, ids in zip(values, coded(table, values)):
        assert ids == (brute_viterbi(table, "▁" + text.replace(" ", "▁")) if text else [])


def test_decoding_is_the_library_s(table):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    values = [t or "" for t in texts()]
    for text, ids in zip(values, coded(table, values)):
        assert sentence_pieces.decode(table, ids) == model.decode(ids) == text.replace("▁", " ")


def test_words_and_whole_texts_agree(table):
    values = [t for t in texts() if t and len(t) < 2000]
    by_word = coded(table, values)
    table.by_word = False
    try:
        assert coded(table, values) == by_word
    finally:
        table.by_word = True


def test_encode_and_decode_frames(spark, table):
    back = sentence_pieces.decoded(sentence_pieces.encode(frame(spark), table), table).collect()
    for row in back:
        if row["doc_id"] is not None:
            assert row["decoded"] == (texts()[row["doc_id"]] or "").replace("▁", " ")


# fingerprints

def test_fingerprints(spark):
    values = given_texts(spark)
    found = {r["doc_id"]: r for r in driver.queries()["op7_fingerprints"](spark, SF_DIR).collect()}
    ids = sorted(values)
    for i, following in zip(ids, ids[1:] + ids[:1]):
        row, text = found[i], values[i]
        n = len(text) // 4
        changed = text[:len(text) - n] + values[following][:n]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        for name, value in (("fingerprint", text), ("edited_fingerprint", changed)):
            assert row[name] == fingerprints.written(fingerprints.anchors(value.encode()))
        one, two, other = (fingerprints.read(x) for x in (row["fingerprint"], row["edited_fingerprint"], found[following]["fingerprint"]))
        assert row["near_edited"] == fingerprints.likeness(one, two) and row["near_next"] == fingerprints.likeness(one, other)
    assert sum(r["near_edited"] for r in found.values()) / len(found) > 0.6


def test_closed_syncmers():
    text = sentence(random.Random(1), 200).encode()
    at, _ = fingerprints.anchors(text)
    inner = [int(hashing.ranges(hashing.running(np.frombuffer(text, np.uint8), hashing.EXACT), np.array([i]), np.array([i + fingerprints.S]))[0])
             for i in range(len(text) - fingerprints.S + 1)]
    width = fingerprints.K - fingerprints.S + 1
    expected = [i for i in range(len(text) - fingerprints.K + 1)
                if min(inner[i:i + width]) in (inner[i], inner[i + width - 1])]
    assert at.tolist() == expected
    moved, _ = fingerprints.anchors(b"something before " + text)
    assert set(at + 17) <= set(moved.tolist())          # anchors don't depend on what stands around them


@pytest.mark.parametrize("length", [*range(16, 300), 400, 1000])
def test_short_texts_keep_their_likeness(length):
    r = random.Random(length)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz     ", "the of and ", "abcdefghäöü "):
        for _ in range(5):
            text, following = ("".join(r.choice(alphabet) for _ in range(length)) for _ in range(2))
            changed = fingerprints.edited(text, following)
            found = [fingerprints.anchors(t.encode()) for t in (text, changed)]
            assert fingerprints.likeness(*found) > 0
            assert all(fingerprints.likeness(f, fingerprints.read(fingerprints.written(f))) == 1 for f in found)
    other = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(length))
    assert fingerprints.likeness(fingerprints.anchors(text.encode()), fingerprints.anchors(other.encode())) == 0


# sharding

def test_lookup_table():
    names = [f"s{k}" for k in range(13)]
    table = sharding.lookup_table(names, 1009)
    counts = np.bincount(table)
    assert len(counts) == 13 and counts.max() - counts.min() <= 1
    # the same fill, written plainly
    free, order = set(range(1009)), {n: [(sharding._number(f"offset:{n}") + j * (sharding._number(f"skip:{n}") % 1008 + 1)) % 1009
                                         for j in range(1009)] for n in names}
    expected = [None] * 1009
    while free:
        for n in sorted(names):
            if free:
                slot = next(s for s in order[n] if s in free)
                free.discard(slot)
                expected[slot] = names.index(n)
    assert table.tolist() == expected
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(names[a] != names[b] for a, b in zip(table, fewer) if a != 12)
    assert moved / 1009 < 0.2


def test_places(spark):
    found = driver.queries()["op10_sharding"](spark, SF_DIR).collect()
    names = [f"shard-{k:02d}" for k in range(64)]
    table, after = sharding.lookup_table(names), sharding.lookup_table(names[:-1])
    assert len(found) == 200
    for r in found:
        slot = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"], r["shard_after"]) == (slot, names[table[slot]], names[after[slot]])


def test_write_shards(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "out"), ["a", "b"])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and {r["shard"] for r in back.select("shard").distinct().collect()} == {"a", "b"}


# token counts

def test_token_counts(spark):
    whole = packing.library(vocabulary("word_bpe_49k.json"))
    values = given_texts(spark)
    for r in driver.queries()["op9_token_counts"](spark, SF_DIR).collect():
        n = len(whole.encode(values[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(values[r["doc_id"]].encode()), n > 2048)


@pytest.mark.parametrize("slots", [1 << 18, 16])
def test_token_counts_of_awkward_texts(spark, slots):
    from paystrata.llm.token_counts import count_tokens
    whole = packing.library(vocabulary("word_bpe_49k.json"))
    for r in count_tokens(frame(spark), vocabulary("word_bpe_49k.json"), table_slots=slots).collect():
        if r["doc_id"] is not None:
            assert r["n_tokens"] == len(whole.encode(texts()[r["doc_id"]] or "", add_special_tokens=False).ids)
