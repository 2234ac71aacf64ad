"""Near duplicates by minima, whitening and collocations against plain versions."""

import math
import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from cases import empty, frame, link_components, sentence, shingles

from paystrata.llm import minhash, phrases, whitening


# near duplicates

def clustered(seed=5, copies=70):
    """Unlike texts, exact copies, and groups of copies edited more and less, some beyond the bound."""
    r = random.Random(seed)
    out, passage = [], sentence(r, 25)
    for _ in range(30):
        out.append(f"{passage} {sentence(r, r.randrange(5, 90))}")
    for size in (60, 150):
        base = sentence(r, size).split(" ")
        for _ in range(copies):
            words = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 4, 6])):
                words[r.randrange(size)] = f"edit{r.randrange(40)}"
            out.append(" ".join(words))
    r.shuffle(out)
    return out


def test_minhash_equals_all_pairs(spark):
    values = clustered()
    docs = spark.createDataFrame([(7 * i + 3, t) for i, t in enumerate(values)], "doc_id long, text string").repartition(5)
    sets = {7 * i + 3: shingles(t) for i, t in enumerate(values)}
    found = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    assert {i: r["component_id"] for i, r in found.items()} == link_components(sets, 85)
    assert {i: r["n_shingles"] for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (r["component_id"] == i) for i, r in found.items())


def test_minhash_repeated_ids_link_their_texts(spark):
    r = random.Random(2)
    one, two, three = (sentence(r, 60) for _ in range(3))
    docs = spark.createDataFrame([(5, one), (9, one), (9, two), (12, two), (20, three), (20, three), (None, one)],
                                 "doc_id long, text string")
    found = sorted(((row["doc_id"], row["component_id"]) for row in minhash.near_duplicates(docs).collect()), key=str)
    assert found == sorted([(5, 5), (9, 5), (9, 5), (12, 5), (20, 20), (20, 20), (None, None)], key=str)


def test_star_components(spark):
    r = random.Random(1)
    edges = [(a, r.randrange(a)) for a in range(1, 400) if a % 7] + [(3, 3), (399, 398), (398, 399)]
    root = {i: i for i in range(400)}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = {row["node"]: row["component"] for row in
             minhash.star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {a: root[a] for e in edges if e[0] != e[1] for a in e if root[a] != a}


def test_bands_meet_where_texts_link():
    r = random.Random(8)
    for _ in range(40):
        words = sentence(r, 120).split(" ")
        other = list(words)
        other[60] = "edited"
        keys = []
        for w in (words, other):
            raw = " ".join(w).encode()
            own, = minhash.text_shingles(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            keys.append(minhash.band_keys(minhash.signature(own), minhash.BANDS, minhash.ROWS))
        assert (keys[0] == keys[1]).any()


# whitening

def whole(vector):
    return tuple(math.floor(256 * float(c)) for c in vector)


@pytest.mark.parametrize("kind", ["spread", "flat", "narrow", "dependent"])
def test_whitening_equals_dense_algebra(spark, kind):
    r = np.random.default_rng(4)
    d = 3 if kind == "narrow" else 24
    scales = {"spread": 1.3 ** -np.arange(d), "flat": np.ones(d)}.get(kind, np.linspace(2, 1, d))
    x = r.standard_normal((300, d)) * scales
    if kind == "dependent":
        x[:, 2:] = x[:, [0]]
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(900, x[0].tolist()), (None, x[1].tolist())]
    bad = [(1000, None), (1001, [None] + [0.0] * (d - 1)), (1002, [float("nan")] * d), (1003, [float("inf")] + [0.0] * (d - 1)),
           (1004, []), (1005, [1.0]), (1006, [1e300] * d)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(4)
    found = whitening.whiten(table).collect()
    fit = np.array(sorted({whole(v) for _, v in rows}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit.astype(float) - np.array([float(s) / n for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(4, d)
    assert len(found) == len(rows) * k and {f["vec_id"] for f in found} == {i for i, _ in rows}
    by = {(f["vec_id"], f["component"]): f for f in found}
    real = [j for j in range(k) if values[j] > 1e-9 * values.sum()]
    assert kind != "dependent" or len(real) == 2
    for i, v in rows:
        v = whole(v)
        own = (np.array(v, float) - np.array([float(s) / n for s in sums])) @ vectors
        for j in range(k):
            f = by[i, j + 1]
            assert (f["n"], f["deviation"]) == (n, sum((n * a - s) ** 2 for a, s in zip(v, sums)))
            assert abs(f["explained"] - values[j] / values.sum()) < 1e-9
            if j in real:
                assert abs(abs(f["whitened"]) - abs(own[j]) / values[j] ** 0.5) < 1e-7
            else:
                assert f["whitened"] is None
    assert found[0]["identity_error"] < 1e-8
    assert by[0, 1]["whitened"] == by[900, 1]["whitened"]


def test_whitening_of_little(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], kind)).count() == 0
    alone = whitening.whiten(spark.createDataFrame([(1, [0.5, -1.0], 1), (1, [0.5, -1.0], 1)], kind)).collect()
    assert [(f["n"], f["deviation"], f["whitened"], f["explained"]) for f in alone] == [(1, 0, None, 0.0)] * 4


def test_deviations_are_exact_or_null():
    sums, n = [3, -5], 10 ** 9
    x = np.array([[1, 2], [-4, 0], [3, 0], [10, 0]], np.int64)
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, n, sums).to_pylist() == [e if e < 2 ** 63 else None for e in exact]


# collocations

def brute_collocations(rows, support, longest=5, first=2000):
    n, counts = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    frequent = {key: f for key, f in counts.items() if f >= support}
    out = {}
    for (lang, w), a in frequent.items():
        if len(w) < 2:
            continue
        cuts = [(1000 * a * n[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        longer = [v for (other, v), f in frequent.items() if other == lang and len(v) > len(w) and f >= a
                  and any(v[i:i + len(w)] == w for i in range(len(v)))]
        if not longer:
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, l_, r, n[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, l_, r) in enumerate(sorted(found)[:first], 1))


@pytest.mark.parametrize("parts,first", [(1, 2000), (9, 2000), (40, 7)])
def test_collocations_equal_plain_counts(spark, parts, first):
    r = random.Random(6)
    rows = []
    for i in range(160):
        words = [r.choice(["the", "Of", "big", "red", "straße", "o'er", "-", "<b>", "x\xa0y"]) + r.choice(["", "", " ", ",", "\n", ". "])
                 for _ in range(r.randrange(40))]
        rows.append((r.choice(["en", "en", "en", "de", None, "und"]), " ".join(words) + r.choice(["", " New York City hall", "\tNew\tYork  City"])))
    rows += [("en", None), ("en", ""), ("xx", "alone"), ("en", "pad " * 500)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    found = sorted(tuple(row) for row in phrases.collocations(docs, support=12, first=first).collect())
    expected = brute_collocations(rows, 12, first=first)
    assert found == expected and len(found) > 10


def test_scores_beyond_64_bits(spark):
    n, a, l_, r = 9 * 10 ** 17, 8 * 10 ** 12 + 1, 9 * 10 ** 17 - 1, 8 * 10 ** 12 + 3
    table = spark.createDataFrame([("en", "a b", a, 2), ("en", "a", l_, 1), ("en", "b", r, 1), ("en", "c d", 1000, 2),
                                   ("en", "c", 1000, 1), ("en", "d", 1000, 1)], "lang string, phrase string, f long, size int")
    found = {row["phrase"]: row["score"] for row in
             phrases.scored(table, spark.createDataFrame([("en", n)], "lang string, n long")).collect()}
    assert found == {"a b": 1000 * a * n // (l_ * r), "c d": 1000 * 1000 * n // 10 ** 6}
    assert Decimal(found["c d"]) == Decimal(n)


def test_collocations_of_awkward_documents(spark):
    assert phrases.collocations(empty(spark)).count() == 0
    found = phrases.collocations(frame(spark), support=2).collect()
    assert {row["lang"] for row in found} <= {"en", "de", "und"} and found
