"""The pipeline's stages against plain Python, each on what the stage before it kept."""

import re

import numpy as np

import corpus_pipeline
from cases import link_components, shingles
from paystrata.llm import language_id, packing, quality_rules
from paystrata.llm.common import documents
from paystrata.llm.queries import vocabulary
from test_brute_force import brute_spans, check_packed

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def line_fails(line):
    words = WORD.findall(line)
    if not words:
        return False
    solid = sum(map(len, words))
    marks = sum(c.encode() in [bytes([b]) for b in quality_rules.MARKS] for c in line)
    separators = sum(w in quality_rules.SEPARATORS for w in words)
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    return (100 * marks > 20 * solid or len(words) >= 50 and not re.search("[.,;:!?]", line)
            or separators >= 2 and 5 * separators >= len(words)
            or len(words) <= 20 and any(p in lowered for p in quality_rules.PHRASES))


def cleaned(text):
    """The text without failing lines, None if it goes."""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = text.split("\n")
    lost = sum(len(w) for line in lines if line_fails(line) for w in WORD.findall(line))
    if len(words) < 50 or 100 * len(repeated) > 50 * len(words) or 100 * lost > 50 * sum(map(len, words)):
        return None
    return "\n".join(line for line in lines if not line_fails(line))


def masked(text):
    spans = sorted((int(a), int(z)) for a, z in (s.split(":")[1:] for s in brute_spans(text)[1].split(",") if s))
    out, at = [], 0
    for a, z in spans:
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, z)
    return "".join(out) + text[at:]


def unlike(model, text, lang):
    """The text explains itself too badly by its language, told letter run by letter run."""
    raw = text.encode()
    shares = language_id.features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].astype(float) ** 2
    k = model.languages.index(lang)
    letters = sum(b >= 128 or chr(b).isalpha() for b in raw)
    return model.usual_bits[k] - round(float(shares @ model.bits[k]), 3) > 2.5 + 6 / letters ** 0.5


def test_stages_equal_plain_python(spark):
    docs = documents(spark, SF_DIR)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    model = language_id.learned(docs, language_id.trained_rows())
    predicted = language_id.identify(docs, model).collect()
    expected = {r["doc_id"]: texts[r["doc_id"]] for r in predicted
                if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_LANGUAGE_SCORE
                and not unlike(model, texts[r["doc_id"]], r["lang_pred"])}
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        kept = stages[name](spark, docs, SF_DIR).cache()
        assert kept.columns == docs.columns
        return kept, {r["doc_id"]: r["text"] for r in kept.collect()}

    kept, found = run("language_id", docs)
    assert found == expected and len(found) > 150
    kept, found = run("quality_rules", kept)
    expected = {i: c for i, c in ((i, cleaned(t)) for i, t in expected.items()) if c is not None}
    assert found == expected and len(found) > 100
    kept, found = run("shingle_join", kept)
    component = link_components({i: shingles(t) for i, t in expected.items()})
    expected = {i: t for i, t in expected.items() if component[i] == i}
    assert found == expected
    kept, found = run("secret_scan", kept)
    expected = {i: masked(t) for i, t in expected.items()}
    assert found == expected
    assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
    whole = packing.library(vocabulary("byte_bpe_50k.json"))
    ids = {i: whole.encode(t, add_special_tokens=False).ids + [1] for i, t in expected.items()}
    check_packed(stages["packing"](spark, kept, SF_DIR).collect(), ids)
