"""Every operator over awkward documents: nulls, empty and long texts, ties, repeated rows, other columns, no rows."""

import zlib

import pytest
from cases import empty, frame, rows, texts
from pyspark.sql import functions as F

import corpus_pipeline
from paystrata.llm import (fingerprints, language_id, minhash, packing, quality_rules, secret_scan, sentence_pieces, sharding,
                           shingle_join, token_counts, toxicity)
from paystrata.llm.queries import vocabulary

N = len(rows())


def labels(spark, n=len(texts())):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(n)] + [(None, 1, 1), (0, None, None)],
                                 "doc_id long, quality int, toxic int")


OPERATORS = {
    "packing": lambda d: packing.pack(d, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")),
    "shingle_join": shingle_join.shingle_join,
    "minhash": minhash.near_duplicates,
    "language_id": lambda d: language_id.identify(d, language_id.learned(d, language_id.trained_rows())),
    "secret_scan": secret_scan.scan,
    "quality_rules": quality_rules.quality,
    "sentence_pieces": lambda d: sentence_pieces.digests(d, sentence_pieces.load(vocabulary("piece_bpe_32k.model"))),
    "fingerprints": fingerprints.compare,
    "toxicity": lambda d: toxicity.score(d, toxicity.learned(d, labels(d.sparkSession), ~toxicity.held_out())),
    "token_counts": lambda d: token_counts.count_tokens(d, vocabulary("word_bpe_49k.json")),
    "sharding": lambda d: sharding.place(d, ["a", "b", "c"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_one_answer(spark, name):
    found = OPERATORS[name](frame(spark)).collect()
    if name == "packing":
        found = [r for r in found if r["start"] == 0]
    assert len(found) == N
    assert sorted(r["doc_id"] for r in found if r["doc_id"] is not None) == sorted(r[0] for r in rows() if r[0] is not None)
    # a repeated row gets the same answer twice; where it is packed, and what follows it, may differ
    first = [tuple(r) for r in found if r["doc_id"] == 0]
    assert len(first) == 2
    if name not in ("packing", "fingerprints"):
        assert first[0] == first[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, name):
    found = OPERATORS[name](empty(spark))
    assert found.count() == 0 and found.columns


@pytest.mark.parametrize("name", ["quality_rules", "secret_scan", "toxicity", "language_id", "shingle_join"])
def test_equal_texts_get_equal_answers(spark, name):
    by_id = {r["doc_id"]: tuple(r)[1:] for r in OPERATORS[name](frame(spark)).drop("representative").collect()}
    assert by_id[0] == by_id[2]


def test_values_of_empty_texts(spark):
    got = {n: {r["doc_id"]: r for r in OPERATORS[n](frame(spark)).collect()} for n in
           ("packing", "shingle_join", "language_id", "secret_scan", "quality_rules", "sentence_pieces", "token_counts")}
    for i in (3, 4):
        assert got["packing"][i]["doc_tokens"] == 1
        assert (got["shingle_join"][i]["n_shingles"], got["shingle_join"][i]["component_id"]) == (0, i)
        assert got["language_id"][i]["lang_pred"] == "und"
        assert got["secret_scan"][i]["spans"] == ""
        assert not got["quality_rules"][i]["kept"]
        assert got["sentence_pieces"][i]["n_ids"] == 0 and got["sentence_pieces"][i]["round_trip"]
        assert got["token_counts"][i]["n_tokens"] == got["token_counts"][i]["n_bytes"] == 0
    assert got["shingle_join"][None]["component_id"] is None
    assert got["language_id"][10]["lang_pred"] == "und"         # digits only


def test_pipeline_over_awkward_documents(spark, tmp_path):
    for name, docs in (("full", frame(spark)), ("none", empty(spark))):
        docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / name / "documents.parquet"))
        found = corpus_pipeline.run(spark, str(tmp_path / name))
        # 0, 1 and 2 are near copies; the long 11 repeats itself, and the others are too short
        assert {r["doc_id"] for r in found.select("doc_id").distinct().collect()} == ({0} if name == "full" else set())


def test_stages_keep_columns_and_take_effect(spark):
    docs = frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").schema == docs.schema
    masked = corpus_pipeline.secrets(spark, docs.filter("doc_id = 17"), "").first()
    assert "abcdefgh12" not in masked["text"] and "AKIA" not in masked["text"]
    assert masked["n_chars"] == len(masked["text"])
    cut = corpus_pipeline.quality(spark, spark.createDataFrame(
        [(1, texts()[0] + "\nHome | About | Contact | Help")], "doc_id long, text string"), "").first()
    assert cut["text"] == texts()[0]


def test_bytes_that_are_no_utf8(spark):
    raw = spark.sql("SELECT id AS doc_id, CASE WHEN id = 1 THEN decode_bytes WHEN id = 2 THEN CAST(NULL AS STRING) ELSE 'plain words' END AS text, "
                    "'en' AS lang FROM (SELECT id, CAST(X'616263FF20C3286465C3' AS STRING) AS decode_bytes FROM range(4))")
    for name, operator in OPERATORS.items():
        found = operator(raw).collect()
        assert len(found) == 4, name
    assert OPERATORS["fingerprints"](raw).filter("doc_id = 1").first()["n_chars"] == len(b"abc\xff \xc3(de\xc3".decode("utf-8", "replace"))


def test_names_of_callers_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    for name in ("pred", "sure", "strange", "lang_", "score", "unlike", "kept", "cleaned", "_kept", "_lang"):
        docs = docs.withColumn(name, F.lit("own"))
    model = language_id.learned(docs, language_id.trained_rows())
    for kept in (language_id.with_language(docs, model, 0.25), quality_rules.clean(docs)):
        assert kept.columns == docs.columns
        assert {r[0] for r in kept.select(F.concat_ws("", *docs.columns[3:])).distinct().collect()} == {"own" * (len(docs.columns) - 3)}


def test_names_must_not_clash(spark):
    with pytest.raises(ValueError):
        sharding.place(frame(spark).withColumn("slot", F.lit(1)), ["a"])


UNLEARNED = {
    "zh": "今天天气很好我们一起去公园散步吧然后在湖边的咖啡馆喝一杯热茶。", "ja": "今日は天気がいいので友達と公園を散歩します。",
    "ru": "Сегодня хорошая погода и мы пойдем гулять в парк вместе с друзьями.", "el": "Σήμερα ο καιρός είναι καλός και θα πάμε βόλτα.",
    "ar": "الطقس جميل اليوم وسوف نذهب إلى الحديقة مع أصدقائنا", "fi": "Tänään on kaunis ilma ja menemme yhdessä puistoon kävelylle.",
    "gibberish": "xq zzkj qwrt vbnm kjhg pkx wqz jjxk vvqp zkxw bqjz hkqx"}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_texts_of_unlearned_languages_go(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").filter("text RLIKE '[A-Za-z]'")
    model = language_id.learned(docs, language_id.trained_rows())
    strange = spark.createDataFrame([(-1 - i, t * n) for i, (t, n) in enumerate((t, n) for t in UNLEARNED.values() for n in (1, 40))],
                                    "doc_id long, text string")
    found = language_id.with_language(strange, model, corpus_pipeline.LEAST_LANGUAGE_SCORE).collect()
    assert found == []
    # a prediction is always a learned language; only the stage rejects
    assert {r["lang_pred"] for r in language_id.identify(strange, model).collect()} <= {"de", "en", "es", "fr"}
    held = docs.filter(~language_id.trained_rows())
    assert language_id.with_language(held, model, corpus_pipeline.LEAST_LANGUAGE_SCORE).count() == held.count()
    short = held.select("doc_id", F.explode(F.array(*[F.array_join(F.slice(F.split("text", r"\s+"), 1, n), " ") for n in (1, 3, 10)])).alias("text"))
    short = short.filter(r"text RLIKE '\\p{L}'")
    assert {r["lang_pred"] for r in language_id.identify(short, model).select("lang_pred").distinct().collect()} <= {"de", "en", "es", "fr"}
    assert language_id.with_language(short, model, corpus_pipeline.LEAST_LANGUAGE_SCORE).count() >= 0.999 * short.count()


def test_words_that_polynomial_hashes_confuse(spark):
    """Thue-Morse words and lines agree under every polynomial modulo a power of two."""
    one, two = ("".join("ab"[(bin(i).count("1") + k) % 2] for i in range(2048)) for k in (0, 1))
    texts_ = {1: one, 2: two, 3: f"{one}\n{two}", 4: f"{one}\n{one}"}
    docs = spark.createDataFrame(list(texts_.items()), "doc_id long, text string").coalesce(1)
    assert {r["doc_id"]: r["n_dup_lines"] for r in quality_rules.quality(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 1}
    whole = packing.library(vocabulary("byte_bpe_50k.json"))
    for r in OPERATORS["packing"](docs).collect():
        ids = whole.encode(texts_[r["doc_id"]], add_special_tokens=False).ids + [1]
        own = ids[r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own))
    coder = packing.library(vocabulary("word_bpe_49k.json"))
    assert {r["doc_id"]: r["n_tokens"] for r in OPERATORS["token_counts"](docs).collect()} == {
        i: len(coder.encode(t, add_special_tokens=False).ids) for i, t in texts_.items()}
    assert len({r["component_id"] for r in minhash.near_duplicates(docs).collect()}) == 4
