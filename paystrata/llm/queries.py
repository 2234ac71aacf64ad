"""The registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import documents


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids."""
    from paystrata.llm.packing import pack
    return pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


def op2_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents that share three quarters of their five-word shingles."""
    from paystrata.llm.shingle_join import shingle_join
    return shingle_join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from two of three folds."""
    from paystrata.llm.common import fold
    from paystrata.llm.language_id import identify, learned, trained_rows
    docs = documents(spark, sf_dir)
    found = identify(docs, learned(docs, trained_rows()))
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    from paystrata.llm.secret_scan import scan
    return scan(documents(spark, sf_dir)).drop("n_entropy")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    from paystrata.llm.quality_rules import quality
    return quality(documents(spark, sf_dir))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents under the piece vocabulary, as digests, and whether they decode to the text."""
    from paystrata.llm.sentence_pieces import digests, load
    return digests(documents(spark, sf_dir), load(vocabulary("piece_bpe_32k.model")))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    from paystrata.llm.fingerprints import compare
    return compare(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of four of five folds."""
    from paystrata.llm.toxicity import held_out, learned, score
    docs = documents(spark, sf_dir)
    model = learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under the word-based vocabulary."""
    from paystrata.llm.token_counts import count_tokens
    return count_tokens(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))



def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of each document, and where it goes when one of the 64 shards is lost."""
    from paystrata.llm.sharding import place
    shards = [f"shard-{k:02d}" for k in range(64)]
    placed = place(documents(spark, sf_dir).select("doc_id"), shards)
    return place(placed, shards[:-1], slot_name="slot_after", shard_name="shard_after").drop("slot_after")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents that share 85 of 100 of their five-word shingles."""
    from paystrata.llm.minhash import near_duplicates
    return near_duplicates(documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of all embeddings."""
    from paystrata.llm.whitening import whiten
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest collocations of each language in all documents."""
    from paystrata.llm.phrases import collocations
    return collocations(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_packing, op2_shingle_join, op3_language_id, op4_secret_scan, op5_quality_rules, op6_sentence_pieces, op7_fingerprints,
        op8_toxicity, op9_token_counts, op10_sharding, op11_minhash, op12_whitening, op13_phrases)}

_SHINGLE_JOIN_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
edges AS (
    SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
    WHERE 100 * p.o >= 75 * (x.n + y.n - p.o)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

_SECRET_SCAN_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
patterns AS (
    SELECT * FROM (VALUES
        (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
        (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]{32,}'),
        (3, 'entropy_base64', '[A-Za-z0-9+/_=-]{24,}'), (4, 'entropy_hex', '[0-9A-Fa-f]{24,}')) AS t(rank, kind, p)),
raw AS (
    SELECT doc_id, rank, kind, text, regexp_extract_all(text, p) AS m, regexp_extract_all(text, p, 2 * (rank = 0)::INT) AS v,
        regexp_split_to_array(text, p) AS g
    FROM docs, patterns WHERE regexp_matches(text, p)),
numbered AS (
    SELECT doc_id, rank, kind, unnest(range(1, len(m) + 1)) AS i, m, v, g FROM raw),
found AS (
    SELECT doc_id, rank, kind, m[i] AS m, v[i] AS v,
        CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
    FROM numbered),
base AS (
    SELECT doc_id, rank, kind, a, a + length(m) AS z FROM found
    WHERE rank < 3 AND (rank <> 0 OR length(v) >= 8) AND (rank <> 1 OR length(m) >= 16)),
candidates AS (
    SELECT doc_id, rank, kind, a, m, unnest(range(0, length(m) - 23)) AS k,
        CASE rank WHEN 3 THEN 3.9 ELSE 3.0 END AS bits
    FROM found
    WHERE rank >= 3 AND regexp_matches(m, '[0-9]')
      AND CASE rank WHEN 3 THEN regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') ELSE regexp_matches(m, '[A-Fa-f]') END
      AND NOT regexp_matches(m, '(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|sha(1|224|256|384|512)-|0123456789abcdef|abcdefghijklmnop|example|placeholder|changeme|test_?key|your_?(key|token|secret)')
      AND NOT list_bool_or([regexp_matches(lower(m), chr(c::INT) || '{8,}') FOR c IN
          list_concat(range(48, 58), range(97, 123), [45, 61, 95])])),
windows AS (
    SELECT doc_id, rank, kind, a + k AS a FROM candidates
    WHERE list_entropy(string_split(substr(m, k + 1, 24), '')) >= bits - 1e-9),
starts AS (
    SELECT *, CASE WHEN a - lag(a) OVER w <= 24 THEN 0 ELSE 1 END AS new FROM windows WINDOW w AS (PARTITION BY doc_id, rank ORDER BY a)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, rank ORDER BY a) AS run FROM starts),
more AS (SELECT doc_id, rank, kind, min(a) AS a, max(a) + 24 AS z FROM runs GROUP BY doc_id, rank, kind, run),
every AS (
    SELECT * FROM base UNION ALL
    SELECT * FROM more e WHERE NOT EXISTS (FROM base b WHERE b.doc_id = e.doc_id AND b.a < e.z AND e.a < b.z)),
joined AS (
    SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
        count(*) FILTER (rank = 2) AS n_hex,
        coalesce(string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) FILTER (rank < 3), '') AS b,
        string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) AS spans
    FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (doc_id)
"""

_QUALITY_RULES_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
measured AS (
    SELECT doc_id, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM lines),
judged AS (
    SELECT doc_id, line, len(w) AS n, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS solid,
        length(line) - length(regexp_replace(line, '[!#$%&()*+/:;<=>?@\[\\\]^_`{|}~]', '', 'g')) AS marks,
        regexp_matches(line, '[.,;:!?]') AS sentence,
        len(list_filter(w, lambda x: list_contains(['|', '>', '/', '-', '–', '»', '•', '·'], x))) AS separators,
        regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            'all rights reserved|licensed under|released under the|terms of use|terms of service|privacy policy|cookie policy|accept cookies|enable javascript|lorem ipsum|click here|read more|sign up|log in|subscribe to|share this|back to top|powered by') AS phrase
    FROM measured WHERE len(w) > 0),
by_line AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
        sum(solid) FILTER (100 * marks > 20 * solid OR n >= 50 AND NOT sentence
            OR separators >= 2 AND 5 * separators >= n OR phrase AND n <= 20) AS lost
    FROM judged GROUP BY doc_id),
words AS (
    SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs),
grams AS (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM grams) WHERE k > 1),
repeated AS (
    SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY doc_id),
counted AS (
    SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
    FROM words LEFT JOIN by_line USING (doc_id) LEFT JOIN repeated r USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept
FROM counted
"""

_MINHASH_SQL = _SHINGLE_JOIN_SQL.replace("100 * p.o >= 75 *", "100 * p.o >= 85 *").replace(
    "c.component_id\nFROM documents", "c.component_id,\n    d.doc_id = c.component_id AS kept\nFROM documents")

_PHRASES_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS (
    SELECT lang, w, len(w) AS m
    FROM (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces)
    WHERE len(w) > 0),
totals AS (SELECT lang, sum(m)::BIGINT AS n FROM words GROUP BY lang),
spots AS (SELECT lang, w, m, k, unnest(range(1, m - k + 2)) AS i FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE m >= k),
counts AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM spots GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
    SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM counts WHERE k > 1),
scores AS (
    SELECT u.lang, u.phrase, u.k, u.a, l.f AS l, r.f AS r, t.n, u.c, 1000::HUGEINT * u.a * t.n // (l.f::HUGEINT * r.f) AS score
    FROM cuts u JOIN counts l ON l.lang = u.lang AND l.phrase = array_to_string(u.w[1:u.c], ' ')
    JOIN counts r ON r.lang = u.lang AND r.phrase = array_to_string(u.w[u.c + 1:], ' ') JOIN totals t ON t.lang = u.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_ AS (
    SELECT lang, k - w AS k, array_to_string(string_split(phrase, ' ')[s:s + k - w - 1], ' ') AS phrase, max(f) AS most
    FROM (SELECT *, unnest(range(1, w + 2)) AS s FROM (SELECT *, unnest(range(1, k - 1)) AS w FROM counts WHERE k > 2))
    GROUP BY ALL),
left_ AS (
    SELECT x.* FROM lowest x LEFT JOIN inner_ y ON y.lang = x.lang AND y.phrase = x.phrase WHERE y.most IS NULL OR y.most < x.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
    score::BIGINT AS score
FROM left_ QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {"op2_shingle_join": _SHINGLE_JOIN_SQL, "op11_minhash": _MINHASH_SQL,
                          "op13_phrases": _PHRASES_SQL, "op4_secret_scan": _SECRET_SCAN_SQL,
                          "op5_quality_rules": _QUALITY_RULES_SQL}
