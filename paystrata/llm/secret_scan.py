"""Secret scans with built-in expressions only.

Base kinds are patterns. The entropy kinds look at candidate strings: runs of the characters of a class, at least one
window long. A window slides over each candidate; its Shannon entropy is kept up by the counts of the character that
enters and the one that leaves, and windows over the class's threshold join to spans. Candidates that match an entry of
the allow-list, and spans that touch a base span, are left out.

With counts c of the characters in a window of w, the entropy is ``log2(w) - sum(c * log2(c)) / w``. Only the sum is
carried; a character that enters as the c-th of its kind adds ``f(c) - f(c - 1)`` with ``f(c) = c * log2(c)``.

Positions come from splitting: the parts of a text between the matches of a pattern, and the matches, give the start and
end of each match in code points. Texts without a match skip that.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds. Matches of `assign` whose value (group 2) is shorter than
# `ASSIGN_VALUE` are dropped after matching, for they take up their text.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharacterClass:
    """Characters of a candidate, the window's length, the entropy from which on a window counts, and what each
    candidate must hold."""
    kind: str
    characters: str
    window: int
    bits: float
    needs: tuple[str, ...]

    @property
    def pattern(self) -> str:
        return f"(?<![{self.characters}])[{self.characters}]{{{self.window},}}"


CLASSES = (
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 24, 3.9, ("[0-9]", "[A-Z]", "[a-z]")),
    CharacterClass("entropy_hex", "0-9A-Fa-f", 24, 3.0, ("[0-9]", "[A-Fa-f]")),
)
KINDS = (*BASE_KINDS, *(c.kind for c in CLASSES))

# Strings that look random and are none. Matched anywhere in a candidate, in either case.
ALLOWED = (
    "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    "sha(1|224|256|384|512)-",
    "0123456789abcdef",
    "abcdefghijklmnop",
    "example",
    "placeholder",
    "changeme",
    "test_?key",
    "your_?(key|token|secret)",
    "(.)\\1{7,}",
)

_SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"
_NONE = f"CAST(array() AS {_SPAN})"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(kind: str, pattern: str, text: str, keep: str = "true") -> str:
    """SQL for the spans of a pattern's matches; ``keep`` may look at the match as ``m``."""
    p, rank = _literal(pattern), KINDS.index(kind)
    return f"""
    CASE WHEN {text} RLIKE {p} THEN aggregate(
        zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (g, m) -> named_struct('gap', g, 'm', m)),
        named_struct('at', 0, 'spans', {_NONE}),
        (acc, x) -> named_struct(
            'at', acc.at + length(x.gap) + coalesce(length(x.m), 0),
            'spans', CASE WHEN x.m IS NOT NULL AND {keep.replace('$m', 'x.m')} THEN array_append(acc.spans, named_struct(
                'start', acc.at + length(x.gap), 'rank', {rank}, 'kind', '{kind}',
                'end', acc.at + length(x.gap) + length(x.m))) ELSE acc.spans END),
        acc -> acc.spans)
    ELSE {_NONE} END"""


def _count_log(c: str) -> str:
    return f"(CASE WHEN {c} > 1 THEN {c} * log2({c}) ELSE 0D END)"


def _random_parts(kind: CharacterClass, candidate: str, start: str) -> str:
    """SQL for the spans within one candidate whose windows have enough entropy."""
    w, rank = kind.window, KINDS.index(kind.kind)
    most = (math.log2(w) - kind.bits) * w      # the sum of c * log2(c) may not be above this
    entering, leaving = "element_at(c, i)", f"element_at(c, i - {w})"
    # how often a character is in the window before the step
    count = f"size(filter(slice(c, greatest(1, i - {w}), least(i - 1, {w})), y -> y = %s))"
    rest = f"size(filter(slice(c, greatest(1, i - {w} + 1), {w} - 1), y -> y = %s))"
    leave = f"(CASE WHEN i > {w} THEN {_count_log('(' + count % leaving + ')')} - {_count_log('(' + count % leaving + ' - 1)')} ELSE 0D END)"
    there = f"(CASE WHEN i > {w} THEN {rest % entering} ELSE {count % entering} END)"
    enter = f"({_count_log('(' + there + ' + 1)')} - {_count_log(there)})"
    return f"""
    aggregate(array(split({candidate}, '')), {_NONE}, (none, c) -> aggregate(
        sequence(1, size(c)), named_struct('s', 0D, 'from', 0, 'upto', 0, 'spans', {_NONE}),
        (a, i) -> aggregate(array(a.s - {leave} + {enter}), a, (b, s) -> CASE
            WHEN i < {w} OR s > {most!r}D THEN named_struct('s', s, 'from', b.from, 'upto', b.upto, 'spans', b.spans)
            WHEN b.upto > 0 AND i - {w} <= b.upto THEN named_struct('s', s, 'from', b.from, 'upto', i, 'spans', b.spans)
            ELSE named_struct('s', s, 'from', i - {w}, 'upto', i, 'spans', CASE WHEN b.upto > 0 THEN array_append(b.spans,
                named_struct('start', {start} + b.from, 'rank', {rank}, 'kind', '{kind.kind}', 'end', {start} + b.upto))
                ELSE b.spans END) END),
        a -> CASE WHEN a.upto > 0 THEN array_append(a.spans,
            named_struct('start', {start} + a.from, 'rank', {rank}, 'kind', '{kind.kind}', 'end', {start} + a.upto))
            ELSE a.spans END))"""


def base_spans(text: str) -> str:
    return "concat(" + ",".join([
        _found("assign", ASSIGN, text, f"length(regexp_extract($m, {_literal(ASSIGN)}, 2)) >= {ASSIGN_VALUE}"),
        _found("access", ACCESS, text), _found("hex", HEX, text)]) + ")"


def entropy_spans(text: str) -> str:
    """SQL for the spans of all character classes, before base spans are looked at."""
    allowed = _literal("(?i)" + "|".join(ALLOWED))
    parts = []
    for kind in CLASSES:
        needs = " AND ".join(f"$m RLIKE '{n}'" for n in kind.needs)
        candidates = _found(kind.kind, kind.pattern, text, f"({needs} AND NOT $m RLIKE {allowed})")
        parts.append(f"flatten(transform({candidates}, k -> "
                     f"{_random_parts(kind, f'substring({text}, k.start + 1, k.end - k.start)', 'k.start')}))")
    return "concat(" + ",".join(parts) + ")"


def with_spans(docs: DataFrame, text_col: str, spans_col: str) -> DataFrame:
    """``docs`` with an array of (start, rank, kind, end), ordered by start and kind."""
    text = f"coalesce(CAST(`{text_col}` AS STRING), '')"
    base = docs.withColumn(f"{spans_col}_base", F.expr(base_spans(text)))
    both = base.withColumn(f"{spans_col}_more", F.expr(entropy_spans(text)))
    apart = F.expr(f"filter({spans_col}_more, e -> NOT exists({spans_col}_base, b -> b.start < e.end AND e.start < b.end))")
    return both.withColumn(spans_col, F.array_sort(F.concat(f"{spans_col}_base", apart))).drop(
        f"{spans_col}_base", f"{spans_col}_more")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans.

    Spans are kind:start:end in code points, the end excluded. A null or empty text has none. Repeated rows and null ids
    are scanned each. An empty table gives no rows.
    """
    found = with_spans(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                       "text", "found")
    base = F.filter("found", lambda s: s["rank"] < len(BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.size(F.filter("found", lambda s: s["rank"] >= len(BASE_KINDS))).cast("long").alias("n_entropy"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The documents with each span, or run of overlapping spans, replaced by ``mask``."""
    cut = F.expr(f"""aggregate(_spans, named_struct('at', 0, 'parts', CAST(array() AS array<string>)),
        (acc, s) -> CASE
            WHEN s.start >= acc.at THEN named_struct('at', s.end, 'parts', concat(acc.parts,
                array(substring(`{text_col}`, acc.at + 1, s.start - acc.at), {_literal(mask)})))
            ELSE named_struct('at', greatest(acc.at, s.end), 'parts', acc.parts) END,
        acc -> concat(array_join(acc.parts, ''), substring(`{text_col}`, acc.at + 1)))""")
    masked = with_spans(docs, text_col, "_spans").withColumn(
        text_col, F.when(F.size("_spans") > 0, cut).otherwise(F.col(text_col)))
    return masked.select(*docs.columns)
