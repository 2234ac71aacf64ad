"""Language identification in two steps: the family of a text first, then the language within the family.

Texts become relative frequencies of hashed letter runs (one to three bytes of the folded text, everything but letters
is a gap). A softmax over families decides the family; within it, one linear support vector machine for each pair of
languages votes, and the sum of the votes' confidences decides. A family of one language needs no second step.

Families are a table of closely related languages (``FAMILIES``); a language that is not in it is a family of its own.

Both steps choose among learned languages only, and always answer with one. Whether the text looks like that language at all is
asked where texts are to be rejected (``with_language``): how many bits a letter run its learned texts explain this text better
than an even spread over all features does. A text that falls short of the median learned text of that language (each
explained by the others) by more than ``bits_short`` is in no learned language. That bound is wider for a text of few letter
runs, whose mean varies more.
"""

from __future__ import annotations

from dataclasses import dataclass, field as data_field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.llm.common import annotate, field, fold, free_name, pick, ship

FAMILIES = {
    "germanic": ("de", "nl", "en", "sv", "da", "no", "af", "lb", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "indic": ("hi", "ur", "mr", "ne", "bn", "gu", "pa"),
    "semitic": ("ar", "he", "mt", "am"),
}
#: Hashed features, and labelled documents to each language that are learned from: the training bound.
FEATURES = 4096
LEARN_FROM = 400
UNDETERMINED = "und"
#: The part of a language's letter runs that is taken as evenly spread, for runs its learned texts lack; the bits a letter run
#: that a long text may fall short, and what is added for a text of one letter, falling with the root of their number.
EVEN = 0.05
BITS_SHORT = 2.5
MORE_BITS_SHORT = 6.0

FIELDS = [field("lang_pred", T.StringType()), field("score", T.DoubleType())]

# folded letters; bytes of other scripts stay as they are, all else is a gap (0)
_LETTER = np.zeros(256, np.uint32)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def features(data: np.ndarray, offsets: np.ndarray, size: int = FEATURES) -> np.ndarray:
    """One row per text: square roots of the shares of its hashed letter runs (so rows have length 1)."""
    n = len(offsets) - 1
    out = np.zeros((n, size), np.float32)
    letters = _LETTER[data]
    gap = letters == 0
    before = np.append(np.uint32(0), letters[:-1]) if len(letters) else letters
    before2 = np.append(np.uint32(0), before[:-1]) if len(letters) else letters
    for i in range(n):
        own = slice(offsets[i], offsets[i + 1])
        a, b, c, skip = letters[own], before[own], before2[own], gap[own]
        if len(a) == 0:
            continue
        b, c = b.copy(), c.copy()
        b[0] = 0
        c[:2] = 0
        solid = ~skip
        two = (a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA77)) >> np.uint32(20)
        three = (a * np.uint32(0xC2B2AE3D) ^ b * np.uint32(0x27D4EB2F) ^ c * np.uint32(0x165667B1)) >> np.uint32(20)
        counts = (np.bincount(a[solid] % np.uint32(size), minlength=size)
                  + np.bincount(two % np.uint32(size), solid | (b > 0), minlength=size)
                  + np.bincount(three % np.uint32(size), solid & (b > 0), minlength=size))
        total = counts.sum()
        if total:
            out[i] = np.sqrt(counts / total)
    return out


@dataclass
class Model:
    languages: list[str]
    families: list[list[str]]
    family_weights: np.ndarray = data_field(default_factory=lambda: np.zeros((FEATURES + 1, 0)))
    pairs: dict[tuple[str, str], np.ndarray] = data_field(default_factory=dict)
    bits: np.ndarray = data_field(default_factory=lambda: np.zeros((0, FEATURES), np.float32))
    usual_bits: np.ndarray = data_field(default_factory=lambda: np.zeros(0))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The learned language of each row and a score from 0 to 1; ``und`` and 0 only if none was learned."""
        n = len(x)
        if not self.languages:
            return [UNDETERMINED] * n, np.zeros(n)
        x = np.hstack([x, np.ones((n, 1), np.float32)])
        likely = _softmax(x @ self.family_weights)
        family = likely.argmax(axis=1)
        out, score = np.empty(n, object), likely[np.arange(n), family].astype(float)
        for k, members in enumerate(self.families):
            rows = np.flatnonzero(family == k)
            votes = np.zeros((len(rows), len(members)))
            for i, one in enumerate(members):
                for j in range(i + 1, len(members)):
                    sure = 1 / (1 + np.exp(-4 * (x[rows] @ self.pairs[one, members[j]])))
                    votes[:, i] += sure
                    votes[:, j] += 1 - sure
            best = votes.argmax(axis=1)
            out[rows] = np.array(members, object)[best]
            if len(members) > 1:
                score[rows] *= votes[np.arange(len(rows)), best] / (len(members) - 1)
        # a row's sums may differ in the last bits with the rows around it; equal texts are to score alike
        return out.tolist(), np.round(np.clip(score, 0, 1), 5)


    def shortfall(self, x: np.ndarray, languages: list[str]) -> np.ndarray:
        """By how many bits a letter run each row falls short of the usual text of its language."""
        at = np.searchsorted(np.array(self.languages, object), np.array(languages, object))
        return self.usual_bits[at] - np.round(np.einsum("ij,ij,ij->i", x, x, self.bits[at]), 3)


def bits_short(letters: np.ndarray) -> np.ndarray:
    """The shortfall that a text with so many letters may have."""
    return BITS_SHORT + MORE_BITS_SHORT / np.sqrt(np.maximum(letters, 1))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _balanced(y: np.ndarray) -> np.ndarray:
    """Weights with which every class counts alike."""
    _, back, n = np.unique(y, return_inverse=True, return_counts=True)
    return (1 / n[back]) / len(n)


def train_softmax(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 150, rate: float = 20.0) -> np.ndarray:
    weights = np.zeros((x.shape[1], classes), np.float32)
    moved = np.zeros_like(weights)
    importance = _balanced(y)[:, None].astype(np.float32)
    target = np.eye(classes, dtype=np.float32)[y]
    for _ in range(steps):
        slope = x.T @ (importance * (_softmax(x @ weights) - target)) + 1e-5 * weights
        moved = 0.9 * moved - rate * 0.1 * slope
        weights = weights + moved
    return weights


def train_svm(x: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 2.0) -> np.ndarray:
    """A linear support vector machine (squared hinge loss) for y of -1 and 1, by gradient steps."""
    weights = np.zeros(x.shape[1], np.float32)
    moved = np.zeros_like(weights)
    y, importance = y.astype(np.float32), _balanced(y).astype(np.float32)
    for _ in range(steps):
        short = np.maximum(0, 1 - y * (x @ weights))
        slope = -2 * x.T @ (importance * y * short) + 1e-4 * weights
        moved = 0.9 * moved - rate * 0.1 * slope
        weights = weights + moved
    return weights


def _explained(shares: np.ndarray) -> np.ndarray:
    """Bits by which letter runs with these shares explain each feature better than an even spread does."""
    return np.log2((1 - EVEN) * shares * shares.shape[-1] + EVEN)


def likeness_to_own(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The bits of a language's features, and those of its median text; one learned text alone sets no bound."""
    shares = x.astype(float) ** 2
    total, n = shares.sum(axis=0), len(x)
    bits = _explained(total / n).astype(np.float32)
    if n < 2:
        return bits, -np.inf
    by_others = [row @ _explained(np.maximum(total - row, 0) / (n - 1)) for row in shares]
    return bits, float(np.median(by_others))


def train(x: np.ndarray, labels: list[str]) -> Model:
    languages = sorted(set(labels))
    named = [[m for m in members if m in languages] for members in FAMILIES.values()]
    families = [sorted(m) for m in named if m]
    families += [[m] for m in languages if not any(m in f for f in families)]
    if not languages:
        return Model([], [])
    y = np.array(labels)
    own = [likeness_to_own(x[y == m]) for m in languages]
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    family_of = {m: k for k, members in enumerate(families) for m in members}
    model = Model(languages, families, bits=np.array([b for b, _ in own]), usual_bits=np.array([t for _, t in own]))
    model.family_weights = train_softmax(x, np.array([family_of[m] for m in labels]), len(families))
    for members in families:
        for i, one in enumerate(members):
            for other in members[i + 1:]:
                rows = np.flatnonzero((y == one) | (y == other))
                model.pairs[one, other] = train_svm(x[rows], np.where(y[rows] == one, 1.0, -1.0))
    return model


def learned(docs: DataFrame, train_on, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            bound: int = LEARN_FROM) -> Model:
    """A model from at most ``bound`` labelled texts of each language among the rows for which ``train_on`` holds.

    The rows are those with the smallest hashes of id and language, so equal tables give equal models. The languages
    are those of the rows with the smallest hashes; whole texts are looked at.
    """
    ship(docs.sparkSession)
    known = docs.filter(train_on & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(id_col), F.col(lang_col)).alias("h"))
    # the bound-th smallest hash of each language: an aggregate over numbers, combined in the tasks
    share = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    limits = {r["lang"]: min(1.0, 1.2 * bound / r["n"]) for r in share}
    if not limits:
        return Model([], [])
    keep = F.lit(False)
    for lang, part in sorted(limits.items()):
        top = int(-2**63 + part * (2**64 - 1))
        keep = keep | ((F.col("lang") == lang) & (F.col("h") <= F.lit(min(top, 2**63 - 1))))

    def compute():
        return lambda data, offsets: [[row.tobytes() for row in features(data, offsets).astype(np.float16)]]

    rows = (annotate(known.filter(keep), "text", compute, [field("x", T.BinaryType())])
            .select("lang", "h", "x").collect())
    rows.sort(key=lambda r: (r["lang"], r["h"], r["x"]))
    taken, chosen = {}, []
    for row in rows:
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= bound:
            chosen.append(row)
    x = np.array([np.frombuffer(r["x"], np.float16) for r in chosen], np.float32).reshape(-1, FEATURES)
    return train(x, [r["lang"] for r in chosen])


def _labelled(texts: DataFrame, text_col: str, model: Model, pred: str, score: str, strange: str | None = None) -> DataFrame:
    """``texts`` with a predicted language and its score, and, if asked for, whether the text is unlike that language."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def compute():
        def block(data, offsets):
            labels, scores, unlike = [], [], []
            letters = np.concatenate([[0], np.cumsum(_LETTER[data] > 0)])
            for a in range(0, len(offsets) - 1, 256):       # 256 rows of features are 4 MB
                part = offsets[a:a + 257]
                x = features(data[part[0]:part[-1]], part - part[0])
                own = shared.value.predict(x)
                labels += own[0]
                scores.append(own[1])
                if strange and shared.value.languages:
                    unlike.append(shared.value.shortfall(x, own[0]) > bits_short(np.diff(letters[part])))
            found = [labels, np.concatenate([*scores, np.zeros(0)])]
            return [*found, np.concatenate([*unlike, np.zeros(0, bool)]) if unlike else [False] * len(labels)]
        return block

    readable = F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))
    taken = [*texts.columns, pred, score, strange or ""]
    made = {name: free_name(taken, name) for name in ("lang", "score", "unlike")}
    raw = annotate(texts, text_col, compute, [field(made["lang"], T.StringType()), field(made["score"], T.DoubleType()),
                                              field(made["unlike"], T.BooleanType())])
    out = raw.withColumn(pred, F.when(readable, F.col(made["lang"])).otherwise(UNDETERMINED)).withColumn(
        score, F.when(readable, F.col(made["score"])).otherwise(0.0))
    if strange:
        out = out.withColumn(strange, F.col(made["unlike"]) | ~readable)
    return out.drop(*made.values())


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score.

    A null or empty text, or one without a letter, is ``und`` with score 0; so is every text if nothing was learned. Every
    other text has a learned language.
    Repeated rows get the same answer, null ids are kept. An empty table gives no rows.
    """
    return _labelled(pick(docs, id_col, text_col), "text", model, "lang_pred", "score").drop("text")


def with_language(docs: DataFrame, model: Model, min_score: float, text_col: str = "text") -> DataFrame:
    """The documents that are in a learned language with at least this score, with all their columns.

    Documents without text or letters go, and those that are unlike every learned language.
    """
    pred, sure, strange = (free_name(docs.columns, name) for name in ("pred", "sure", "strange"))
    found = _labelled(docs, text_col, model, pred, sure, strange)
    kept = found.filter((F.col(pred) != UNDETERMINED) & (F.col(sure) >= min_score) & ~F.col(strange))
    return kept.select(*[F.col(f"`{name}`") for name in docs.columns])


def trained_rows(id_col: str = "doc_id"):
    """The rows that may be learned from: two of three folds."""
    return fold(id_col, 3) != 1
