"""Quality rules: divergence of a document's distributions from its language's references.

Per document two histograms are taken over the whole text: character classes (code
points, digits left out) and the language's common words (plus "any other word"). Each is compared
with the reference of the document's language by the Jensen-Shannon distance
(base 2, in [0, 1]). A histogram is judged only when the text is long enough for it
(minimum-length guards: 20 words for the classes, 100 for the common words); a shorter text that
passes the base rules is kept.

The references are trained on the corpus itself, each document with the same weight
whatever its length: first the median of each bin over the language's documents that pass the base
rules, then the mean histogram of the documents that are near these medians. Shares are summed as whole numbers (parts in 10^8), so the references do not
depend on the order of rows. They are one row per language of ``COMMON_WORDS`` and one for
all others, so their size is fixed.

The base rules: fewer than ``min_words`` words, or more than ``max_repeat_pct`` % of the
words in 5-word windows that occur at least twice in the text.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botpulse.llm.common import WHITE, Numbered, staged, text_of

# The most common words of each language (articles, pronouns, prepositions).
COMMON_WORDS = {
    "en": "the of and to a in is that it was for on are with as be at this have from or by not but which".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par sur au pas plus ne se son avec".split(),
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
}
OTHER = "other"  # the reference of all further languages: character classes only
N_COMMON = 25
SYMBOLS = "#*$%&|<>"

# Character classes of code points.
N_CLASSES = 9
_LOWER, _UPPER, _DIGIT, _SPACE, _PUNCT, _SYMBOL, _LATIN_LOWER, _LATIN_UPPER, _BEYOND = range(N_CLASSES)
_LATIN_END = 0x250
PARTS = 100_000_000
STEP = 10_000  # medians are taken over shares in steps of 1 / 10,000, so their tables have a fixed size


def _class_table() -> np.ndarray:
    table = np.full(_LATIN_END + 1, _BEYOND, np.uint8)
    for code in range(_LATIN_END):
        c = chr(code)
        if code < 128:
            table[code] = (_LOWER if c.islower() else _UPPER if c.isupper() else _DIGIT if c.isdigit()
                           else _SPACE if c in WHITE else _PUNCT if c in ".,;:!?'\"()-" else _SYMBOL)
        elif c.isalpha():
            table[code] = _LATIN_UPPER if c.isupper() else _LATIN_LOWER
        else:
            table[code] = _SYMBOL
    return table


_TABLE = _class_table()
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words covered by ``width``-word windows found twice or more in the text (all occurrences)."""
    m = len(words) - width + 1
    if m < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = ids[:m].copy()
    for o in range(1, width):
        windows *= _MIX
        windows += ids[o:o + m]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    if len(counts) == m:
        return 0
    again = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for o in range(width):
        covered[o:o + m] |= again
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            n += line in seen
            seen.add(line)
    return n


def _parts(counts: list[int]) -> list[int]:
    total = sum(counts)
    return [c * PARTS // total for c in counts] if total else []


def features(text: str, lang: str) -> tuple:
    """The base figures of a text and its two histograms as shares (parts in ``PARTS``)."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() splits at ASCII white space
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = np.bincount(_TABLE[np.minimum(codes, _LATIN_END)], minlength=N_CLASSES)
    classes[_DIGIT] = 0  # numbers are content: a phone number in a short text is no sign of junk
    common = []
    if lang in COMMON_WORDS:
        lower = text.lower().split()
        counts = Counter(lower)
        common = [counts[w] for w in COMMON_WORDS[lang]]
        common.append(len(lower) - sum(common))
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
            duplicate_lines(text), repeated_words(words), _parts(classes.tolist()), _parts(common))


_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FEATURES = T.StructType([T.StructField(n, T.LongType()) for n in _BASE]
                         + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("classes", "common")])


ROWS = 1_000  # texts turned into figures at once


def _figures(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[tuple[pd.DataFrame, pd.Series]]:
    """Figures and profiles of the texts, some at a time."""
    for texts, profiles in batches:
        for at in range(0, len(texts), ROWS):
            some = profiles.iloc[at:at + ROWS].reset_index(drop=True)
            rows = [features(t, p) for t, p in zip(texts.iloc[at:at + ROWS], some)]
            yield pd.DataFrame(rows, columns=[*_BASE, "classes", "common"]), some


@F.pandas_udf(_FEATURES)
def _features(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for found, _ in _figures(batches):
        yield found


def jensen_shannon(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances (base 2) of the rows of ``counts`` from the rows of ``reference``."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-300)
    q = reference / np.maximum(reference.sum(axis=1, keepdims=True), 1e-300)
    m = np.maximum((p + q) / 2, 1e-300)

    def half(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.maximum(x, 1e-300) / m), 0.0).sum(axis=1) / 2

    return np.sqrt(np.clip(half(p) + half(q), 0.0, 1.0))


_WIDTHS = {"classes": N_CLASSES, "common": N_COMMON + 1}


def quality_features(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     min_words: int = 10, max_repeat_pct: int = 20, figures=_features) -> DataFrame:
    """Every row of ``docs`` with a struct column ``quality_features`` (of the UDF ``figures``) and ``quality_profile``, ``base_failed``."""
    lang = F.lower(docs[f"`{lang_col}`"].cast("string"))
    profile = F.when(lang.isin(*COMMON_WORDS), lang).otherwise(OTHER)
    found = docs.withColumns({"quality_profile": profile})
    found = found.withColumn("quality_features", figures(text_of(docs, text_col), F.col("quality_profile")))
    f = F.col("quality_features")
    return found.withColumn("base_failed", (f.n_words < min_words)
                            | (100 * f.n_repeat_words > max_repeat_pct * f.n_words))


def _histograms(rows: DataFrame, summary) -> dict[str, dict[str, list[float]]]:
    """Per profile a summary of the rows' shares, bin by bin (at most one row per profile is collected)."""
    sums = [summary(F.get(F.col(f"quality_features.{name}"), F.lit(i))).alias(f"{name}_{i}")
            for name, width in _WIDTHS.items() for i in range(width)]
    return {r.quality_profile: {name: [float(r[f"{name}_{i}"] or 0) for i in range(width)]
                                for name, width in _WIDTHS.items()}
            for r in rows.groupBy("quality_profile").agg(*sums).collect()}


def _known(references: dict, name: str) -> dict[str, np.ndarray]:
    return {p: np.array(h[name]) for p, h in references.items() if sum(h[name])}


def _far(shares: pd.Series, profiles: pd.Series, known: dict[str, np.ndarray]) -> np.ndarray:
    """Distances of histograms from their profiles' references; not a number without either."""
    out = np.full(len(shares), np.nan)
    able = [i for i, (s, p) in enumerate(zip(shares, profiles)) if s is not None and len(s) and p in known]
    if able:
        out[able] = jensen_shannon(np.stack([shares[i] for i in able]).astype(float),
                                   np.stack([known[profiles[i]] for i in able]))
    return out


def _distances(references: dict, name: str):
    """A UDF: the distances of histogram ``name`` from the profiles' references; null without either."""
    known = _known(references, name)

    @F.pandas_udf("double")
    def distance(shares: pd.Series, profiles: pd.Series) -> pd.Series:
        return pd.Series(_far(shares, profiles, known))

    return distance


def _figures_and_distances(references: dict):
    """A UDF: the figures of a text with both distances, by one Python worker a task: the figures handed to a second UDF
    would take a second worker beside it. The histograms are left out."""
    known = {name: _known(references, name) for name in _WIDTHS}

    @F.pandas_udf(T.StructType([T.StructField(n, T.LongType()) for n in _BASE]
                               + [T.StructField(n, T.DoubleType()) for n in _WIDTHS]))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for found, profiles in _figures(batches):
            yield found.assign(**{name: _far(found[name], profiles, known[name]) for name in _WIDTHS})

    return run


def judge(found: DataFrame, references: dict, class_min_words: int = 20, class_limit: float = 0.175,
          common_min_words: int = 100, common_limit: float = 0.33) -> DataFrame:
    """``found`` (of :func:`quality_features`) with both distances and ``kept``."""
    raw = {f"{name}_raw": _distances(references, name)(F.col(f"quality_features.{name}"), F.col("quality_profile"))
           for name in _WIDTHS}
    return verdicts(found.withColumns(raw), {name: F.col(f"{name}_raw") for name in _WIDTHS}, class_min_words, class_limit,
                    common_min_words, common_limit).drop(*raw)


def verdicts(found: DataFrame, raw: dict[str, Column], class_min_words: int = 20, class_limit: float = 0.175,
             common_min_words: int = 100, common_limit: float = 0.33) -> DataFrame:
    """``found`` with the distances of histograms that are long enough to be judged, and ``kept``."""
    n = F.col("quality_features.n_words")
    guards = {"classes": ("class_distance", n >= class_min_words), "common": ("common_distance", n >= common_min_words)}
    out = found.withColumns({o: F.when(enough, F.nanvl(raw[name], F.lit(None))) for name, (o, enough) in guards.items()})
    far = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > class_limit) | (
        F.coalesce(F.col("common_distance"), F.lit(0.0)) > common_limit)
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


def fit_references(found: DataFrame, **limits) -> dict[str, dict[str, list[float]]]:
    """References from the rows of :func:`quality_features` that pass the base rules: first the medians of
    the bins, which a minority of junk does not move, then the means over the rows that these keep."""
    sound = found.where(~F.col("base_failed") & (F.col("quality_features.n_words") >= 20))
    first = _histograms(sound, lambda share: F.percentile(F.floor(share / STEP), 0.5))
    second = _histograms(judge(sound, first, **limits).where("kept"), F.sum)
    return {**first, **second}


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """Every row of ``docs`` with the base figures, both distances and ``kept``.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, common_distance and kept, and leaves out the text; columns of ``docs`` with
    these names are replaced. ``kept`` is false when the base rules fail, else true unless a
    guarded distance is above its limit. Distances are null below their guards (kept).

    Null text is the empty text (fails the base rules). A null or unknown language is
    judged by character classes against the profile of all other languages. Repeated
    rows each keep their row; an empty table gives an empty one; texts are read whole.
    """
    own = Numbered(docs)
    found = quality_features(own.frame, own(text_col), own(lang_col))
    found = staged(found.withColumn(own(text_col), F.lit(None).cast("string")), "quality-features")
    judged = judge(found, fit_references(found, **limits), **limits)
    judged = judged.withColumns({n: F.col(f"quality_features.{n}") for n in _BASE})
    return own.restore(judged, *_BASE, "base_failed", "class_distance", "common_distance", "kept").drop(text_col)


def keep_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with the columns of ``docs``.

    The references are fitted first, from a staged table of figures without texts. Null and empty texts go, repeated
    rows go or stay together, an empty table gives an empty one; texts are read whole, of any length."""
    own = Numbered(docs)
    found = quality_features(own.frame, own(text_col), own(lang_col))
    fitted = fit_references(staged(found.select("quality_profile", "quality_features", "base_failed"),
                                   "quality-features"), **limits)
    found = quality_features(own.frame, own(text_col), own(lang_col), figures=_figures_and_distances(fitted))
    return own.restore(verdicts(found, {name: F.col(f"quality_features.{name}") for name in _WIDTHS}, **limits).where("kept"))
