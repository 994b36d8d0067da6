"""Secret scans (DataFrame functions only): fixed patterns, then windowed entropy.

Base kinds are regular expressions. The method adds the kind ``entropy``: candidates are maximal runs
of at least ``WINDOW`` key characters with a digit and a letter. A window of ``WINDOW``
characters slides over each candidate; the counts of its characters change by one entering and one leaving
character a step, and so does the sum of ``c * log2(c)`` from which the Shannon entropy follows. A
candidate is a secret if a window reaches the threshold of its character class (the smallest of
hex, lower-case alphanumeric, base64 that holds all its characters), unless it lies in a
base span or matches the allow list (well-known identifiers, placeholders, sequences).
Entropies are whole numbers (millionths of a bit times the window), so they are exact everywhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botpulse.llm.common import Numbered, once, text_of

WINDOW = 20
KINDS = ("assign", "access", "hex", "entropy")
# Fixed patterns. A run too short for its kind matches nothing; the last kind is checked by length afterwards.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % WINDOW
# Bits of entropy a window needs, by character class.
CLASSES = (("^[0-9A-Fa-f]+$", 2.9), ("^[0-9a-z]+$", 3.5), (".*", 3.7))
ALLOWED = (
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",  # UUIDs
    r"(?i)example|sample|placeholder|changeme|dummy|redacted",
    r"(?i)abcdefgh|01234567|12345678|qwerty|(.)\1{7,}",
    r"^[0-9]+([-_/+][0-9]+)*$",  # numbers, dates, phone numbers
    r"(?i)^[a-z]+([-_/+][a-z]+)*([-_/+]?[0-9]{1,4})?$",  # words with at most one short number
)
_MILLION = 1_000_000
_F = [0] + [round(c * math.log2(c) * _MILLION) for c in range(1, WINDOW + 1)]


def _spans(text: Column, pattern: str, passes=None, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end), in code points.

    The pieces between the matches and the matches themselves give the offsets. ``passes`` judges a
    match by its ``group``; failing matches are dropped after they were consumed."""
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    good = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(pieces.alias("gap"), matches.alias("size"), good.alias("group"))
    kind = "array<struct<start:int,end:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(state: Column, row: Column) -> Column:
        start = state.at + row.gap
        end = start + F.coalesce(row["size"], F.lit(0))
        ok = row["size"].isNotNull()
        if passes is not None:
            ok = ok & passes(row["group"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(ok, F.concat(state.out, span)).otherwise(state.out).alias("out"))

    found = F.aggregate(rows, zero, step, lambda s: s.out)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(kind))


def peak_entropy(word: Column, window: int = WINDOW) -> Column:
    """The largest entropy of any window of an ASCII word, times ``window``, in millionths of a bit."""
    codes = F.transform(F.filter(F.split(word, ""), lambda c: c != ""), F.ascii)
    table = F.array(*[F.lit(x).cast("long") for x in _F])
    steps = F.zip_with(codes, F.concat(F.array_repeat(F.lit(-1), window), codes),
                       lambda enters, leaves: F.struct(enters.alias("a"), leaves.alias("b")))
    zero = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0).cast("long").alias("sum"),
                    F.lit(0).alias("seen"), F.lit(0).cast("long").alias("most"))
    full = _F[window]

    def step(state: Column, x: Column) -> Column:
        enters, leaves, counts = x.a, x.b, state["counts"]
        c = F.get(counts, enters)
        d = F.get(counts, leaves)
        same = enters == leaves
        gain = F.when(same, 0).otherwise(F.get(table, c + 1) - F.get(table, c))
        loss = F.when(same | (leaves < 0), 0).otherwise(F.get(table, d) - F.get(table, d - 1))
        total = state["sum"] + gain - loss
        moved = F.transform(counts, lambda n, i: n + F.when(i == enters, 1).otherwise(0)
                            - F.when(i == leaves, 1).otherwise(0))
        seen = state["seen"] + 1
        now = F.when(seen >= window, F.lit(full) - total).otherwise(0)
        return F.struct(moved.alias("counts"), total.alias("sum"), seen.alias("seen"),
                        F.greatest(state["most"], now.cast("long")).alias("most"))

    # past the word's end there is nothing to enter
    return F.aggregate(F.filter(steps, lambda s: s.a.isNotNull()), zero, step, lambda s: s["most"])


def _secret(word: Column, window: int, allowed: tuple[str, ...]) -> Column:
    need = F.lit(None).cast("long")
    for pattern, bits in reversed(CLASSES):
        need = F.when(word.rlike(pattern), F.lit(round(bits * window * _MILLION))).otherwise(need)
    fine = word.rlike("[0-9]") & word.rlike("[A-Za-z]")
    for pattern in allowed:
        fine = fine & ~word.rlike(pattern)
    return F.when(fine, peak_entropy(word, window) >= need).otherwise(False)


def secret_spans(docs: DataFrame, text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Every row of ``docs`` with ``secrets``: an array of (start, kind number, end), ordered so.

    Offsets are code points, end exclusive; kinds are numbered as in ``KINDS``. Null text is
    empty (no spans). Repeated rows keep their rows, an empty table gives an empty one. Texts are
    searched whole. A column named secrets is replaced.
    """
    numbered = Numbered(docs)
    text = text_of(numbered.frame, numbered(text_col))
    own = {"__assign": _spans(text, ASSIGN, lambda g: F.length(g) >= 6, 2), "__access": _spans(text, ACCESS),
           "__hex": _spans(text, HEX)}
    found = numbered.frame.withColumns({k: once(v) for k, v in own.items()})
    found = found.withColumn("__words", once(_spans(text, CANDIDATE, lambda w: _secret(w, WINDOW, allowed))))

    def tagged(name: str, kind: int) -> Column:
        return F.transform(name, lambda s: F.struct(s.start.alias("start"), F.lit(kind).alias("kind"), s.end.alias("end")))

    base = F.concat(*[tagged(name, i) for i, name in enumerate(own)])
    found = found.withColumn("__base", once(base))
    fresh = F.filter(tagged("__words", 3), lambda w: ~F.exists(
        "__base", lambda b: (b.start < w.end) & (w.start < b.end)))
    return numbered.restore(found.withColumn("secrets", once(F.array_sort(F.concat("__base", fresh)))), "secrets")


def as_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")
