"""Line dedup by winnowing: later copies of repeated runs of lines are deleted.

A document is the sequence of its lines that hold a word, each stripped of white space.
A run of consecutive lines qualifies if it has ``run`` lines or ``words`` words. A line is deleted
when it lies in a qualifying run that also starts at an earlier place; places are ordered by document
id (nulls first), then text hash, then position, so of each repeated run the earliest place stays.

1. *Winnow.* The window at a line is the shortest qualifying run that begins there. In every window the
   smallest line hash is selected (leftmost on ties). Equal windows select equal lines, so every repeated
   run that qualifies holds a common fingerprint. Only selected lines are emitted.
2. *Join positions.* Fingerprints that occur once are dropped (counted with map-side combining).
3. *Extend.* Around each place of a repeated fingerprint the match is extended to the left and to the right by
   up to ``run - 1`` lines: every qualifying extension has a digest. The earliest place of each
   (fingerprint, extension) is found by a map-side combined minimum; places behind it are matches. A longer
   repeated run is the union of these, as each of its lines lies in a qualifying part of at most ``run`` lines.
4. *Delete.* The lines of the matched runs go.

Nothing pairs copies with each other, so a line that a third of all documents hold costs a few
rows per place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botpulse.llm.common import WHITE, Numbered, once, staged, text_of
from botpulse.llm.substring_dedup import _mixed, row_key

RUN, WORDS = 3, 8
_STEP = np.uint64(0x9E3779B97F4A7C15)


def lines_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line with a word: the halves of its 128-bit hash and its number of words."""
    import xxhash

    lines = [s.encode("utf-8", "surrogatepass") for line in text.split("\n") if (s := line.strip(WHITE))]
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), ">u8").reshape(-1, 2).astype(np.uint64)
    return halves[:, 1], halves[:, 0], np.fromiter((len(s.split()) for s in lines), np.int64, len(lines))


def _qualifies(words: np.ndarray, length: int, run: int, least: int | None) -> np.ndarray:
    """For each start, whether the ``length`` lines from there qualify; starts whose lines end in the document only."""
    n = max(0, len(words) - length + 1)
    if length == run:
        return np.ones(n, bool)
    if least is None:
        return np.zeros(n, bool)
    before = np.concatenate([[0], np.cumsum(words)])
    return before[length:length + n] - before[:n] >= least


def fingerprints(h: np.ndarray, words: np.ndarray, run: int, least: int | None) -> np.ndarray:
    """Places of the lines that the windows select, ascending."""
    open_ = np.ones(len(h), bool)
    chosen = np.zeros(len(h), bool)
    for length in range(1, run + 1):
        fits = _qualifies(words, length, run, least)
        at = np.flatnonzero(fits & open_[:len(fits)])
        open_[at] = False
        if len(at):
            view = np.lib.stride_tricks.sliding_window_view(h, length)[at]
            chosen[at + view.argmin(axis=1)] = True
    return np.flatnonzero(chosen)


def extensions(run: int) -> list[tuple[int, int]]:
    """``(lines to the left, length)`` of the runs of up to ``run`` lines around a line."""
    return [(left, length) for length in range(1, run + 1) for left in range(length)]


def extended(at: np.ndarray, g: np.ndarray, words: np.ndarray, run: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the extensions around each place, one column each, and whether they exist and qualify."""
    shapes = extensions(run)
    marks, there = np.zeros((len(at), len(shapes)), np.uint64), np.zeros((len(at), len(shapes)), bool)
    for k, (left, length) in enumerate(shapes):
        fits = _qualifies(words, length, run, least)
        start = at - left
        inside = (start >= 0) & (start < len(fits))
        inside[inside] = fits[start[inside]]
        value = np.full(int(inside.sum()), k + 1, np.uint64) * _STEP
        for o in range(length):
            value = _mixed((value ^ g[start[inside] + o]) * _STEP)
        marks[inside, k], there[:, k] = value, inside
    return marks, there


def delete_lines(text: str, spans) -> str:
    """``text`` without the non-blank lines of the runs, given as (first line, number of lines)."""
    gone, out, number = set(), [], 0
    for s, n in spans:
        gone.update(range(s, s + n))
    for line in text.split("\n"):
        if line.strip(WHITE):
            if number not in gone:
                out.append(line)
            number += 1
        else:
            out.append(line)
    return "\n".join(out)


def _winnowed(run: int, least: int | None):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, seeds, marks, there = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                h, g, words = lines_of(text.as_py())
                at = fingerprints(h, words, run, least)
                if len(at):
                    rows.append(np.full(len(at), i))
                    places.append(at)
                    seeds.append(h[at])
                    for out, value in zip((marks, there), extended(at, g, words, run, least)):
                        out.append(value)
            if rows:
                row = pa.array(np.concatenate(rows))
                mark = np.concatenate(marks)
                digests = pa.array(mark.ravel().view(np.int64), mask=~np.concatenate(there).ravel())
                ends = np.arange(len(mark) + 1, dtype=np.int32) * mark.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(row), batch.column("r1").take(row), batch.column("r2").take(row),
                     pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(seeds).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), digests)], names=["id", "r1", "r2", "line", "fingerprint", "marks"])

    return apply


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
                  words: int | None = WORDS) -> DataFrame:
    """Runs of lines ``(r1, r2, start, length)`` that repeat an earlier place."""
    text = text_of(docs, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[f"`{id_col}`"].alias("id"), *row_key(docs, id_col, text), text.alias("text"))
    seeds = staged(rows.mapInArrow(_winnowed(run, words), f"id {id_type}, r1 long, r2 long, line int,"
                                                          " fingerprint long, marks array<long>"), "line-fingerprints")
    shared = staged(seeds.groupBy("fingerprint").agg(F.count("*").alias("c")).where("c > 1").select("fingerprint"),
                    "line-shared")
    shapes = extensions(run)
    left, length = (F.array(*[F.lit(s[i]) for s in shapes]) for i in (0, 1))
    around = seeds.join(shared, "fingerprint", "left_semi").select(
        "id", "r1", "r2", "line", "fingerprint", F.posexplode("marks").alias("shape", "mark")).where("mark IS NOT NULL")
    around = staged(around.select("id", "r1", "r2", "fingerprint", "mark", (F.col("line") - left[F.col("shape")]).alias("at"),
                                  length[F.col("shape")].alias("length")), "line-extensions")
    place = F.struct("id", "r1", "r2", "at")
    origins = around.groupBy("fingerprint", "mark").agg(F.count("*").alias("c"), F.min(place).alias("origin")).where("c > 1").drop("c")
    origins = staged(origins, "line-origins")  # a plain join of two tables: a hot key can be split
    return (around.join(origins, ["fingerprint", "mark"]).where(place != F.col("origin"))
            .select("r1", "r2", F.col("at").alias("start"), "length"))


@F.pandas_udf(T.StringType())
def _edited(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if t is None else delete_lines(t, [(s["start"], s["length"]) for s in found])
                      for t, found in zip(texts, spans)], dtype=object)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
               words: int | None = WORDS) -> DataFrame:
    """Every row of ``docs`` with ``kept_text`` (string) and ``n_removed`` (deleted lines).

    Columns of ``docs`` with these names are replaced. Null text is the empty text. Blank lines are
    never deleted and don't interrupt a run. Rows equal in id and text are one document read
    twice: they get the same result and are no copies of each other. A document with fewer
    than ``run`` lines and ``words`` words loses nothing; with ``words=None`` runs qualify by their lines only.
    An empty table gives an empty one; texts are taken whole, of any length.
    """
    if run < 1 or (words is not None and words < 1):
        raise ValueError("run and words must be at least 1")
    own = Numbered(docs)
    base, id_col, text_col = own.frame, own(id_col), own(text_col)
    text = text_of(base, text_col)
    spans = repeated_runs(base, id_col, text_col, run, words).groupBy("r1", "r2").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("__spans"))
    r1, r2 = row_key(base, id_col, text)
    base = base.withColumns({"__r1": r1, "__r2": r2})
    joined = base.join(spans, (F.col("__r1") == spans.r1) & (F.col("__r2") == spans.r2), "left")
    whole = text_of(joined, text_col)
    # only texts with matches go through Python, once: a filter on the result would take a second worker beside the first
    nothing = F.array().cast("array<struct<start:int,length:int>>")
    edited = once(_edited(F.when(F.col("__spans").isNotNull(), whole), F.coalesce("__spans", nothing)))

    def grown(a: Column, s: Column) -> Column:
        end = F.greatest(a.end, s.start + s.length)
        return F.struct((a.n + end - F.greatest(a.end, F.least(s.start, end))).alias("n"), end.alias("end"))

    # lines in the union of the sorted runs
    covered = F.aggregate(F.col("__spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), grown)
    return own.restore(joined.withColumns({
        "kept_text": F.coalesce(edited, whole),
        "n_removed": F.coalesce(covered.n, F.lit(0)).cast("long"),
    }), "kept_text", "n_removed")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
                 words: int | None = WORDS, length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with their deduplicated texts, without the documents of which no line is left.

    ``length_col``, if there, is set to the new text's length where lines were deleted. A null or blank text loses nothing
    and stays; repeated rows get one result; an empty table gives an empty one."""
    own = Numbered(docs)
    found = line_dedup(own.frame, own(id_col), own(text_col), run, words)
    emptied = (F.col("n_removed") > 0) & ~F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")
    out = []
    for i, field in enumerate(docs.schema.fields):
        c = F.col(f"__c{i}").alias(field.name)
        if field.name == text_col:
            c = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col(f"__c{i}")).alias(text_col)
        elif field.name == length_col:
            c = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(field.dataType)).otherwise(F.col(f"__c{i}")).alias(field.name)
        out.append(c)
    return found.where(~emptied).select(*out)
