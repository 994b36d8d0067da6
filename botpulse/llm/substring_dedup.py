"""Substring dedup with one compressed FM-index per shard.

Every window of ``window`` words whose word sequence also starts elsewhere is removed
from all its places; windows are judged on the input.

1. *Cut.* Each document's windows are cut into segments: runs of consecutive windows
   that share their anchor (the minimal ``gram``-word shingle of a window, leftmost on
   ties). Equal windows have equal anchors, so only segments with the same anchor can
   hold the same window. A row is (document, place, anchor, digest of the segment).
2. *Count.* Anchors are counted with map-side combining. An anchor that occurs once has no
   repeated window. The segments of the others are counted by their digest: a kind of segment is kept once, with
   its number of copies.
3. *Search.* The kinds go to shards by anchor. A shard is indexed (``fm_index``): a bit vector marks the places in copied
   kinds, which count twice. Every kind is streamed against the index; backward search computes matching
   statistics, and the intervals that reach the window's length are its runs of repeated windows. The
   number of shards follows the measured number of words, so a shard has a bounded size.
4. An anchor with more than ``hot`` kinds (a phrase in ever new surroundings) would
   overfill one shard. Its windows are spread by their own digests and counted instead:
   the exact way for hot anchors.
5. The runs of a kind are joined to all its segments. Anchors, digests and windows that hold many rows
   are known from the counts; their rows are joined apart, by broadcast of the few build rows or over salts.

No step holds a group of copies in one task: copies meet only in sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botpulse.functions.joins import SHARES, split_join
from botpulse.llm.common import staged, text_of
from botpulse.llm.fm_index import FMIndex

GRAM = 8
HOT = 1_000  # kinds of segments of an anchor above which windows are counted one by one
SHARD_WORDS = 1_000_000
STREAM = 65_536  # segments streamed against an index at once
CROWDS = 100_000  # hot anchors up to which their table is broadcast

_BASE = 0x9E3779B97F4A7C15
_LOW32 = np.uint64(0xFFFFFFFF)


def word_hashes(text: str) -> np.ndarray:
    import xxhash

    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() splits at ASCII white space
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _rolling(h: np.ndarray, width: int) -> np.ndarray:
    m = len(h) - width + 1
    out = h[:m].copy()
    for o in range(1, width):
        out *= np.uint64(_BASE)
        out += h[o:o + m]
    return _mixed(out)


class _Digests:
    """Digests of any stretches of a hash array, by prefix sums modulo 2^64."""

    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls.powers) < n:
            n = max(n, 2 * len(cls.powers))
            up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 2**64), np.uint64)
            up[0] = down[0] = 1
            cls.powers, cls.inverses = np.cumprod(up), np.cumprod(down)

    def __init__(self, h: np.ndarray):
        self._grow(len(h) + 1)
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(_mixed(h) * self.powers[:len(h)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inverses[start]
        return _mixed(raw + (end - start).astype(np.uint64) * np.uint64(0x94D049BB133111EB))


def cut(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a document: first window, number of windows, anchor, digest."""
    n = len(h) - window + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    grams = _rolling(h, gram)
    least = (grams & ~_LOW32) | np.arange(len(grams), dtype=np.uint64)  # leftmost on ties of the upper half
    span, width = window - gram + 1, 1
    while width * 2 <= span:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:n], least[span - width:][:n])
    at = (least[:n] & _LOW32).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.concatenate([first, [n]]))
    return first, count, grams[at[first]], _Digests(h).of(first, first + count - 1 + window)


def row_key(docs: DataFrame, id_col: str, text: Column) -> list[Column]:
    """A row's identity: 128 bits of its id and text."""
    return [F.xxhash64(docs[f"`{id_col}`"], text).alias("r1"),
            F.xxhash64(F.lit(0x5EED), docs[f"`{id_col}`"], text).alias("r2")]


@F.pandas_udf(T.BinaryType())
def _packed(texts: pd.Series) -> pd.Series:
    """Texts compressed for the shuffle."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    return pd.Series([pack(t.encode("utf-8", "surrogatepass")) for t in texts], dtype=object)


def _unpack(blob: bytes) -> str:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(blob).decode("utf-8", "surrogatepass")


def _cut_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [cut(word_hashes(t.as_py()), window, gram) for t in batch.column("text")]
            sizes = [len(p[0]) for p in parts]
            if not sum(sizes):
                continue
            first, count, anchor, digest = (np.concatenate(x) for x in zip(*parts))
            row = np.repeat(np.arange(len(parts)), sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("r1").take(pa.array(row)), batch.column("r2").take(pa.array(row)),
                 pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)),
                 pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64))],
                names=["r1", "r2", "first", "n", "anchor", "digest"])

    return run


_CONTENT = "anchor long, digest long, copies long, r1 long, r2 long, first int, n int, words binary"
_WINDOWS = "anchor long, mark long, digest long, copies long, at int"
_RUNS = "anchor long, digest long, start int, end int, kind string"  # windows start to end - 1 of a segment


def _contents(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                h = word_hashes(_unpack(row["packed"]))
                for s in row["segments"]:
                    words = h[s["first"]: s["first"] + s["n"] - 1 + window]
                    out.append((s["anchor"], s["digest"], s["copies"], row["r1"], row["r2"], s["first"], s["n"],
                                words.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i not in (5, 6) else pa.array(c, pa.int32())
                                                  for i, c in enumerate(zip(*out))],
                                                 names=[f.split()[0] for f in _CONTENT.split(", ")])

    return run


def _windows(window: int):
    """The windows of hot anchors' segments, one row each, marked by their digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                h = np.frombuffer(row["words"], np.uint64)
                at = np.arange(row["n"])
                mark = _Digests(h).of(at, at + window)
                same = {k: pa.array([row[k]] * len(at), pa.int64()) for k in ("anchor", "digest", "copies")}
                yield pa.RecordBatch.from_arrays(
                    [same["anchor"], pa.array(mark.view(np.int64)), same["digest"], same["copies"],
                     pa.array(at.astype(np.int32))], names=[f.split()[0] for f in _WINDOWS.split(", ")])

    return run


def _search(window: int, depth: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.drop_duplicates(["anchor", "digest"])  # identical input rows give a segment twice
        words = [np.frombuffer(w, np.uint64) for w in shard["words"]]
        index = FMIndex(words, depth, shard["copies"].to_numpy() > 1)
        runs: list[tuple[int, int, int]] = []
        for at in range(0, len(words), STREAM):
            runs += [(at + q, a, b) for q, a, b in index.repeated_windows(words[at:at + STREAM], window)]
        of = np.array([q for q, _, _ in runs], np.int64)
        return pd.DataFrame({
            "anchor": shard["anchor"].to_numpy()[of], "digest": shard["digest"].to_numpy()[of],
            "start": np.array([a for _, a, _ in runs], np.int32), "end": np.array([b for _, _, b in runs], np.int32),
            "kind": "index"})

    return run


def _held(counts: DataFrame, key: str, n: str, total: int) -> list:
    """The keys with more than one in ``SHARES`` of ``total`` rows by a table of counts: fewer than ``SHARES``."""
    return [r[0] for r in counts.where(F.col(n) * SHARES > total).select(key).collect()]


def repeated_segments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                      gram: int = GRAM, hot: int = HOT, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The segments whose anchor occurs again, their kinds ``(anchor, digest, copies, one)``, and the runs
    ``(anchor, digest, start, end, kind)`` of repeated windows in each kind, found by the index or by counting."""
    if not 1 <= gram <= window:
        raise ValueError("the anchor must fit into the window")
    text = text_of(docs, text_col)
    rows = docs.select(*row_key(docs, id_col, text), text.alias("text"))
    segments = staged(rows.mapInArrow(_cut_rows(window, gram),
                                      "r1 long, r2 long, first int, n int, anchor long, digest long"), "segments")
    anchors = staged(segments.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1"), "anchors")
    # Written tables on both sides, here and below: only exchanges below the joins, so that AQE can split them too.
    again = staged(split_join(segments, anchors.select("anchor"), "anchor", hot=_held(anchors, "anchor", "c", segments.count())),
                   "repeated-anchors")
    kinds = staged(again.groupBy("anchor", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct("r1", "r2", "first", "n")).alias("one")), "segment-kinds")
    crowds = staged(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > hot)
                    .select("anchor", F.lit(True).alias("hot")), "crowds")
    wanted = (kinds.groupBy("one.r1", "one.r2")
              .agg(F.collect_list(F.struct("anchor", "digest", "copies", "one.first", "one.n")).alias("segments")))
    words = staged(rows.select("r1", "r2", _packed("text").alias("packed")).join(wanted, ["r1", "r2"])
                   .select("r1", "r2", "packed", "segments").mapInArrow(_contents(window), _CONTENT), "segment-words")
    contents = words.join(F.broadcast(crowds), "anchor", "left") if crowds.count() <= CROWDS else split_join(
        words, crowds, "anchor", "left")
    total = words.agg(F.sum(F.length("words"))).first()[0] or 0
    shards = max(1, -(-total // (8 * shard_words)))
    longest = 2 * window - gram  # a segment's windows share a shingle
    searched = (contents.where("hot is null").select("anchor", "digest", "copies", "words")
                .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
                .groupBy("shard").applyInPandas(_search(window, longest), _RUNS))

    windows = staged(contents.where("hot").drop("hot").dropDuplicates(["anchor", "digest"])
                     .mapInArrow(_windows(window), _WINDOWS), "hot-windows")
    marks = staged(windows.groupBy("mark", "anchor").agg(F.count("*").alias("c"), F.sum("copies").alias("places"))
                   .where("places > 1"), "hot-marks")
    # Windows of a copied segment repeat as it does; those of the others are looked up.
    crowded = split_join(windows.where("copies = 1"), marks.select("mark", F.col("anchor").alias("of")), "mark",
                         hot=_held(marks, "mark", "c", windows.count())).where("anchor = of")
    counted = crowded.select("anchor", "digest", F.col("at").alias("start"), (F.col("at") + 1).alias("end"),
                             F.lit("hot").alias("kind"))
    copied = windows.where("copies > 1").groupBy("anchor", "digest").agg(
        F.lit(0).alias("start"), (F.max("at") + 1).alias("end")).withColumn("kind", F.lit("hot"))
    return again, kinds, staged(searched.unionByName(counted).unionByName(copied), "runs")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   **options) -> DataFrame:
    """Word spans ``(r1, r2, start, end)`` of rows, each a union of repeated windows (they may overlap)."""
    again, kinds, runs = repeated_segments(docs, id_col, text_col, window, **options)
    hot = _held(kinds.groupBy("digest").agg(F.sum("copies").alias("c")), "digest", "c", again.count())
    found = runs.select("digest", F.col("anchor").alias("of"), "start", "end")
    return split_join(again, found, "digest", hot=hot).where("anchor = of").select(
        "r1", "r2", (F.col("first") + F.col("start")).cast("long").alias("start"),
        (F.col("first") + F.col("end") - 1 + window).cast("long").alias("end"))


def remove_spans(text: str, spans) -> tuple[int, int, str]:
    """Words, removed words, and the kept words joined by one space."""
    words = text.encode("utf-8", "surrogatepass").split()
    if spans is None or not len(spans):
        return len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass")
    change = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        change[s["start"]] += 1
        change[s["end"]] -= 1
    out = np.cumsum(change[:-1]) > 0
    kept = [words[i] for i in np.flatnonzero(~out)]
    return len(words), int(out.sum()), b" ".join(kept).decode("utf-8", "surrogatepass")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                    keep_text: bool = True, **options) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256 and, unless ``keep_text`` is
    false, ``kept_text`` (the kept words joined by one space).

    Null text has no words. Documents shorter than a window lose nothing. Repeated rows are separate
    documents: all their windows repeat. Null ids are ids like any other. An empty table gives an
    empty result; texts of any length are taken whole. Only id and text are read, so other
    columns may have any names.
    """
    text = text_of(docs, text_col)
    spans = repeated_spans(docs, id_col, text_col, window, **options)
    lists = spans.groupBy("r1", "r2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = docs.select(docs[f"`{id_col}`"].alias("id"), *row_key(docs, id_col, text), _packed(text).alias("packed"))
    joined = rows.join(lists, ["r1", "r2"], "left").select("id", "packed", "spans")
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [remove_spans(_unpack(p.as_py()), s.as_py())
                     for p, s in zip(batch.column("packed"), batch.column("spans"))]
            columns = [batch.column("id"), pa.array([f[0] for f in found], pa.int64()),
                       pa.array([f[1] for f in found], pa.int64()),
                       pa.array([hashlib.sha256(f[2].encode("utf-8", "surrogatepass")).hexdigest() for f in found],
                                pa.string())]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                columns.append(pa.array([f[2] for f in found], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(apply, schema).withColumnRenamed("id", id_col)
