"""Ranked lexical search: exact top documents per query text, with geometric blocks and summary bounds.

*Forward index.* One pass over the documents counts their terms; kept are the counts of the terms that the
queries hold (a written table), and every document's length. ``N``, ``L`` and the document frequencies are
counted over all documents.

*Blocks.* Each task reads its part of the forward index in shards of bounded size. In a shard each term has
a posting list, and a list that a query needs is cut into blocks of similar documents: every
``BLOCK``-th posting is a centre, each posting joins the centre with the largest inner product (of
projected score vectors). A block's summary is the coordinatewise maximum of its documents' impacts, so
the summary's score is an exact upper bound of each of its documents' scores.

*Search.* A query visits its lists from the heaviest term on. Its threshold is the score that the k-th best
document is known to reach: at first by the k-th largest impact of single terms, counted
over all documents, then by the best that the task has found. A list is visited only while the
remaining terms can reach the threshold; in it, a block is skipped only if its summary, over the terms that
are left, stays below the threshold. All others are scored exactly. Documents of earlier lists are settled. Equal
scores are never cut, so ties by id are exact. Each task gives its best k, and the best k of these are the result.

Queries are taken in blocks of ``QUERIES`` distinct texts against all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from botpulse.llm.common import staged, text_of

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # on UTF-8 bytes: no byte of a longer character is below 0x80
QUERIES = 1000  # distinct query texts searched in one pass over the documents
BLOCK = 32  # postings for each centre of a list
CELLS = 1 << 24  # documents x query terms of a shard
SHARD = 4096  # documents of a shard at most
STEP = 1 << 15  # impacts are counted in steps of this width for the first thresholds
_DIM = 32  # width of the projection that centres are compared in


def term_counts(text: bytes) -> Counter:
    """The terms of a UTF-8 text, only A-Z lower-cased, with their counts."""
    return Counter(TERM.findall(text.lower()))  # bytes.lower() knows ASCII only


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(term_counts(t)) for t in _bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.list_(pa.binary()))], names=["key", "terms"])


def _forward(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in _bytes(batch.column("text")):
                found = term_counts(text)
                hits = sorted((vocabulary[t], found[t]) for t in found.keys() & known)
                sizes.append(sum(found.values()))
                terms.append([t for t, _ in hits])
                counts.append([c for _, c in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], names=["id", "n", "terms", "counts"])

    return run


class Shard:
    """The impacts of some documents (rows of ``impacts``) over the query terms, with blocked posting lists."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_rows: int, weights: np.ndarray, block: int):
        self.weights, self.block = weights, block
        self.impacts = np.zeros((n_rows, len(weights)), np.int32)
        self.impacts[rows, terms] = impacts
        order = np.argsort(terms, kind="stable")
        self._rows, bounds = rows[order], np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self._from, self._to = bounds[:-1], bounds[1:]
        self.most = self.impacts.max(axis=0) if n_rows else np.zeros(len(weights), np.int32)
        self._blocked: dict[int, tuple] = {}
        self._place: np.ndarray | None = None

    def postings(self, term: int) -> np.ndarray:
        return self._rows[self._from[term]:self._to[term]]

    def _places(self) -> np.ndarray:
        """Each document's score vector, projected."""
        if self._place is None:
            signs = np.random.default_rng(0).choice(np.array([-1, 1], np.float32), (len(self.weights), _DIM))
            place = self.impacts.astype(np.float32) @ (signs * self.weights[:, None].astype(np.float32))
            self._place = place / np.maximum(np.linalg.norm(place, axis=1, keepdims=True), 1e-9)
        return self._place

    def blocks(self, term: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(documents in block order, block starts, summaries)``; summaries are over the terms ``columns``."""
        if term not in self._blocked:
            rows = self.postings(term)
            if len(rows) > self.block:
                place = self._places()[rows]
                nearest = np.argmax(place @ place[::self.block].T, axis=1)
                order = np.argsort(nearest, kind="stable")
                rows, nearest = rows[order], nearest[order]
                starts = np.flatnonzero(np.concatenate([[True], nearest[1:] != nearest[:-1]]))
            else:
                starts = np.zeros(1, np.int64)
            self._blocked[term] = (rows, starts, np.maximum.reduceat(self.impacts[np.ix_(rows, columns)], starts, axis=0))
        return self._blocked[term]


class Query:
    """A query's terms, heaviest first, the threshold it starts from, and the best documents so far."""

    def __init__(self, terms: np.ndarray, floor: int, k: int):
        self.terms, self.floor, self.k = terms, floor, k
        self.best: list[tuple] = []  # (-score, no id, id), best first

    def take(self, scores: np.ndarray, ids: list) -> None:
        new = [(-int(s), i is None, i) for s, i in zip(scores, ids)]
        self.best = sorted(self.best + new)[:self.k]
        if len(self.best) == self.k:
            self.floor = max(self.floor, -self.best[-1][0])

    def search(self, shard: Shard, ids: list, columns_of: dict[int, np.ndarray]) -> int:
        """Take up the shard's documents that belong to the best; returns how many blocks were skipped."""
        terms = self.terms[shard.most[self.terms] > 0]
        weights = shard.weights[terms]
        reach = np.cumsum((weights * shard.most[terms].astype(np.int64))[::-1])[::-1]
        settled, skipped = np.zeros(len(ids), bool), 0
        for at, term in enumerate(terms):
            if reach[at] < self.floor:
                break
            columns = columns_of[int(term)]
            rows, starts, summaries = shard.blocks(int(term), columns)
            bound = summaries[:, np.searchsorted(columns, terms[at:])].astype(np.int64) @ weights[at:]
            fits = bound >= self.floor
            skipped += int(len(fits) - fits.sum())
            sizes = np.diff(np.append(starts, len(rows)))
            left = rows[np.repeat(fits, sizes)]
            left = left[~settled[left]]
            if len(left):
                scores = shard.impacts[np.ix_(left, terms[at:])].astype(np.int64) @ weights[at:]
                keep = scores >= self.floor
                self.take(scores[keep], [ids[r] for r in left[keep]])
            settled[rows] = True
        return skipped


def _search(queries: list[tuple[int, np.ndarray, int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int, id_type: pa.DataType,
            block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = {key: Query(terms, floor, k) for key, terms, floor in queries}
        together: dict[int, set] = {}
        for _, terms, _ in queries:
            for t in terms.tolist():
                together.setdefault(t, set()).update(terms.tolist())
        columns_of = {t: np.array(sorted(s)) for t, s in together.items()}
        size = max(1, min(SHARD, CELLS // max(1, len(weights))))
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                listed = part.column("terms")
                rows = np.repeat(np.arange(part.num_rows), np.diff(listed.offsets.to_numpy()))
                terms = listed.flatten().to_numpy()
                counts = part.column("counts").flatten().to_numpy()
                n = part.column("n").to_numpy()
                m = 50 + (50 * n * n_docs) // n_terms
                impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * m[rows])
                shard = Shard(rows, terms, impacts, part.num_rows, weights, block)
                ids = part.column("id").to_pylist()
                for query in running.values():
                    query.search(shard, ids, columns_of)
        keys, ids, scores = [], [], []
        for key, query in running.items():
            for score, _, i in query.best:
                keys.append(key)
                ids.append(i)
                scores.append(-score)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, id_type), pa.array(scores, pa.int64())],
                                         names=["key", "id", "score"])

    return run


def first_thresholds(forward: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Per query term: ``df`` and ``floor``, an impact that at least ``k`` documents reach (0 if fewer hold the term)."""
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {n_terms}L")
    impact = F.expr("(1000000000 * hit.counts) div (1000 * hit.counts + 20 * m)")
    steps = (forward.select(m.alias("m"), F.explode(F.arrays_zip("terms", "counts")).alias("hit"))
             .groupBy(F.col("hit.terms").alias("term"), F.floor(impact / STEP).alias("step")).agg(F.count("*").alias("n")))
    down = Window.partitionBy("term").orderBy(F.desc("step"))  # a term has at most 1,000,000 / STEP steps
    return steps.withColumn("so_far", F.sum("n").over(down)).groupBy("term").agg(
        F.sum("n").alias("df"), F.coalesce(F.max(F.when(F.col("so_far") >= k, F.col("step"))), F.lit(0)).alias("floor"))


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK,
                   queries: int = QUERIES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each row of ``items``, scores above 0 only.

    A term is a maximal run of letters, digits and characters beyond ASCII; only A-Z are lower-cased. A query's
    terms count once each. Equal scores rank by ascending id, null ids last; documents equal in id and score
    take a rank each. Rows of ``items`` that repeat a text get the same ranking each. Null and empty texts have no terms:
    as documents they are never found, as items they find nothing. Long texts are counted whole. An empty
    table gives an empty one. The output has these four names whatever the input's are.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(docs[f"`{id_col}`"].alias("id"), text_of(docs, text_col).alias("text"))
    asked = items.select(items[f"`{item_col}`"].alias("item_id"), F.xxhash64(text_of(items, item_text_col)).alias("key"),
                         text_of(items, item_text_col).alias("text"))
    wanted = staged(asked.select("key", "text").dropDuplicates(["key"]).mapInArrow(
        _query_terms, "key long, terms array<binary>").where(F.size("terms") > 0), "queries")
    passes = -(-wanted.count() // queries)
    found = spark.createDataFrame([], f"key long, id {id_type}, score long")
    for at in range(passes):
        part = wanted.where(F.pmod("key", F.lit(passes)) == at).collect()  # about ``queries`` rows
        names = sorted({t for row in part for t in row.terms})
        vocabulary = {bytes(t): i for i, t in enumerate(names)}
        forward = staged(source.mapInArrow(_forward(vocabulary), f"id {id_type}, n long, terms array<int>, counts array<long>")
                         .where("n > 0"), "forward-index")
        n_docs, n_terms = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights, floors = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        for row in first_thresholds(forward, n_docs, n_terms, k).collect():  # a row per query term
            weights[row.term] = weight(n_docs, row.df)
            floors[row.term] = row.floor * STEP
        plan = []
        for row in part:
            own = np.array([vocabulary[bytes(t)] for t in row.terms])
            own = own[np.argsort(-weights[own], kind="stable")]
            own = own[weights[own] > 0]
            if len(own):
                plan.append((row.key, own, max(1, int((weights[own] * floors[own]).max()))))
        if plan:
            arrow_type = pa.int64() if id_type in ("bigint", "int", "smallint", "tinyint") else pa.string()
            best = forward.where(F.size("terms") > 0).select(
                F.col("id") if arrow_type == pa.int64() else F.col("id").cast("string").alias("id"), "n", "terms", "counts").mapInArrow(
                _search(plan, weights, n_docs, n_terms, k, arrow_type, block),
                f"key long, id {'long' if arrow_type == pa.int64() else 'string'}, score long")
            found = found.unionByName(best.withColumn("id", F.col("id").cast(id_type)))
    ranked = Window.partitionBy("key").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return asked.select("item_id", "key").join(found, "key").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
