"""Token counts by a two-tier pre-token lookup (no pre-token shuffle).

The tokenizer is a SentencePiece BPE model with identity normalisation, a dummy
prefix and byte fallback. None of its pieces holds a line break, and a piece holds
the space mark only as a leading run, so no merge ever crosses the border before a
run of spaces or around a line break: the token count of a text is the sum of
the counts of its pre-tokens (a run of spaces plus the word behind it; a line break).

* Tier 1 is a broadcast table *pre-token → length* of at most ``table_size`` entries
  (a fixed bound, whatever the corpus). Its entries are the heavy hitters of the
  whole corpus: every task keeps a bounded lossy counter over all its rows and
  hands on at most ``per_task`` entries, which are summed. Pre-tokens themselves are
  never shuffled.
* Tier 2 is a bounded cache in each Python worker; only what misses both is encoded.

Which entries are in which tier changes the speed only, never a count.
"""

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botpulse.llm.common import Numbered, text_of

TABLE_SIZE = 32_768  # entries of the broadcast table
PER_TASK = 4_096  # heavy hitters a task hands on
COUNTER_SIZE = 200_000  # entries of a task's lossy counter before it is pruned
CACHE_SIZE = 200_000  # entries of a worker's cache before it is emptied
LONGEST_KEPT = 40  # longer pre-tokens are encoded each time: neither table nor cache holds them

_SPACED = re.compile(" *[^ ]+| +")


def _processor(model_file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def pre_tokens(text: str) -> Iterator[list[str]]:
    """The pre-tokens of each line of ``text`` as lookup keys; line breaks are left out.

    ``w`` stands for one space mark and ``w`` (so ``""`` is a lone mark), and
    ``"\\n" + w`` for a word at the start of a later line, which has no mark.
    """
    if "\u2581" in text:  # the model's space mark, written out, is a space to it
        text = text.replace("\u2581", " ")
    for number, line in enumerate(text.split("\n")):
        if number and not line:
            continue
        if "  " in line or line[:1] == " " or line[-1:] == " " or not line:
            parts = _SPACED.findall(line if number else " " + line)
            yield [p[1:] if p[0] == " " else "\n" + p for p in parts]
        else:
            words = line.split(" ")
            if number:
                words[0] = "\n" + words[0]
            yield words


class _Lengths(dict):
    """Tier 1 with tier 2 behind it."""

    def __init__(self, table: dict[str, int], model_file: str):
        super().__init__(table)
        self.encode = _processor(model_file).encode
        self.line_break = len(self.encode("\n")) - 1
        self[""] = 1
        self.cache: dict[str, int] = {}

    def __missing__(self, key: str) -> int:
        n = self.cache.get(key)
        if n is None:
            n = len(self.encode(key, num_threads=1))
            if key[:1] == "\n":  # the dummy prefix and the line break are not the word's
                n -= 1 + self.line_break
            if len(key) <= LONGEST_KEPT:
                if len(self.cache) >= CACHE_SIZE:
                    self.cache.clear()
                self.cache[key] = n
        return n

    def of(self, text: str) -> int:
        if not text:
            return 0
        get = self.__getitem__
        return text.count("\n") * self.line_break + sum(sum(map(get, words)) for words in pre_tokens(text))


def frequent_lengths(texts: DataFrame, model_file: str, table_size: int = TABLE_SIZE) -> dict[str, int]:
    """The corpus's heavy-hitter pre-tokens with their lengths: at most ``table_size`` entries."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                if s := text.as_py():
                    counts.update(chain.from_iterable(pre_tokens(s)))
                    if len(counts) > COUNTER_SIZE:  # lossy counting: the rare half goes
                        counts = Counter(dict(counts.most_common(COUNTER_SIZE // 2)))
        top = heapq.nlargest(PER_TASK, (kv for kv in counts.items() if len(kv[0]) <= LONGEST_KEPT),
                             key=lambda kv: (kv[1], kv[0]))
        lengths = _Lengths({}, model_file)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64()),
             pa.array([lengths[k] for k, _ in top], pa.int32())], names=["key", "n", "length"])

    rows = (texts.mapInArrow(summarise, "key string, n long, length int")
            .groupBy("key").agg(F.sum("n").alias("n"), F.first("length").alias("length"))
            .orderBy(F.desc("n"), "key").limit(table_size).collect())
    return {r.key: r.length for r in rows}


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, text_col: str = "text",
                 table_size: int = TABLE_SIZE) -> DataFrame:
    """Every row of ``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` added.

    Columns of ``docs`` with these names are replaced. Null text counts as the empty
    text (0 bytes, 0 tokens); an empty table gives an empty table; repeated rows
    each keep their own row; texts of any length are counted whole, a word too
    long for the tables is encoded on its own.
    """
    spark = docs.sparkSession
    texts = docs.select(text_of(docs, text_col).alias("text"))
    table = spark.sparkContext.broadcast(frequent_lengths(texts, model_file, table_size))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = _Lengths(table.value, model_file)
        for texts in batches:
            yield pd.Series([lengths.of(t) for t in texts], dtype="int64")

    own = Numbered(docs)
    text = text_of(own.frame, own(text_col))
    counted = own.frame.withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_tokens": count(text)})
    return own.restore(counted.withColumn("over_limit", F.col("n_tokens") > limit), "n_bytes", "n_tokens", "over_limit")
