"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). Raking scales the cells' token
weights until their sums match a target share for every value of each dimension.
A document's sampling probability is its cell's ratio of target to present tokens,
scaled to the token budget and cut at 1; cells cut there carry the rest as a weight above 1, so
that weighted tokens match the targets. The decision of a document depends on its id and the
seed only.

Cells are summed with map-side combining. Up to ``MAX_CELLS`` of them are raked on the driver; more are
raked by the same steps, with the same stop rule and normalisation, as joins and sums of the cell table. If the
targets are not met after ``ROUNDS`` rounds (cells that they need may not exist), an ``UnmetTargets`` warning says by how much.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botpulse.llm.common import Numbered, staged, text_of

DIMENSIONS = ("source", "lang", "topic")
MAX_CELLS = 100_000
ROUNDS, TOLERANCE = 60, 1e-10
MISSING = "(null)"
NO_GOAL = "no value of a dimension has a positive target"
NO_CELL = "the targets exclude each other: no cell is left"


class UnmetTargets(UserWarning):
    """Raking ended with sums that differ from their targets."""


def _report(error: float) -> None:
    if error >= TOLERANCE:
        warnings.warn(f"after {ROUNDS} rounds a share still differs from its target by {error:.3g}", UnmetTargets, stacklevel=4)


def topic_of(text: Column) -> Column:
    """A coarse topic by form, for tables without a topic column."""
    return (F.when(F.contains(text, F.lit("icense")), "legal")
            .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("555-")), "contact")
            .when(F.contains(text, F.lit(" | ")), "tabular")
            .when(F.octet_length(text) >= 8000, "long")
            .otherwise("prose"))


def estimated_tokens(text: Column) -> Column:
    """A quarter of the bytes, at least one."""
    return F.greatest(F.lit(1), F.ceil(F.octet_length(text) / 4)).cast("long")


def target_shares(totals: dict[str, float], given: dict[str, float] | None, temperature: float) -> dict[str, float]:
    """Shares of a dimension's values: as given (values not named get none), else present shares
    raised to ``temperature``; scaled to 1 over the values present."""
    raw = {v: float((given or {}).get(v, 0.0)) if given is not None else t ** temperature for v, t in totals.items()}
    total = sum(raw.values())
    if total <= 0:
        raise ValueError(NO_GOAL)
    return {v: x / total for v, x in raw.items()}


def rake(tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Cell weights (sum 1) whose sums along each dimension approach the targets, and the largest
    difference between a sum and its target in the last round."""
    w = tokens / tokens.sum()
    worst = 0.0
    for _ in range(ROUNDS):
        worst = 0.0
        for code, target in zip(codes, targets):
            now = np.bincount(code, w, len(target))
            worst = max(worst, float(np.abs(now - target).max()))
            w = w * np.divide(target, now, out=np.zeros_like(target), where=now > 0)[code]
        if worst < TOLERANCE:
            break
    if not w.sum() > 0:
        raise ValueError(NO_CELL)
    return w / w.sum(), worst


def scale_to_budget(tokens: np.ndarray, ratio: np.ndarray, budget: float) -> float:
    """The factor with which ``sum(tokens * min(1, factor * ratio))`` is the budget."""
    order = np.argsort(-ratio, kind="stable")
    t, r = tokens[order].astype(float), ratio[order]
    cut = np.concatenate([[0.0], np.cumsum(t)])  # tokens of the cells cut at 1
    rest = np.concatenate([np.cumsum((t * r)[::-1])[::-1], [0.0]])
    for k in range(len(t)):
        if rest[k] > 0:
            factor = (budget - cut[k]) / rest[k]
            if factor * r[k] <= 1:
                return max(factor, 0.0)
    return float("inf")


def _raked_on_driver(cells: DataFrame, names: list[str], targets: dict, temperature: float, fraction: float) -> DataFrame:
    rows = cells.collect()  # at most MAX_CELLS
    spark = cells.sparkSession
    schema = cells.select(*names).schema.add("probability", "double").add("weight", "double")
    if not rows:
        return spark.createDataFrame([], schema)
    rows.sort(key=lambda r: tuple(r[n] for n in names))
    tokens = np.array([r["tokens"] for r in rows], float)
    codes, wanted = [], []
    for n in names:
        values = sorted({r[n] for r in rows})
        number = {v: i for i, v in enumerate(values)}
        code = np.array([number[r[n]] for r in rows])
        totals = dict(zip(values, np.bincount(code, tokens).tolist()))
        shares = target_shares(totals, targets.get(n), temperature)
        codes.append(code)
        wanted.append(np.array([shares[v] for v in values]))
    w, error = rake(tokens, codes, wanted)
    _report(error)
    ratio = w / tokens
    factor = scale_to_budget(tokens, ratio, fraction * tokens.sum())
    if np.isinf(factor):
        factor = 1.0 / ratio[ratio > 0].min()
    p = np.minimum(1.0, factor * ratio)
    weight = np.divide(factor * ratio, p, out=np.zeros_like(p), where=p > 0)
    return spark.createDataFrame([(*(r[n] for n in names), float(a), float(b)) for r, a, b in zip(rows, p, weight)], schema)


def _raked_by_joins(cells: DataFrame, names: list[str], targets: dict, temperature: float, fraction: float) -> DataFrame:
    """The same raking over a cell table of any size; each round is a written table."""
    def totals_of(df: DataFrame, n: str, value: str) -> DataFrame:
        return df.groupBy(n).agg(F.sum(value).alias("sum"))

    wanted = {}
    for n in names:
        if targets.get(n) is not None:
            pairs = [(v, float(x)) for v, x in targets[n].items()]
            goal = totals_of(cells, n, "tokens").join(
                cells.sparkSession.createDataFrame(pairs, f"{n} string, goal double"), n, "left")
            goal = goal.select(n, F.coalesce("goal", F.lit(0.0)).alias("goal"))
        else:
            goal = totals_of(cells, n, "tokens").select(n, F.pow(F.col("sum").cast("double"), temperature).alias("goal"))
        all_goals = staged(goal, "mix-targets")
        whole = all_goals.agg(F.sum("goal")).first()[0]
        if not whole > 0:
            raise ValueError(NO_GOAL)
        wanted[n] = all_goals.select(n, (F.col("goal") / whole).alias("goal"))
    whole = cells.agg(F.sum("tokens")).first()[0]
    now = staged(cells.withColumn("w", F.col("tokens") / whole), "mix-cells")
    worst = 0.0
    for _ in range(ROUNDS):
        worst = 0.0
        for n in names:
            sums = staged(totals_of(now, n, "w").join(wanted[n], n), "mix-sums")
            worst = max(worst, sums.agg(F.max(F.abs(F.col("sum") - F.col("goal")))).first()[0])
            factor = sums.select(n, F.when(F.col("sum") > 0, F.col("goal") / F.col("sum")).otherwise(0.0).alias("f"))
            now = staged(now.join(factor, n).withColumn("w", F.col("w") * F.col("f")).drop("f"), "mix-cells")
        if worst < TOLERANCE:
            break
    reached = now.agg(F.sum("w")).first()[0]
    if not reached > 0:
        raise ValueError(NO_CELL)
    _report(worst)
    rated = staged(now.withColumn("ratio", F.col("w") / reached / F.col("tokens")), "mix-ratios")
    low, high = 0.0, 1.0 / rated.where("ratio > 0").agg(F.min("ratio")).first()[0]
    for _ in range(60):  # the budget's factor by bisection
        middle = (low + high) / 2
        kept = rated.agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("ratio") * middle))).first()[0]
        low, high = (middle, high) if kept < fraction * whole else (low, middle)
    p = F.least(F.lit(1.0), F.col("ratio") * high)
    return rated.select(*names, p.alias("probability"), F.when(p > 0, F.col("ratio") * high / p).otherwise(0.0).alias("weight"))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temperature: float = 0.5,
        fraction: float = 0.5, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        max_cells: int = MAX_CELLS, tokens_col: str | None = None) -> DataFrame:
    """Every row of ``docs`` with ``topic``, ``n_tokens``, ``probability``, ``weight`` and ``kept``.

    ``targets[dimension]`` maps values to shares; a dimension without an entry is flattened with
    ``temperature``. ``fraction`` of the tokens is kept in expectation. A null source or language is
    the value "(null)"; a column "topic" of ``docs`` is used where there is one, else the topic is the
    text's form. Tokens are those of ``tokens_col`` (as of ``token_counts``; at least one, null: one), else a quarter of the
    text's bytes. Null text has one token; texts are taken whole, of any length. Rows without an id are decided by their text, repeated rows
    alike. Other columns with these names are replaced; an empty table gives an empty one.
    Targets without a positive share, or that no cell can meet, are a ``ValueError``; targets missed
    after the last round an ``UnmetTargets`` warning.
    """
    targets = targets or {}
    unknown = set(targets) - set(DIMENSIONS)
    if unknown:
        raise ValueError(f"no such dimension: {sorted(unknown)}")
    named = Numbered(docs)
    has_topic, source_col, lang_col = "topic" in docs.columns, named("source"), named("lang")
    topic_col = named("topic") if has_topic else None
    counted = named(tokens_col) if tokens_col else None
    docs, id_col, text_col = named.frame, named(id_col), named(text_col)
    text = text_of(docs, text_col)
    tokens = F.greatest(F.lit(1), F.coalesce(docs[counted].cast("long"), F.lit(1))).cast("long") if counted else estimated_tokens(text)
    topic = docs[topic_col].cast("string") if has_topic else topic_of(text)
    own = F.col(f"`{id_col}`")
    base = docs.withColumns({
        "topic": F.coalesce(topic, F.lit(MISSING)), "n_tokens": tokens,
        "__source": F.coalesce(docs[source_col].cast("string"), F.lit(MISSING)),
        "__lang": F.coalesce(docs[lang_col].cast("string"), F.lit(MISSING)),
        "__u": F.shiftrightunsigned(F.xxhash64(F.lit(seed), own, F.when(own.isNull(), text)), 11) * F.lit(2.0 ** -53)})
    cells = staged(base.groupBy(F.col("__source").alias("source"), F.col("__lang").alias("lang"), "topic")
                   .agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    names = list(DIMENSIONS)
    if cells.count() <= max_cells:
        rated = F.broadcast(_raked_on_driver(cells, names, targets, temperature, fraction))
    else:
        rated = _raked_by_joins(cells, names, targets, temperature, fraction)
    rated = rated.select(F.col("source").alias("__s"), F.col("lang").alias("__l"), F.col("topic").alias("__t"),
                         F.col("probability").alias("__p"), F.col("weight").alias("__w"))
    joined = base.join(rated, (F.col("__source") == F.col("__s")) & (F.col("__lang") == F.col("__l"))
                       & (F.col("topic") == F.col("__t")), "left")
    mixed = joined.withColumns({"probability": F.col("__p"), "weight": F.col("__w"), "kept": F.col("__u") < F.col("__p")})
    return named.restore(mixed, "topic", "n_tokens", "probability", "weight", "kept")
