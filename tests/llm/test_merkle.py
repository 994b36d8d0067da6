"""The Merkle manifest against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from botpulse.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes: list[str], arity: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root and every leaf's siblings on the left and right, level by level."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            run = nodes[i - i % arity:i - i % arity + arity]
            path.append(("".join(run[:i % arity]), "".join(run[i % arity + 1:])))
        nodes = [digest("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]
        at = [i // arity for i in at]
    return nodes[0], paths


def folded(node: str, path) -> str:
    for left, right in path:
        node = digest(left + node + right)
    return node


def expected(rows, arity: int, claim) -> Counter:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = own, *tree([leaf(r) for r in own], arity)
    root, above = tree([trees[g][1] for g in names], arity)
    found = Counter()
    for g, over in zip(names, above):
        own, subroot, paths = trees[g]
        for row, path in zip(own, paths):
            whole = path + over
            folds_to = folded(leaf(claim(row)), whole)
            found[row[0], leaf(row), subroot, root, digest("".join(a + b for a, b in whole)), folds_to, folds_to == root] += 1
    return found


def got(df) -> Counter:
    return Counter(tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_against_plain_python(spark, arity):
    rnd = random.Random(arity)
    rows = [(rnd.choice([None, *range(60)]), rnd.choice([None, "a", "b"]), rnd.choice([None, "en", "de", "", "é", "z"]),
             rnd.choice([None, 1, 22]), rnd.choice([None, "", "x", "Straße 😀", "y" * 50_000])) for _ in range(157)]
    rows += [rows[0]] * 9 + [(1, "s", "one", 3, "alone")]

    def claim(row):
        return (*row[:3], row[3] + 1, row[4]) if row[0] is not None and row[0] % 5 == 0 and row[3] is not None else row

    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    claimed = {"n_chars": F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    out = merkle.merkle_manifest(df, claimed=claimed, arity=arity)
    want = expected(rows, arity, claim)
    assert got(out) == want
    assert any(not key[-1] for key in want) and any(key[-1] for key in want)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 33])
def test_small_tables(spark, n):
    rows = [(i, None, "en", None, f"t{i}") for i in range(n)]
    out = merkle.merkle_manifest(spark.createDataFrame(rows, SCHEMA))
    assert got(out) == (expected(rows, 2, lambda r: r) if n else Counter())


def test_columns_may_be_called_like_the_operators_own(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(5)]
    plain = spark.createDataFrame(rows, SCHEMA)
    clashing = plain.withColumns({c: F.lit(7) for c in ("g", "i", "n", "digest", "left", "path", "leaf", "root", "id", "name", "claim")})
    assert got(merkle.merkle_manifest(clashing)) == got(merkle.merkle_manifest(plain))


def test_arity_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        merkle.merkle_manifest(spark.createDataFrame([(1, "s", "en", 1, "t")], SCHEMA), arity=1)
