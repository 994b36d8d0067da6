"""Merkle manifest of a table: a tree per group, a tree over the groups' roots, and a proof per row.

*Digest.* ``H`` is the lowercase hex SHA-256 of the inputs' concatenation, digests as hex text. A leaf
is ``H`` of the row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value.

*Order.* Leaves are numbered per group by a range partitioning: every sorted partition counts
its rows per group, and the counts before it are its offset. No window runs over a whole group, so
a group may hold all rows.

*Levels.* Each level equijoins its nodes with themselves, once per slot offset, at the computed index of
the sibling (``index XOR 1`` in a binary tree, ``run * arity + (slot + offset) % arity`` otherwise); the rows
of slot zero then emit the parents. A level is a written table with ``1/arity`` of the rows below it, so all
levels together hold less than twice the leaves and the joins' keys (group, index) are spread evenly.

*Proofs.* From the roots downwards a node's path is its siblings followed by its parent's path: one join on
(group, parent index) a level. A path is text, ``left,right;`` per level, where left and right are
the digests of the run's other nodes on either side (both empty in a run of one).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from botpulse.llm.common import staged

IN_ROW = 100_000  # offsets of so many (partition, group) pairs are broadcast (about 100 bytes each); beyond, joined
SMALL = 2 << 20  # bytes up to which the upper levels of a tree, whose rows are known in number, are broadcast
DIGEST = 66  # bytes of a digest in a path
CHAINED = 5  # levels of paths in one job


def leaf_digest(*fields: Column) -> Column:
    """``H`` of a row's fields, with byte counts so that no two rows can run together."""
    def written(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` (a stored table) with ``i``, the row's number in its group from 0, and ``n``, the group's rows.

    Rows that are equal in all of ``order`` are numbered in any order.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = staged(ranged.select("*", F.spark_partition_id().alias("part"),
                                  F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "placed")
    parts = placed.groupBy("part", group).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged(parts.select("part", group, "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
                                F.sum("rows").over(whole).alias("n")), "offsets")
    if parts.count() <= IN_ROW:
        parts = F.broadcast(parts)
    return placed.join(parts, ["part", group]).select(
        *rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("i"), "n")


def with_siblings(nodes: DataFrame, arity: int, small: bool = False) -> DataFrame:
    """Nodes ``(g, i, n, digest)`` with ``left`` and ``right``, the joined digests of the run's other nodes."""
    slot = F.col("i") % arity
    found, columns = nodes, []
    for offset in range(1, arity):
        sibling = F.col("i").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("i") - slot + (slot + offset) % arity
        other = nodes.select(F.col("g").alias("g_"), F.col("i").alias("i_"), F.col("digest").alias(f"d{offset}"))
        found = found.withColumn("at_", sibling).join(
            F.broadcast(other) if small else other, (F.col("g") == F.col("g_")) & (F.col("at_") == F.col("i_")), "left").drop("g_", "i_", "at_")
        columns.append(F.struct(((slot + offset) % arity).alias("slot"), F.col(f"d{offset}").alias("digest")))
    others = F.array_sort(F.filter(F.array(*columns), lambda s: s.digest.isNotNull()))

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter(others, keep), lambda s: s.digest), "")

    return found.select("g", "i", "n", "digest", joined(lambda s: s.slot < slot).alias("left"),
                        joined(lambda s: s.slot > slot).alias("right"))


def _parents(level: DataFrame, arity: int) -> DataFrame:
    return level.where(F.col("i") % arity == 0).select(
        "g", F.floor(F.col("i") / arity).alias("i"), F.ceil(F.col("n") / arity).alias("n"),
        F.sha2(F.concat("digest", "right"), 256).alias("digest"))


@dataclass(frozen=True)
class Forest:
    """Trees of nodes ``(g, i, n, digest)``: their levels with siblings (leaves first) and ``(g, digest, height)`` of the roots."""

    levels: list[DataFrame]
    roots: DataFrame
    arity: int
    rows: list[int]  # of each level at most

    @classmethod
    def grown(cls, leaves: DataFrame, arity: int) -> Forest:
        if arity < 2:
            raise ValueError("arity must be 2 or more")
        most, total, trees = leaves.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*"), F.count(F.when(F.col("i") == 0, 1))).first()
        levels, rows, nodes = [], [], leaves.select("g", "i", "n", "digest")
        roots = nodes.where("n = 1").select("g", "digest", F.lit(0).alias("height"))
        while most > 1:
            rows.append(total // arity ** len(levels) + trees)
            small = rows[-1] * 200 <= SMALL
            level = with_siblings(nodes.where("n > 1"), arity, small)
            levels.append(staged(level.coalesce(1) if small else level, "merkle-level"))
            nodes, most = _parents(levels[-1], arity), -(-most // arity)
            roots = roots.unionByName(nodes.where("n = 1").select("g", "digest", F.lit(len(levels)).alias("height")))
        return cls(levels, staged(roots, "merkle-roots"), arity, rows)

    def paths(self, above: DataFrame) -> DataFrame:
        """``(g, i, digest, path)`` of every leaf. ``above`` has ``(g, path)``: what follows a tree's own path."""
        tops = self.roots.join(above, "g").select("g", F.lit(0).cast("long").alias("i"), "digest", "path", "height")
        if len(self.levels) > CHAINED:
            tops = staged(tops, "merkle-tops")
        found = tops.where(F.col("height") == len(self.levels)).drop("height")
        for at in reversed(range(len(self.levels))):
            up = found.select(F.col("g").alias("g_"), F.col("i").alias("i_"), F.col("path").alias("rest"))
            above_here = len(self.levels) - at + 20  # digests of a path, with those over the groups
            if at + 1 < len(self.rows) and self.rows[at + 1] * above_here * DIGEST <= SMALL:
                up = F.broadcast(up)
            down = self.levels[at].withColumn("p_", F.floor(F.col("i") / self.arity))
            found = down.join(up, (F.col("g") == F.col("g_")) & (F.col("p_") == F.col("i_"))).select(
                "g", "i", "digest", F.concat("left", F.lit(","), "right", F.lit(";"), "rest").alias("path"))
            found = found.unionByName(tops.where(F.col("height") == at).drop("height"))
            if at and at % CHAINED == 0:
                found = staged(found, "merkle-paths")
        return found


def folded(digest: Column, path: Column) -> Column:
    """The digest that a path leads to from ``digest``."""
    steps = F.filter(F.split(path, ";"), lambda s: s != "")
    return F.aggregate(steps, digest, lambda acc, s: F.sha2(
        F.concat(F.substring_index(s, ",", 1), acc, F.substring_index(s, ",", -1)), 256))


def proof_digest(path: Column) -> Column:
    """``H`` of the path's siblings in order."""
    return F.sha2(F.translate(path, ",;|", ""), 256)


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
                    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    claimed: dict[str, Column] | None = None, arity: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``group_col``, ``leaf``, ``subroot``, ``root``, ``proof`` (the path,
    with a ``|`` between the group's part and the part over groups), ``proof_sha256``, ``folded_root`` and ``verified``.

    Leaves ascend by id within their group, groups by name in UTF-8 byte order; a null group is a group of its
    own, the first. ``claimed`` replaces fields of the rows as they are now (say a copy to be checked against
    the manifest): ``folded_root`` is the root that a row's claimed content leads to with the siblings of
    the manifest, ``verified`` whether that is the root. Null ids come first. Rows equal in id
    are ordered by leaf digest, and equal rows give equal leaves with different proofs. Null fields are
    written ``-``, empty texts ``0:``; texts are hashed whole. An empty table gives an empty one. Only the
    named columns are read, so other columns can't clash.
    """
    def column(name: str) -> Column:
        return F.col(f"`{name}`")

    now = {f: column(f) for f in fields} | (claimed or {})
    group = F.coalesce(F.concat(F.lit("1"), column(group_col).cast("string")), F.lit("0"))  # null before all names
    leaves = staged(docs.select(
        column(id_col).alias("id"), column(group_col).alias("name"), group.alias("g"),
        leaf_digest(*[column(f) for f in fields]).alias("digest"), leaf_digest(*now.values()).alias("claim")), "leaves")
    leaves = numbered(leaves, "g", ["id", "digest"])
    forest = Forest.grown(leaves, arity)
    groups = numbered(forest.roots.select("g", "digest", F.lit("").alias("all")), "all", ["g"]).select(
        F.col("g").alias("name"), F.col("all").alias("g"), "i", "n", "digest")
    top = Forest.grown(groups, arity)
    root = top.roots.select("digest").first()
    over = top.paths(top.roots.select("g", F.lit("").alias("path"))).select(F.col("i").alias("i_"), "path")
    above = groups.join(over, F.col("i") == F.col("i_")).select(F.col("name").alias("g"), F.concat(F.lit("|"), "path").alias("path"))
    paths = forest.paths(staged(above, "group-paths")).select(
        F.col("g").alias("g_"), F.col("i").alias("i_"), F.col("path").alias("proof"))
    rows = leaves.join(paths, (F.col("g") == F.col("g_")) & (F.col("i") == F.col("i_")))
    own, rest = F.substring_index("proof", "|", 1), F.substring_index("proof", "|", -1)
    rows = rows.withColumn("subroot", folded(F.col("digest"), own))
    same = folded(F.col("subroot"), rest)
    changed = folded(folded(F.col("claim"), own), rest)
    return rows.select(
        F.col("id").alias(id_col), F.col("name").alias(group_col), F.col("digest").alias("leaf"), "subroot",
        F.lit(root[0] if root else None).cast("string").alias("root"), "proof", proof_digest(F.col("proof")).alias("proof_sha256"),
        F.when(F.col("claim") == F.col("digest"), same).otherwise(changed).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
