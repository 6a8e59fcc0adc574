"""Merkle manifest of a dataset: a digest for each row, one root, and a proof that a row is under it.

Rows of a group (a language) are leaves in order of their id.  Every run of eight consecutive nodes becomes a parent,
until one node is left; the groups' last nodes, in order of the group, become the root in the same way.

A leaf's rank, written in base eight, says where it is in every run above it.  Ranks that agree in all but their last
three digits are a block.  Within a block the digits are grouped away from the last to the first, each time nesting
the structs of the nodes below; blocks are then the leaves of the next three digits.  So a row of nested structs has at
most 512 leaves, however large the group.  Proofs come from the top down: a block's path is put beside its nested structs
by a union and a grouping, and a transform and an explode give the paths of what is in it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailgauge.llm.common import lower_ascii
from mailgauge.llm.ranks import ranked
from mailgauge.sources.scratch import land

# A run has eight nodes, which is three bits of a rank.
BITS = 3
FANOUT = 1 << BITS
# Digits that are grouped away within a block of FANOUT ** DIGITS nodes.
DIGITS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

# What a row carries through the tree beside its digest.
_Carried = Mapping[str, Column]


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text, 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row's values one after the other, each as its byte count, ``:`` and itself, or ``-`` for null."""

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return digest(F.concat(*map(written, values)))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, p: digest(F.concat(p["left"], node, p["right"])))


def _depth(size: Column) -> Column:
    """Levels above the leaves of a group of that size: the least d with FANOUT ** d >= size."""
    return sum(((size > F.lit(FANOUT**d)).cast("int") for d in range(62 // BITS + 1)), F.lit(0))


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda node: node["digest"]), "")


def _nested(nodes: DataFrame) -> DataFrame:
    """grp, block, depth, nodes, digest: one row for each block of ``nodes`` (grp, rank, depth, digest, own)."""
    digits = [f"_d{i}" for i in range(DIGITS)]
    rows = nodes.select(
        "grp",
        F.shiftright("rank", BITS * DIGITS).alias("block"),
        "depth",
        *[F.shiftright("rank", BITS * i).bitwiseAND(FANOUT - 1).cast("int").alias(d) for i, d in enumerate(digits)],
        "digest",
        F.col("own").alias("below"),
    ).repartition("grp", "block")
    # All groupings below are of the same shuffle.
    for level, digit in enumerate(digits):
        kept = ["grp", "block", "depth", *reversed(digits[level + 1 :])]
        run = F.sort_array(F.collect_list(F.struct(digit, "digest", "below")))
        rows = rows.groupBy(*kept).agg(run.alias("below"))
        # A group of few leaves has its last node below this level already, which is then handed up as it is.
        above = F.when(F.col("depth") > level, digest(_joined(F.col("below"))))
        rows = rows.withColumn("digest", F.coalesce(above, F.col("below")[0]["digest"]))
    return rows.withColumnRenamed("below", "nodes")


def _paths(blocks: DataFrame) -> DataFrame:
    """own, digest and path of all nodes nested in ``blocks``, beside the blocks' other columns.

    ``blocks`` are as ``_nested`` returns them, with ``path``, that of the block itself.
    """

    def within(nodes: Column, path: Column, level: int) -> Column:
        def one(node: Column, at: Column) -> Column:
            left = _joined(F.slice(nodes, 1, at))
            right = _joined(F.slice(nodes, at + 2, FANOUT))
            step = F.when(F.col("depth") > level, F.array(F.struct(left.alias("left"), right.alias("right"))))
            longer = F.concat(F.coalesce(step, F.array().cast(_PATH)), path)
            if level:
                return within(node["below"], longer, level - 1)
            return F.array(F.struct(node["below"].alias("own"), node["digest"].alias("digest"), longer.alias("path")))

        return F.flatten(F.transform(nodes, one))

    others = [c for c in blocks.columns if c not in ("nodes", "path", "digest", "grp", "block", "depth")]
    found = F.explode(within(F.col("nodes"), F.col("path"), DIGITS - 1)).alias("_node")
    return blocks.select("grp", *others, found).select("grp", *others, "_node.*")


_PATH = "array<struct<left:string,right:string>>"


def _towers(leaves: DataFrame) -> list[DataFrame]:
    """Blocks of ``leaves``, blocks of those blocks, and so on until each group is one block; stored."""
    towers, height = [], leaves.agg(F.max("depth")).head()[0] or 0
    while True:
        towers.append(land(_nested(leaves)))
        height -= DIGITS
        if height <= 0:
            return towers
        leaves = towers[-1].select(
            "grp",
            F.col("block").alias("rank"),
            F.greatest(F.col("depth") - DIGITS, F.lit(0)).alias("depth"),
            "digest",
            F.col("block").alias("own"),
        )


def _beside(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """Blocks and what is known of each (grp, block, and more columns), both one row: no join is needed."""
    more = [c for c in known.columns if c not in ("grp", "block")]
    both = blocks.unionByName(known, allowMissingColumns=True)
    held = [c for c in both.columns if c not in ("grp", "block")]
    met = both.groupBy("grp", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in held])
    return met.select(*blocks.columns, *more)


def _descend(towers: list[DataFrame], known: DataFrame) -> DataFrame:
    """``_paths`` of the leaves, from the lowest blocks up; ``known`` has grp and what its single top block gets."""
    known = known.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(towers):
        found = _paths(_beside(blocks, known))
        known = found.drop("digest").withColumnRenamed("own", "block")
    return found


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    group: str = "lang",
    order: str = "doc_id",
    carry: _Carried | None = None,
) -> DataFrame:
    """doc_id, group, leaf, subroot, root, path for every row, and the ``carry`` columns.

    ``columns`` make up a leaf, in that order.  Leaves of a group ascend by ``order`` (an integer, null first) and,
    where that is equal, by their digest; groups ascend bytewise, null first.  ``path`` has the siblings of each level
    from the leaf up, as text of their digests to the left and to the right; a run of one node is a step
    with neither.  ``folded(leaf, path)`` equals ``root``.

    A null has a leaf of its own kind, other than an empty text; a text is hashed whole where it is read, and only
    digests are shuffled.  Repeated rows are leaves each; which of them gets which place is not told.  A table of one
    row has its leaf as root, an empty one gives no rows.  Columns of ``docs`` not named play no part.
    """
    carried = dict(carry or {})
    rows = docs.select(
        F.col(order).cast("long").alias("id"),
        F.struct(F.col(group).isNotNull().alias("known"), F.col(group).cast("string").alias("name")).alias("grp"),
        leaf_digest([F.col(c) for c in columns]).alias("digest"),
        F.struct(*[value.alias(name) for name, value in carried.items()], F.lit(None).alias("_")).alias("carried"),
    )
    leaves = ranked(rows, ["grp"], ["id", "digest"]).select(
        "grp", "rank", _depth(F.col("size")).alias("depth"), "digest", F.struct("id", "carried").alias("own")
    )
    towers = _towers(leaves)

    # The groups' last nodes are the leaves of one more tree.
    top = towers[-1].select("grp", "digest")
    tops = ranked(top, [], ["grp"]).select(
        F.lit(0).alias("grp"), "rank", _depth(F.col("size")).alias("depth"), "digest", F.struct("grp").alias("own")
    )
    upper = _towers(tops)
    root = upper[-1].select("grp", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    subroots = _descend(upper, root).select("own.grp", "root", F.col("digest").alias("subroot"), "path")

    found = _descend(towers, subroots)
    return found.select(
        F.col("own.id").alias("doc_id"),
        F.col("grp.name").alias("lang"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        *[F.col(f"own.carried.{name}").alias(name) for name in carried],
    )


def audit_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``docs``.

    Every third row or so, told by the crc32 of its id, is read back with its text in lower case; its proof then leads
    to another root, unless the text had no capital.  A row without an id is read back as it is.
    """
    tampered = leaf_digest([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS])
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    manifest = merkle_manifest(docs, carry={"read_back": F.when(altered, tampered)})
    found = manifest.withColumn("folded_root", folded(F.coalesce("read_back", "leaf"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
