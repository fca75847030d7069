"""Merkle manifest of a dataset, from concatenated-level strings.

The leaves of a group, in order, are cut into aligned blocks of 512. A block keeps each level of
its tree as one string of hexadecimal digests. The parents are the hashes of the fixed-width
substrings of a level (a run of eight digests each), put together to the next level; the siblings of a
node are the substrings on either side of it in its run. The tops of the blocks are the nodes of
the next round, until each group has one. The tops of the groups form a tree in the same way.

Leaves are numbered by a range sort and the counts of its partitions, so neither a group that
holds most rows nor a doc_id that all rows share meets in one task, and no tree is larger than a block
anywhere. Every round is written to the shared folder: an executor lost later costs nothing.

Defined results: a null value is `-` in its leaf; null groups come first, then the others by their
UTF-8 bytes; null doc_ids come before others, and rows of the same doc_id in the order of their leaves,
so repeated rows have the same leaf and proofs of their own places. Empty texts are values like
others and very long ones are hashed whole. A null doc_id is never tampered with. Columns other
than the five of a leaf are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import materialize

#: Nodes of a run, hexadecimal digits of a digest, levels of a block.
FANOUT, DIGITS, LEVELS = 8, 64, 3
RUN = FANOUT * DIGITS
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value as a part of a leaf: its length in bytes and itself, or `-`."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds `pos`, the place of a row within its `key` from 0, and `total`, the rows of the key.

    Rows are sorted by ranges of (key, order) and written; then a row's place is its distance from
    the first of its key in the partition plus what earlier partitions hold of the key.
    """
    width = F.lit(1 << 33)
    placed = materialize(
        rows.repartitionByRange(F.col("key"), *order).sortWithinPartitions("key", *order)
        .withColumn("at", F.monotonically_increasing_id()),
        "sorted-nodes",
    ).withColumn("part", F.floor(F.col("at") / width).cast("long"))
    by_key = Window.partitionBy("key")
    before = by_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
        .select(
            "key", "part",
            (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("rows").over(by_key).alias("total"),
        )
    )
    return (
        placed.join(parts, ["key", "part"])
        .withColumn("pos", F.col("at") + F.col("shift"))
        .drop("at", "part", "shift")
    )


def levels_of(total: Column, most: int) -> Column:
    """Levels of a block above its leaves: as many as the group still needs, up to those of a block."""
    needed = F.lit(most)
    for n in range(most - 1, -1, -1):
        needed = F.when(total <= FANOUT**n, F.lit(n)).otherwise(needed)
    return needed


def runs(level: Column) -> Column:
    """The runs of a level, by fixed-width substrings."""
    last = F.floor((F.length(level) - 1) / RUN).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(level, i * RUN + 1, F.lit(RUN))
    )


def parents(level: Column) -> Column:
    return F.array_join(F.transform(runs(level), lambda run: F.sha2(run, 256)), "")


def siblings(run_list: Column, place: Column) -> Column:
    """What stands before and after the node at `place` in its run."""
    run = F.get(run_list, F.floor(place / FANOUT).cast("int"))
    start = (place % FANOUT).cast("int") * DIGITS
    return F.struct(
        F.substring(run, F.lit(1), start).alias("before"),
        F.substring(run, start + DIGITS + 1, F.lit(RUN)).alias("after"),
    )


def blocks_of(nodes: DataFrame, levels: int) -> DataFrame:
    """key, block, total, height, members and the strings level0, level1, ... of every block. `nodes`
    has key, pos, total, node and what else is to be kept with a member."""
    own = [c for c in nodes.columns if c not in ("key", "pos", "total", "node")]
    gathered = nodes.groupBy(
        "key", "total", F.floor(F.col("pos") / FANOUT**levels).cast("long").alias("block")
    ).agg(F.sort_array(F.collect_list(F.struct("pos", "node", *own))).alias("members"))
    out = gathered.withColumn("height", levels_of(F.col("total"), levels)).withColumn(
        "level0", F.array_join(F.col("members.node"), "")
    )
    for n in range(1, levels + 1):
        out = out.withColumn(
            f"level{n}", F.when(F.col("height") >= n, parents(F.col(f"level{n - 1}")))
        )
    return materialize(out, "merkle-blocks")


def climb(nodes: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, and key, top of every group."""
    rounds = []
    while True:
        blocks = blocks_of(nodes, levels)
        rounds.append(blocks)
        top = F.coalesce(*(F.col(f"level{n}") for n in range(levels, -1, -1)))
        tops = blocks.select(
            "key", F.col("block").alias("pos"), top.alias("node"),
            F.ceil(F.col("total") / FANOUT**levels).alias("total"),
        )
        if blocks.filter(F.col("total") > FANOUT**levels).isEmpty():
            return rounds, tops.select("key", F.col("node").alias("top"))
        nodes = tops


def members_with_paths(blocks: DataFrame, above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The members of blocks, each with `path`: its siblings on every level up to the root, the lowest
    first. `above` has key, pos (of the block), path and other columns to hand down."""
    handed = [c for c in above.columns if c not in ("key", "pos", "path")]
    rows = blocks.join(above.withColumnRenamed("pos", "block"), ["key", "block"])
    for n in range(levels):
        rows = rows.withColumn(f"runs{n}", runs(F.col(f"level{n}")))

    def member(m: Column, place: Column) -> Column:
        own = [
            siblings(F.col(f"runs{n}"), F.floor(place / FANOUT**n)) for n in range(levels)
        ]
        path = F.concat(F.slice(F.array(*own), F.lit(1), F.col("height")), F.col("path"))
        return F.struct(m.alias("member"), path.alias("path"))

    return rows.select(
        "key", *handed, F.inline(F.transform("members", member))
    ).select("key", *handed, "member.*", "path")


def tree_paths(rounds: list[DataFrame], top: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Members of the first round with their whole paths. `top`: key, path of each group's top and
    columns to hand down."""
    above = top.withColumn("pos", F.lit(0).cast("long"))
    for blocks in reversed(rounds[1:]):
        above = members_with_paths(blocks, above, levels).drop("node")
    return members_with_paths(rounds[0], above, levels)


def folded(path: Column, node: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(
        path, node, lambda below, s: F.sha2(F.concat(s["before"], below, s["after"]), 256)
    )


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    parts = F.transform(path, lambda s: F.concat(s["before"], s["after"]))
    return F.sha2(F.array_join(parts, ""), 256)


def manifest(leaves: DataFrame, order: list[str], levels: int = LEVELS) -> DataFrame:
    """The leaves (key, leaf and other columns) with subroot, root and path. Keys are not null; groups
    come in the order of their keys."""
    nodes = numbered(
        leaves.withColumnRenamed("leaf", "node").withColumn("tie", F.monotonically_increasing_id()),
        [*(F.col(c).asc_nulls_first() for c in order), F.col("node"), F.col("tie")],
    ).drop("tie")
    rounds, tops = climb(nodes, levels)
    groups = tops.select(F.lit(0).alias("key"), F.col("key").alias("name"), F.col("top").alias("node"))
    over, root = climb(numbered(groups, [F.col("name")]), levels)
    no_siblings = F.array().cast("array<struct<before:string,after:string>>")
    top = tree_paths(over, root.select("key", F.col("top").alias("root"), no_siblings.alias("path")), levels)
    top = materialize(
        top.select(F.col("name").alias("key"), F.col("node").alias("subroot"), "root", "path"), "groups"
    )
    return tree_paths(rounds, top, levels).withColumnRenamed("node", "leaf")


def verify_documents(documents: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document. Where 3 divides
    the crc32 of doc_id the text is tampered with (A-Z lower-cased) before the root is recomputed."""
    values = ["doc_id", "source", "lang", "n_chars"]
    columns = [F.col(c) for c in values]
    tampered = F.translate("text", CAPITALS, SMALL)
    chosen = F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False)
    )
    leaves = materialize(
        documents.select(
            "doc_id",
            F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("key"),
            leaf(*columns, F.col("text")).alias("leaf"),
            F.when(chosen & (tampered != F.col("text")), leaf(*columns, tampered)).alias("changed"),
        ),
        "leaves",
    )
    return manifest(leaves, ["doc_id"], levels).select(
        "doc_id", "leaf", "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("path"), F.coalesce("changed", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
