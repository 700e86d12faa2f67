"""Merkle manifest of a table: a proof of each row against one root.

Leaves are ranked within their group (a language) from a global sort.  The
base-8 digits of a rank are then grouped away one after another: rows are dealt out by
their block of 8^3 ranks once, and within it each ``groupBy`` drops one digit
and nests the children in the struct of their parent.  The roots of blocks are
ranked nodes of the next pass, until a group has one node; the subroots of the
groups are the leaves of one last tree.  On the way back a pass adds to each
of its structs the path above it, by a union and a grouping, and unfolds it with
``transform`` and ``explode``: no proof needs a join, and no row holds more than
one block.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small

FANOUT = 8
#: Digits that one pass groups away; a block has FANOUT ** DIGITS nodes.
DIGITS = 3
#: Columns of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """H of the fields: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return digest(F.concat(*parts))


def ranked(nodes: DataFrame, group: str, order: list[str], rank: str = "rank") -> DataFrame:
    """``nodes`` with their place, from 0, in the order of ``order`` within ``group``.

    The rows are sorted over all partitions and written once, so a group of any
    size is spread over many tasks.  The driver gets two numbers of each partition.
    Ties need the same values in all of ``order``.
    """
    ordered = nodes.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = cut(ordered.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    runs = placed.groupBy(part.alias("part"), group).agg(F.min("place").alias("start"), F.count("*").alias("n"))
    # The first and last group of each partition; only these can go on in another one.
    ends = runs.groupBy("part").agg(
        F.min_by(F.struct(F.col(group).alias("g"), "n"), "start").alias("first"),
        F.max_by(F.struct(F.col(group).alias("g"), "n"), "start").alias("last"),
        F.count("*").alias("groups"),
    )
    base, open_group, open_n = {}, None, 0  # the rank at which each partition begins
    for row in sorted(ends.collect(), key=lambda r: r.part):  # one row a partition
        goes_on = open_n > 0 and row.first.g == open_group
        base[row.part] = open_n if goes_on else 0
        open_group, open_n = row.last.g, row.last.n + (base[row.part] if row.groups == 1 else 0)
    sent = nodes.sparkSession.sparkContext.broadcast(base)
    schema = placed.drop("place").schema.add(rank, "long")
    at = placed.columns.index(group)

    def number(batches):
        previous, n = None, None
        for batch in small(batches, 4096):
            groups, places, ranks = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1), []
            for k, g in enumerate(groups):
                if n is None:
                    n = sent.value[places[k].as_py() >> 33]
                elif g != previous:
                    n = 0
                ranks.append(n)
                previous, n = g, n + 1
            columns = batch.columns[:-1] + [pa.array(ranks, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return placed.mapInArrow(number, schema)


def _parent(kids: Column, first: Column) -> Column:
    """H of the children's digests; an only child of the first place is passed through, as its level has no other."""
    lone = first & (F.size(kids) == 1)
    return F.when(lone, kids[0]["hash"]).otherwise(digest(F.array_join(F.transform(kids, lambda k: k["hash"]), "")))


def rollup(nodes: DataFrame, group: str, digits: int = DIGITS) -> DataFrame:
    """(group, block, hash, kids): one nested struct for each block of FANOUT ** digits ranks.

    ``nodes`` has (group, rank, hash) and any payload, which stays at the bottom.
    """
    width = FANOUT**digits
    payload = [c for c in nodes.columns if c not in (group, "rank", "hash")]
    block = F.floor(F.col("rank") / F.lit(width)).cast("long")
    names = [f"d{k}" for k in range(digits)]
    level = nodes.select(
        group,
        block.alias("block"),
        *[F.pmod(F.shiftright("rank", 3 * k), F.lit(FANOUT)).cast("int").alias(names[k]) for k in range(digits)],
        F.struct(F.lit(0).alias("d"), "hash", *payload).alias("node"),
    ).repartition(group, "block")
    for k in range(digits):
        above = names[k + 1 :]
        first = F.col("block") == 0
        for name in above:
            first = first & (F.col(name) == 0)
        kids = F.sort_array(F.collect_list(F.col("node").withField("d", F.col(names[k]))))
        level = level.groupBy(group, "block", *above).agg(kids.alias("kids"))
        level = level.withColumn("hash", _parent(F.col("kids"), first))
        if above:
            level = level.select(
                group, "block", *above, F.struct(F.lit(0).alias("d"), "hash", "kids").alias("node")
            )
    return level.select(group, "block", "hash", "kids")


STEP = "struct<left:string,right:string>"


def _steps(kids: Column, lone: Column, above: Column) -> Column:
    """Each child with the path from it to the root; a lone child adds no step."""

    def path(kid: Column, at: Column) -> Column:
        hashes = F.transform(kids, lambda k: k["hash"])
        step = F.struct(
            F.array_join(F.slice(hashes, 1, at), "").alias("left"),
            F.array_join(F.slice(hashes, at + 2, FANOUT), "").alias("right"),
        )
        return F.struct(kid.alias("node"), F.when(lone, above).otherwise(F.concat(F.array(step), above)).alias("path"))

    return F.transform(kids, path)


def unroll(blocks: DataFrame, group: str, digits: int = DIGITS) -> DataFrame:
    """The bottom nodes of ``blocks`` (group, block, kids, path, carried), each with its whole path.

    Adds rank, node and path; path is the array of (left, right) siblings' digests from the node up to the root.
    """
    rows = blocks.withColumn("rank", F.col("block"))
    for _ in range(digits):
        lone = (F.col("rank") == 0) & (F.size("kids") == 1)
        rows = rows.select(
            group, "carried", "rank", F.explode(_steps(F.col("kids"), lone, F.col("path"))).alias("kid")
        ).select(
            group,
            "carried",
            (F.col("rank") * FANOUT + F.col("kid.node.d")).alias("rank"),
            F.col("kid.node").alias("node"),
            F.col("kid.path").alias("path"),
        )
        if "kids" in rows.schema["node"].dataType.names:
            rows = rows.withColumn("kids", F.col("node.kids"))
    return rows


def _tree(nodes: DataFrame, group: str, digits: int) -> list[DataFrame]:
    """The passes of all groups' trees; the last one has a single block a group."""
    passes = [cut(rollup(nodes, group, digits))]
    while not passes[-1].filter("block > 0").isEmpty():
        above = passes[-1].select(group, F.col("block").alias("rank"), "hash")
        passes.append(cut(rollup(above, group, digits)))
    return passes


def _descend(passes: list[DataFrame], top: DataFrame, group: str, digits: int) -> DataFrame:
    """The bottom nodes below ``top`` (group, block, path, carried), by one union and grouping a pass."""
    for blocks in reversed(passes):
        kids = blocks.schema["kids"].dataType.simpleString()
        path, carried = (top.schema[c].dataType.simpleString() for c in ("path", "carried"))
        below = blocks.select(
            group, "block", "kids", F.lit(None).cast(path).alias("path"), F.lit(None).cast(carried).alias("carried")
        )
        above = top.select(group, "block", F.lit(None).cast(kids).alias("kids"), "path", "carried")
        met = below.unionByName(above).groupBy(group, "block").agg(
            *[F.get(F.collect_list(c), F.lit(0)).alias(c) for c in ("kids", "path", "carried")]
        )
        found = unroll(met.filter("kids IS NOT NULL"), group, digits)
        top = found.select(group, F.col("rank").alias("block"), "path", "carried") if blocks is not passes[0] else found
    return top


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def manifest(
    docs: DataFrame,
    tampered: dict[str, Column] | None = None,
    fields: tuple = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    digits: int = DIGITS,
) -> DataFrame:
    """One row per row of ``docs``: ``order``, leaf, subroot, root, path, proof_sha256, folded_root, verified.

    ``path`` is an array of (left, right), the siblings' digests on either side of the
    node, from the leaf up to the root.  ``tampered`` replaces fields of the rows whose proof is
    tried; folded_root is what these rows and the original siblings lead to, and
    verified tells if that is the root.

    Nulls are hashed as `-`; rows of a null group form a group that comes first, and rows
    without an id come first in theirs.  Rows that repeat an id are ordered by
    their leaves; equal rows get proofs of neighbouring places.  Other columns
    are not read.  An empty table gives an empty result.
    """
    values = {f: F.col(f) for f in fields}
    # Below, columns have names of their own, whatever the table calls its own ones.
    leaves = docs.select(
        values.get(group, F.col(group)).cast("string").alias("g"),
        F.col(order).alias("id"),
        leaf_digest(list(values.values())).alias("hash"),
        leaf_digest(list((values | (tampered or {})).values())).alias("tried"),
    )
    lower = _tree(ranked(leaves, "g", ["id", "hash", "tried"]), "g", digits)
    subroots = lower[-1].select(F.lit(0).alias("all"), F.col("g").alias("name"), "hash")
    upper = _tree(ranked(subroots, "all", ["name"]), "all", digits)
    root = upper[-1].select(
        "all", "block", F.array().cast(f"array<{STEP}>").alias("path"), F.col("hash").alias("carried")
    )
    groups = _descend(upper, root, "all", digits).select(
        F.col("node.name").alias("g"),
        F.lit(0).cast("long").alias("block"),
        "path",
        F.struct(F.col("node.hash").alias("subroot"), F.col("carried").alias("root")).alias("carried"),
    )
    found = _descend(lower, groups, "g", digits)
    folded = fold(F.col("node.tried"), F.col("path"))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return found.select(
        F.col("node.id").alias(order),
        F.col("node.hash").alias("leaf"),
        "carried.subroot",
        "carried.root",
        "path",
        digest(siblings).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
