"""Merkle manifest of a dataset, rolled up as nested structs.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a group stand
in order; while a group has several nodes, every three consecutive ones become
their hash, and what remains is the group's subroot.  The subroots, in order
of their groups, become the root in the same way.

A leaf's rank is split into base-3 digits.  Rows are dealt once by (group,
block of 3^LEVELS ranks); inside a block the digit columns are grouped away
one after the other, lowest first, each time nesting the child structs in
their parent, so one exchange serves all levels and a group holds at most a
block.  The blocks' hashes are the leaves of the next such rollup, until every
group has one block; the groups' subroots are rolled up alike.  Then every
block is opened from the top: nested transforms give each leaf the hashes
beside its path and one explode emits them.  What stands above a block meets
it in a grouping by the block's name (no join).

Defined results: every row is a leaf; null fields count as ``-``; null groups
are a group of their own and stand first, as null order values do in a group;
rows of one order value stand by leaf hash, and rows equal in all fields stay
one leaf each with equal digests but different proofs; an empty table has no
root and gives no row.  Very long texts are hashed where they are read and do
not travel.  Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_written, written

#: Children of a node, and digit columns (levels) of a block: 3^5 = 243 leaves.
FAN = 3
LEVELS = 5
#: Bits that monotonically_increasing_id leaves to the place in a partition.
PLACE_BITS = 33


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def ranked(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank``, the place (from 0) in its ``tree`` by ``order``.
    A range partitioning and a sort; a tree that runs over several partitions
    adds one offset for each, and a partition needs at most one of them."""
    spark = rows.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    placed = written(placed, name).withColumn("part", F.shiftright("place", PLACE_BITS))
    sizes = placed.groupBy("part", tree).agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(tree).orderBy("part")) - F.col("n")
    # Only the first tree of a partition can have begun in an earlier one: at most a row a partition.
    offset = sizes.select(F.col("part").alias("at"), F.col(tree).alias("of"), earlier.alias("earlier")).where("earlier > 0")
    inside = F.row_number().over(Window.partitionBy("part", tree).orderBy("place")) - 1
    numbered = placed.withColumn("inside", inside).join(F.broadcast(offset), (F.col("part") == F.col("at")) & F.col(tree).eqNullSafe(F.col("of")), "left")
    return numbered.withColumn("rank", F.col("inside") + F.coalesce("earlier", F.lit(0))).drop("place", "part", "at", "of", "earlier", "inside")


def lone(block: Column, higher: list[Column], kids: Column) -> Column:
    """Whether a node's only child is all that its tree has on that level:
    ranks are dense, so such a child is the first of the first block."""
    first = block == 0
    for digit in higher:
        first = first & (digit == 0)
    return first & (F.size(kids) == 1)


def rolled_up(nodes: DataFrame, levels: int) -> DataFrame:
    """``tree, block, node`` of ``nodes(tree, rank, hash, payload)``: every
    block as one struct ``hash, kids`` of nested structs."""
    digit = [F.pmod(F.floor(F.col("rank") / FAN**j), F.lit(FAN)).cast("int").alias(f"d{j}") for j in range(levels)]
    block = F.floor(F.col("rank") / FAN**levels).cast("long").alias("block")
    now = nodes.select("tree", block, *digit, F.struct("hash", "payload").alias("node")).repartition("tree", "block")
    for level in range(1, levels + 1):
        higher = [f"d{j}" for j in range(level, levels)]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{level - 1}").alias("d"), "node")))
        now = now.groupBy("tree", "block", *higher).agg(kids.alias("kids"))
        hashes = F.transform("kids", lambda k: k["node"]["hash"])
        own = F.when(lone(F.col("block"), [F.col(d) for d in higher], F.col("kids")), hashes[0]).otherwise(F.sha2(F.array_join(hashes, ""), 256))
        now = now.select("tree", "block", *higher, F.struct(own.alias("hash"), "kids").alias("node"))
    return now


def stages(leaves: DataFrame, name: str, levels: int) -> list[DataFrame]:
    """Written rollups of ``leaves(tree, rank, hash, payload)``, the lowest
    first; in the last one every tree is one block, whose hash is its root."""
    out = [written(rolled_up(leaves, levels), f"{name}-0")]
    while out[-1].agg(F.max("block")).first()[0]:
        up = out[-1].select("tree", F.col("block").alias("rank"), F.col("node.hash").alias("hash"), F.col("block").alias("payload"))
        out.append(written(rolled_up(up, levels), f"{name}-{len(out)}"))
    return out


def opened(level: int, node: Column, path: Column, block: Column, higher: list[Column]) -> Column:
    """Every leaf below ``node`` with its payload, hash and path: the hashes
    before and after its own on each level, the lowest level first."""
    if level == 0:
        return F.array(F.struct(node["payload"].alias("payload"), node["hash"].alias("hash"), path.alias("path")))
    kids = node["kids"]

    def below(kid: Column, i: Column) -> Column:
        beside = lambda some: F.array_join(F.transform(some, lambda k: k["node"]["hash"]), "")
        step = F.struct(beside(F.slice(kids, F.lit(1), i)).alias("before"), beside(F.slice(kids, i + 2, F.lit(FAN))).alias("after"))
        longer = F.when(lone(block, higher, kids), path).otherwise(F.concat(F.array(step), path))
        return opened(level - 1, kid["node"], longer, block, [*higher, kid["d"]])

    return F.flatten(F.transform(kids, below))


def paths(rolled: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """``payload, hash, path, top, subroot`` for every leaf of the stages;
    ``above(tree, path, top)`` is what stands above each tree's root."""
    node_type = [stage.schema["node"].dataType for stage in rolled]
    over = above.select("tree", F.lit(0).cast("long").alias("block"), "path", "top", F.lit(None).cast("string").alias("subroot"))
    for i in reversed(range(len(rolled))):
        trees = rolled[i].select("tree", "block", "node", *[F.lit(None).cast(over.schema[c].dataType).alias(c) for c in ("path", "top", "subroot")])
        both = trees.unionByName(over.withColumn("node", F.lit(None).cast(node_type[i])))
        met = both.groupBy("tree", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("node", "path", "top", "subroot")])
        subroot = F.coalesce("subroot", "node.hash") if i == len(rolled) - 1 else F.col("subroot")
        leaf = F.explode(opened(levels, F.col("node"), F.col("path"), F.col("block"), [])).alias("leaf")
        found = met.select("tree", "top", subroot.alias("subroot"), leaf)
        over = found.select("tree", F.col("leaf.payload").alias("block"), "leaf.path", "top", "subroot") if i else found
    return over.select("leaf.*", "top", "subroot")


def manifest(docs: DataFrame, group: str, order: str, fields: list[Column], found: list[Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """``<order>, leaf, subroot, root, path, found_leaf, folded_root`` for every
    row of ``docs``: ``fields`` make the leaves, ``found`` are the fields as
    found later (default: the same), whose leaf is folded along the path."""
    leaf = leaf_hash(fields)
    later = leaf_hash(found) if found is not None else leaf
    narrow = docs.select(docs[group].alias("tree"), docs[order].alias("id"), leaf.alias("hash"), later.alias("later"))
    leaves = written(narrow.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = ranked(leaves, "tree", ["id", "hash", "row"], "merkle-ranked")
    trees = stages(placed.select("tree", "rank", "hash", F.struct("id", "later").alias("payload")), "merkle-trees", levels)
    subroots = trees[-1].select(F.lit(0).alias("all"), "tree", F.col("node.hash").alias("hash"))
    top = stages(ranked(subroots, "all", ["tree"], "merkle-groups").select(F.col("all").alias("tree"), "rank", "hash", F.struct("tree").alias("payload")), "merkle-top", levels)
    nothing = F.array().cast("array<struct<before:string,after:string>>")
    root = top[-1].select("tree", nothing.alias("path"), F.col("node.hash").alias("top"))
    over = paths(top, root, levels).select(F.col("payload.tree").alias("tree"), "path", "top")
    fold = F.aggregate("path", F.col("payload.later"), lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))
    out = paths(trees, over, levels).select(F.col("payload.id").alias(order), F.col("hash").alias("leaf"), "subroot", F.col("top").alias("root"),
                                            "path", F.col("payload.later").alias("found_leaf"), fold.alias("folded_root"))
    drop_written(leaves)
    return out


def proof(path: Column) -> Column:
    """All hashes beside a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")
