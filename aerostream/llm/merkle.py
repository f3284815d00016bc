"""Merkle manifest of a table, and proofs by a recursive query.

Rows are leaves of one tree per group, in order; every ``FAN`` consecutive nodes
of a level are hashed into a node of the next until one is left, and the groups'
roots are the leaves of the tree over all. Levels are built bottom-up by one
grouping each and written as parent-linked node rows: a node has its children's
digests and the link (tree, node, place) to its parent.

``proofs`` climbs by a recursive query: from each leaf, a step joins the parent,
emits the siblings' digests and hashes the run with the leaf's claimed digest in
its place. A step is a row of its own, so digests are not carried from step to
step. The siblings above a block of ``FAN ** BLOCK`` leaves are the same for all of
them: the block's top node climbs too and emits them once. One grouping per block
at the end joins a leaf's own siblings and its block's. Spark keeps each step of
a recursion as shuffle output, which lost executors' tasks rebuild.

Skew: positions come from ranges of (group, order, digest), so a group that
holds most rows is numbered by many tasks. All leaves of a tree meet at its upper
nodes: these are copied per block, which adds a sixty-fourth of a row per leaf and
step, and a join key never has more leaves than a block.

Defined results: a null value is hashed as ``-``; a null group is a group of its
own and comes first; null ids come first, repeated ids in the order of their
digests, equal rows each have a place; columns other than the fields named are
ignored; an empty table has no root and gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostream.llm.common import running, saved

FAN = 8
BITS = 3  # FAN = 2 ** BITS
BLOCK = 2  # a block is FAN ** BLOCK leaves
LEVEL = 52  # a node's number: its level above this bit, its place in the level below
TOP = -1  # the tree over the groups' roots


def field(c: Column) -> Column:
    """A value as it is hashed: ``-`` for null, else bytes, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(c: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(c, 256))


def as_text(c: Column) -> Column:
    """Digests as lower-case hex text."""
    return F.lower(F.hex(c))


@dataclass
class Manifest:
    """leaves (tree, idx, id, leaf, claimed, links), nodes (tree, node, digest,
    children, links), trees (tree, grp, width, subroot), the root's
    hex text and how many levels are over the groups' roots."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: str | None
    over: int


def _placed(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add ``idx``, the place (from 0) of a row in its group by ``order``."""
    rows = rows.withColumn("_row", F.monotonically_increasing_id())  # equal rows may part
    cells = rows.repartitionByRange(group, *order, "_row").drop("_row")
    cells = saved(cells.withColumn("cell", F.spark_partition_id()).withColumn("_one", F.lit(1).cast("long")), name)
    return running(cells, group, "cell", [F.col(c) for c in order], "_one", "idx").drop("cell", "_one")


def _levels(leaves: DataFrame, most: int, name: str) -> list[DataFrame]:
    """Levels 1, 2, ... of all trees over ``leaves`` (tree, idx, digest, width),
    written; width is the number of nodes of the tree at that level."""
    levels, below, level = [], leaves, 0
    while most > 1:
        level, most = level + 1, -(-most // FAN)
        runs = below.where(F.col("width") > 1).groupBy("tree", F.shiftright("idx", BITS).alias("idx"), "width") \
            .agg(F.array_sort(F.collect_list(F.struct(F.col("idx").alias("at"), F.col("digest").alias("d")))).alias("run"))
        children = F.aggregate("run", F.lit(b""), lambda a, x: F.concat(a, x["d"]))
        runs = runs.select("tree", "idx", F.expr(f"(width + {FAN - 1}L) div {FAN}L").alias("width"), children.alias("children"))
        below = saved(runs.select("*", digest(as_text(F.col("children"))).alias("digest"), F.lit(level).alias("level")),
                      f"{name}-{level}")
        levels.append(below)
    return levels


def _linked(nodes: DataFrame, groups: int) -> DataFrame:
    """Add the link to the parent: up_tree, up_node, pos. A tree's last node
    stands in the tree over all; the root has no link."""
    level, inside = F.col("level").cast("long"), F.col("width") > 1
    lifted = ~inside & (F.col("tree") != TOP) & F.lit(groups > 1)
    number = lambda lv, at: F.shiftleft(lv + 1, LEVEL) + F.shiftright(at, BITS)
    return nodes.withColumns({
        "up_tree": F.when(inside, F.col("tree")).when(lifted, F.lit(TOP).cast("long")),
        "up_node": F.when(inside, number(level, F.col("idx"))).when(lifted, number(F.lit(0).cast("long"), F.col("tree"))),
        "pos": F.when(inside, F.col("idx") % FAN).when(lifted, F.col("tree") % FAN).cast("int")})


def build(docs: DataFrame, fields: list[str], id_col: str, group_col: str, claimed: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``: digests of ``fields``, one tree per value of
    ``group_col`` with leaves by ``id_col``. ``claimed`` gives fields the values
    to be verified later in place of the true ones."""
    leaf = lambda of: digest(F.concat(*[field(of.get(c, F.col(c))) for c in fields]))
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf({}).alias("digest"), leaf(claimed or {}).alias("claimed"))
    groups = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("width")).withColumn("_all", F.lit(0))
    trees = saved(_placed(groups, "_all", ["grp"], "merkle-groups").select("grp", F.col("idx").alias("tree"), "width"),
                  "merkle-trees")
    count, most = trees.agg(F.count(F.lit(1)), F.max("width")).first()
    by_group = trees.select(F.col("grp").alias("_grp"), "tree", "width")
    leaves = _placed(rows, "grp", ["id", "digest"], "merkle-order") \
        .join(by_group, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp", "grp").withColumn("level", F.lit(0))
    leaves = saved(_linked(leaves, count), "merkle-leaves")
    levels = _levels(leaves.select("tree", "idx", "digest", "width"), most or 0, "merkle-level")
    tops = leaves.select("tree", "digest", "width")
    for level in levels:
        tops = tops.unionByName(level.select("tree", "digest", "width"))
    tops = saved(tops.where(F.col("width") == 1).select("tree", "digest"), "merkle-tops")
    over = tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest",
                       F.lit(count).cast("long").alias("width"))
    above = _levels(over, count, "merkle-over")
    root = (above[-1] if above else tops).select(as_text(F.col("digest"))).first()
    every = None
    for level in levels + above:
        every = level if every is None else every.unionByName(level)
    if every is None:
        every = docs.sparkSession.createDataFrame([], "tree long, idx long, width long, children binary, digest binary, level int")
    nodes = _linked(every, count).withColumn("node", F.shiftleft(F.col("level").cast("long"), LEVEL) + F.col("idx"))
    trees = trees.join(tops.select(F.col("tree").alias("_t"), F.col("digest").alias("subroot")), F.col("tree") == F.col("_t")) \
        .select("tree", "grp", "width", "subroot")
    return Manifest(leaves, nodes, trees, root[0] if root else None, len(above))


def _per_block(rows: DataFrame) -> DataFrame:
    """A copy of each row for the blocks from ``first`` to ``last``, dealt out in
    stretches of 4096, so that no row makes a long array."""
    first, last = F.col("first"), F.col("last")
    rows = rows.withColumn("_part", F.explode(F.sequence(F.shiftright(first, 12), F.shiftright(last, 12))))
    low = F.shiftleft(F.col("_part"), 12)
    rows = rows.repartition("leaf_tree", "node", "_part") \
        .withColumn("block", F.explode(F.sequence(F.greatest(first, low), F.least(last, low + 4095))))
    return rows.drop("first", "last", "_part")


def _by_block(m: Manifest) -> DataFrame:
    """Node rows, copied for every block of leaves below them: (leaf_tree, block)."""
    link = ["node", "tree", "children", "up_tree", "up_node", "pos"]
    last = m.trees.select(F.col("tree").alias("_t"), F.shiftright(F.col("width") - 1, BITS * BLOCK).alias("_last"))
    inner = m.nodes.where(F.col("tree") != TOP)
    low = inner.where(F.col("level") <= BLOCK).select(
        F.col("tree").alias("leaf_tree"), *link, F.expr(f"shiftright(idx, {BITS} * ({BLOCK} - level))").alias("block"))
    wide = F.expr(f"shiftleft(1L, {BITS} * (level - {BLOCK}))")
    high = inner.where(F.col("level") > BLOCK).join(last, F.col("tree") == F.col("_t")).select(
        F.col("tree").alias("leaf_tree"), *link, (F.col("idx") * wide).alias("first"),
        F.least((F.col("idx") + 1) * wide - 1, F.col("_last")).alias("last"))
    nodes = low.unionByName(_per_block(high))
    if m.over:
        # the tree over all: each group's path in it
        path = last.select("_t", "_last", F.explode(F.sequence(F.lit(1), F.lit(m.over))).alias("_level"))
        number = f"shiftleft(cast(_level as bigint), {LEVEL}) + shiftright(_t, {BITS} * _level)"
        top = m.nodes.where(F.col("tree") == TOP).join(path, F.expr(number) == F.col("node")).select(
            F.col("_t").alias("leaf_tree"), *link, F.lit(0).cast("long").alias("first"), F.col("_last").alias("last"))
        nodes = nodes.unionByName(_per_block(top))
    return nodes


CLIMB = """
WITH RECURSIVE climb (tree, block, idx, id, step, up_tree, up_node, pos, folded, beside) AS (
  SELECT tree, block, idx, id, 0, up_tree, up_node, pos, claimed, digest FROM {climbers}
  UNION ALL
  SELECT c.tree, c.block, c.idx, c.id, c.step + 1, n.up_tree, n.up_node, n.pos,
         unhex(sha2(lower(hex(concat(substr(n.children, 1, 32 * c.pos), c.folded, substr(n.children, 32 * c.pos + 33)))), 256)),
         CASE WHEN c.idx IS NULL OR (n.tree = c.tree AND n.node < {above})
              THEN concat(substr(n.children, 1, 32 * c.pos), substr(n.children, 32 * c.pos + 33)) END
  FROM climb c JOIN {nodes} n
    ON n.leaf_tree = c.tree AND n.block = c.block AND n.tree = c.up_tree AND n.node = c.up_node)
SELECT tree, block, idx, id, step, folded, beside FROM climb WHERE beside IS NOT NULL OR up_tree IS NULL
"""
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _climbers(m: Manifest) -> DataFrame:
    """Every leaf, and every block's top node (no ``idx``), with links."""
    link = ["up_tree", "up_node", "pos"]
    leaves = m.leaves.select("tree", F.shiftright("idx", BITS * BLOCK).alias("block"), "idx", "id", *link, "claimed", "digest")
    none = F.lit(None).cast("long")
    top = (F.col("level") == BLOCK) | ((F.col("width") == 1) & (F.col("level") < BLOCK))
    blocks = m.nodes.where((F.col("tree") != TOP) & top).select("tree", "idx", *link, "digest") \
        .unionByName(m.leaves.where(F.col("width") == 1).select("tree", "idx", *link, "digest"))
    blocks = blocks.select("tree", F.col("idx").alias("block"), none.alias("idx"), none.alias("id").cast(m.leaves.schema["id"].dataType),
                           *link, F.col("digest").alias("claimed"), F.lit(b"").alias("digest"))
    return leaves.unionByName(blocks)


def climbed(spark: SparkSession, m: Manifest) -> DataFrame:
    """(tree, id, leaf, siblings, folded) per leaf, written: all siblings'
    digests joined, and what the climb from the claimed digest comes to."""
    nodes = saved(_by_block(m), "merkle-blocks")
    sql = CLIMB.replace("{above}", f"{(BLOCK + 1) << LEVEL}L")
    rows = spark.sql(sql, climbers=_climbers(m), nodes=nodes)
    step = F.struct("step", "beside", "folded", "id")
    per = rows.repartition("tree", "block").groupBy("tree", "block", "idx").agg(F.array_sort(F.collect_list(step)).alias("s"))
    beside = lambda a, x: F.concat(a, F.coalesce(x["beside"], F.lit(b"")))
    per = per.select("tree", "block", "idx", F.col("s")[0]["id"].alias("id"), F.col("s")[0]["beside"].alias("leaf"),
                     F.aggregate(F.slice("s", 2, F.size("s")), F.lit(b""), beside).alias("own"),
                     F.element_at("s", -1)["folded"].alias("folded"))
    path = F.max(F.when(F.col("idx").isNull(), F.col("own"))).over(Window.partitionBy("tree", "block"))
    per = per.withColumn("path", path).where(F.col("idx").isNotNull()) \
        .select("tree", "id", "leaf", F.sha2(as_text(F.concat("own", "path")), 256).alias("proof"), "folded")
    # a recursion has one row per leaf and step, which the setting's default would refuse
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return saved(per, "merkle-proofs")
    finally:
        spark.conf.set(ROW_LIMIT, before)


def proofs(spark: SparkSession, m: Manifest) -> DataFrame:
    """Per leaf: id, grp, leaf, subroot, root, proof_sha256, folded_root, verified."""
    trees = m.trees.select(F.col("tree").alias("_t"), "grp", as_text(F.col("subroot")).alias("subroot"))
    folded = as_text(F.col("folded"))
    return climbed(spark, m).join(trees, F.col("tree") == F.col("_t")).select(
        "id", "grp", as_text(F.col("leaf")).alias("leaf"), "subroot", F.lit(m.root).cast("string").alias("root"),
        F.col("proof").alias("proof_sha256"), folded.alias("folded_root"), (folded == F.lit(m.root)).alias("verified"))
