"""Merkle manifest of a dataset, proven by a recursive query that climbs from every leaf.

Each row is a leaf, H (lowercase hex SHA-256) of its columns, each ``-`` if null, else
UTF-8 byte count, ``:``, value.  Leaves are ordered by id in their group (lang); every 8
consecutive nodes of a level become their parent, up to the group's subroot, and the
subroots, ordered by group, likewise become the root.

Order without a group in one task: leaves are sorted by range over all tasks; a row's
place in its group is its place in its task plus the group's rows in earlier tasks, which
is a table of one row per task and group it holds.

Every level is an aggregation of the one below and is written as node rows: a node's key
(tree, level, place), the digests of its children, and the key of its parent, with its own
slot there.  The climb is a recursive query over these rows.  Leaves of one lowest node
share all that lies above it, so they climb in one row: an array with a folded digest for
each of them, and the siblings met, appended once for all.  A step joins the row with its
parent's node, folds each digest between the siblings to its left and right, and appends
those.  It ends at the root, which has no parent.  Digests are 32 bytes in the rows and
become hex text where they are hashed.

The recursion limit on rows is lifted while the climb is written, and put back.

Defined cases: null values have their mark; a null group is a group of its own and comes
first; a null id comes first; leaves of one id are ordered by their digest, and repeated
rows are leaves of their own; a single leaf is its group's subroot, a single subroot is
the root; long texts are hashed whole; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, materialise

FANOUT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Tree of the subroots; the groups' own trees are numbered from 0.
TOP = -1
_ROWS = "spark.sql.cteRecursionRowLimit"
_TASK = 1 << 33


def leaf_digest(values: list[Column]) -> Column:
    """H of the values, as 32 bytes."""
    parts = []
    for v in values:
        s = v.cast("string")
        parts.append(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _h(digests: Column) -> Column:
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def _joined(digests: Column | str) -> Column:
    """An array of digests as one string of bytes."""
    return F.unhex(F.array_join(F.transform(digests, F.hex), ""))


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the ``task`` they were sorted into, offsets (task, group, before, total,
    low)), from which ``placed`` numbers a group's rows.  ``order`` must tell all but equal
    rows apart."""
    split = fresh(rows, "draw")
    keys = [group, *order]
    dealt = (rows.withColumn(split, F.rand(11)).repartitionByRange(*keys, split)
             .sortWithinPartitions(*keys, split).drop(split)
             .withColumn("mid", F.monotonically_increasing_id()))
    dealt = materialise(dealt, name)
    dealt = dealt.select("*", F.floor(F.col("mid") / _TASK).cast("long").alias("task"))
    runs = dealt.groupBy("task", group).agg(F.count(F.lit(1)).alias("n"), F.min("mid").alias("low"))
    # of a group: one row per task that holds a part of it
    before = F.expr(f"sum(n) over (partition by {group} order by task rows between unbounded preceding and current row) - n")
    total = F.expr(f"sum(n) over (partition by {group})")
    return dealt, materialise(runs.select("task", group, before.cast("long").alias("before"), total.alias("total"), "low"),
                              f"{name}_offsets")


def placed(dealt: DataFrame, offsets: DataFrame, group: str) -> DataFrame:
    """``ranked`` rows with their ``place`` in the group, its ``total``, and what else the
    offsets hold."""
    off = offsets.withColumnsRenamed({"task": "o_task", group: "o_group"})
    return (dealt.join(off, (F.col("task") == F.col("o_task")) & F.col(group).eqNullSafe(F.col("o_group")))
            .withColumn("place", F.col("mid") - F.col("low") + F.col("before"))
            .drop("o_task", "o_group", "before", "low", "mid", "task"))


def _levels(lowest: DataFrame, top: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(node rows of all levels, the trees' roots (tree, digest, level)) over ``lowest``, node
    rows (tree, level 1, place, total, children) of trees with up to ``top`` of them."""
    level = materialise(lowest, name)
    all_levels, width, k = [level], top, 1
    while width > 1:
        up = (level.where("total > 1")
              .select("tree", F.floor(F.col("place") / FANOUT).cast("long").alias("up"), "place", "total",
                      _h(F.col("children")).alias("digest"))
              .groupBy("tree", "up", F.ceil(F.col("total") / FANOUT).cast("long").alias("total"))
              .agg(F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("c")))
        k += 1
        level = materialise(up.select("tree", F.lit(k).alias("level"), F.col("up").alias("place"), "total",
                                      _joined(F.col("c.digest")).alias("children")), f"{name}_{k}")
        all_levels.append(level)
        width = -(-width // FANOUT)
    nodes = all_levels[0]
    for more in all_levels[1:]:
        nodes = nodes.unionByName(more)
    return nodes, nodes.where("total = 1").select("tree", _h(F.col("children")).alias("digest"), "level")


@contextlib.contextmanager
def _no_row_limit(spark: SparkSession):
    old = spark.conf.get(_ROWS, None)
    spark.conf.set(_ROWS, "-1")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_ROWS)
        else:
            spark.conf.set(_ROWS, old)


CLIMB = """
WITH RECURSIVE climb(leaves, folded, siblings, tree, level, up, slot) AS (
  SELECT leaves, folded, siblings, tree, level, up, slot FROM {starts}
  UNION ALL
  SELECT leaves,
         transform(folded, f -> unhex(sha2(lower(hex(concat(left_of, f, right_of))), 256))),
         concat(siblings, left_of, right_of), tree, level, up, slot
  FROM (SELECT c.leaves, c.folded, c.siblings, n.up_tree AS tree, n.up_level AS level, n.up, n.slot,
               substring(n.children, 1, 32 * c.slot) AS left_of, substring(n.children, 32 * c.slot + 33) AS right_of
        FROM climb c JOIN {nodes} n ON n.tree = c.tree AND n.level = c.level AND n.place = c.up)
)
SELECT leaves, folded, siblings FROM climb WHERE tree IS NULL"""


def manifest(rows: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = COLUMNS,
             tampered: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """One row per row: id, leaf, subroot, root, proof_sha256, folded_root, verified.  Rows for
    which ``when`` holds are folded with the columns in ``tampered`` put in place."""
    spark = rows.sparkSession
    cols = [F.col(c) for c in columns]
    leaf = leaf_digest(cols)
    other = F.lit(None).cast("binary")
    if tampered is not None:
        other = F.when(when, leaf_digest([tampered.get(c, F.col(c)) for c in columns]))
    # digests are made once, and the sort by range moves no texts
    leaves = materialise(rows.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf.alias("leaf"),
                                     other.alias("other")), "leaves")
    dealt, offsets = ranked(leaves, "grp", ["id", "leaf"], "ranked")
    groups = offsets.groupBy("grp").agg(F.max("total").alias("total"))
    g_dealt, g_offsets = ranked(groups.withColumn("all", F.lit(0)), "all", ["grp"], "groups")
    groups = materialise(placed(g_dealt.withColumnRenamed("total", "size"), g_offsets, "all")
                         .select("grp", F.col("place").alias("tree"), "size", F.col("total").alias("trees")), "trees")
    sizes = groups.agg(F.max("size"), F.max("trees")).first()
    if sizes[0] is None:
        sizes = (0, 0)

    numbered = offsets.join(groups.select(F.col("grp").alias("g"), "tree"), F.col("grp").eqNullSafe(F.col("g"))).drop("g")
    place = F.col("place")
    # the lowest nodes, each with up to 8 leaves; a single leaf stands for itself
    lowest = materialise(
        placed(dealt, numbered, "grp")
        .select("tree", F.when(F.col("total") > 1, F.floor(place / FANOUT)).otherwise(0).cast("long").alias("place"),
                     "total", F.struct(place.alias("at"), "leaf", "other", "id").alias("l"))
        .groupBy("tree", "place", "total").agg(F.sort_array(F.collect_list("l")).alias("l"))
        .select("tree", "place", "total", "l", _joined(F.col("l.leaf")).alias("children"))
        .withColumn("leaves", F.monotonically_increasing_id()), "lowest")

    several = lowest.where("total > 1").select("tree", F.lit(1).alias("level"), "place",
                                               F.ceil(F.col("total") / FANOUT).cast("long").alias("total"), "children")
    nodes, roots = _levels(several, -(-sizes[0] // FANOUT), "nodes")
    alone = lowest.where("total = 1").select("tree", F.col("children").alias("digest"), F.lit(0).alias("level"))
    subroots = materialise(roots.unionByName(alone), "subroots")
    lone_tree = sizes[1] <= 1
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.floor(F.col("tree") / FANOUT).cast("long").alias("up"),
                          F.struct(F.col("tree").alias("at"), "digest").alias("c"))
    top = (top.groupBy("tree", "up").agg(F.sort_array(F.collect_list("c")).alias("c"))
           .select("tree", F.lit(1).alias("level"), F.col("up").alias("place"),
                   F.lit(-(-sizes[1] // FANOUT)).cast("long").alias("total"), _joined(F.col("c.digest")).alias("children")))
    top_nodes, top_roots = _levels(top.where(F.lit(not lone_tree)), -(-sizes[1] // FANOUT), "top")
    root = (subroots if lone_tree else top_roots).select("digest").first()
    root = F.lit(bytes(root[0]) if root else b"")

    # parent links: within the tree, from a subroot into the top tree, and none from the root
    last = F.col("total") == 1

    def linked(nodes, at_root_tree):
        none = F.lit(None).cast("long")
        if at_root_tree:
            up_tree, up_level, up, slot = none, none, none, none
        else:
            up_tree, up_level = F.lit(TOP).cast("long"), F.lit(1).cast("long")
            up, slot = F.floor(F.col("tree") / FANOUT).cast("long"), (F.col("tree") % FANOUT).cast("long")
        return nodes.select(
            "tree", F.col("level").cast("long").alias("level"), "place", "children",
            F.when(last, up_tree).otherwise(F.col("tree")).alias("up_tree"),
            F.when(last, up_level).otherwise(F.col("level") + 1).cast("long").alias("up_level"),
            F.when(last, up).otherwise(F.floor(F.col("place") / FANOUT)).cast("long").alias("up"),
            F.when(last, slot).otherwise(F.col("place") % FANOUT).cast("long").alias("slot"))

    linked_rows = materialise(linked(nodes, lone_tree).unionByName(linked(top_nodes, True)), "linked")
    def left_of(i):
        return F.substring("children", F.lit(1), i * 32)

    def right_of(i):
        return F.substring("children", i * 32 + 33, F.length("children"))

    # the first step of every leaf, inside its lowest node
    own = F.transform("l", lambda x, i: F.when(F.col("total") == 1, F.coalesce(x["other"], x["leaf"])).otherwise(
        _h(F.concat(left_of(i), F.coalesce(x["other"], x["leaf"]), right_of(i)))))
    lows = (several.select("tree", "place", "total", F.lit(1).alias("level"), "children")
            .unionByName(lowest.where("total = 1").select("tree", "place", "total", F.lit(0).alias("level"), "children")))
    first = (lowest.select("tree", "place", "leaves", own.alias("folded"))
             .join(linked(lows, lone_tree).drop("children", "level")
                   .withColumnsRenamed({"tree": "t", "place": "p"}),
                   (F.col("tree") == F.col("t")) & (F.col("place") == F.col("p")))
             .select("leaves", "folded", F.lit(b"").alias("siblings"), F.col("up_tree").alias("tree"),
                     F.col("up_level").alias("level"), "up", "slot"))
    starts = materialise(first, "starts")
    with _no_row_limit(spark):
        climbed = materialise(spark.sql(CLIMB, starts=starts, nodes=linked_rows), "climbed")

    def proof(i):
        lowest_ones = F.when(F.col("total") > 1, F.concat(left_of(i), right_of(i))).otherwise(F.lit(b""))
        return F.sha2(F.lower(F.hex(F.concat(lowest_ones, F.col("siblings")))), 256)

    def text(digest):
        return F.lower(F.hex(digest))

    found = (lowest.join(climbed, "leaves").join(subroots.select("tree", F.col("digest").alias("subroot")), "tree")
             .select("subroot", F.explode(F.transform("l", lambda x, i: F.struct(
                 x["id"].alias("id"), x["leaf"].alias("leaf"), proof(i).alias("proof"),
                 F.element_at("folded", i + 1).alias("folded")))).alias("x")))
    return found.select(F.col("x.id").alias("id"), text(F.col("x.leaf")).alias("leaf"), text(F.col("subroot")).alias("subroot"),
                        text(root).alias("root"), F.col("x.proof").alias("proof_sha256"),
                        text(F.col("x.folded")).alias("folded_root"), (F.col("x.folded") == root).alias("verified"))


def tampered_thirds(text_col: str = "text", id_col: str = "doc_id") -> tuple[dict[str, Column], Column]:
    """Tampering that lower-cases A-Z in the text of rows whose crc32(id as text) 3 divides;
    a null id counts as empty text, a null text stays null."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    low = F.when(F.col(text_col).isNotNull(), ascii_lower(F.col(text_col)))
    return {text_col: low}, F.crc32(key) % 3 == 0
