"""Exact duplicate removal by deterministic block naming.

Every normalised text is cut into blocks of ``block`` bytes.  The distinct blocks
are sorted within their hash partitions and numbered, so each distinct block has
one integer name; then adjacent names are paired and the distinct pairs named in the
same way, level by level, until each document has a single name.  Two documents
have the same (level, name) if and only if their texts are equal: names stand for
content, not for hashes.  A 64-bit hash only routes rows to names; where two
different blocks share one, they are found and joined on their content.

Only DataFrame functions are used.  Block contents cross the network once, after
the map side has merged equal blocks; everything later moves integers.  The joins
that give names back to occurrences read written tables on both sides, so adaptive
execution splits the name of a block that a third of all rows share.

Defined cases: a null text counts as empty, and an empty text is one empty block;
a null id sorts below every other; rows that repeat both id and text are reported
each, and ``drop_duplicates`` lets one of them stay; of rows with one id and texts
that differ in case only, the one with the larger hash stays; an empty table gives
an empty report; columns beyond id and text are not read here and come through
``drop_duplicates`` as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, drop_rows, materialise

BLOCK_BYTES = 1024
KEY = ["id", "h", "n"]
_NONE = -(1 << 63)


def _blocks(docs: DataFrame, id_col: str, text_col: str, block: int, digest: bool,
            route: Callable[[Column], Column]) -> DataFrame:
    """(id, h, n, size, pos, block, route[, sha]) of every block of every text."""
    base = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("h"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).alias("n"),
        ascii_lower(F.col(text_col)).alias("t"))
    base = base.withColumn("size", F.greatest(F.lit(1), F.ceil(F.octet_length("t") / block)).cast("int"))
    cut = F.expr(f"transform(sequence(0, size - 1), i -> substring(CAST(t AS BINARY), i * {block} + 1, {block}))")
    cols = [*KEY, "size"]
    if digest:
        base = base.withColumn("sha", F.sha2(F.col("t"), 256))
        cols.append("sha")
    out = base.select(*cols, F.posexplode(cut).alias("pos", "block"))
    return out.withColumn("route", route(F.col("block")))


def _number(distinct: DataFrame, *order: str) -> DataFrame:
    """Integer names in sorted order within each partition."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block: int = BLOCK_BYTES,
               route: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: id, h, n (hash and bytes of the text as given), sha
    (of the normalised text), level and name, its collision-free identity."""
    blocks = _blocks(docs, id_col, text_col, block, True, route)
    occ = materialise(blocks.select(
        *KEY, "size", "pos", "route", F.when(F.col("pos") == 0, F.col("sha")).alias("sha")), "occurrences")

    bare = _blocks(docs, id_col, text_col, block, False, route)
    names = materialise(_number(bare.select("route", "block").distinct(), "block")
                        .select("route", "name"), "names")
    clash = names.groupBy("route").count().where("count > 1").select("route")
    if clash.isEmpty():
        level0 = occ.join(names, "route").select(*KEY, "size", "pos", "name")
    else:
        clash = materialise(clash, "clashes")
        sure = occ.join(names.join(clash, "route", "left_anti"), "route")
        mixed = bare.join(clash, "route", "left_semi")
        own = materialise(_number(mixed.select("route", "block").distinct(), "block")
                          .withColumn("name", -F.col("name") - 1), "names")
        level0 = (sure.select(*KEY, "size", "pos", "name")
                  .unionByName(mixed.join(own, ["route", "block"]).select(*KEY, "size", "pos", "name")))

    done = []
    cur, level = level0, 0
    longest = occ.agg(F.max("size")).first()[0] or 1
    while True:
        done.append(cur.where("size = 1").select(*KEY, F.lit(level).alias("level"), "name"))
        if longest <= 1:
            break
        pairs = materialise(
            cur.where("size > 1").groupBy(*KEY, "size", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                 F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(_NONE)).alias("b")),
            "pairs")
        names = materialise(_number(pairs.select("a", "b").distinct(), "a", "b"), "names")
        cur = (pairs.join(names, ["a", "b"])
               .select(*KEY, F.expr("(size + 1) div 2").cast("int").alias("size"), "pos", "name"))
        longest, level = -(-longest // 2), level + 1

    ident = done[0]
    for d in done[1:]:
        ident = ident.unionByName(d)
    ident = ident.distinct().select(*[F.col(k).alias(f"i_{k}") for k in KEY], "level", "name")
    rows = occ.where("pos = 0").select(*KEY, "sha")
    same = (F.col("id").eqNullSafe(F.col("i_id"))) & (F.col("h") == F.col("i_h")) & (F.col("n") == F.col("i_n"))
    return materialise(rows.join(ident, same).select(*KEY, "sha", "level", "name"), "identities")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block: int = BLOCK_BYTES,
                     route: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: id, h, n, keep_id, group_size, kept, text_sha256."""
    rows = identities(docs, id_col, text_col, block, route)
    groups = materialise(
        rows.groupBy("level", "name")
        .agg(F.max(F.struct(*KEY)).alias("keep"), F.count(F.lit(1)).alias("group_size")), "groups")
    return (rows.join(groups, ["level", "name"])
            .select(*KEY, F.col("keep.id").alias("keep_id"), "group_size",
                    (F.struct(*KEY) == F.col("keep")).alias("kept"), F.col("sha").alias("text_sha256")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    block: int = BLOCK_BYTES) -> DataFrame:
    """The columns of ``docs``; of equal texts the row with the largest id stays."""
    report = materialise(duplicate_groups(docs, id_col, text_col, block), "report")
    text = F.col(text_col)
    key = {"id": F.col(id_col), "h": F.xxhash64(text), "n": F.coalesce(F.octet_length(text), F.lit(0))}
    kept = drop_rows(docs, report.where("NOT kept").select(*KEY).distinct(), key)
    again = report.where("kept").groupBy(*KEY).count().where("count > 1").select(*KEY)
    if again.isEmpty():
        return kept
    repeated = drop_rows(kept, again, key, "left_semi")
    return drop_rows(kept, again, key).unionByName(repeated.dropDuplicates([id_col, text_col]))
