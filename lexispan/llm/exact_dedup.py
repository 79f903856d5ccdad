"""Exact deduplication by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. A block's
name is a pair of integers: a bucket, computed from the block alone, and
the block's rank among the distinct blocks of that bucket in sorted
order. Adjacent names are then paired and the pairs named in the same
way, level by level, until one name is left for each document. Two
texts of one byte length have the same last name exactly when they are
equal: a bucket is only a way to spread the sort over the cluster, the
rank tells its members apart, so no collision of the bucket function
can merge two texts.

Nearly every bucket holds one distinct block, whose rank is 1 by
definition. One aggregation over the distinct blocks of a level proves
which buckets hold more; only blocks of those are ranked and joined
back. Texts therefore cross the network once, after map-side
deduplication: a block that a third of all documents share leaves every
task once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lexispan.llm.common import Scratch, broadcast_within, free_names, let, let_go, shared_table

BLOCK_BYTES = 4096

Bucket = Callable[..., Column]


def _clashing(items: DataFrame, keys: list[str]) -> DataFrame | None:
    """Ranks of the distinct items whose bucket holds several, or None."""
    several = items.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = shared_table(several.select("bucket"), "several")
    if several.isEmpty():
        return None
    rank = F.row_number().over(W.partitionBy("bucket").orderBy(*keys))
    ranked = items.join(several, "bucket", "left_semi").withColumn("rank", rank)
    return shared_table(ranked, "ranks")


def _name(occurrences: DataFrame, keys: list[str], ranks: DataFrame | None) -> Column | DataFrame:
    """Occurrences (uid, pos, bucket, keys) with their rank."""
    if ranks is None:
        return occurrences.withColumn("rank", F.lit(1))
    same = [F.col(f"o.{k}") == F.col(f"r.{k}") for k in ["bucket", *keys]]
    return (occurrences.alias("o").join(ranks.alias("r"), same, "left")
            .select("o.*", F.coalesce("r.rank", F.lit(1)).alias("rank")))


def _gather(named: DataFrame) -> DataFrame:
    """Names of each document in text order (one array per document)."""
    listed = F.sort_array(F.collect_list(F.struct("pos", F.col("bucket").alias("b"), F.col("rank").alias("r"))))
    return named.groupBy("uid").agg(
        F.transform(listed, lambda x: F.struct(x["b"].alias("b"), x["r"].alias("r"))).alias("names"))


def _pairs(names: Column, bucket: Bucket) -> Column:
    """Adjacent names with the pair's bucket; a last odd name is paired
    with (0, 0), which no block has since ranks start at 1."""
    def pair(i: Column) -> Column:
        left = F.get(names, 2 * i)
        right = F.get(names, 2 * i + 1)
        parts = [left["b"], left["r"], F.coalesce(right["b"], F.lit(0).cast("long")),
                 F.coalesce(right["r"], F.lit(0))]
        return F.struct(bucket(*parts).alias("bucket"),
                        *[p.alias(a) for p, a in zip(parts, ("lb", "lr", "rb", "rr"), strict=True)])
    last = F.ceil(F.size(names) / 2).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), pair)


def document_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES, bucket: Bucket = F.xxhash64) -> DataFrame:
    """One row per input row: uid, id, n_bytes, sha, bucket, rank.

    (n_bytes, bucket, rank) is equal for two rows exactly when their
    texts are; null text counts as empty. ``bucket`` may be any function
    of its arguments to a long: it changes speed, never results.
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    n_blocks = F.greatest(F.lit(1), F.ceil(F.octet_length(raw) / block_bytes).cast("int"))
    blocks = let(raw, lambda r: F.transform(
        F.sequence(F.lit(0), n_blocks - 1),
        lambda i: F.substring(r, i * block_bytes + 1, F.lit(block_bytes))))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(raw).cast("long").alias("n_bytes"),
                       F.sha2(raw, 256).alias("sha"), blocks.alias("blocks"))
    pieces = docs.select(F.explode(blocks).alias("block"))
    distinct = pieces.select(bucket(F.col("block")).alias("bucket"), "block").distinct()
    ranks = _clashing(distinct, ["block"])
    if ranks is None:
        names = F.transform("blocks", lambda x: F.struct(bucket(x).alias("b"), F.lit(1).alias("r")))
        state = rows.select(F.monotonically_increasing_id().alias("uid"), "id", "n_bytes", "sha",
                            names.alias("names"))
        state = shared_table(state, "level")
    else:
        keyed = shared_table(rows.withColumn("uid", F.monotonically_increasing_id()), "rows")
        spread = keyed.select("uid", F.posexplode("blocks").alias("pos", "block"))
        spread = spread.withColumn("bucket", bucket(F.col("block")))
        state = shared_table(
            keyed.drop("blocks").join(_gather(_name(spread, ["block"], ranks)), "uid"), "level")
    longest = state.agg(F.max(F.size("names"))).first()[0] or 1
    keys = ["lb", "lr", "rb", "rr"]
    while longest > 1:
        # A document down to one name is done: documents of one byte
        # length all take the same number of levels.
        pairs = F.when(F.size("names") > 1, let(F.col("names"), lambda v: _pairs(v, bucket)))
        paired = shared_table(state.withColumn("pairs", pairs), "pairs")
        distinct = paired.select(F.inline("pairs")).distinct()
        ranks = _clashing(distinct, keys)
        if ranks is None:
            up = F.transform("pairs", lambda p: F.struct(p["bucket"].alias("b"), F.lit(1).alias("r")))
            state = shared_table(
                paired.withColumn("names", F.coalesce(up, F.col("names"))).drop("pairs"), "level")
        else:
            spread = (paired.select("uid", F.posexplode("pairs").alias("pos", "p"))
                      .select("uid", "pos", "p.*"))
            done = paired.where(F.col("pairs").isNull()).drop("pairs")
            more = (paired.where(F.col("pairs").isNotNull()).drop("pairs", "names")
                    .join(_gather(_name(spread, keys, ranks)), "uid"))
            state = shared_table(done.unionByName(more), "level")
        longest = -(-longest // 2)
    return state.select("uid", "id", "n_bytes", "sha", F.col("names")[0]["b"].alias("bucket"),
                        F.col("names")[0]["r"].alias("rank"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, bucket: Bucket = F.xxhash64) -> DataFrame:
    """Groups of equal texts; one row per input row.

    Returns doc_id, keep_id, group_size, kept, text_sha256. Texts are
    equal when their bytes are; null counts as empty. The row with the
    largest id stays (a null id is the smallest); of repeated rows with
    that id and text one stays. An empty table gives an empty result;
    other columns of ``docs``, whatever their names, are not read.
    """
    state = document_names(docs, id_col, text_col, block_bytes, bucket)
    identity = ["n_bytes", "bucket", "rank"]
    groups = state.groupBy(*identity).agg(
        F.max(F.struct("id", "uid")).alias("top"), F.count(F.lit(1)).alias("group_size"))
    # Read back, both sides of the join are plain exchanges, so a group
    # that holds a large share of the rows is split over tasks.
    groups = shared_table(groups, "groups")
    return state.join(groups, identity).select(
        F.col("id").alias("doc_id"), F.col("top.id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("top.uid")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns, whatever their names:
    of equal texts the row with the largest id (null the smallest), and
    of repeated rows of that id and text one. Null and empty texts are
    equal; an empty table stays empty."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    marks = exact_dedup(docs, id_col, text_col).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    marks = scratch.table(marks, "marks")
    let_go(spark)
    names = free_names(docs, 3)
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    # Few rows are copies: those that go, and those that stay once.
    gone = marks.where(~F.col("kept") | (F.col("rows") > 1)).select(
        F.col("doc_id").alias(names[0]), F.col("text_sha256").alias(names[1]))
    gone = broadcast_within(scratch.table(gone, "gone"), 160)
    same = docs[id_col].eqNullSafe(gone[names[0]]) & (sha == gone[names[1]])
    stays = docs.join(gone, same, "left_anti")
    again = marks.where(F.col("kept") & (F.col("rows") > 1)).select(
        F.col("doc_id").alias(names[0]), F.col("text_sha256").alias(names[1]))
    again = scratch.table(again, "again")
    if again.isEmpty():
        scratch.drop(marks)
        return stays
    once = docs.join(broadcast_within(again, 160), docs[id_col].eqNullSafe(again[names[0]]) & (
        sha == again[names[1]]), "left_semi")
    once = once.withColumn(names[2], sha).dropDuplicates([id_col, names[2]]).drop(names[2])
    return stays.unionByName(once)
