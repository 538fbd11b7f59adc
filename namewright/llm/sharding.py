"""Shards of bounded size by extendible hashing."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import whole_text

LIMIT_BYTES = 1 << 20
BITS_PER_WORD = 60
STEP = 6


def _bits(digest: Column) -> Column:
    """The first 60 bits of a hexadecimal digest as a string of 0 and 1."""
    return F.lpad(F.conv(F.left(digest, F.lit(BITS_PER_WORD // 4)), 16, 2), BITS_PER_WORD, "0")


def shard_directory(sizes: DataFrame, limit_bytes: int, step: int = STEP) -> DataFrame:
    """The leaves (shard, shard_bytes, shard_rows) of the directory over rows (path, bytes).

    ``path`` is a string of hash bits. A bucket is a prefix of the path; it is a leaf if
    its rows fit the limit, or if it has one row, and is split on the next bit if not. A
    round sums up prefixes of ``step`` more bits at once, for the rows of oversized
    buckets only; nothing but those rows and their sums is read again.
    """
    open_rows, depth, leaves = sizes, 0, None
    while True:
        first, depth = depth, depth + step
        ends = open_rows.groupBy(F.left("path", F.lit(depth)).alias("end")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("n")
        )
        levels = F.sequence(F.lit(first), F.lit(depth))
        buckets = (
            ends.select("end", "bytes", "n", F.explode(levels).alias("depth"))
            .groupBy(F.expr("left(end, depth)").alias("shard"), "depth")
            .agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        )
        buckets = stage(
            buckets.withColumn("fits", (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_rows") == 1)), "buckets"
        )
        # A fitting bucket is a leaf if it is the root or its parent was split.
        split = buckets.filter(~F.col("fits")).select(F.col("shard").alias("parent"))
        fits = buckets.filter("fits").withColumn("parent", F.expr("left(shard, depth - 1)"))
        new = fits.filter("depth = 0").unionByName(fits.join(split, "parent", "left_semi")).drop("parent", "fits")
        leaves = new if leaves is None else leaves.unionByName(new)
        still = buckets.filter(~F.col("fits") & (F.col("depth") == depth)).select(F.col("shard").alias("end"))
        if still.isEmpty():
            return leaves
        open_rows = stage(
            open_rows.withColumn("end", F.left("path", F.lit(depth))).join(still, "end", "left_semi").drop("end"),
            "open",
        )


def assign_shards(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep=(), limit_bytes: int = LIMIT_BYTES, step: int = STEP
) -> DataFrame:
    """Rows (doc_id, *keep, bytes, shard, depth, shard_bytes, shard_rows), one per row of ``docs``.

    ``shard`` is the leaf's prefix of hash bits, the empty string if one shard holds
    everything. The bits are those of the key's MD5, so a document's place does not depend
    on other keys; where many rows share one key (or have none, which counts as the empty
    string), the bits of their texts follow, and last those of the row's number, so that
    every shard fits its limit. A text larger than the limit has a shard of its own.
    A missing text has no bytes.
    """
    named = docs.select(
        F.col(key).alias("doc_id"),
        *keep,
        F.octet_length(whole_text(text)).cast("long").alias("bytes"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("_first"),
        F.md5(whole_text(text)).alias("_second"),
    ).withColumn("_row", F.monotonically_increasing_id())
    rows = stage(named, "sizes")
    path = F.concat(_bits(F.col("_first")), _bits(F.col("_second")), _bits(F.md5(F.col("_row").cast("string"))),
                    F.lpad(F.bin("_row"), 64, "0"))
    leaves = stage(shard_directory(rows.select(path.alias("path"), "bytes"), limit_bytes, step), "leaves")
    leaves = leaves.withColumn("depth", F.col("depth").cast("int"))
    # A row looks for its leaf at the depths that leaves have.
    depths = [row.depth for row in leaves.select("depth").distinct().collect()]
    placed = rows.withColumn("_path", path).withColumn(
        "_at", F.explode(F.array(*[F.lit(d) for d in sorted(depths)] or [F.lit(0)]))
    )
    placed = placed.withColumn("_shard", F.expr("left(_path, _at)"))
    match = (placed["_shard"] == leaves["shard"]) & (placed["_at"] == leaves["depth"])
    return placed.join(leaves, match).select(
        "doc_id", *keep, "bytes", "shard", "depth", "shard_bytes", "shard_rows"
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """Write one folder of Parquet per shard; rows of one shard meet in one task, bounded by its limit."""
    named = assigned.withColumn("shard", F.concat(F.lit("s"), "shard"))
    named.repartition("shard").write.partitionBy("shard").parquet(path)
