"""Exact duplicates by naming blocks: equal texts get one integer identity, without odds of a collision."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import whole_text, without_blanks

BLOCK_BYTES = 4096
UNPAIRED = -1
MOST_COLLISIONS = 10_000


def blocks_of(text: Column, block_bytes: int) -> Column:
    """The UTF-8 bytes of a text in blocks of fixed size; an empty text is one empty block."""
    return F.flatten(
        F.transform(
            F.array(text.cast("binary")),
            lambda whole: F.transform(
                F.sequence(F.lit(0), F.greatest(F.expr("0"), (F.octet_length(whole) - 1) / block_bytes).cast("int")),
                lambda i: F.substring(whole, i * block_bytes + 1, F.lit(block_bytes)),
            ),
        )
    )


def _name(distinct: DataFrame, keys, label: str) -> DataFrame:
    """Sort distinct keys within their partitions; the place in that order is the name."""
    return stage(
        distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()),
        label,
    )


def name_blocks(blocks: DataFrame, hashed=F.xxhash64) -> tuple[DataFrame, list[int]]:
    """Integer names of the distinct blocks, and the hashes that two different blocks share.

    Blocks are told apart by their bytes; the hash only leads the sort order and stands for
    the block in the narrow tables. Where different blocks share a hash (about 17 of the
    25 billion blocks of 100 TB), the stored names also carry the bytes.
    """
    distinct = blocks.select(hashed("block").alias("h"), "block").distinct()
    names = _name(distinct, ["h", "block"], "names").select("h", "name")
    shared = names.groupBy("h").count().filter("count > 1").select("h").limit(MOST_COLLISIONS + 1).collect()
    if len(shared) > MOST_COLLISIONS:
        raise ValueError(f"over {MOST_COLLISIONS} hashes name several blocks each; give another hash")
    return names, [row.h for row in shared]


def text_identity(docs: DataFrame, text: str = "text", keep=(), block_bytes: int = BLOCK_BYTES, hashed=F.xxhash64):
    """Name every text: rows of equal normalised text, and only these, share ``level`` and ``name``.

    Returns a stored table (_row, *keep, n_chars, text_sha256, level, name), one row per
    row of ``docs``. Distinct blocks are sorted into integer names, then adjacent names
    are paired, the distinct pairs are sorted into names again, and so on until a
    text has one name; a last name without a partner is paired with -1. ``level`` counts
    the pairings, so a name is only compared with names of texts of as many levels.
    Only the first naming moves texts, each distinct block once per task.
    """
    source = docs.select(*[F.col(c) for c in keep], F.length(whole_text(text)).alias("n_chars"),
                         without_blanks(whole_text(text)).alias("_norm"))
    block = source.select(F.explode(blocks_of(F.col("_norm"), block_bytes)).alias("block"))
    names, shared = name_blocks(block, hashed)
    keys = ["h"]
    if shared:
        keys = ["h", "bytes"]
        told_apart = lambda b: F.when(hashed(b).isin(shared), b).otherwise(F.lit(b""))
        names = _name(block.select(hashed("block").alias("h"), told_apart(F.col("block")).alias("bytes")).distinct(),
                      keys, "names")
        key = lambda b: F.struct(hashed(b).alias("h"), told_apart(b).alias("bytes"))
    else:
        key = lambda b: F.struct(hashed(b).alias("h"))
    rows = stage(
        source.select(
            *keep,
            "n_chars",
            F.sha2("_norm", 256).alias("text_sha256"),
            F.transform(blocks_of(F.col("_norm"), block_bytes), key).alias("_blocks"),
        ).withColumn("_row", F.monotonically_increasing_id()),
        "texts",
    )
    places = rows.select("_row", F.size("_blocks").cast("long").alias("n"), F.posexplode("_blocks").alias("pos", "b"))
    named = stage(
        places.select("_row", "n", F.col("pos").cast("long"), "b.*").join(names, keys).select("_row", "n", "pos", "name"),
        "named",
    )
    longest = named.agg(F.max("n")).first()[0] or 1
    finished = [named.filter("n = 1").select("_row", F.lit(0).alias("level"), "name")]
    level = 0
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        pairs = (
            named.filter("n > 1")
            .groupBy("_row", "n", F.expr("pos div 2").alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(UNPAIRED)).alias("right"),
            )
        )
        names = _name(pairs.select("left", "right").distinct(), ["left", "right"], "pairs")
        named = stage(
            pairs.join(names, ["left", "right"]).select("_row", F.expr("(n + 1) div 2").alias("n"), "pos", "name"),
            "named",
        )
        finished.append(named.filter("n = 1").select("_row", F.lit(level).alias("level"), "name"))
    identity = finished[0]
    for more in finished[1:]:
        identity = identity.unionAll(more)
    return stage(rows.drop("_blocks").join(identity, "_row"), "identity")


def exact_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, hashed=F.xxhash64
) -> DataFrame:
    """Say for every row which row of equal text stays; white space does not count.

    One row per row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256). Of equal
    texts the one with the most code points before normalisation stays, then the smallest
    key; missing keys come last, and of rows that tie in all this exactly one stays. A
    missing text is empty, all empty texts are equal. Other columns are not read, so
    their names cannot clash. An empty table gives no rows.
    """
    named = text_identity(docs.select(F.col(key).alias("doc_id"), text), text, ["doc_id"], block_bytes, hashed)
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "_row")
    # Stored, so that Spark can split the join below at a group that holds many rows.
    groups = stage(
        named.groupBy("level", "name").agg(F.count("*").alias("group_size"), F.min(order).alias("_first")), "groups"
    )
    return named.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("_first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_first._row")).alias("kept"),
        "text_sha256",
    )
