"""Near copies by the Jaccard similarity of five-word shingles: SimHash and MinHash candidates, verified exactly."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import two_hashes, whole_text
from .components import components
from .simhash import BITS, SHINGLES_AT_ONCE, linked_fingerprints, majority, votes_of

WIDTH = 5
PERCENT = 80
BANDS, ROWS = 20, 5
SMALL_BUCKET = 32
DIFFERING_BITS = 2
SEED = 42
HASHES_AT_ONCE = 1 << 12
BROADCAST_ROWS = 1 << 20
_draw = np.random.default_rng(SEED)
# Odd factors and summands, one pair per row of each band.
_FACTORS, _SUMMANDS = (_draw.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) for _ in range(2))
_FACTORS |= np.uint64(1)


def shingle_set(raw: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text in UTF-8.

    Words are those of ``simhash.fingerprint``. A text of fewer words is one shingle, a text
    without words has none.
    """
    words = raw.lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: max(1, len(words) - width + 1)].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = (digest(joined[a:b], SEED) for a, b in zip(starts, ends))
    return np.unique(np.fromiter(hashes, dtype="<u8", count=len(starts)))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One long per band: a hash of the band's minima; sets of similarity s share it with odds of s**ROWS."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        mixed = _FACTORS * hashes[at : at + HASHES_AT_ONCE]
        mixed += _SUMMANDS
        np.minimum(least, mixed.min(axis=1), out=least)
    raw, size = least.astype("<u8").tobytes(), 8 * ROWS
    keys = [xxhash.xxh64_intdigest(raw[size * b : size * (b + 1)], b) for b in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def set_fingerprint(hashes: np.ndarray) -> int:
    """The SimHash of a shingle set; that of no shingles is 0."""
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        votes += votes_of(hashes[at : at + SHINGLES_AT_ONCE])
    return majority(votes, len(hashes))


def sketch_column(text: str, width: int = WIDTH):
    """(digest, n, fp, bands) of a text column: 128 bits that name the shingle set, its size, its SimHash and its band keys."""

    @F.arrow_udf("struct<digest: binary, n: long, fp: long, bands: array<long>>")
    def of_batch(texts: pa.Array) -> pa.Array:
        digests, sizes, prints, bands = [], [], [], []
        for raw in texts:
            hashes = shingle_set(raw.as_py(), width)
            digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
            sizes.append(len(hashes))
            prints.append(set_fingerprint(hashes))
            bands.append(band_keys(hashes))
        columns = [
            pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
        ]
        return pa.StructArray.from_arrays(columns, ["digest", "n", "fp", "bands"])

    return of_batch(whole_text(text).cast("binary"))


def shingle_column(text: str, width: int = WIDTH):
    """The whole shingle set of a text column as an array of longs."""

    @F.arrow_udf("array<long>")
    def of_batch(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_set(raw.as_py(), width).view("<i8") for raw in texts], pa.list_(pa.int64()))

    return of_batch(whole_text(text).cast("binary"))


def bucket_members(sets: DataFrame) -> DataFrame:
    """(bucket, size, node, n): the members of all buckets that hold two sets or more of ``sets`` (node, n, bands).

    Counts alone are shuffled first; they are stored, so that Spark can split the join at a crowded bucket.
    """
    members = sets.select("node", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    return stage(members.join(stage(shared, "buckets"), "bucket"), "members")


def _fits(percent: int):
    """Do the sizes of the sets x and y allow the similarity?"""
    return 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def candidates(met: DataFrame, percent: int = PERCENT, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Pairs (a, b), a < b, of ``bucket_members`` whose sizes allow the similarity.

    All members of a bucket of up to ``small_bucket`` sets meet. In a larger one every member
    meets two others, the first and the last in an order that is another one in each bucket, which
    holds a crowd of near copies together at a cost in proportion to its size. Pairs of a crowd
    that this leaves apart are those of ``crowd_candidates``.
    """
    small = met.filter(F.col("size") <= small_bucket).groupBy("bucket").agg(F.collect_list(F.struct("node", "n")).alias("m"))
    pairs = F.flatten(
        F.transform(
            "m", lambda x, i: F.transform(F.slice("m", 1, i), lambda y: F.struct(x.alias("x"), y.alias("y")))
        )
    )
    within = small.select(F.explode(pairs).alias("p")).select("p.x", "p.y")
    crowded = met.filter(F.col("size") > small_bucket)
    member = F.struct(F.xxhash64("bucket", "node").alias("turn"), "node", "n")
    ends = stage(crowded.groupBy("bucket").agg(F.min(member).alias("first"), F.max(member).alias("last")), "centres")
    centre = F.explode(F.array("first", "last")).alias("c")
    around = crowded.join(ends, "bucket").select(F.struct("node", "n").alias("x"), centre)
    around = around.select("x", F.struct("c.node", "c.n").alias("y"))
    return _ordered(within.unionAll(around).filter(_fits(percent) & (F.col("x.node") != F.col("y.node"))))


def simhash_candidates(sets: DataFrame, percent: int = PERCENT, most: int = DIFFERING_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of ``sets`` (node, n, fp) by op6's operator, if their sizes allow the similarity.

    The sets of one fingerprint meet the first of them; the first ones of fingerprints that differ
    in at most ``most`` bits meet as ``linked_fingerprints`` links them.
    """
    member = F.struct("node", "n")
    homes = stage(sets.groupBy("fp").agg(F.min(member).alias("home"), F.count("*").alias("size")), "homes")
    crowds = homes.filter("size > 1").select("fp", F.col("home").alias("y"))
    same = sets.join(crowds, "fp").select(member.alias("x"), "y").filter("x.node <> y.node")
    links = stage(linked_fingerprints(homes.select("fp"), most), "links")
    x, y = homes.select(F.col("fp").alias("a"), F.col("home").alias("x")), homes.select(F.col("fp").alias("b"), F.col("home").alias("y"))
    near = links.join(x, "a").join(y, "b").select("x", "y")
    return _ordered(same.unionAll(near).filter(_fits(percent)))


def mixed_crowds(met: DataFrame, roots: DataFrame, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """(node, n, part) of all members of crowded buckets that still hold several components; ``part`` names the component."""
    crowded = met.filter(F.col("size") > small_bucket)
    parts = stage(
        crowded.join(roots.select(F.col("node").alias("_node"), "root"), F.col("node") == F.col("_node"), "left")
        .select("bucket", "node", "n", F.coalesce("root", "node").alias("part")),
        "parts",
    )
    several = stage(parts.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high"), "several")
    return stage(parts.join(several, "bucket").select("node", "n", "part").distinct(), "mixed")


def crowd_candidates(mixed: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs (a, b) of ``mixed`` from different components that can reach the similarity; none is left out.

    Prefix filtering: each set's shingles are put in one order, those of the fewest sets first. Two
    sets as similar as asked share a shingle among the first n - ceil(2s / (1 + s) * n) + 1 of the smaller and the first
    n - ceil(s * n) + 1 of the larger one, and where they first do, enough shingles must follow in both. In texts on one
    template the first shingles are what the texts have of their own, so texts that differ from it by more than a ninth
    meet only where they share more than the template. A shingle of one set alone joins nothing and only takes its place.
    """
    tokens = mixed.join(sets, "node").select("node", "n", "part", F.explode("shingles").alias("token"))
    known = stage(tokens.groupBy("token").agg(F.count("*").alias("n_sets")).filter("n_sets > 1"), "frequencies")
    common = F.sort_array(F.collect_list(F.struct("n_sets", "token")))
    ranked = tokens.join(known, "token").groupBy("node", "n", "part").agg(common.alias("common"))

    alone = F.col("n") - F.size("common")

    def prefix(least_common):
        """(token, left): the first common shingles and how many shingles of the set there are from each on."""
        first = F.slice("common", 1, F.greatest(F.col("n") - least_common + 1 - alone, F.lit(0)).cast("int"))
        return F.transform(first, lambda c, i: F.struct(c["token"].alias("token"), (F.size("common") - i).alias("left")))

    ranked = stage(
        ranked.select(
            F.struct("node", "n", "part").alias("set"),
            prefix(F.expr(f"(2 * {percent} * n + {99 + percent}) div {100 + percent}")).alias("smaller"),
            prefix(F.expr(f"({percent} * n + 99) div 100")).alias("larger"),
        ),
        "prefixes",
    )
    x = ranked.select(F.col("set").alias("x"), F.inline("smaller").alias("token", "x_left"))
    y = ranked.select(F.col("set").alias("y"), F.inline("larger").alias("token", "y_left"))
    turn = F.struct("x.n", "x.node") < F.struct("y.n", "y.node")
    enough = (100 + percent) * F.least("x_left", "y_left") >= percent * (F.col("x.n") + F.col("y.n"))
    return _ordered(x.join(y, "token").filter(turn & (F.col("x.part") != F.col("y.part")) & _fits(percent) & enough))


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose whole shingle sets (node, shingles) have a Jaccard similarity of ``percent`` or more."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    counted = pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("n"), (F.size("sa") + F.size("sb")).alias("both"))
    return counted.filter((100 + percent) * F.col("n") >= percent * F.col("both")).select("a", "b")


def _few(rows: DataFrame) -> DataFrame:
    """Narrow rows, broadcast if there are at most 2**20 of them."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def _same(left: str, right: str):
    return [F.col(f"{left}{name}").eqNullSafe(F.col(f"{right}{name}")) for name in ("key", "h1", "h2")]


def linked_sets(sets: DataFrame, whole: DataFrame, percent: int, width: int, small_bucket: int) -> DataFrame:
    """(node, root) of all sets that are linked, but the roots; ``whole`` has the texts (key, h1, h2, text) of the sets' first rows."""
    met = bucket_members(sets)
    pairs = stage(simhash_candidates(sets, percent).unionAll(candidates(met, percent, small_bucket)).distinct(), "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    first = sets.join(needed, "node", "left_semi").select("node", *[F.col(f"first.{c}").alias(f"f_{c}") for c in ("key", "h1", "h2")])
    texts = whole.withColumnsRenamed({c: f"w_{c}" for c in ("key", "h1", "h2")}).join(_few(stage(first, "needed")), _same("w_", "f_"))
    # Rows that repeat have equal sets; one is enough.
    shingles = texts.select("node", shingle_column("text", width).alias("shingles")).dropDuplicates(["node"])
    shingles = stage(shingles, "shingles")
    links = stage(verified(pairs, shingles, percent), "verified")
    roots = stage(components(links), "roots")
    mixed = mixed_crowds(met, roots, small_bucket)
    if mixed.isEmpty():
        return roots
    more = stage(verified(crowd_candidates(mixed, shingles, percent), shingles, percent), "verified")
    return roots if more.isEmpty() else stage(components(links.unionAll(more)), "roots")


def drop_near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WIDTH,
    small_bucket: int = SMALL_BUCKET,
) -> DataFrame:
    """Keep one row of each component of near copies, with all its columns: the smallest key, missing ones last.

    Two rows are linked if the sets of their word shingles are equal or have a Jaccard
    similarity of at least ``percent`` hundredths. Equal sets are one node, so a text that
    fills a third of the table takes part once. Pairs are found by SimHash, as in op6 but on these
    shingles, and, as copies of this similarity mostly differ in more bits than an index of 64-bit
    fingerprints can bridge, by MinHash besides. No link is made that the whole sets don't confirm. A missing text is empty; texts without words are equal. Of rows that
    tie, also of repeated rows, exactly one stays. Rows are named by key and 128 hash bits of the text;
    documents are read where their text is needed and else pass by the narrow tables, and in the
    end only the names of dropped and of repeated rows are joined to them.
    """
    source = docs.select(F.struct("*").alias("_doc")).select("_doc", F.col("_doc")[key].alias("key"), whole_text(f"_doc.`{text}`").alias("text"))
    named = source.select("_doc", "key", *two_hashes(F.col("text")), "text")
    sketched = named.select("key", "h1", "h2", sketch_column("text", width).alias("_sketch"))
    marked = stage(sketched.select("key", "h1", "h2", "_sketch.*"), "marked")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "h1", "h2")
    grouped = marked.groupBy("digest").agg(F.any_value("n").alias("n"), F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands"), F.min(order).alias("first"))
    sets = stage(grouped.withColumn("node", F.monotonically_increasing_id()), "sets")
    roots = linked_sets(sets, named.select("key", "h1", "h2", "text"), percent, width, small_bucket)
    in_group = sets.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        "digest", "first", F.coalesce("root", "node").alias("root")
    )
    firsts = stage(in_group.groupBy("root").agg(F.min("first").alias("best")), "firsts")
    best = in_group.join(firsts, "root").select("digest", "best")
    rows = marked.groupBy("key", "h1", "h2").agg(F.any_value("digest").alias("digest"), F.count("*").alias("n_rows"))
    judged = stage(rows, "rows").join(best, "digest")
    stays = F.col("key").eqNullSafe(F.col("best.key")) & (F.col("h1") == F.col("best.h1")) & (F.col("h2") == F.col("best.h2"))
    names = [F.col(c).alias(f"f_{c}") for c in ("key", "h1", "h2")]
    special = stage(judged.select(*names, stays.alias("stays"), "n_rows").filter("not stays or n_rows > 1"), "special")
    whole = named.select("_doc", *[F.col(c).alias(f"w_{c}") for c in ("key", "h1", "h2")])
    untouched = whole.join(_few(special), _same("w_", "f_"), "left_anti").select("_doc.*")
    repeated = special.filter("stays")
    if repeated.isEmpty():
        return untouched
    once = whole.join(_few(repeated), _same("w_", "f_"), "left_semi").groupBy("w_key", "w_h1", "w_h2")
    return untouched.unionAll(once.agg(F.any_value("_doc").alias("_doc")).select("_doc.*"))
