"""Near duplicates by 64-bit SimHash, found with a generalised pigeonhole index."""

from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import whole_text
from .components import components

BITS = 64
SEED = 42
SMALL_BUCKET = 64
SHINGLES_AT_ONCE = 1 << 16


def votes_of(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set."""
    bits = np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def majority(votes: np.ndarray, n: int) -> int:
    """The fingerprint, as a signed long: the bits that over half of ``n`` hashes have set."""
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def fingerprint(raw: bytes, width: int = 3) -> int:
    """SimHash of the word shingles of a text in UTF-8; a text without words has 0.

    bytes.lower and bytes.split know just the ASCII letters and the six ASCII blanks.
    """
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        stop = min(n, at + SHINGLES_AT_ONCE)
        votes += votes_of(np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:stop], ends[at:stop])], dtype="<u8"))
    return majority(votes, n)


def fingerprint_column(text: str, width: int = 3):
    """The fingerprint of a text column as a signed long; texts go to Python in Arrow batches."""

    @F.arrow_udf("long")
    def of_batch(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(raw.as_py(), width) for raw in texts], pa.int64())

    return of_batch(whole_text(text).cast("binary"))


class Part(NamedTuple):
    """Some of the 64 bits, and how many of them may differ in a probe; -1: no probe."""

    bits: tuple[int, ...]
    threshold: int


def bit_counts(fingerprints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how often bit i and bit j are both set, over all of them."""

    def counted(batches):
        total, both = 0, np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            raw = np.asarray(batch.column(0)).astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float64)
            total, both = total + len(bits), both + (bits.T @ bits).astype(np.int64)
        if total:
            i, j = np.triu_indices(BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*i.tolist(), -1]), pa.array([*j.tolist(), -1]), pa.array([*both[i, j].tolist(), total])],
                ["i", "j", "n"],
            )

    rows = (
        fingerprints.mapInArrow(counted, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    )
    total, both = 0, np.zeros((BITS, BITS))
    for i, j, n in rows:
        if i < 0:
            total = n
        else:
            both[i, j] = both[j, i] = n
    return total, both


def group_bits(total: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Deal the bits to parts of even width so that correlated bits share a part."""
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.clip(share * (1 - share), 1e-12, None))
    related = np.abs((both / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread))
    left, groups = list(range(BITS)), []
    for k in range(parts):
        width = BITS * (k + 1) // parts - BITS * k // parts
        seed = max(left, key=lambda b: (related[b, left].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < width:
            nearest = max(left, key=lambda b: (related[b, group].sum(), -b))
            group.append(nearest)
            left.remove(nearest)
        groups.append(tuple(sorted(group)))
    return groups


def allocate(total: int, both: np.ndarray, most: int) -> list[Part]:
    """Choose the number of parts and their thresholds by the smallest estimated work.

    If k bits differ in all, some part differs in at most its threshold, provided that the
    thresholds sum up to k - parts + 1. A part's work is its probes plus the pairs that
    are estimated to meet in it, from how often its bits differ between two fingerprints.
    """
    share = np.diag(both) / max(total, 1)
    best_cost, best_parts = None, []
    for n_parts in range(1, most + 3):
        groups = group_bits(total, both, n_parts)
        state = {0: (0.0, ())}  # sum of thresholds so far -> work, thresholds
        for group in groups:
            differ = np.array([1.0])
            for b in group:
                p = 2 * share[b] * (1 - share[b])
                differ = np.convolve(differ, [1 - p, p])
            after = {}
            for spent, (cost, chosen) in state.items():
                for t in range(-1, most + 1):
                    probes = total * sum(comb(len(group), r) for r in range(t + 1))
                    pairs = total * total / 2 * differ[: t + 1].sum()
                    option = (cost + probes + pairs, (*chosen, t))
                    if spent + t not in after or option < after[spent + t]:
                        after[spent + t] = option
            state = after
        cost, chosen = state.get(most - n_parts + 1, (None, ()))
        if cost is not None and (best_cost is None or cost < best_cost):
            best_cost, best_parts = cost, [Part(g, t) for g, t in zip(groups, chosen)]
    return best_parts


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _flips(bits, most: int) -> list[int]:
    """All masks of up to ``most`` of the bits, no bit first."""
    masks = [0]
    for _ in range(most):
        masks = list(dict.fromkeys([*masks, *(m ^ (1 << b) for m in masks for b in bits if not m >> b & 1)]))
    return [_signed(m) for m in masks]


def probes(fingerprints: DataFrame, parts: list[Part]) -> DataFrame:
    """Rows (part, bucket, fp, home): the own bucket of each fingerprint in each part, and its neighbours."""
    rows = None
    for number, part in enumerate(parts):
        if part.threshold < 0:
            continue
        mask = F.lit(_signed(sum(1 << b for b in part.bits)))
        flips = F.array(*[F.lit(m).cast("long") for m in _flips(part.bits, part.threshold)])
        here = fingerprints.select(F.lit(number).alias("part"), "fp", F.explode(flips).alias("flip")).select(
            "part",
            F.col("fp").bitwiseAND(mask).bitwiseXOR(F.col("flip")).alias("bucket"),
            "fp",
            (F.col("flip") == 0).alias("home"),
        )
        rows = here if rows is None else rows.unionAll(here)
    return rows


def verified_links(members: DataFrame, most: int) -> DataFrame:
    """Compare the members of small buckets; links (a, b) of a spanning forest per bucket."""

    def compared(batches):
        for batch in batches:
            a, b = [], []
            for bucket in batch.column(0).to_pylist():
                root = list(range(len(bucket)))
                for j, right in enumerate(bucket):
                    for i in range(j):
                        left = bucket[i]
                        if (
                            (left["home"] or right["home"])
                            and root[i] != root[j]
                            and ((left["fp"] ^ right["fp"]) & 0xFFFFFFFFFFFFFFFF).bit_count() <= most
                        ):
                            old, new = root[j], root[i]
                            root = [new if r == old else r for r in root]
                            a.append(left["fp"])
                            b.append(right["fp"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    buckets = members.groupBy("part", "bucket").agg(F.collect_list(F.struct("fp", "home")).alias("members"))
    return buckets.select("members").mapInArrow(compared, "a long, b long")


def shared_neighbours(fingerprints: DataFrame, most: int) -> DataFrame:
    """Links of crowded buckets without comparing pairs.

    Two values differ in at most 2r bits just if flipping up to r bits of each can give the
    same value, so all fingerprints that share such a value are linked to its smallest.
    An odd limit takes one flip more on one side: its own value stands for the other side.
    """
    near, far = most // 2, most - most // 2
    masks = _flips(range(BITS), far)
    inner = set(_flips(range(BITS), near))
    flips = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m in inner).alias("near")) for m in masks])
    keys = fingerprints.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip.m")).alias("spot"), F.col("flip.near").alias("near")
    )
    if near == far:
        least = keys.groupBy("spot").agg(F.min("fp").alias("least"), F.max("fp").alias("greatest"))
    else:
        least = keys.filter("near").groupBy("spot").agg(F.min("fp").alias("least"), F.lit(None).cast("long").alias("greatest"))
    met = least.filter("greatest is null or least <> greatest")
    return (
        keys.join(met, "spot").filter("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()
    )


def linked_fingerprints(fingerprints: DataFrame, most: int = 2, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Links between distinct fingerprints (column fp) whose transitive closure is that of all pairs
    that differ in at most ``most`` bits.

    Buckets of up to ``small_bucket`` rows are compared within a task. Members of larger
    ones meet by shared neighbours instead, which takes a fixed number of rows each, so
    no bucket is ever gathered whole or compared pair by pair.
    """
    total, both = bit_counts(fingerprints)
    parts = allocate(total, both, most)
    rows = probes(fingerprints, parts)
    sizes = rows.groupBy("part", "bucket").agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
    # Stored first, so that Spark can split the join at a bucket that holds many rows.
    crowds = stage(sizes.filter("n > 1 and homes > 0"), "buckets")
    met = stage(rows.join(crowds, ["part", "bucket"]), "probes")
    small = verified_links(met.filter(F.col("n") <= small_bucket), most)
    crowded = met.filter(F.col("n") > small_bucket).select("fp").distinct()
    return small.unionAll(shared_neighbours(crowded, most))


def group_fingerprints(marked: DataFrame, most: int, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """(fp, root) of every distinct fingerprint of ``marked``; ``root`` names its component."""
    distinct = stage(marked.select("fp").distinct(), "fingerprints")
    roots = components(linked_fingerprints(distinct, most, small_bucket))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def simhash_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = 2, width: int = 3,
    small_bucket: int = SMALL_BUCKET,
) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one per row of ``docs``.

    Fingerprints of word shingles link at ``most`` or fewer differing bits;
    ``component_id`` is the smallest key that can be reached, missing keys aside (missing
    if no other is there). A missing text is empty; texts without words share
    fingerprint zero and are linked like any others. Repeated rows are returned each.
    Other columns are not read.
    """
    marked = stage(
        docs.select(F.col(key).alias("doc_id"), fingerprint_column(text, width).alias("fp")), "marked"
    )
    smallest = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    of_root = smallest.join(group_fingerprints(marked, most, small_bucket), "fp")
    component = stage(of_root.select("fp", "root", "least"), "roots")
    least = component.groupBy("root").agg(F.min("least").alias("component_id"))
    named = component.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = 2, width: int = 3
) -> DataFrame:
    """Keep one row of each component, with all its columns: the smallest key, missing ones last.

    Of rows that tie, also of repeated rows, exactly one stays.
    """
    marked = stage(
        docs.select(F.struct("*").alias("_doc"), whole_text(text).alias("_whole"))
        .select("_doc", fingerprint_column("_whole", width).alias("fp"))
        .withColumn("_row", F.monotonically_increasing_id()),
        "marked",
    )
    narrow = marked.select("fp", "_row", F.col("_doc")[key].alias("key"))
    firsts = (
        narrow.join(stage(group_fingerprints(narrow, most), "roots"), "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("key").isNull(), "key", "_row")).alias("first"))
        .select(F.col("first._row").alias("_row"))
    )
    return marked.join(firsts, "_row", "left_semi").select("_doc.*")
