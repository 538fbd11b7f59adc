"""Boilerplate lines: lines that many sites share are cut from all documents but the first."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import BLANKS, two_hashes, whole_text

MIN_SITES = 10
LG_REGISTERS = 8


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg: int = LG_REGISTERS) -> DataFrame:
    """Lines (h1, h2) on at least ``min_sites`` different sites, with the smallest document that has each.

    ``lines`` has (h1, h2, site, doc). Sites per line are counted by HyperLogLog sketches,
    which merge on the map side. 2**8 registers err by 6.5 % (one standard deviation), so
    an estimate over twice or under half the limit is over seven deviations off; only
    lines between these get exact counts, of sites already made distinct on the map side.
    """
    sketched = stage(
        lines.groupBy("h1", "h2")
        .agg(F.hll_sketch_agg("site", F.lit(lg)).alias("sketch"), F.min("doc").alias("first_doc"))
        .select("h1", "h2", "first_doc", F.hll_sketch_estimate("sketch").alias("sites"))
        .filter(F.col("sites") * 2 >= min_sites),
        "spread",
    )
    sure = sketched.filter(F.col("sites") > 2 * min_sites).select("h1", "h2", "first_doc")
    near = sketched.filter(F.col("sites") <= 2 * min_sites).select("h1", "h2", "first_doc")
    exact = (
        lines.filter("site is not null")
        .join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("sites"))
        .filter(F.col("sites") >= min_sites)
        .select("h1", "h2")
    )
    return stage(sure.unionAll(near.join(exact, ["h1", "h2"])), "boilerplate")


def _without(text: Column, removed: Column) -> Column:
    """Join the lines that stand between the removed places (sorted, from 0)."""

    def joined(p):
        lines, gone = p["lines"], p["gone"]
        after = lambda k: F.when(k == 0, 0).otherwise(F.get(gone, k - 1) + 1)
        until = lambda k: F.coalesce(F.get(gone, k), F.size(lines))
        kept = F.transform(
            F.sequence(F.lit(0), F.size(gone)), lambda k: F.slice(lines, after(k) + 1, until(k) - after(k))
        )
        return F.array_join(F.flatten(kept), "\n")

    pair = F.array(F.struct(F.split(text, "\n", -1).alias("lines"), removed.alias("gone")))
    return F.element_at(F.transform(pair, joined), 1)


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source",
    min_sites: int = MIN_SITES, lg: int = LG_REGISTERS,
) -> DataFrame:
    """All rows with all columns as (_doc, text, n_lines, n_removed): ``text`` is without boilerplate lines.

    Lines are cut at \\n and compared without the blanks around them; lines without a word
    stay. A line on ``min_sites`` or more different sites (a missing site is none) is
    boilerplate, however large the table is: it stays in the document with the smallest key that has it and goes
    from all others. So nothing is lost for good, also not a text that was copied to
    many sites. A document without a key is never the first. A missing text stays missing.
    Repeated rows are treated alike; tables without rows give none.
    """
    source = docs.select(F.struct("*").alias("_doc")).select(
        "_doc", F.col("_doc")[text].cast("string").alias("text"), F.col("_doc")[key].alias("doc"),
        F.col("_doc")[site].cast("string").alias("site"),
    )
    whole = whole_text("text")
    named = [F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(1), whole).alias("t2")]
    lines = stage(
        source.select("doc", "site", *named, F.posexplode(F.split(whole, "\n", -1)).alias("pos", "line"))
        .filter(_trimmed(F.col("line")) != "")
        .select("doc", "site", "t1", "t2", "pos", *two_hashes(_trimmed(F.col("line")))),
        "lines",
    )
    removed = (
        lines.join(spread_lines(lines, min_sites, lg), ["h1", "h2"])
        .filter(~F.col("doc").eqNullSafe(F.col("first_doc")))
        .groupBy("doc", "t1", "t2")
        .agg(F.sort_array(F.collect_set("pos")).alias("gone"))
        .withColumnsRenamed({"doc": "g_doc", "t1": "g1", "t2": "g2"})
    )
    rows = source.select("_doc", "text", "doc", *named)
    same = rows["doc"].eqNullSafe(removed["g_doc"]) & (F.col("t1") == F.col("g1")) & (F.col("t2") == F.col("g2"))
    return rows.join(removed, same, "left").select(
        "_doc",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("gone"))).alias("text"),
        F.size(F.split(whole, "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def without_boilerplate(docs: DataFrame, text: str = "text", chars: str = "n_chars", **options) -> DataFrame:
    """The documents with their own columns; the text is cut, and its length in ``chars`` counted anew."""
    cut = dedup_lines(docs, text=text, **options)
    fields = [
        F.col("text").alias(name)
        if name == text
        else F.length("text").cast(docs.schema[name].dataType).alias(name)
        if name == chars
        else F.col("_doc")[name].alias(name)
        for name in docs.columns
    ]
    return cut.select(*fields)
