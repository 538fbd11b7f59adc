"""From raw documents to packed training sequences, stage by stage."""

from namewright.llm.line_dedup import without_boilerplate
from namewright.llm.near_copies import drop_near_copies
from namewright.llm.quality import keep_quality
from namewright.llm.queries import packed_documents
from namewright.session import stage


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the quality rules."""
    return keep_quality(docs)


def line_dedup(spark, docs, sf_dir):
    """The same documents without boilerplate lines, which stay in their first document alone."""
    return without_boilerplate(docs)


def near_copies(spark, docs, sf_dir):
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more, by SimHash and MinHash."""
    return drop_near_copies(docs)


def best_fit_packing(spark, docs, sf_dir):
    """Pieces of all documents and their places in training sequences."""
    return packed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("best_fit_packing", best_fit_packing),
]

# Tokens and fingerprints have no counterpart in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on the documents of a folder; each stage is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
