"""The registered queries of the corpus operators."""

from pyspark.sql import functions as F

from .bpe import encode_documents
from .chat import format_trees, read_loss, read_turns
from .common import range_ranked
from .conversation_repair import damage_and_repair
from .exact_dedup import exact_dedup
from .fill_middle import fill_in_middle, restored
from .html_text import extract_main_text
from .line_dedup import dedup_lines
from .packing import pack, token_pieces
from .quality import quality_report
from .quality_model import fit, score_documents
from .sharding import assign_shards
from .simhash import simhash_groups
from .token_counts import token_counts

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def read(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query
def op1_quality_rules(spark, sf_dir):
    return quality_report(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op2_html_extraction(spark, sf_dir):
    return extract_main_text(read(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op3_bpe_encoding(spark, sf_dir):
    return encode_documents(read(spark, sf_dir, "documents", "doc_id", "text"))


def conversation_messages(turns):
    """Each turn replies to the one before it; ties are ordered by role and text."""
    ranked = range_ranked(turns, "conv_id", ["turn", "role", "text"], "turns", "id")
    return ranked.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("none")).alias("tree"),
        "conv_id",
        "id",
        F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


@query
def op4_chat_formatting(spark, sf_dir):
    control = "</s>[INST] ok [/INST]"
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(
            [(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string"
        )
    )
    formatted = format_trees(conversation_messages(turns))
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    read_back = formatted.select(
        F.when(F.col("tree") != "none", F.expr("substring(tree, 2)").cast("long")).alias("conv_id"),
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return read_back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def packed_documents(docs):
    """Pieces of all documents with their ids, a digest of these, and where each is packed."""
    return pack(token_pieces(docs)).withColumn("ids_crc32", F.crc32("ids").cast("long"))


@query
def op5_best_fit_packing(spark, sf_dir):
    return packed_documents(read(spark, sf_dir, "documents", "doc_id", "text")).drop("ids")


@query
def op6_simhash_dedup(spark, sf_dir):
    return simhash_groups(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op7_sharding(spark, sf_dir):
    return assign_shards(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op8_token_counts(spark, sf_dir):
    return token_counts(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_line_dedup(spark, sf_dir):
    cut = dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return cut.select(F.col("_doc.doc_id").alias("doc_id"), "text", "n_lines", "n_removed")


@query
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_quality_classifier(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return score_documents(docs, model).select("_doc.doc_id", "held_out", "score", "predicted")


@query
def op12_fill_in_middle(spark, sf_dir):
    made = fill_in_middle(read(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select(
        "_doc.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        "output_sha256",
        restored("output", "form")["sha256"].alias("restored_sha256"),
    )


@query
def op13_conversation_repair(spark, sf_dir):
    return damage_and_repair(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
