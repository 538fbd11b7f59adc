"""Very long texts are judged by the same ratios as others, and need memory for little but themselves."""

import tracemalloc

import corpus_pipeline
from namewright.llm import quality, queries, token_counts


def test_quality_keeps_very_long_texts(spark, tmp_path):
    clean = "\n".join(f"the word{i} of page{i} and line{i} in book{i}" for i in range(130_000))
    junk = "\n".join(f"the #a{i} #b{i} $c{i} in #d{i} of" for i in range(150_000))
    rows = [(1, clean), (2, junk)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in quality.quality_report(table).collect()}
    assert all(got[k].n_words > 1_000_000 for k in (1, 2))
    assert got[1].kept and not got[2].kept and not got[2].base_failed
    table.write.parquet(f"{tmp_path}/documents.parquet")
    judged = {r.doc_id: r.kept for r in queries.op1_quality_rules(spark, str(tmp_path)).collect()}
    assert judged == {1: True, 2: False}
    kept = dict(corpus_pipeline.STAGES)["quality_rules"](spark, table, "")
    assert [r.doc_id for r in kept.select("doc_id").collect()] == [1]


def test_token_counts_of_texts_without_spaces_need_little_memory():
    counter = token_counts.UnigramCounter([("a", -1.0), ("aba", -2.0), ("ab", -1.5), ("▁", 0.0)])
    plain = "abaxé" * 4000
    short = counter.count(plain[:50])
    tracemalloc.start()
    try:
        assert counter.count(plain) - 1 == 400 * (short - 1)
        assert counter.count("aba" * 300_000) == 300_001
        assert tracemalloc.get_traced_memory()[1] < 20_000_000  # 22 bytes a character
    finally:
        tracemalloc.stop()
