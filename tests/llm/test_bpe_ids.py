"""The BPE encoder hands out ids, and ids decode to text."""

import numpy as np
import pytest

from namewright.llm import bpe


def test_ids_and_decoded_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    shared = " ".join(f"word{i % 37} naïve{i % 5}" for i in range(400))
    texts = [None, "", "a text of its own", *[f"start {k} {shared} end {k}" for k in range(6)]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    made = bpe.document_ids(table, cut_bits=5, slot_bits=16)
    ids = {r.doc_id: np.frombuffer(r.ids, bpe.codec().kind).tolist() for r in made.collect()}
    assert ids == {k: exact.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(texts)}
    back = {r.doc_id: r.text for r in bpe.decode_documents(made).collect()}
    assert back == {k: exact.decode(v, skip_special_tokens=False) for k, v in ids.items()}


@pytest.mark.parametrize("slot_bits", [4, 6, 9, 20])
def test_load_of_the_table_changes_no_result(spark, slot_bits):
    """From about 30 and 3 marks a slot to nearly none; string keys, missing ones, clashing names."""
    exact = bpe.codec().tokenizer
    passage = [" ".join(f"w{(7 * i + k) % 91}" for i in range(60)) for k in range(8)]
    texts = [f"head{i} {passage[i % 8]} middle{i} {passage[(i + 3) % 8]} " + "x" * i for i in range(60)]
    rows = [*[(f"k{i}", t) for i, t in enumerate(texts)], (None, texts[0]), ("none", None), ("k1", texts[1])]
    table = spark.createDataFrame(rows, "id string, body string").selectExpr("*", "1 as part", "2 as ids").repartition(3)
    made = bpe.document_ids(table, key="id", text="body", cut_bits=5, slot_bits=slot_bits).collect()
    got = sorted((r.doc_id or "", np.frombuffer(r.ids, bpe.codec().kind).tolist()) for r in made)
    assert got == sorted((k or "", exact.encode(t or "", add_special_tokens=False).ids) for k, t in rows)


def test_share_of_keys_and_size_of_the_table(spark, monkeypatch):
    """The table follows the parts; past its largest size only a share of the parts is looked up."""
    assert bpe.table_size(0) == (bpe.LEAST_SLOT_BITS, 0) and bpe.table_size(2_000_000) == (25, 0)
    bits, skip = bpe.table_size(400_000_000_000)
    assert bits == bpe.MOST_SLOT_BITS and 2 * 400_000_000_000 >> skip <= 1 << bits
    monkeypatch.setattr(bpe, "LEAST_SLOT_BITS", 6)
    monkeypatch.setattr(bpe, "MOST_SLOT_BITS", 6)
    shared = " ".join(f"word{i % 53}" for i in range(900))
    texts = [f"{k} {shared} {k}" for k in range(40)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert bpe.repeated_slots(table, "text", 5).skip > 3
    ids = {r.doc_id: np.frombuffer(r.ids, bpe.codec().kind).tolist() for r in bpe.document_ids(table, cut_bits=5).collect()}
    assert ids == {k: bpe.codec().tokenizer.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts)}


def test_long_words_are_not_remembered():
    tool = bpe.Codec(bpe.VOCABULARY)
    raw = b"short " + b"y" * 500 + b" short"
    assert np.frombuffer(tool.encode(raw), tool.kind).tolist() == tool.tokenizer.encode(raw.decode(), add_special_tokens=False).ids
    assert set(tool.known) == {b"short"}


def test_full_word_tables_change_no_ids(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_IN_MEMORY", 8)
    tool = bpe.Codec(bpe.VOCABULARY)
    for k in range(30):
        raw = " ".join(f"the w{(i * k) % 23} of x{k}" for i in range(6)).encode()
        assert np.frombuffer(tool.encode(raw), tool.kind).tolist() == tool.tokenizer.encode(raw.decode(), add_special_tokens=False).ids
        assert len(tool.known) <= 24 and len(tool.older) <= 24
