"""Byte-pair encoding that encodes passages which documents share only once."""

import hashlib
import os
from array import array
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import BLANKS, whole_text

VOCABULARY = "word_bpe_49k.json"
WINDOW = 8
CUT_BITS = 9
LEAST_SLOT_BITS, MOST_SLOT_BITS = 16, 29
SLOTS_PER_PART = 16
WORDS_IN_MEMORY = 1 << 18
LONGEST_REMEMBERED = 64
_CODECS: dict = {}
_BLANK_BYTES = np.zeros(256, dtype=bool)
_BLANK_BYTES[[ord(c) for c in BLANKS]] = True


class Codec:
    """Encodes and decodes text with a tokenizers file in which white space ends every token.

    Words (text between ASCII blanks) encode alike wherever they stand, so the ids of those of
    up to 64 bytes are remembered in a table of bounded size; a full one is kept beside a new one, which takes
    over the words that are met again. Without a decoder in the file, decoding joins
    the tokens' strings with spaces; both directions are lists to join.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # Arrow and Spark run on little-endian machines, so an array's bytes are as ``kind`` says.
        self.kind, self.code = ("<u2", "H") if size <= 1 << 16 else ("<u4", "I")
        self.decimals = [b"%d" % i for i in range(size)]
        self.strings = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(size)]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, raw: bytes) -> bytes:
        """The ids of a text, as little-endian unsigned numbers of ``kind``."""
        words = raw.split()
        known = self.known
        missing = {w for w in words if w not in known}
        if missing:
            if len(known) + len(missing) > WORDS_IN_MEMORY:
                self.older, self.known = known, {}
                known, missing = self.known, set(words)
            older, order = self.older, []
            for word in missing:
                if word in older:
                    known[word] = older[word]
                else:
                    order.append(word)
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in order], add_special_tokens=False)
            known.update(zip(order, [array(self.code, e.ids).tobytes() for e in encoded]))
            joined = b"".join([known[w] for w in words])
            for word in order:
                if len(word) > LONGEST_REMEMBERED:
                    del known[word]
            return joined
        return b"".join([known[w] for w in words])

    def count(self, ids: bytes) -> int:
        return len(ids) // np.dtype(self.kind).itemsize

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, in UTF-8."""
        return b" ".join(map(self.strings.__getitem__, np.frombuffer(ids, dtype=self.kind).tolist()))

    def ids_and_text(self, ids: bytes) -> tuple[int, str, str]:
        """Number of ids, and the digests of their decimal list and of the decoded text."""
        numbers = np.frombuffer(ids, dtype=self.kind).tolist()
        listed = b" ".join(map(self.decimals.__getitem__, numbers))
        return len(numbers), hashlib.sha256(listed).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


def codec(vocabulary: str = VOCABULARY) -> Codec:
    """One codec per Python worker."""
    if vocabulary not in _CODECS:
        _CODECS[vocabulary] = Codec(vocabulary)
    return _CODECS[vocabulary]


def shared_parts(raw: bytes, cut_bits: int = CUT_BITS) -> list[tuple[int, int]]:
    """Start and stop of the inner part of each content-defined chunk of a text.

    A chunk ends where a hash of the last 8 bytes has ``cut_bits`` zero bits, so the same
    passage is cut alike in every document. The join of two chunks has to be encoded anew:
    from the last blank before to the first blank after it, where tokens end whatever
    stands beyond, so that both sides agree with it exactly. What lies between two joins
    is the chunk's inner part, which encodes alike in every document. A chunk with fewer
    than two blanks has none and belongs to the join.
    """
    if len(raw) < WINDOW + 2:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    windows = np.ndarray((len(raw) - WINDOW + 1,), dtype="<u8", buffer=raw, strides=(1,))
    mixed = windows * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    cuts = np.nonzero(mixed >> np.uint64(64 - cut_bits) == 0)[0] + WINDOW
    blanks = np.nonzero(_BLANK_BYTES[data])[0]
    if not len(blanks):
        return []
    edges = np.concatenate(([0], cuts, [len(raw)]))
    first = np.searchsorted(blanks, edges[:-1])
    last = np.searchsorted(blanks, edges[1:]) - 1
    inner = first < last
    return list(zip(blanks[first[inner]].tolist(), blanks[last[inner]].tolist()))


def part_key(part: bytes) -> bytes:
    """128 bits that name a part; two different parts share them with odds of 2**-128."""
    return xxhash.xxh3_128_digest(part)


class Slots(NamedTuple):
    """Which parts of chunks repeat: a bit table of 2**bits slots for the parts whose key starts with ``skip`` zero bits."""

    table: np.ndarray
    bits: int
    skip: int

    def repeated(self, key: bytes) -> bool:
        return reusable(key, self.skip) and all(self.table[s >> 6] >> (s & 63) & 1 for s in places(key, self.bits))


def places(key: bytes, bits: int) -> tuple[int, int]:
    """A part's two slots."""
    mask = (1 << bits) - 1
    return int.from_bytes(key[:8], "little") & mask, int.from_bytes(key[8:], "little") & mask


def reusable(key: bytes, skip: int) -> bool:
    return not skip or int.from_bytes(key[:8], "little") >> (64 - skip) == 0


def table_size(n_parts: int) -> tuple[int, int]:
    """(bits, skip): 16 slots a part, up to 64 MB; of more parts than half its slots only a share of keys is looked up."""
    bits = min(max((SLOTS_PER_PART * n_parts).bit_length(), LEAST_SLOT_BITS), MOST_SLOT_BITS)
    return bits, max(0, (2 * n_parts >> bits).bit_length())


def repeated_slots(docs: DataFrame, text: str, cut_bits: int, slot_bits: int | None = None) -> Slots:
    """Which slots hold two parts or more of the whole corpus.

    A part has two slots, and every part that occurs twice has both bits set. A part that
    shares both slots with others by chance has, too; it is only moved in vain. The table follows the
    number of parts that the bytes of all texts make likely. A corpus of more parts than the largest table
    holds looks up a share of the keys, so that moved data stay in proportion; the other
    parts are encoded where they stand. Neither changes a result.
    """
    whole = docs.select(whole_text(text).cast("binary").alias("raw"))
    size = whole.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    bits, skip = (slot_bits, 0) if slot_bits else table_size(size >> cut_bits)

    def slots(batches):
        for batch in batches:
            found = []
            for raw in batch.column(0).to_pylist():
                for a, b in shared_parts(raw, cut_bits):
                    key = part_key(raw[a:b])
                    if reusable(key, skip):
                        found += places(key, bits)
            values, counts = np.unique(np.array(found, dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], ["slot", "n"])

    counted = whole.mapInArrow(slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = (
        counted.filter("n > 1").groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    )
    table = np.zeros(max(1, (1 << bits) >> 6), dtype=np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return Slots(table, bits, skip)


class Finish(NamedTuple):
    """What is kept of a document's ids: column definitions, and their values from (codec, ids)."""

    columns: str
    values: Callable[[Codec, bytes], tuple]


IDS = Finish("n_tokens long, ids binary", lambda tool, ids: (tool.count(ids), ids))
DIGESTS = Finish("n_tokens long, ids_sha256 string, decoded_sha256 string", lambda tool, ids: tool.ids_and_text(ids))
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}


def _batch(rows: list[tuple], columns: str, key: pa.DataType) -> pa.RecordBatch:
    """A batch of rows that start with the document's key."""
    fields = [field.split(" ") for field in columns.split(", ")]
    names, kinds = ["doc_id", *[name for name, _ in fields]], [key, *[_KINDS[kind] for _, kind in fields]]
    values = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(v), kind) for v, kind in zip(values, kinds)], names)


def encoded_documents(
    docs: DataFrame, finish: Finish, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
    cut_bits: int = CUT_BITS, slot_bits: int | None = None,
) -> DataFrame:
    """Rows (doc_id, *finish.columns), one per row of ``docs``; keys keep their type.

    Three passes. The first counts in which hash slots parts of chunks repeat. The second
    finishes documents without repeated parts on the spot. Of the others it encodes the
    joins and the parts that stand alone, and sends out each repeated part once per task.
    Those are then encoded once each, and the last pass puts their ids where the documents
    have them. Of finished documents only what ``finish`` keeps is stored. A missing text is empty: no ids. Repeated rows are
    encoded each. Columns other than key and text are not read.
    """
    source = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(repeated_slots(source, "_text", cut_bits, slot_bits))
    key_kind = source.schema["doc_id"].dataType.simpleString()
    columns, values = finish
    unfinished = "between array<binary>, keys array<binary>, part binary"
    nothing = (None,) * len(columns.split(", "))

    def second(batches):
        tool, slots = codec(vocabulary), shared.value
        sent: set[bytes] = set()
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, between, at = [], [], 0
                for a, b in shared_parts(raw, cut_bits):
                    name = part_key(raw[a:b])
                    if not slots.repeated(name):
                        continue
                    if name not in sent:
                        if len(sent) >= 1 << 18:
                            sent.clear()
                        sent.add(name)
                        rows.append((None, *nothing, None, [name], raw[a:b]))
                    between.append(tool.encode(raw[at:a]))
                    keys.append(name)
                    at = b
                if keys:
                    between.append(tool.encode(raw[at:]))
                    rows.append((doc_id, *nothing, between, keys, None))
                else:
                    rows.append((doc_id, *values(tool, tool.encode(raw)), None, None, None))
            yield _batch(rows, f"{columns}, {unfinished}", batch.schema.field(0).type)

    passed = stage(
        source.select("doc_id", F.col("_text").cast("binary").alias("raw"))
        .mapInArrow(second, f"doc_id {key_kind}, {columns}, {unfinished}")
        .withColumn("_row", F.monotonically_increasing_id()),
        "encoded",
    )

    def encode_parts(batches):
        tool = codec(vocabulary)
        for batch in batches:
            ids = [tool.encode(part) for part in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["key", "ids"])

    parts = passed.filter("part is not null").select(F.get("keys", F.lit(0)).alias("key"), "part")
    encoded = stage(parts.dropDuplicates(["key"]).mapInArrow(encode_parts, "key binary, ids binary"), "parts")
    waiting = passed.filter("between is not null")
    filled = (
        waiting.select("_row", F.posexplode("keys").alias("pos", "key"))
        .join(encoded, "key")
        .groupBy("_row")
        .agg(F.collect_list(F.struct("pos", "ids")).alias("parts"))
    )

    def last(batches):
        tool = codec(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, between, parts in zip(*[column.to_pylist() for column in batch.columns]):
                pieces = [ids for known in zip(between, [None] * len(between)) for ids in known]
                for part in parts:
                    pieces[2 * part["pos"] + 1] = part["ids"]
                rows.append((doc_id, *values(tool, b"".join(pieces[:-1]))))
            yield _batch(rows, columns, batch.schema.field(0).type)

    joined = waiting.select("_row", "doc_id", "between").join(filled, "_row")
    assembled = joined.select("doc_id", "between", "parts").mapInArrow(last, f"doc_id {key_kind}, {columns}")
    finished = passed.filter("between is null and part is null")
    return finished.select(*assembled.columns).unionByName(assembled)


def document_ids(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, n_tokens, ids); ``ids`` are numbers of the codec's ``kind``. Options as of ``encoded_documents``."""
    return encoded_documents(docs, IDS, **options)


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (doc_id, text): the decoded text of every row (doc_id, ids)."""
    key_kind = encoded.schema["doc_id"].dataType.simpleString()

    def decoded(batches):
        tool = codec(vocabulary)
        for batch in batches:
            texts = [tool.decode(ids).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {key_kind}, text string")


def encode_documents(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): digests of each document's ids and of the text they decode to."""
    return encoded_documents(docs, DIGESTS, **options)
