"""Best-fit packing of token sequences of fixed room."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import range_ranked, whole_text

ROOM = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
# Fixed value: the one special token of the vocabulary.
SPECIAL = "<|endoftext|>"
_ENCODERS: dict = {}


def encoder(vocabulary: str = VOCABULARY):
    """A function from a text to its ids, as the vocabulary's tokenizers file gives them.

    The same merges stand in a rank file that a faster encoder reads. It gives the same
    ids for every code point; only texts that spell out the special token take the other
    way. One encoder per Python worker.
    """
    if vocabulary not in _ENCODERS:
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        exact.no_truncation()
        exact.no_padding()

        def encode(text: str) -> np.ndarray:
            if SPECIAL in text:
                return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
            return np.asarray(fast.encode_to_numpy(text, disallowed_special=())).astype("<u4")

        _ENCODERS[vocabulary] = encode
    return _ENCODERS[vocabulary]


def token_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", room: int = ROOM, vocabulary: str = VOCABULARY
) -> DataFrame:
    """(doc_id, piece, start, length, ids): every text's ids and the end id, cut to ``room``.

    ``ids`` are little-endian unsigned 32-bit numbers. All pieces but the first of a text
    fill the room; the first takes what is left over. A missing text is empty and has
    just the end id. Repeated rows are cut each. Keys keep their type.
    """

    def pieces(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.binary()]

            def flush(out=out, kinds=kinds):
                return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

            held = 0
            for doc_id, whole in zip(batch.column(0), batch.column(1)):
                ids = np.append(encode(whole.as_py()), np.uint32(END_ID)).astype("<u4")
                raw, n, start = ids.tobytes(), len(ids), 0
                for piece in range((n + room - 1) // room):
                    stop = start + (room if piece else (n - 1) % room + 1)
                    for name, value in zip(out, (doc_id.as_py(), piece, start, stop - start, raw[4 * start : 4 * stop])):
                        out[name].append(value)
                    start = stop
                held += len(raw)
                if held > 16 << 20:
                    yield flush()
                    held = 0
                    for values in out.values():
                        values.clear()
            yield flush()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text")).mapInArrow(
        pieces, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


class Placed(NamedTuple):
    """Pieces of one length with ranks from ``first`` on go to sequences from ``sequence`` on,
    ``each`` to a sequence, where ``used`` tokens stand already."""

    length: int
    first: int
    sequence: int
    each: int
    used: int


def best_fit(counts: dict[int, int], room: int) -> tuple[list[Placed], int]:
    """Bulk-synchronous best fit, longest pieces first, on counts per length.

    One round per length: all its pieces together look for the successor of their length
    among the gaps, the smallest gap that holds them. Gaps of one size form ranges of
    sequence numbers, pieces of one length a range of ranks, so conflicts are settled by
    rank: the k-th pieces take the k-th gap. Gaps are updated and the sweep is repeated
    until the round's pieces are placed or open new sequences. The result is that of
    sequential best fit decreasing. The work and the result are bounded by the room
    alone (at most 45 different lengths fill a sequence of 1024), not by the documents.
    Returns the placements and the number of sequences.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    placed, sequences = [], 0

    def fill(length, rank, left, low, high, free):
        """Put pieces into sequences low..high of the same free room; returns pieces placed."""
        each, used = free // length, room - free
        full = min(high - low, left // each)
        if full:
            placed.append(Placed(length, rank, low, each, used))
            gaps.setdefault(free - each * length, []).append((low, low + full))
        done, low = full * each, low + full
        if low < high and left > done:  # the last sequence of the round gets fewer
            rest = left - done
            placed.append(Placed(length, rank + done, low, rest, used))
            gaps.setdefault(free - rest * length, []).append((low, low + 1))
            done, low = left, low + 1
        if low < high:
            gaps.setdefault(free, []).append((low, high))
        return done

    for length in range(room, 0, -1):
        left, rank = counts.get(length, 0), 0
        free = length
        while left:
            while free <= room and not gaps.get(free):
                free += 1
            if free > room:
                each = room // length
                new = (left + each - 1) // each
                done = fill(length, rank, left, sequences, sequences + new, room)
                sequences += new
            else:
                low, high = gaps[free].pop()
                done = fill(length, rank, left, low, high, free)
            rank, left = rank + done, left - done
    return placed, sequences


def pack(pieces: DataFrame, room: int = ROOM, order=("doc_id", "piece")) -> DataFrame:
    """Add (sequence_id, offset) to pieces with a ``length`` of at most ``room``, which keep all their columns.

    Pieces are stored once with their ids. Lengths and keys alone are range-sorted and ranked; of them only the
    counts per length (at most ``room``) reach the driver. Each task then looks up where its pieces go, and the
    places are joined to the stored pieces.
    """
    held = stage(pieces.withColumn("_piece", F.monotonically_increasing_id()), "pieces", compression="zstd")
    ranked = range_ranked(held.select("length", *order, "_piece"), "length", order, "ranked", "_rank")
    counts = {row.length: row.n for row in ranked.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if counts and not (1 <= min(counts) and max(counts) <= room):
        raise ValueError(f"pieces must have 1 to {room} tokens")
    placed, _ = best_fit(counts, room)
    placed.sort()
    table = np.array(placed, dtype=np.int64).reshape(-1, len(Placed._fields))
    spots = (table[:, 0] << 44) + table[:, 1]

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def spot(length: pa.Array, rank: pa.Array) -> pa.Array:
        size, rank = np.asarray(length), np.asarray(rank)
        row = table[np.searchsorted(spots, (size << 44) + rank, side="right") - 1]
        after = rank - row[:, 1]
        sequence = row[:, 2] + after // row[:, 3]
        offset = row[:, 4] + after % row[:, 3] * size
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    places = ranked.select("_piece", spot("length", "_rank").alias("_spot")).select("_piece", "_spot.*")
    return held.join(places, "_piece").drop("_piece")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed pieces' ids joined; a sequence is bounded by its room."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_parts"))
    ids = F.unhex(F.array_join(F.transform("_parts", lambda p: F.hex(p["ids"])), ""))
    return joined.select("sequence_id", "length", ids.alias("ids"))
