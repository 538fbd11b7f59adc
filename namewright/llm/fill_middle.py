"""Fill-in-the-middle training texts by piece tables: descriptors are cut and permuted, texts stay where they are."""

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

# The marks before prefix, suffix and middle.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
# The order of the three parts in the output of each form.
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PARTS = ("prefix", "middle", "suffix")
TEXT, MARK = 0, 1
MARK_BUFFER = b"".join(MARKS.values())
PERCENT, SPM_PERCENT = 90, 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
PIECE_TYPE = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))


class Piece(NamedTuple):
    """``length`` bytes from ``start`` on of an immutable buffer: TEXT or MARK."""

    buffer: int
    start: int
    length: int


def unit_starts(raw: bytes) -> np.ndarray:
    """Where the units of a text in UTF-8 start: runs of ASCII letters, and any other code point alone."""
    data = np.frombuffer(raw, dtype=np.uint8)
    letter = _LETTER[data]
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.nonzero(start)[0]


def code_points(raw: bytes, start: int, length: int) -> int:
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8, length, start) & 0xC0) != 0x80)) if length else 0


def cut(pieces: list[Piece], at: int) -> list[Piece]:
    """Split the descriptor that holds offset ``at`` of the described text; there is one piece more afterwards."""
    out, before, done = [], 0, False
    for piece in pieces:
        if not done and before <= at <= before + piece.length:
            head = at - before
            out += [Piece(piece.buffer, piece.start, head), Piece(piece.buffer, piece.start + head, piece.length - head)]
            done = True
        else:
            out.append(piece)
        before += piece.length
    return out


def arrange(parts: dict[str, Piece], form: str) -> list[Piece]:
    """The parts in the order of ``form``, each after the descriptor of its mark."""
    order = []
    for name in ORDERS[form]:
        order += [Piece(MARK, MARK_BUFFER.index(MARKS[name]), len(MARKS[name])), parts[name]]
    return order


def located(output: bytes, form: str) -> dict[str, Piece]:
    """The parts of an output as descriptors over it: the inverse of ``arrange``.

    Texts that hold a mark are never arranged, and no mark can begin in a part and
    end in a mark behind it, so the first place of each mark is its own.
    """
    parts, stop = {}, len(output)
    for name in reversed(ORDERS[form]):
        mark = MARKS[name]
        at = output.index(mark) + len(mark)
        parts[name] = Piece(TEXT, at, stop - at)
        stop = at - len(mark)
    return parts


def restored_pieces(output: bytes, form: str) -> list[Piece]:
    """Descriptors over an output that spell the text it was made of."""
    if form == "plain":
        return [Piece(TEXT, 0, len(output))]
    parts = located(output, form)
    return [parts[name] for name in PARTS]


def spelled(pieces: list[Piece], text: bytes):
    """The bytes that the descriptors stand for, piece by piece and without copies."""
    buffers = (memoryview(text), memoryview(MARK_BUFFER))
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def streamed_sha256(pieces: list[Piece], text: bytes) -> str:
    digest = hashlib.sha256()
    for view in spelled(pieces, text):
        digest.update(view)
    return digest.hexdigest()


def planned(raw: bytes, draws, percent: int, spm_percent: int):
    """(n, form, prefix_chars, middle_chars, pieces) of one text and its four draws."""
    starts = unit_starts(raw)
    n = len(starts)
    whole = [Piece(TEXT, 0, len(raw))]
    if not n or any(mark in raw for mark in MARKS.values()) or draws[2] % 100 >= percent:
        return n, "plain", None, None, whole
    edge = lambda units: int(starts[units]) if units < n else len(raw)
    low, high = sorted(edge(draw % (n + 1)) for draw in draws[:2])
    parts = dict(zip(PARTS, cut(cut(whole, high), low)))
    form = "spm" if draws[3] % 100 < spm_percent else "psm"
    chars = [code_points(raw, parts[name].start, parts[name].length) for name in ("prefix", "middle")]
    return n, form, *chars, arrange(parts, form)


_PLAN = pa.struct(
    [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
     ("pieces", PIECE_TYPE), ("output_sha256", pa.string())]
)
_PLAN_DDL = (
    "struct<n: long, form: string, prefix_chars: long, middle_chars: long, "
    "pieces: array<struct<buffer: int, start: long, length: long>>, output_sha256: string>"
)


def draws_of(key: Column, seed: str = "1:") -> Column:
    """Four numbers below 2**32 from the digest of ``seed`` and the key; a missing key counts as empty."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.transform(F.array(*[F.substring(digest, 8 * i + 1, 8) for i in range(4)]), lambda h: F.conv(h, 16, 10).cast("long"))


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """Each row with all its columns as (_doc, n, form, prefix_chars, middle_chars, pieces, output_sha256, output).

    ``n`` counts the units of the text: runs of ASCII letters and single other code points.
    Two cuts between units, both drawn from the key, part it into prefix, middle and suffix; equal draws make
    an empty middle. ``pieces`` describes the output as (buffer, start, length) in bytes over the
    text (buffer 0) and the marks (buffer 1); its hash is streamed from the pieces. ``output`` is
    spelled from them where it is asked for. Rows whose text is empty, missing (counts as empty)
    or holds a mark, and those beyond ``percent``, stay plain: the text as it is, prefix_chars and
    middle_chars null. Repeated rows get the same cuts. Nothing is shuffled; a task holds one
    Arrow batch of texts and a few bytes a byte of one text.
    """

    @F.arrow_udf(_PLAN_DDL)
    def plan(raws: pa.Array, draws: pa.Array) -> pa.Array:
        rows = []
        for raw, drawn in zip(raws, draws):
            raw = raw.as_py()
            n, form, prefix, middle, pieces = planned(raw, drawn.as_py(), percent, spm_percent)
            described = [piece._asdict() for piece in pieces]
            rows.append((n, form, prefix, middle, described, streamed_sha256(pieces, raw)))
        columns = zip(*rows) if rows else [[]] * len(_PLAN)
        return pa.StructArray.from_arrays(
            [pa.array(list(values), field.type) for values, field in zip(columns, _PLAN)], fields=list(_PLAN)
        )

    whole = docs.select(F.struct("*").alias("_doc")).withColumn("_raw", whole_text(f"_doc.`{text}`").cast("binary"))
    made = whole.withColumn("_plan", plan("_raw", draws_of(F.col("_doc")[key])))
    return made.select("_doc", "_plan.*", spelled_column(F.col("_raw"), F.col("_plan")["pieces"]).alias("output"))


def spelled_column(raw: Column, pieces: Column) -> Column:
    """The text that pieces over a text in UTF-8 (binary) stand for."""
    buffer = lambda p: F.when(p["buffer"] == TEXT, raw).otherwise(F.lit(MARK_BUFFER))
    part = lambda p: F.substring(buffer(p), (p["start"] + 1).cast("int"), p["length"].cast("int"))
    return F.array_join(F.transform(pieces, lambda p: part(p).cast("string")), "")


def restored(output, form) -> Column:
    """(text, sha256) of outputs and their forms: the exact text, and its hash streamed from descriptors over the output."""

    @F.arrow_udf("struct<text: string, sha256: string>")
    def of_batch(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        texts, digests = [], []
        for spelled_out, made_as in zip(outputs, forms):
            raw = spelled_out.as_py().encode()
            pieces = restored_pieces(raw, made_as.as_py())
            texts.append(b"".join(spelled(pieces, raw)).decode())
            digests.append(streamed_sha256(pieces, raw))
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(digests, pa.string())], ["text", "sha256"])

    return of_batch(output, form)
