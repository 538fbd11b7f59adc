"""Least-cost repair of conversations: integers that carry cost and edits, a minimum over a DAG, merged by segments."""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import BLANKS, range_ranked, two_hashes

# Costs of the edits, and the octal digits that order their initials; 0 pads the end.
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3
DIGITS = {"D": "1", "I": "2", "K": "3", "R": "4"}
_TO_DIGITS = str.maketrans(DIGITS)
_TO_LETTERS = str.maketrans({digit: letter for letter, digit in DIGITS.items()})
ROLES = {"u": "user", "a": "assistant"}
# What has been said so far: nothing, a system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
BIT = 3
SEGMENT = 256
FAN = 16
# Faults of a row, in the order in which they count.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
_SUMMARY = "struct<first: int, last: int, rows: long, illegal: long, cells: array<struct<cost: long, edits: string>>>"
_SUMMARY_TYPE = pa.struct(
    [("first", pa.int32()), ("last", pa.int32()), ("rows", pa.int64()), ("illegal", pa.int64()),
     ("cells", pa.list_(pa.struct([("cost", pa.int64()), ("edits", pa.string())])))]
)


def prepend(weight: int | None, cost: int, edits: str, width: int) -> int | None:
    """The weight of a path that starts with ``edits`` at ``cost`` and goes on as ``weight`` says.

    A weight is one integer: the cost above ``width`` bits, below it three bits a letter,
    the first letter highest and zeros after the last. Of two weights the smaller has the
    lower cost or, at one cost, the letters that come first in ASCII order.
    """
    if weight is None:
        return None
    low = weight & ((1 << width) - 1)
    if edits:
        size = BIT * len(edits)
        low = (int(edits.translate(_TO_DIGITS), 8) << (width - size)) | (low >> size)
    return ((weight >> width) + cost << width) | low


def least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def spelled(weight: int, width: int) -> tuple[int, str]:
    """Cost and edits of a weight."""
    low = weight & ((1 << width) - 1)
    return weight >> width, format(low, f"0{width // BIT}o").rstrip("0").translate(_TO_LETTERS) if low else ""


def one_row_back(ahead: list, code: int, width: int) -> list:
    """Least weights from each state on, one row earlier: inserts before the row, then the row's own edit."""
    initial, fault = code & 3, code >> 2
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    done = []
    for state in STATES:
        ways = [prepend(ahead[state], COSTS["D"], "D", width)]
        if fault not in (BLANK, DUPLICATE):
            after = NEXT[state]
            ways.append(prepend(ahead[after], COSTS["R"] + extra, "R", width))
            if initial == after or initial == SYSTEM and state == NOTHING:
                ways.append(prepend(ahead[initial], COSTS["K"] + extra, "K", width))
        done.append(least(*ways))
    # Two inserts reach every state there is a use for; a third only goes round.
    once = [least(done[s], prepend(done[NEXT[s]], COSTS["I"], "I", width)) for s in STATES]
    return [least(done[s], prepend(once[NEXT[s]], COSTS["I"], "I", width)) for s in STATES]


def summarised(codes: list[int]) -> dict:
    """A segment of rows: for every state before and after it the least cost and its edits, and what counts add up."""
    width = BIT * 3 * len(codes)
    columns = []
    for end in STATES:
        weights = [0 if state == end else None for state in STATES]
        for code in reversed(codes):
            weights = one_row_back(weights, code, width)
        columns.append(weights)
    cells = [
        None if columns[end][start] is None else dict(zip(("cost", "edits"), spelled(columns[end][start], width)))
        for start in STATES
        for end in STATES
    ]
    initials = [code & 3 for code in codes]
    illegal = sum(not legal(a, b) for a, b in zip(initials, initials[1:]))
    return {"first": initials[0], "last": initials[-1], "rows": len(codes), "illegal": illegal, "cells": cells}


def legal(before: int, after: int) -> bool:
    return (before, after) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def merged(parts: list[dict]) -> dict:
    """Neighbouring segments as one.

    At one cost no edits of the same rows are the beginning of others (those would have more inserts,
    which cost), so the least of the parts joined are the least of the whole.
    """
    if len(parts) == 1:
        return parts[0]
    longest = [max(len(c["edits"]) for c in part["cells"] if c) for part in parts]
    width = BIT * max(1, sum(longest))
    columns = []
    for end in STATES:
        weights = [0 if state == end else None for state in STATES]
        for part in reversed(parts):
            cells = part["cells"]
            weights = [
                least(*[
                    prepend(weights[mid], cells[4 * start + mid]["cost"], cells[4 * start + mid]["edits"], width)
                    for mid in STATES
                    if cells[4 * start + mid] and weights[mid] is not None
                ])
                for start in STATES
            ]
        columns.append(weights)
    cells = [
        None if columns[end][start] is None else dict(zip(("cost", "edits"), spelled(columns[end][start], width)))
        for start in STATES
        for end in STATES
    ]
    seams = sum(not legal(a["last"], b["first"]) for a, b in zip(parts, parts[1:]))
    return {
        "first": parts[0]["first"],
        "last": parts[-1]["last"],
        "rows": sum(part["rows"] for part in parts),
        "illegal": seams + sum(part["illegal"] for part in parts),
        "cells": cells,
    }


def finished(summary: dict) -> tuple[int, str]:
    """Cost and edits of a whole conversation, with the inserts after its last row; roles end as ``(s?(ua)+)?``."""
    width = BIT * (max(len(c["edits"]) for c in summary["cells"] if c) + 2)
    tails = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
    ways = []
    for end, tail in tails.items():
        cell = summary["cells"][4 * NOTHING + end]
        if cell:
            weight = prepend(0, COSTS["I"] * len(tail), tail, width)
            ways.append(prepend(weight, cell["cost"], cell["edits"], width))
    return spelled(least(*ways), width)


def edited_rows(audit: str):
    """(place, edit, role, inserts) per row that stays or has inserts before it; the tail has no edit.

    ``role`` is the new role of a row with a changed one. What stays alternates between user and
    assistant, behind a system turn if the number of turns that stay is odd.
    """
    state = NOTHING
    system_first = sum(letter != "D" for letter in audit) % 2 == 1
    inserts, place = [], 0
    for letter in audit:
        role = None
        if letter != "D":
            state = SYSTEM if system_first else NEXT[state]
            role = None if system_first else ROLES["u" if state == USER else "a"]
            system_first = False
        if letter == "I":
            inserts.append(role)
            continue
        if letter != "D" or inserts:
            yield place, letter, role if letter == "R" else None, inserts
            inserts = []
        place += 1
    if inserts:
        yield place, None, None, inserts


def _initial() -> Column:
    first = F.substring("role", 1, 1)
    return F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(NOTHING)


def faulty_rows(rows: DataFrame) -> DataFrame:
    """Number the rows (conv, turn, role, text) of each conversation by turn and add each row's first fault.

    Missing turns come first; rows of one turn are ordered by role and text. A row is a
    duplicate if its role and text stand on a lower number of its conversation, found by the least number
    of each (128 hash bits of role and text), which is reduced on the map side.
    """
    ranked = range_ranked(rows, "conv", ["turn", "role", "text"], "turns")
    bare = F.btrim("text", F.lit(BLANKS))
    marked = stage(ranked.select("*", *two_hashes(F.struct("role", "text")), bare.alias("_bare")), "turns")
    firsts = stage(
        marked.groupBy(F.col("conv").alias("_conv"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).agg(F.min("rank").alias("_first")),
        "firsts",
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    last = F.substring("_bare", -1, 1)
    fault = (
        F.when(F.col("_bare") == "", BLANK)
        .when(F.col("rank") > F.col("_first"), DUPLICATE)
        .when(~last.isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )
    return marked.join(firsts, same).select("conv", "turn", "role", "text", "rank", fault.alias("fault"))


def conversation_edits(faults: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit) per conversation of ``faulty_rows``.

    Rows are gathered in segments of at most 256 small numbers; each segment becomes its least
    weights between the four states. Up to 16 neighbouring segments are then merged into one per
    round, so a conversation that holds a third of all rows is worked on by many tasks, and the rounds
    grow with the logarithm of the longest one.
    """
    code = (_initial() + 4 * F.col("fault")).cast("int").alias("code")

    @F.arrow_udf(_SUMMARY)
    def summary(codes: pa.Array) -> pa.Array:
        return pa.array([summarised(c.as_py()) for c in codes], _SUMMARY_TYPE)

    @F.arrow_udf(_SUMMARY)
    def joined(parts: pa.Array) -> pa.Array:
        return pa.array([merged(p.as_py()) for p in parts], _SUMMARY_TYPE)

    @F.arrow_udf("struct<cost: long, audit: string>")
    def whole(summaries: pa.Array) -> pa.Array:
        kind = pa.struct([("cost", pa.int64()), ("audit", pa.string())])
        return pa.array([dict(zip(("cost", "audit"), finished(s.as_py()))) for s in summaries], kind)

    gathered = (
        faults.select("conv", "rank", F.expr(f"rank div {SEGMENT}").alias("segment"), code)
        .groupBy("conv", "segment")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "code"))).alias("rows"))
    )
    segments = stage(gathered.select("conv", "segment", summary(F.col("rows")["code"]).alias("summary")), "segments")
    while (segments.agg(F.max("segment")).first()[0] or 0) > 0:
        parts = segments.groupBy("conv", F.expr(f"segment div {FAN}").alias("segment")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("segment").alias("at"), "summary"))).alias("parts")
        )
        segments = stage(parts.select("conv", "segment", joined(F.col("parts")["summary"]).alias("summary")), "segments")
    return segments.select("conv", F.col("summary")["illegal"].alias("illegal"), whole("summary").alias("_whole")).select(
        "conv", "illegal", "_whole.*"
    )


def repaired_rows(faults: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations: rows (conv, place, slot, role, text), inserted ones with an empty text."""
    conv = edits.schema["conv"].dataType.simpleString()

    def spread(batches):
        for batch in batches:
            keys, audits = batch.column(0), batch.column(1).to_pylist()
            at, rows = [], []

            def flush():
                kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)]
                taken = keys.take(pa.array(at, pa.int64()))
                return pa.RecordBatch.from_arrays([taken, *columns], ["e_conv", "place", "edit", "e_role", "inserts"])

            for i, audit in enumerate(audits):
                for row in edited_rows(audit):
                    at.append(i)
                    rows.append(row)
                    if len(rows) == 1 << 14:
                        yield flush()
                        at.clear()
                        rows.clear()
            yield flush()

    spread_out = edits.select("conv", "audit").mapInArrow(
        spread, f"e_conv {conv}, place long, edit string, e_role string, inserts array<string>"
    )
    rows = faults.select("conv", "rank", "role", "text")
    met = spread_out.join(rows, F.col("e_conv").eqNullSafe(F.col("conv")) & (F.col("place") == F.col("rank")), "left")
    own = F.struct(F.coalesce("e_role", "role").alias("role"), F.col("text"))
    inserted = F.transform("inserts", lambda role: F.struct(role.alias("role"), F.lit("").alias("text")))
    stays = F.col("edit").isin("K", "R")
    lines = F.concat(inserted, F.when(stays, F.array(own)).otherwise(F.slice(F.array(own), 1, 0)))
    return met.select(F.col("e_conv").alias("conv"), "place", F.posexplode(lines).alias("slot", "line")).select(
        "conv", "place", "slot", "line.*"
    )


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): the digest of each conversation's ``role:text`` lines, joined by newlines.

    A digest takes its bytes in order, so the lines of one conversation pass one task; they
    are sorted (spilling to disk) and streamed, and the task holds one batch of them only.
    """
    conv = repaired.schema["conv"].dataType.simpleString()

    def digests(batches):
        held, digest, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            keys, out = [], []
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest is None or key != held:
                    if digest is not None:
                        keys.append(held)
                        out.append(digest.hexdigest())
                    held, digest = key, hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n")
                    digest.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(out, pa.string())], ["conv", "repaired_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([held], kind), pa.array([digest.hexdigest()], pa.string())], ["conv", "repaired_sha256"]
            )

    line = F.concat("role", F.lit(":"), "text").alias("line")
    lines = repaired.repartition("conv").sortWithinPartitions("conv", "place", "slot")
    return lines.select("conv", line).mapInArrow(digests, f"conv {conv}, repaired_sha256 string")


def repair_conversations(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """A report per conversation and the repaired rows.

    The report has (conv, gaps, blank, duplicate, truncated, illegal, cost, audit). Rows may be kept,
    given another role, deleted, and empty ones inserted, at least total cost, so that roles end as an
    optional system turn and user and assistant in turns; of equally cheap repairs the one whose edits
    (D, I, K, R in order) come first in ASCII order is taken. Blank and duplicate rows must go. A missing role or text
    counts as one space, a missing turn comes first and is in no gap, rows without a key are one
    conversation. Rows that repeat are duplicates. Other columns are not read; a table without rows
    gives none.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    named = rows.select(F.col(key).alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"))
    faults = stage(faulty_rows(named), "faults")
    edits = stage(conversation_edits(faults), "edits")
    count = lambda kind, name: F.count(F.when(F.col("fault") == kind, 1)).alias(name)
    per_turn = faults.groupBy("conv", "turn").agg(count(BLANK, "b"), count(DUPLICATE, "d"), count(TRUNCATED, "t"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    counts = per_turn.groupBy(F.col("conv").alias("_conv")).agg(
        gaps, F.sum("b").alias("blank"), F.sum("d").alias("duplicate"), F.sum("t").alias("truncated")
    )
    report = edits.join(counts, F.col("conv").eqNullSafe(F.col("_conv")))
    report = report.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return report, repaired_rows(faults, edits)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by crc32(``conv_id:turn``) % 20, a missing value counting as one space.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 sets the role user.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))), F.lit(20))
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.filter("kind > 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``, also where the damage left no row: the report and the digest of the repair."""
    report, repaired = repair_conversations(damaged(conversations))
    digests = conversation_digests(repaired).withColumnRenamed("conv", "_conv")
    report = report.join(digests, F.col("conv").eqNullSafe(F.col("_conv")), "left")
    everyone = conversations.select("conv_id").distinct()
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return everyone.join(report, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *[zero(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
