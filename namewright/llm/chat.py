"""Reply trees to conversations in one chat format."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

# Markers of two common chat formats. None but the first two is written; all are escaped.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROL = (OPEN, CLOSE, "<s>", "</s>", "[INST]", "[/INST]")
_TAILS = "|".join(rf"\Q{c[1:]}\E" for c in CONTROL)
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    r"""Put a backslash after the first character of every control string.

    One that already has n backslashes there gets n + 1, so that unescape can tell. The
    tails hold neither an opening character nor a backslash: matches cannot overlap.
    """
    return F.regexp_replace(text, rf"([<\[])(\\*+)(?={_TAILS})", r"$1\\$2")


def unescape(text: Column) -> Column:
    """The text before escape."""
    return F.regexp_replace(text, rf"([<\[])\\(\\*+)(?={_TAILS})", "$1$2")


def _role(role: Column) -> Column:
    r"""A role in one line: backslash and newline are written \\ and \n."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_back(role: Column) -> Column:
    plain = unescape(role)
    parts = F.transform(F.split(plain, r"\\\\", -1), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def _reach(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """How every message reaches its root: rows (tree, id, up, total, turns), and the jumps that lead there.

    Iterative self-joins double the reach: after k rounds ``up`` is the message's 2**k-th ancestor,
    ``total`` and ``turns`` are the scores and the number of the messages before that ancestor.
    At the end ``up`` is null, but for messages in a reply loop or below one. A chain of n
    messages takes log2(n) rounds. The k-th jump has (tree, id, up) of those with a 2**k-th ancestor.
    """
    nodes = stage(messages.select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "messages")
    there = nodes.select("tree", F.col("id").alias("parent"), F.col("id").alias("up"))
    reach = nodes.join(there, ["tree", "parent"], "left").select(
        "tree", "id", "up", F.col("score").alias("total"), F.lit(1).cast("long").alias("turns")
    )
    reach, jumps = stage(reach, "reach"), []
    for _ in range(max(1, nodes.count()).bit_length()):
        going = reach.filter("up is not null")
        if going.isEmpty():
            break
        jumps.append(going.select("tree", "id", "up"))
        above = reach.select(
            "tree", F.col("id").alias("up"), F.col("up").alias("_up"), F.col("total").alias("_total"), F.col("turns").alias("_turns")
        )
        further = going.join(above, ["tree", "up"]).select(
            "tree", "id", F.col("_up").alias("up"), (F.col("total") + F.col("_total")).alias("total"),
            (F.col("turns") + F.col("_turns")).alias("turns"),
        )
        reach = stage(reach.filter("up is null").unionAll(further), "reach")
    return reach, jumps


def branches(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The leaves of reply trees, one row (tree, leaf, branch_score, n_turns) a branch, and the jumps to lay them out.

    ``messages`` has (tree, id, parent, score), none of tree and id missing, ids unique in a tree.
    A message whose parent is missing or not in the tree is a root. A branch's score is the mean of
    its messages' scores, a missing score is 0. No path is laid out: a tree costs its messages
    times the logarithm of its depth, not its leaves times their depth. Messages in a
    reply loop, or below one, have no root and are in no branch; ``message_accounts`` counts them.
    """
    reach, jumps = _reach(messages)
    answered = messages.select("tree", F.col("parent").alias("id")).filter("id is not null").distinct()
    leaves = reach.filter("up is null").join(answered, ["tree", "id"], "left_anti")
    score = (F.col("total") / F.col("turns")).alias("branch_score")
    return leaves.select("tree", F.col("id").alias("leaf"), score, F.col("turns").alias("n_turns")), jumps


def best_branches(leaves: DataFrame, most: int | None = 1) -> DataFrame:
    """The ``most`` best leaves of each tree with their ``branch_rank``; None keeps all.

    Ties go to the smaller leaf. Spark limits ranks on the map side before it shuffles the leaves of a tree.
    """
    order = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")
    ranked = leaves.withColumn("branch_rank", F.row_number().over(order))
    return ranked if most is None else ranked.filter(F.col("branch_rank") <= most)


def reply_paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """The messages of chosen branches: the leaves' columns with ``id`` and ``depth``, 0 at the root."""
    paths = stage(chosen.withColumns({"id": F.col("leaf"), "depth": F.col("n_turns") - 1}), "paths")
    for k, jump in enumerate(jumps):
        above = paths.join(jump, ["tree", "id"]).withColumns({"id": F.col("up"), "depth": F.col("depth") - (1 << k)})
        paths = stage(paths.unionByName(above.drop("up")), "paths")
    return paths


def message_accounts(messages: DataFrame) -> DataFrame:
    """One row: all messages, and those in no conversation because they have no tree or id, repeat an id, or reply in a loop."""
    keyed = messages.filter("tree is not null and id is not null")
    known = stage(keyed.groupBy("tree", "id").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m")).select("tree", "id", "m.*"), "messages")
    reach, _ = _reach(known)
    total = messages.agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("tree").isNull() | F.col("id").isNull()).alias("without_key")
    )
    kept = reach.agg(F.count(F.lit(1)).alias("_known"), F.count_if(F.col("up").isNotNull()).alias("in_loops"))
    joined = total.join(kept, F.lit(True))  # one row each
    return joined.select(
        "messages", "without_key", (F.col("messages") - F.col("without_key") - F.col("_known")).alias("repeated"), "in_loops"
    )


def format_trees(messages: DataFrame, most: int | None = 1, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One conversation per chosen path: (tree, leaf, branch_score, branch_rank, n_turns, formatted, loss_spans).

    ``messages`` has (tree, id, parent, role, text, score). A missing role or text is empty. Rows
    without tree or id are left out; of rows that repeat an id of their tree the smallest
    by (parent, role, text, score) counts. ``loss_spans`` lists the code points (start, length)
    of each text of ``loss_role`` as it stands in ``formatted``. Branches are ranked before any path is laid out. One conversation is one output
    row, so its size bounds what a task gathers; sorting and offsets work on rows before.
    """
    narrow = ["parent", "role", "text", "score"]
    known = messages.filter("tree is not null and id is not null").groupBy("tree", "id").agg(F.min(F.struct(*narrow)).alias("m"))
    known = stage(known.select("tree", "id", "m.*"), "messages")
    leaves, jumps = branches(known)
    paths = reply_paths(best_branches(leaves, most), jumps)
    turns = paths.join(known.select("tree", "id", "role", "text"), ["tree", "id"])
    empty = F.lit("")
    head = F.concat(F.lit(OPEN), _role(F.coalesce("role", empty)), F.lit("\n"))
    body = escape(F.coalesce("text", empty))
    pieces = turns.withColumns({"_head": head, "_body": body, "_loss": F.coalesce(F.col("role") == loss_role, F.lit(False))})
    along = Window.partitionBy("tree", "leaf").orderBy("depth")
    size = F.length("_head") + F.length("_body") + len(CLOSE) + 1
    placed = pieces.withColumn("_start", F.sum(size.cast("long")).over(along) - size)
    turn = F.struct(
        F.col("depth"),
        F.concat("_head", "_body", F.lit(CLOSE + "\n")).alias("piece"),
        (F.col("_start") + F.length("_head")).alias("start"),
        F.length("_body").cast("long").alias("length"),
        F.col("_loss").alias("loss"),
    )
    joined = placed.groupBy("tree", "leaf", "branch_score", "branch_rank").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return joined.select(
        "tree",
        "leaf",
        "branch_score",
        "branch_rank",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("t", lambda x: x["loss"]), lambda x: F.struct(x["start"], x["length"])).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) back from a formatted conversation."""
    pieces = F.split(formatted, rf"\Q{CLOSE}\E\n", -1)
    return F.transform(
        F.slice(pieces, 1, F.size(pieces) - 1),
        lambda p: F.struct(
            _role_back(F.substring(F.substring_index(p, "\n", 1), len(OPEN) + 1, F.lit(2**31 - 1))).alias("role"),
            unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """The texts under the loss mask, unescaped, as a list."""
    return F.transform(
        F.array(F.struct(formatted.alias("f"), loss_spans.alias("s"))),
        lambda p: F.transform(
            p["s"], lambda s: unescape(F.substring(p["f"], (s["start"] + 1).cast("int"), s["length"].cast("int")))
        ),
    )[0]
