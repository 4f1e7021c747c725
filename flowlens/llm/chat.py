"""Chat formatting: from reply trees to one text per chosen conversation.

Messages form trees by their parent.  Paths are found by iterative self-joins that
double their reach: after k rounds a node knows its ancestor 2**k steps up, and the
length and score of the way there, so long threads take few rounds.  Leaves are
ranked by the score of their path; the path of each chosen leaf is then marked
downwards through the same joins, at two rows per message and round however
branched the tree is.

A path is written in parts of so many turns, so a thread of any length never
becomes one cell.  Readers stream the parts in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import land

BEGIN, END = "<|im_start|>", "<|im_end|>"
TURNS = 256  # of a part
LOSS_ROLE = "assistant"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
    "loss_sha256 string, formatted_chars long"
)


def escape(text: Column) -> Column:
    """No ``<|`` is left: it becomes ``<\\|``, and ``<`` with backslashes gets one more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escape_role(role: Column) -> Column:
    """A role on one line, without control strings."""
    one = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(one)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def linear(conversations: DataFrame) -> DataFrame:
    """Conversations as trees: each turn answers the one before it.

    Rows of a conversation are ordered by turn, then role and text, so repeated
    turns all stay.  They are numbered per run of turns and then by the runs
    before, so that a very long conversation is numbered by many tasks.
    """
    rows = conversations.select(
        conversations["conv_id"].alias("tree"),
        conversations["turn"].cast("long").alias("turn"),
        F.coalesce(conversations["role"], F.lit("")).alias("role"),
        F.coalesce(conversations["text"], F.lit("")).alias("text"),
    ).withColumn("run", F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(1 << 60))))
    counts = rows.groupBy("tree", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(
        F.col("tree").alias("of"), F.col("run").alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    )
    within = Window.partitionBy("tree", "run").orderBy("turn", "role", "text")
    numbered = rows.withColumn("nth", F.row_number().over(within) - 1)
    numbered = numbered.join(ahead, F.col("tree").eqNullSafe(F.col("of")) & (F.col("run") == F.col("at")))
    node = (F.col("nth") + F.col("ahead")).cast("long")
    return numbered.select(
        "tree", node.alias("node"), F.when(node > 0, node - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"),
    )


def _jumps(links: DataFrame) -> list[DataFrame]:
    """Landed tables (tree, node, up, steps, sum): k-th one reaches 2**k steps up.

    Where the root is nearer, ``up`` is null and steps and sum are those to the root.
    """
    reach = [land(links, "jump")]
    while not reach[-1].where("up is not null").isEmpty():
        # Nodes that have come to their root rest; only the others are joined again.
        near, far = reach[-1].where("up is not null").alias("n"), reach[-1].alias("f")
        joined = near.join(
            far,
            F.col("n.tree").eqNullSafe(F.col("f.tree")) & (F.col("n.up") == F.col("f.node")),
            "left",
        )
        further = (
            land(
                joined.select(
                    F.col("n.tree").alias("tree"),
                    F.col("n.node").alias("node"),
                    F.col("f.up").alias("up"),
                    (F.col("n.steps") + F.coalesce("f.steps", F.lit(0))).alias("steps"),
                    (F.col("n.sum") + F.coalesce("f.sum", F.lit(0.0))).alias("sum"),
                ),
                "jump",
            )
        )
        reach.append(further.unionByName(reach[-1].where("up is null")))
        if len(reach) > 63:
            raise ValueError("the replies form a circle")
    return reach


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """The messages (role, text) on the ``best`` paths of each tree.

    Input (tree, node, parent, role, text, score); output (tree, branch, depth,
    role, text), where ``branch`` is the path's rank from one and ``depth`` the
    message's place from zero.  Paths rank by their mean score, then the longer and
    the smaller leaf first.  A parent that is missing makes its child a root; a
    node that is its own parent too.
    """
    messages = land(messages, "messages")
    known = messages.select(F.col("tree").alias("of"), F.col("node").alias("there"))
    links = messages.join(
        known,
        F.col("tree").eqNullSafe(F.col("of")) & (F.col("parent") == F.col("there")) & (F.col("parent") != F.col("node")),
        "left",
    ).select(
        "tree", "node", F.col("there").alias("up"), F.when(F.col("there").isNull(), 0).otherwise(1).cast("long").alias("steps"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("sum"),
    )
    reach = _jumps(links)
    whole = reach[-1]
    inner = reach[0].where("up is not null").select(F.col("tree").alias("of"), F.col("up").alias("there")).distinct()
    leaves = whole.join(
        inner, F.col("tree").eqNullSafe(F.col("of")) & (F.col("node") == F.col("there")), "left_anti"
    )
    rank = Window.partitionBy("tree").orderBy(
        F.desc(F.col("sum") / (F.col("steps") + 1)), F.desc("steps"), "node"
    )
    chosen = leaves.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= best)
    marked = land(chosen.select("tree", "branch", "node"), "marked")
    for jump in reversed(reach):
        ways = jump.where("up is not null").select(F.col("tree").alias("of"), F.col("node").alias("at"), "up")
        above = marked.join(
            ways, F.col("tree").eqNullSafe(F.col("of")) & (F.col("node") == F.col("at"))
        ).select("tree", "branch", F.col("up").alias("node"))
        marked = land(marked.unionByName(above), "marked")
    placed = marked.select(F.col("tree").alias("of"), "branch", F.col("node").alias("at")).join(
        whole.select(F.col("tree").alias("__tree"), F.col("node").alias("__node"), F.col("steps").alias("depth")),
        F.col("of").eqNullSafe(F.col("__tree")) & (F.col("at") == F.col("__node")),
    )
    return messages.join(
        placed, F.col("tree").eqNullSafe(F.col("of")) & (F.col("node") == F.col("at"))
    ).select("tree", "branch", "depth", "role", "text")


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, branch, part, text, loss): the written conversations, and their loss mask.

    ``loss`` holds the spans [begin, end) of assistant text in code points.
    """
    head = F.concat(F.lit(BEGIN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = turns.select(
        F.col("tree").alias("conv_id"),
        "branch",
        F.floor(F.col("depth") / TURNS).alias("part"),
        F.struct(
            "depth",
            F.concat(head, body, F.lit(f"{END}\n")).alias("piece"),
            F.length(head).alias("head"),
            F.length(body).alias("body"),
            (F.col("role") == LOSS_ROLE).alias("loss"),
        ).alias("turn"),
    )
    grouped = pieces.groupBy("conv_id", "branch", "part").agg(
        F.array_sort(F.collect_list("turn")).alias("turns")
    )
    tail = len(END) + 1
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        begin = state["at"] + turn["head"]
        end = begin + turn["body"]
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        spans = F.when(turn["loss"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + tail).alias("at"), spans.alias("spans"))

    return grouped.select(
        "conv_id",
        "branch",
        "part",
        F.array_join(F.transform("turns", lambda turn: turn["piece"]), "").alias("text"),
        F.aggregate("turns", start, add)["spans"].alias("loss"),
    )


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted part."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its parts, which follow each other."""
    now, state, rows = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["conv_id"], row["branch"])
            if state is None or key != now:
                if state is not None:
                    rows.append(_closed(now, state))
                now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(row["text"]):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for span in row["loss"]:
                learned = unescape(row["text"][span["begin"] : span["end"]])
                state[2] += len(learned)
                state[3].update(learned.encode("utf-8", "surrogatepass"))
            state[4] += len(row["text"])
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
            rows = []
    if state is not None:
        yield pa.RecordBatch.from_pylist([_closed(now, state)], _SCHEMA)


_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _closed(key: tuple, state: list) -> dict:
    values = [key[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]
    return dict(zip(_SCHEMA.names, values))


def digests(written: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, one row for each.

    A digest follows a conversation's text in order; the parts of one conversation
    are sorted and streamed through one task, which holds one part at a time.
    """
    ordered = written.repartition("conv_id", "branch").sortWithinPartitions("conv_id", "branch", "part")
    return ordered.mapInArrow(_digests, DIGEST)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The written parts of all conversations (conv_id, turn, role, text).

    Null roles and texts are empty, null turns come first, a null conv_id is a
    conversation of its own; an empty table gives no rows; further columns are not read.
    """
    return land(formatted(paths(linear(conversations))), "formatted")
