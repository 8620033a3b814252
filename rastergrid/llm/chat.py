"""Chat formatting of reply trees.

Iterative self-joins double the distance that each message looks up its tree, until all have met their
root; that gives every root-to-leaf path its length and score. The paths of a conversation are ranked by
mean score, the messages of the chosen ones are gathered by walking the same jumps down from the
leaf, and each path is written as one conversation.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

# Fixed texts of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    """No control string is left: a backslash goes between ``<`` and ``|``, and backslashes are doubled."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def format_turns(turns: list[tuple[str, str]], loss_role: str = LOSS_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """The conversation, and the spans (start, end) of code points under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape_role(role)}\n", escape(text)
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}{CLOSE}\n")
        at += len(parts[-1])
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts back from a conversation."""
    turns = []
    for piece in formatted.split(OPEN)[1:]:
        role, _, rest = piece.partition("\n")
        turns.append((unescape(role), unescape(rest[: -len(CLOSE) - 1])))
    return turns


def as_tree(rows: DataFrame) -> DataFrame:
    """conv, node, parent, role, text, score from (conv_id, turn, role, text): each turn answers the one before.

    Null texts and roles are empty; a null turn comes first, rows of the same turn follow by role and text;
    rows without conv_id form one conversation, with ``conv`` empty.
    """
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    return rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).select(
        "conv", F.row_number().over(order).cast("bigint").alias("node"), "role", "text", F.lit(0.0).alias("score")
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def chosen_paths(messages: DataFrame, paths: int = 1) -> DataFrame:
    """(conv, leaf, rank, node, depth) of the ``paths`` best root-to-leaf paths of each conversation.

    ``messages`` has conv, node, parent (null at a root), score; of paths with the same mean score the one
    with the smaller leaf is first. A message whose parent is missing is a root; messages in a circle
    have no root and belong to no path.
    """
    edges = messages.select("conv", "node", "parent", "score")
    there = edges.select("conv", F.col("node").alias("parent"), F.lit(True).alias("__there"))
    start = edges.join(there, ["conv", "parent"], "left").select(
        "conv", "node", F.when(F.col("__there"), F.col("parent")).alias("up"), F.lit(1).cast("bigint").alias("depth"),
        F.col("score").cast("double").alias("total"),
    )
    step, jumps = save(start, "chat-step"), []
    most = edges.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    for _ in range(int(most).bit_length()):
        if step.where("up is not null").isEmpty():
            break
        jumps.append(step.select("conv", "node", "up"))
        above = step.select("conv", F.col("node").alias("up"), F.col("up").alias("__up"), F.col("depth").alias("__depth"),
                            F.col("total").alias("__total"))
        step = save(
            step.join(above, ["conv", "up"], "left").select(
                "conv", "node", F.col("__up").alias("up"), (F.col("depth") + F.coalesce("__depth", F.lit(0))).alias("depth"),
                (F.col("total") + F.coalesce("__total", F.lit(0.0))).alias("total"),
            ),
            "chat-step",
        )
    rooted = step.where("up is null").select("conv", "node", "depth", "total")
    inner = start.where("up is not null").select("conv", F.col("up").alias("node")).distinct()
    leaves = rooted.join(inner, ["conv", "node"], "left_anti")
    best = Window.partitionBy("conv").orderBy((F.col("total") / F.col("depth")).desc(), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= paths)
    members = ranked.select("conv", F.col("node").alias("leaf"), "rank", "node")
    for jump in jumps:
        members = members.unionByName(
            members.join(jump, ["conv", "node"]).where("up is not null").select("conv", "leaf", "rank", F.col("up").alias("node"))
        )
        members = save(members, "chat-members")
    return members.join(rooted.select("conv", "node", "depth"), ["conv", "node"])


def _written(batches, loss_role: str):
    """Conversations from rows (conv, leaf, role, text) that come path by path, in order."""
    key, turns = None, []
    names = ["conv", "leaf", "formatted", "loss_spans"]
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def made():
        text, spans = format_turns(turns, loss_role)
        found = [{"start": a, "end": b} for a, b in spans]
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([text]), pa.array([found], spans_type)], names=names
        )

    for batch in batches:
        for conv, leaf, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "leaf", "role", "text")]):
            if key != (conv, leaf):
                if turns:
                    yield made()
                key, turns = (conv, leaf), []
            turns.append((role, text))
    if turns:
        yield made()


def format_chats(messages: DataFrame, paths: int = 1, loss_role: str = LOSS_ROLE) -> DataFrame:
    """conv, leaf, formatted and loss_spans (array of start and end, in code points) of the chosen paths.

    An empty table gives an empty result. One path is one text, however long, and is written by one task.
    """
    chosen = chosen_paths(messages, paths)
    rows = chosen.join(messages.select("conv", "node", "role", "text"), ["conv", "node"])
    ordered = rows.select("conv", "leaf", "depth", "role", "text").repartition("conv", "leaf").sortWithinPartitions(
        "conv", "leaf", "depth"
    )
    return ordered.mapInArrow(
        lambda batches: _written(batches, loss_role),
        "conv string, leaf bigint, formatted string, loss_spans array<struct<start: bigint, end: bigint>>",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what a reader of the conversations gets."""
    def digests(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
                turns = parse(text)
                whole = hashlib.sha256("".join([f"{role}\n{said}\n" for role, said in turns]).encode())
                loss = "".join([unescape(text[s["start"] : s["end"]]) for s in spans])
                rows.append((len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *columns],
                names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.select("conv", "formatted", "loss_spans").mapInArrow(
        digests, "conv string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
