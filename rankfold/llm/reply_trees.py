"""Reply trees as chat text.

``root_paths`` lists the paths from the root of a tree of messages to its best leaves,
``format_chats`` writes each path as one text, and ``read_chats`` reads such texts again.

Paths come from iterated self-joins of ``(node, up)``: after round *i* every message knows
its ancestor ``2**i`` steps up, so a chain of *n* messages takes ``log2(n)`` rounds, not
*n*. Only identifiers and scores take part; texts are joined once, to the chosen paths.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import column, in_arrow, whole, written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

_CHAT = "chat_id bigint, formatted string, loss array<struct<start:bigint,end:bigint>>"


def escape(text: str) -> str:
    r"""Text that holds no ``<|``: ``<``, *n* backslashes, ``|`` gets one backslash more."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(turns) -> tuple[str, list[tuple[int, int]]]:
    """One text, and where in it the assistant's texts stand (code points)."""
    parts, loss, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{_role_out(role)}\n", escape(text)
        if role == "assistant":
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE, "\n"]
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), loss


def read_turns(formatted: str) -> list[tuple[str, str]]:
    turns = []
    for block in formatted.split(OPEN)[1:]:
        role, _, text = block[: -len(CLOSE) - 1].partition("\n")
        turns.append((_role_in(role), unescape(text)))
    return turns


def root_paths(nodes: DataFrame, keep: int | None = 1) -> DataFrame:
    """Paths from root to leaf.

    ``nodes``: ``tree, node, parent, score``; ``node`` is unique in its tree. A message whose
    parent is null, itself or not in the tree is a root; a null score counts as nothing. A
    path's score is the sum of its messages' scores; the ``keep`` best leaves of each tree
    stay (null: all), ties by the smaller node. Messages on a circle of parents have no
    root and are on no path. Returns ``tree, leaf, rank, node, above``: ``above`` counts the
    steps from the leaf up to the message.
    """
    known = nodes.select("tree", F.col("node").alias("known"))
    step = nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("gain"))
    up = step.alias("s").join(
        known.alias("k"),
        F.col("s.tree").eqNullSafe(F.col("k.tree"))
        & (F.col("s.parent") == F.col("k.known"))
        & (F.col("s.parent") != F.col("s.node")),
        "left",
    )
    first = written(up.select("s.tree", "s.node", F.col("known").alias("up"), "gain"), "jump")
    # Messages that have reached their root leave the rounds; the others jump over them.
    jumps, ended = [first.where("up is not null")], first.where("up is null")
    size = first.groupBy("tree").count().agg(F.max("count")).head()[0] or 1
    for _ in range(math.ceil(math.log2(size)) if size > 1 else 0):
        a, b = jumps[-1].alias("a"), jumps[-1].unionAll(ended).alias("b")
        twice = a.join(
            b, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.up") == F.col("b.node"))
        ).select("a.tree", "a.node", F.col("b.up").alias("up"), (F.col("a.gain") + F.col("b.gain")).alias("gain"))
        twice = written(twice, "jump")
        jumps.append(twice.where("up is not null"))
        ended = ended.unionAll(twice.where("up is null"))

    inner = jumps[0].select(F.col("tree").alias("t"), F.col("up").alias("u"))
    leaves = ended.join(
        inner.distinct(), F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("u")), "left_anti"
    )
    order = Window.partitionBy("tree").orderBy(F.col("gain").desc(), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    if keep is not None:
        ranked = ranked.where(F.col("rank") <= keep)
    paths = written(
        ranked.select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("above")),
        "paths",
    )
    for i, jump in enumerate(jumps[:-1]):
        far = (
            paths.alias("p")
            .join(
                jump.alias("j"),
                F.col("p.tree").eqNullSafe(F.col("j.tree")) & (F.col("p.node") == F.col("j.node")),
            )
            .select("p.tree", "p.leaf", "p.rank", F.col("j.up").alias("node"), F.col("p.above") + F.lit(2**i))
        )
        paths = written(paths.unionAll(far), "paths")
    return paths


def chat_turns(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """``tree, leaf, rank, turns``; ``messages``: ``tree, node, role, text``, nulls as empty."""
    texts = messages.select(
        F.col("tree").alias("t"), F.col("node").alias("n"), whole("role").alias("role"), whole("text").alias("text")
    )
    return (
        paths.join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
        .groupBy("tree", "leaf", "rank")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("above")).alias("at"), "role", "text"))).alias("turns"))
        .withColumn("turns", F.transform("turns", lambda x: F.struct(x["role"], x["text"])))
    )


def format_chats(chats: DataFrame) -> DataFrame:
    """``chat_id, turns`` (role, text) to ``chat_id, formatted, loss``."""

    def formatted(batches):
        for batch in batches:
            texts, masks = [], []
            for turns in batch.column(1).to_pylist():
                text, loss = format_turns(tuple(turn.values()) for turn in turns or ())
                texts.append(text)
                masks.append([{"start": a, "end": b} for a, b in loss])
            mask = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(masks, mask)],
                names=["chat_id", "formatted", "loss"],
            )

    return in_arrow(chats.select("chat_id", "turns"), formatted, _CHAT)


def read_chats(chats: DataFrame) -> DataFrame:
    """What ``format_chats`` wrote: turns and the text under the loss mask, unescaped."""

    def read(batches):
        for batch in batches:
            turns, learned = [], []
            for text, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns.append([{"role": role, "text": body} for role, body in read_turns(text)])
                learned.append("".join(unescape(text[span["start"] : span["end"]]) for span in loss))
            turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(turns, turn), pa.array(learned, pa.string())],
                names=["chat_id", "formatted", "turns", "learned"],
            )

    return in_arrow(
        chats.select("chat_id", "formatted", "loss"),
        read,
        "chat_id bigint, formatted string, turns array<struct<role:string,text:string>>, learned string",
    )


def turns_of(conversations: DataFrame) -> DataFrame:
    """Conversations as trees of one branch: ``tree, node, parent, score, role, text``.

    Rows are ordered by turn, then role and text, so rows repeated whole keep their number.
    A null ``conv_id`` is a conversation of its own.
    """
    turns = conversations.select(
        column("conv_id").cast("long").alias("tree"), column("turn").alias("turn"), "role", "text"
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = turns.withColumn("node", F.row_number().over(order).cast("long"))
    return numbered.select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(1.0).alias("score"),
        "role",
        "text",
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Every conversation as one text: ``chat_id, formatted, loss``."""
    messages = written(turns_of(conversations), "turns")
    paths = root_paths(messages.select("tree", "node", "parent", "score"), keep=1)
    chats = chat_turns(paths, messages)
    return format_chats(chats.select(F.col("tree").alias("chat_id"), "turns"))


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
