r"""Conversations as prefix trees: turns that conversations share from their start are written once.

A node is a turn together with all turns before it, so conversations that begin alike share nodes. Nodes are laid
out depth first. Each carries its place in its tree's sequence, its position ids (those of its place in the
conversation, so a branch goes on where its parent ended) and the intervals of the sequence that it may attend to:
its ancestors. A turn is written as

    ### role⏎text</turn>⏎

Inside texts and roles a backslash is put before every backslash, ``###`` and ``</turn>``; a line break in a role
becomes ``\n``. So the marks appear unescaped at turn borders only and reading back is exact. Tokens are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.common import running
from recordlens.sources.scratch import materialize

OPEN, CLOSE = "### ", "</turn>\n"
LEARNED = ("assistant",)
_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>)")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|\n")
_ROLE_ESCAPED = re.compile(r"\\(\\|###|</turn>|n)")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as written, and where its text begins and ends in it."""
    head = OPEN + _ROLE_CONTROL.sub(lambda m: "\\n" if m[0] == "\n" else "\\" + m[0], role) + "\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse_turn(written: str) -> tuple[str, str]:
    """Role and text of a turn as written."""
    head, _, rest = written.partition("\n")
    if not head.startswith(OPEN) or not rest.endswith(CLOSE):
        raise ValueError("not a turn")
    role = _ROLE_ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], head[len(OPEN) :])
    return role, unescape(rest[: -len(CLOSE)])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_TURN = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("parent", pa.binary()), ("node", pa.binary()), ("tree", pa.binary()), ("written", pa.string()), ("length", pa.int64()), ("position", pa.int64()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])
_TURN_DDL = "conv_id long, place long, parent binary, node binary, tree binary, written string, length long, position long, loss_start long, loss_end long"


def _formatted(learned: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chain, tree, place, position = object(), b"", b"", 0, 0
        for batch in batches:
            out, size = [], 0
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                role, text = role or "", text or ""
                if conv != current:
                    current, chain, tree, place, position = conv, b"", b"", 0, 0
                written, start, end = format_turn(role, text)
                parent, chain = chain, hashlib.sha256(chain + written.encode("utf-8", "surrogatepass")).digest()[:16]
                tree = tree or chain
                if role not in learned:
                    start = end = 0
                out.append((conv, place, parent, chain, tree, written, len(written), position, start, end))
                place, position, size = place + 1, position + len(written), size + len(written)
                if size > 4_000_000:
                    yield _batch(out, _TURN)
                    out, size = [], 0
            if out:
                yield _batch(out, _TURN)

    return run


def build_trees(conversations: DataFrame, learned: tuple[str, ...] = LEARNED) -> tuple[DataFrame, DataFrame]:
    """The nodes and the turns of ``conversations (conv_id, turn, role, text)``. Runs jobs.

    ``nodes``: ``tree, node, start, length, position, loss_start, loss_end, attends, written``. ``start`` is the place
    in the tree's sequence, ``position`` the first position id (the others count on), the loss is on
    ``[loss_start, loss_end)`` of ``written`` (texts of ``learned`` roles), ``attends`` lists the intervals
    ``[start, end)`` of all ancestors in ascending order, merged where they touch. Sequences are in depth-first order: the nodes of a tree by
    ``start`` are a preorder walk.
    ``turns``: ``conv_id, place, node`` says which node holds each turn of a conversation.

    Turns of equal number are in the order of role and text. Null roles and texts are empty; a null turn comes
    first; rows with a null ``conv_id`` are one conversation. An empty table gives no rows; other columns are not read.

    Each conversation is streamed through one task turn by turn, as a chain of turns has to be; nothing is held but the last turn's digest.
    Every turn costs a constant number of bytes, however long its conversation: the depth-first order is that of conversations
    (see ``_ranks``), and a node stands where the first conversation that holds it has it. Trees of any size are laid out over
    all tasks, so a first turn that a third of all conversations share is spread like any other.
    """
    by = [F.col("turn").asc_nulls_first(), "role", "text"]
    rows = conversations.select(F.col("conv_id").cast("long"), "role", "text", "turn")
    # Null ids meet in one partition, as equal ids do.
    ordered = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *by)
    turns = materialize(ordered.select("conv_id", "role", "text").mapInArrow(_formatted(learned), _TURN_DDL), "turns")

    ranks = _ranks(turns)
    steps = turns.select("conv_id", "place", "node", "length").join(ranks, turns["conv_id"].eqNullSafe(ranks["_conv"]))
    steps = materialize(steps.select("rank", "place", "node", "length"), "steps")
    # All turns of a node have its place and length; its owner is the first conversation that holds it.
    owned = steps.groupBy("node").agg(F.min("rank").alias("owner"), F.max("place").alias("place"), F.max("length").alias("length"))
    placed = running(materialize(owned, "owned"), [F.col("owner"), F.col("place")], "length", "at")
    placed = materialize(placed.select("node", "owner", "at", "length"), "places")

    # Walk each owner from its root, whose place is its tree's start, through the ancestors of the nodes it owns.
    walked = steps.select("rank", "place", "node").join(placed, "node").select("rank", "place", "node", "at", "length", (F.col("owner") == F.col("rank")).alias("own"))
    attends = walked.repartition("rank").sortWithinPartitions("rank", "place").mapInArrow(_intervals, "node binary, start long, attends array<array<long>>")
    # Equal nodes have equal other columns.
    columns = ("tree", "length", "position", "loss_start", "loss_end", "written")
    nodes = turns.groupBy("node").agg(*[F.max(c).alias(c) for c in columns])
    return (
        nodes.join(attends, "node").select("tree", "node", "start", "length", "position", "loss_start", "loss_end", "attends", "written"),
        turns.select("conv_id", "place", "node"),
    )


def _ranks(turns: DataFrame) -> DataFrame:
    """``_conv, rank``: conversations numbered so that those below any node follow each other. Runs jobs.

    A conversation's choices are its first node and those whose parent has other children as well. Sorted by their
    choices, two conversations part where their trees fork, and one that ends on the way of another comes before it. A turn is one
    choice at most, of 16 bytes, so a chain of any length that nobody else enters is one choice.
    """
    children = turns.where("place > 0").groupBy("parent").agg(F.min("node").alias("_least"), F.max("node").alias("_greatest"))
    # A table, so that Spark knows its size and can split the turns below a hot first turn in the join.
    forks = materialize(children.where("_least <> _greatest").select("parent"), "forks")
    later = turns.where("place > 0").select("conv_id", "place", "parent", "node").join(forks, "parent", "left_semi")
    choices = turns.where("place = 0").select("conv_id", "place", "node").unionByName(later.select("conv_id", "place", "node"))
    paths = choices.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "node"))).alias("_choices"))
    paths = materialize(paths.select(F.col("conv_id").alias("_conv"), F.col("_choices.node").alias("_path"), F.lit(1).cast("long").alias("_one")), "paths")
    numbered = running(paths, [F.col("_path"), F.col("_conv").asc_nulls_first()], "_one", "rank")
    return materialize(numbered.select("_conv", "rank"), "ranks")


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.binary()), ("start", pa.int64()), ("attends", pa.list_(pa.list_(pa.int64())))])
    current, root, spans = None, 0, []
    for batch in batches:
        out = []
        for rank, _, node, at, length, own in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if rank != current:
                current, root, spans = rank, at, []
            start = at - root
            if own:
                out.append((node, start, [list(s) for s in spans]))
            if spans and spans[-1][1] == start:
                spans[-1] = (spans[-1][0], start + length)
            else:
                spans.append((start, start + length))
        yield _batch(out, schema) if out else pa.RecordBatch.from_pylist([], schema=schema)


def read_conversations(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Read every conversation back from the nodes: digests of its turns and of the text under its loss mask.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. Turns are joined to the nodes that
    hold them and streamed in order; a node that many conversations share is an ordinary hot join key.
    """
    rows = turns.join(nodes.select("node", "written", "loss_start", "loss_end"), "node")
    ordered = rows.select("conv_id", "place", "written", "loss_start", "loss_end").repartition("conv_id")
    return ordered.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place").mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    current, state = None, None

    def done() -> tuple:
        return (current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    for batch in batches:
        out = []
        for conv, _, written, start, end in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if state is None or conv != current:
                if state is not None:
                    out.append(done())
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_turn(written)
            learned = unescape(written[start:end])
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            state[2] += len(learned)
            state[3].update(learned.encode("utf-8", "surrogatepass"))
            state[4] += len(written)
        if out:
            yield _batch(out, schema)
    if state is not None:
        yield _batch([done()], schema)


def stored(nodes: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write the trees out and give what is read back from the files. Runs jobs."""
    return materialize(nodes, "tree-nodes"), materialize(turns, "tree-turns")
