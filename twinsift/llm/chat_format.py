"""Chat formatting as a prefix tree.

Every turn becomes a string of a template that marks turns and escapes its
control strings inside texts reversibly; conversations that share their first
turns share tree nodes. Tokens are the code points of the formatted text.
All nodes are laid out once, depth first; a node carries

* ``start``, ``length``: its place in that sequence,
* ``position``: the position id of its first token on its path (token ``i``
  of the node has position id ``position + i``),
* ``ancestors``: one attention interval ``(start, end)`` for each earlier turn
  of its path; a token attends to these and to earlier tokens of its node,
* ``loss_start``, ``loss_length``: its tokens under the loss mask (the text
  of an assistant turn),

and a conversation is the node of its last turn.

How: a conversation's turns give a chain of hashes (a node's key covers all
turns up to it), so its path is a list of keys. Distinct paths are
range-sorted, which is the depth-first order of the leaves; a node belongs to
the first path that has it (an aggregate by key, so a first turn shared by a
third of all conversations is reduced before the shuffle), and running
lengths over (path, depth) give the starts: sums inside each range of the
sort plus one total a range. The keys shared most (fewer than 256) are salted
in the joins.

Defined cases: null texts and roles are empty strings; turns are ordered by
(turn, role, text), null turns first, repeated rows are turns of their own;
rows without a conversation id form one conversation; an empty table gives no
rows; extra columns are ignored. The turns of one conversation meet in one
task (as hashes for the chain, as texts when it is read back), like one
document.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsift.llm import common

# --------------------------------------------------------------- template
_FRAME = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("", "</s>")}
_OTHER = ("<|role:", "|>", "<|end|>")
_CONTROL = re.compile(r"\[/?INST\]|<</?SYS>>|</?s>|<\|")
_ESCAPED = re.compile(r"\\(.)", re.S)
_ROLE = re.compile(r"<\|role:((?:\\.|[^\\|])*)\|>", re.S)


def escape(text: str) -> str:
    """Backslashes are doubled and one is put into each control string, so
    that none is left whole; ``unescape`` takes one backslash off each."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """The formatted turn and the start and length of its loss mask."""
    role, body = role or "", escape(text or "")
    if role in _FRAME:
        head, tail = _FRAME[role]
    else:
        head, tail = _OTHER[0] + role.replace("\\", "\\\\").replace("|", "\\|") + _OTHER[1], _OTHER[2]
    return head + body + tail, len(head), len(body) if role == "assistant" else 0


def parse_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out, at = [], 0
    while at < len(text):
        for role, (head, tail) in _FRAME.items():
            if head and text.startswith(head, at):
                break
        else:
            m = _ROLE.match(text, at)
            role, head, tail = (unescape(m[1]), m[0], _OTHER[2]) if m else ("assistant", "", "</s>")
        end = text.index(tail, at + len(head))
        out.append((role, unescape(text[at + len(head):end])))
        at = end + len(tail)
    return out


# ------------------------------------------------------------------- tree
def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    t = conversations.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                             F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                             F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in t.schema}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(*format_turn(r, x), hashlib.sha256(f"{len(r)}:{r}{x}".encode("utf-8", "surrogatepass")).digest()[:16])
                for r, x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        cols = list(zip(*rows, strict=True)) if rows else [()] * 4
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2).cast(pa.string()), pa.array(cols[0], pa.string()),
             pa.array([len(x) for x in cols[0]], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.binary())],
            names=["conv_id", "turn", "role", "tokens", "length", "loss_start", "loss_length", "hash"])

    return common.map_batches(t, run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, tokens string, "
                                      "length long, loss_start long, loss_length long, hash binary")


def _paths(turns: DataFrame) -> DataFrame:
    """One row a conversation: its path of node keys and the turns' lengths."""
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "hash", "length"))).alias("t"))
    lists = lists.select("conv_id", F.col("t.hash").alias("hashes"), F.col("t.length").alias("lengths"))
    id_type = lists.schema["conv_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        paths = []
        for hashes in batch.column(1).to_pylist():
            key, path = b"", []
            for h in hashes:
                key = hashlib.sha256(key + h).digest()[:16]
                path.append(key)
            paths.append(path)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.list_(pa.binary())), batch.column(2)],
                                          names=["conv_id", "path", "lengths"])

    return common.map_batches(lists, run, f"conv_id {id_type}, path array<binary>, lengths array<bigint>")


def prefix_tree(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The tree (one row a node, see above, ``tokens`` the formatted turn)
    and the conversations (conv_id, leaf_start)."""
    turns = common.stored(_turns(conversations, conv_col, turn_col, role_col, text_col), "chat-turns")
    paths = common.stored(_paths(turns), "chat-paths")
    leaf = F.element_at("path", -1)
    unique = paths.groupBy(leaf.alias("leaf")).agg(F.first("path").alias("path"), F.first("lengths").alias("lengths"))
    # The rank is (range of the sort, place in it); stored, so it stays.
    ranked = unique.repartitionByRange("path").sortWithinPartitions("path").select(
        F.monotonically_increasing_id().alias("rank"), "leaf", "path", "lengths")
    ranked = common.stored(ranked, "chat-ranked")
    # Position ids: the lengths before each turn of the path.
    steps = ranked.select("rank", F.posexplode(F.arrays_zip("path", "lengths")).alias("depth", "s"), "lengths")
    steps = steps.select("rank", "depth", F.col("s.path").alias("node"), F.col("s.lengths").alias("length"))
    position = F.sum("length").over(Window.partitionBy("rank").orderBy("depth")) - F.col("length")
    steps = common.stored(steps.withColumn("position", position), "chat-steps")
    nodes = steps.groupBy("node").agg(F.min("rank").alias("rank"), F.first("depth").alias("depth"), F.first("length").alias("length"),
                                      F.first("position").alias("position"), F.count(F.lit(1)).alias("paths"))
    nodes = common.stored(nodes.withColumn("range", F.shiftright("rank", 33)), "chat-nodes")
    totals = nodes.groupBy("range").agg(F.sum("length").alias("total"))
    offsets = totals.select("range", (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("offset"))
    inside = Window.partitionBy("range").orderBy("rank", "depth")
    placed = nodes.withColumn("start", F.sum("length").over(inside) - F.col("length")).join(offsets, "range")
    placed = common.stored(placed.select("node", "rank", "depth", "length", "position", "paths",
                                         (F.col("start") + F.col("offset")).alias("start")), "chat-placed")
    hot = common.heavy_keys(placed, "node", "paths")
    spans = common.salted_join(steps.select("rank", "depth", "node"), placed.select("node", "start", "length"), "node", hot,
                               "rank", "inner")
    spans = spans.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct(
        "depth", "start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"))
    spans = common.stored(spans, "chat-spans")
    # A turn that stands for each node: that of the smallest conversation of
    # the node's first path.
    owners = paths.groupBy(leaf.alias("leaf")).agg(F.min_by("conv_id", F.struct("conv_id")).alias("conv_id"))
    numbered = turns.withColumn("depth", F.row_number().over(
        Window.partitionBy("conv_id").orderBy("turn", "role", "hash", "length")) - 1)
    first = placed.join(ranked.select("rank", "leaf"), "rank").join(owners, "leaf").join(spans, "rank").alias("n")
    t = numbered.alias("t")
    tree = first.join(t, F.col("n.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("n.depth") == F.col("t.depth"))).select(
        F.col("n.start").alias("start"), F.col("n.length").alias("length"), F.col("n.depth").alias("depth"), "n.position", "n.paths",
        F.transform(F.expr("slice(n.spans, 1, n.depth)"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("ancestors"),
        "t.loss_start", "t.loss_length", "t.tokens")
    ends = spans.select("rank", F.element_at("spans", -1)["start"].alias("leaf_start")).join(ranked.select("rank", "leaf"), "rank")
    of_leaf = paths.select("conv_id", leaf.alias("leaf"))
    copies = of_leaf.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    convs = common.salted_join(of_leaf, ends.drop("rank"), "leaf", common.heavy_keys(copies, "leaf", "n"), "conv_id", "inner")
    return tree, convs.select("conv_id", "leaf_start")


def read_conversations(tree: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a conversation from a written tree: conv_id and ``nodes``, its
    nodes' (position, tokens, loss_start, loss_length) in order. Each distinct
    leaf is read once; nodes on many paths are salted."""
    leaves = convs.groupBy("leaf_start").agg(F.count(F.lit(1)).alias("n"))
    own = tree.select(F.col("start").alias("leaf_start"), F.col("ancestors"), "length").join(leaves, "leaf_start")
    spans = F.concat(F.col("ancestors.start"), F.array("leaf_start"))
    steps = own.select("leaf_start", F.explode(spans).alias("start"))
    hot = common.heavy_keys(tree.select("start", "paths"), "start", "paths")
    node = tree.select("start", "position", "tokens", "loss_start", "loss_length")
    texts = common.salted_join(steps, node, "start", hot, "leaf_start", "inner").groupBy("leaf_start").agg(
        F.sort_array(F.collect_list(F.struct("position", "tokens", "loss_start", "loss_length"))).alias("nodes"))
    return common.salted_join(convs, texts, "leaf_start", common.heavy_keys(leaves, "leaf_start", "n"), "conv_id", "inner").select("conv_id", "nodes")


def digests(read: DataFrame) -> DataFrame:
    """Digest columns of conversations read back."""
    id_type = read.schema["conv_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for nodes in batch.column(1).to_pylist():
            text = "".join(n["tokens"] for n in nodes)
            turns = parse_turns(text)
            loss = [unescape(n["tokens"][n["loss_start"]:n["loss_start"] + n["loss_length"]]) for n in nodes]
            enc = lambda s: s.encode("utf-8", "surrogatepass")
            rows.append((len(turns), hashlib.sha256(enc("".join(f"{r}\n{t}\n" for r, t in turns))).hexdigest(),
                         sum(map(len, loss)), hashlib.sha256(enc("".join(loss))).hexdigest(), len(text)))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                          names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return common.map_batches(read, run, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, "
                                         "loss_sha256 string, formatted_chars long")
