"""Chat formatting of reply trees.

Messages name their parent; iterative self-joins with doubling (each round joins the table of 2^k-th
ancestors with itself) enumerate every root-to-leaf path in log2(depth) rounds, branches are ranked
by score within their root, and each chosen path becomes one conversation string in a template whose
control strings cannot occur inside texts.

Template, per turn: ``<|role|>\\n`` text ``</s>\\n``. Texts are escaped reversibly: ``&``, ``<`` and
``[`` become ``&amp;``, ``&lt;`` and ``&#91;`` (roles also ``|``), so no control string that starts
with ``<`` or ``[`` survives inside a text. The loss mask is a list of code point spans.

Scale: no recursion on the driver, every round is written to the shared folder; rows are the sum of
path lengths, which is the size of the output. A message with a third of all replies is a hot key of
a join of two scans, which adaptive execution splits. Ranking is salted. Only one conversation's own
turns meet in one task, as its string must.

Edge cases: null texts and roles are empty; a parent that does not exist makes a root; messages that
reach no root (a cycle) give no path. Ties of score go to the smaller leaf. Repeated turns keep all
rows, ordered by (turn, role, text). An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import stash

END = "</s>\n"
# The escapes, in the order in which they are applied.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ESCAPES = ESCAPES + (("|", "&#124;"),)


def escape(c: Column, pairs=ESCAPES) -> Column:
    for plain, coded in pairs:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column, pairs=ESCAPES) -> Column:
    for plain, coded in reversed(pairs):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def root_to_leaf_paths(nodes: DataFrame) -> DataFrame:
    """nodes (node, parent) -> (leaf, node, height): every node of every root-to-leaf path, leaf at height 0."""
    links = nodes.select(F.col("node").alias("n"), F.col("parent").alias("p")).filter("p is not null and n <> p")
    ids = nodes.select(F.col("node").alias("p"))
    jump = stash(links.join(ids, "p", "left_semi").select(F.col("n").alias("node"), F.col("p").alias("up")), "jump")
    total, jumps = nodes.count(), []
    while not jump.isEmpty():
        if len(jumps) > math.log2(total + 1) + 1:
            break  # what still jumps runs in a cycle
        jumps.append(jump)
        again = jump.select(F.col("node").alias("mid"), F.col("up").alias("far"))
        jump = stash(jump.join(again, jump.up == again.mid).select("node", F.col("far").alias("up")), "jump")
    parents = (jumps[0] if jumps else jump).select(F.col("up").alias("node"))
    leaves = nodes.select("node").join(parents, "node", "left_anti")
    if not jump.isEmpty():
        leaves = leaves.join(jump.select("node"), "node", "left_anti")
    paths = stash(leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("height")), "paths")
    for k, step in enumerate(jumps):
        hop = step.select(F.col("node").alias("mid"), "up")
        higher = paths.join(hop, paths.node == hop.mid).select("leaf", F.col("up").alias("node"), (F.col("height") + (1 << k)).alias("height"))
        paths = stash(paths.union(higher), "paths")
    return paths


def best_branches(paths: DataFrame, scores: DataFrame, top_k: int, salts: int = 64) -> DataFrame:
    """The top_k leaves of each root by mean message score: (leaf, root, rank)."""
    scored = paths.join(scores, "node").groupBy("leaf").agg(
        F.max_by("node", "height").alias("root"), F.avg("score").alias("score")
    )
    order = (F.col("score").desc_nulls_last(), F.col("leaf"))
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("leaf"), F.lit(salts)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("root", "salt").orderBy(*order))).filter(F.col("rank") <= top_k)
    final = first.withColumn("rank", F.row_number().over(Window.partitionBy("root").orderBy(*order))).filter(F.col("rank") <= top_k)
    return final.select("leaf", "root", "rank")


def format_turns(turns: Column) -> tuple[Column, Column]:
    """array<struct<role,text>> -> (formatted string, loss spans array<struct<start,len>> of assistant texts)."""
    head = lambda t: F.concat(F.lit("<|"), escape(t["role"], ROLE_ESCAPES), F.lit("|>\n"))
    formatted = F.array_join(F.transform(turns, lambda t: F.concat(head(t), escape(t["text"]), F.lit(END))), "")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,len:bigint>>").alias("spans"))

    def step(acc, t):
        begin = acc["at"] + F.length(head(t))
        size = F.length(escape(t["text"])).cast("long")
        span = F.array(F.struct(begin.alias("start"), size.alias("len")))
        spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((begin + size + len(END)).alias("at"), spans.alias("spans"))

    return formatted, F.aggregate(turns, start, step, lambda acc: acc["spans"])


def read_turns(formatted: Column) -> Column:
    """The turns back from a formatted string: array<struct<role,text>>."""
    pieces = F.split(formatted, END, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p):
        close = F.instr(p, "|>\n")
        role = F.substr(p, F.lit(3), close - 3)
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(F.substr(p, close + 3)).alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["len"].cast("int")))), "")


def format_trees(messages: DataFrame, top_k: int = 1) -> DataFrame:
    """messages (node, parent, tree, role, text, score) -> leaf, root, tree, rank, n_turns, formatted, loss_spans."""
    messages = stash(messages.select("node", "parent", "tree", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "score"), "messages")
    paths = root_to_leaf_paths(messages.select("node", "parent"))
    chosen = stash(best_branches(paths, messages.select("node", "score"), top_k), "branches")
    steps = paths.join(chosen, "leaf").join(messages.select("node", "tree", "role", "text"), "node")
    turns = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("height")).alias("o"), "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    talks = steps.groupBy("leaf", "root", "rank").agg(F.max_by("tree", "height").alias("tree"), turns.alias("turns"))
    formatted, spans = format_turns(F.col("turns"))
    return talks.select("leaf", "root", "tree", "rank", F.size("turns").cast("long").alias("n_turns"), formatted.alias("formatted"), spans.alias("loss_spans"))


def linear_messages(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) as trees without branches: each turn answers the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = F.row_number().over(order)
    name = lambda i: F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.lit("#"), i.cast("string"))
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("at", at)
    return rows.select(
        name(F.col("at")).alias("node"), F.when(F.col("at") > 1, name(F.col("at") - 1)).alias("parent"), F.col("conv_id").alias("tree"),
        "role", "text", F.length(F.coalesce("text", F.lit(""))).cast("double").alias("score"),
    )
