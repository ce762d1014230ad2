"""Chat formatting of reply trees, with DataFrame functions only.

Paths are enumerated by iterative self-joins that double the distance each time: round i joins every node with
its ancestor 2**i steps up, so a branch of n turns takes log2(n) rounds, and keys are nodes, never whole
trees.  Sums along the way give each leaf its path's score; the best leaves of each tree are chosen, and only their paths
are spelled out, by the same jumps.

A turn reads "### role:\\ntext</turn>\\n".  The control strings "### " and "</turn>" inside a text, and the
backslash itself, are written as a backslash and a letter, so that plain replacement reads them back.
The loss mask has a span of code points for the text of each assistant turn.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import dropped, written

OPEN, HEAD, CLOSE = "### ", ":\n", "</turn>\n"
#: What is replaced, in this order; read back in the reverse order.
_ESCAPES = (("\\", "\\s"), ("### ", "\\o"), ("</turn>", "\\c"))
_ROLE_ESCAPES = (*_ESCAPES, (":", "\\d"), ("\n", "\\n"))


def _replaced(c: Column, pairs) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def escaped(text: Column, role: bool = False) -> Column:
    return _replaced(text, _ROLE_ESCAPES if role else _ESCAPES)


def unescaped(text: Column, role: bool = False) -> Column:
    return _replaced(text, [(b, a) for a, b in reversed(_ROLE_ESCAPES if role else _ESCAPES)])


def best_paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(tree, path, pos, node): the nodes, from the root, of the `top` best branches of each tree.

    nodes: tree string, node long (unique in its tree), parent long (null or absent: a root), score double.  A branch runs
    from a root to a node without replies; branches rank by mean score (a null is 0), then length, then
    smallest leaf; path is the leaf.  Nodes on a cycle reach no root and stand in no branch.
    """
    nodes = written(nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    start = nodes.join(known, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("steps"), F.col("score").alias("total"))
    start = written(start, "start")
    # at round k, `below` has the nodes with an ancestor 2**k steps up; the others know their root's distance and are done
    below, done, jumps = start.where("up is not null"), [start.where("up is null")], []
    for _ in range(nodes.count().bit_length() + 1):
        if below.isEmpty():
            break
        jumps.append(below)
        at = reduce(DataFrame.union, (x.select("tree", F.col("node").alias("up"), F.col("up").alias("far"), F.col("steps").alias("more"), F.col("total").alias("add")) for x in (below, *done)))
        met = written(below.join(at, ["tree", "up"]).select("tree", "node", F.col("far").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("total") + F.col("add")).alias("total")), "jumps")
        below = met.where("up is not null")
        done.append(met.where("up is null"))
    ends = reduce(DataFrame.union, done).select("tree", "node", "steps", "total")
    leaves = ends.join(nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct(), ["tree", "node"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy((F.col("total") / (F.col("steps") + 1)).desc(), F.col("steps").desc(), "node"))
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= top)
    path = written(chosen.select("tree", F.col("node").alias("path"), "steps", "node"), "paths")
    for k, jump in enumerate(jumps):
        further = path.join(jump.select("tree", "node", "up"), ["tree", "node"]).select("tree", "path", (F.col("steps") - (1 << k)).alias("steps"), F.col("up").alias("node"))
        longer = written(path.select("tree", "path", "steps", "node").union(further), "paths")
        dropped(path)
        path = longer
    return path.select("tree", "path", F.col("steps").alias("pos"), "node")


def formatted(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, path, n_turns, formatted, mask): one conversation for each of the best branches of each tree.

    messages: tree string, node long, parent long, role, text, score.  A null role or text is empty.  mask has, turn by
    turn, the first code point and length of the text to learn from (null for roles but assistant).  An empty table gives an empty result.
    """
    paths = best_paths(messages, top)
    turns = paths.join(messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")), ["tree", "node"])
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), role=True), F.lit(HEAD))
    turns = turns.select("tree", "path", "pos", head.alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("learn"))
    size = F.char_length("head") + F.char_length("body") + len(CLOSE)
    so_far = Window.partitionBy("tree", "path").orderBy("pos")
    turns = turns.withColumn("first", F.sum(size.cast("long")).over(so_far) - F.char_length("body") - len(CLOSE))
    span = F.when(F.col("learn"), F.struct(F.col("first").alias("first"), F.char_length("body").cast("long").alias("length")))
    every = F.sort_array(F.collect_list(F.struct("pos", F.concat("head", "body", F.lit(CLOSE)).alias("turn"), span.alias("span"))))
    out = turns.groupBy("tree", "path").agg(every.alias("every"))
    return out.select("tree", "path", F.size("every").cast("long").alias("n_turns"), F.array_join("every.turn", "").alias("formatted"), F.col("every.span").alias("mask"))


def parsed(conversations: DataFrame) -> DataFrame:
    """(tree, path, pos, role, text, learnt, chars): the turns read back from formatted(); learnt is the text under the loss mask, chars the conversation's code points."""
    pieces = F.split("formatted", CLOSE)
    rows = conversations.select("tree", "path", F.char_length("formatted").cast("long").alias("chars"), F.posexplode(F.arrays_zip(F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("piece"), F.col("mask").alias("span"))).alias("pos", "x"))
    rows = rows.select("tree", "path", "chars", "pos", F.col("x.piece").alias("piece"), F.col("x.span").alias("span"))
    size = (F.char_length("piece") + len(CLOSE)).cast("long")
    before = F.sum(size).over(Window.partitionBy("tree", "path").orderBy("pos")) - size
    cut = F.instr("piece", HEAD)
    rows = rows.withColumn("before", before).withColumn("cut", cut)
    piece, at = F.col("piece"), F.col("cut")
    under = F.substring(piece, (F.col("span.first") - F.col("before") + 1).cast("int"), F.col("span.length").cast("int"))
    return rows.select(
        "tree", "path", "pos", "chars",
        unescaped(F.substring(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1), role=True).alias("role"),
        unescaped(F.substring(piece, at + len(HEAD), F.char_length(piece))).alias("text"),
        F.coalesce(unescaped(under), F.lit("")).alias("learnt"),
    )


def chains(conversations: DataFrame) -> DataFrame:
    """Messages of linear conversations (conv_id, turn, role, text): each turn replies to the one before it.

    Turns that share a number stand by role and text; a null turn stands first; rows without a conv_id are one conversation.
    """
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    rows = conversations.select(tree.alias("tree"), "conv_id", "turn", "role", "text")
    order = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    rows = rows.select("tree", "conv_id", order.alias("node"), "role", "text")
    return rows.select("tree", "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def op3_reply_trees(spark, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings in its texts, formatted, read back and digested."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    hard = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    messages = written(chains(given.union(own)), "messages")
    turns = parsed(formatted(messages))
    listed = F.sort_array(F.collect_list(F.struct("pos", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn"), "learnt")))
    read = turns.groupBy("tree", "path").agg(listed.alias("t"), F.max("chars").alias("formatted_chars"))
    said, learnt = F.array_join("t.turn", ""), F.array_join("t.learnt", "")
    return read.select(
        F.when(F.col("tree") != "null", F.col("tree").cast("long")).alias("conv_id"), F.size("t").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
