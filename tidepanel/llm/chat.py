"""Chat formatting of reply trees, in DataFrame operations only.

Replies point to their parents. Ancestors are found by repeated self-joins, each twice as far as
the one before, which also sums scores along the way; the leaves of a tree are ranked by the
score of their path, the chosen paths are walked back by the same jumps, and each is written as
one conversation with a loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.text import bind
from tidepanel.session import write_table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """One backslash more between every ``<`` and ``|``: no control string is left, none is lost."""
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")).otherwise(text)


def unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")).otherwise(text)


def escape_role(role: Column) -> Column:
    """A role is one line: % and newline as %25 and %0A."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _order() -> list[Column]:
    """How the messages of a tree are numbered: by id, then role and text where ids repeat."""
    return [F.col("node"), F.col("role"), F.col("h")]


def _keyed(messages: DataFrame, node: str) -> DataFrame:
    return messages.withColumns({
        "t": F.coalesce(F.col("tree_id").cast("string"), F.lit("\0")), "node": F.col(node),
        "role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit("")),
        "h": F.xxhash64(F.coalesce("text", F.lit(""))),
    })


def format_turns(messages: DataFrame) -> DataFrame:
    """Conversations without branches: (tree_id, turn, role, text), each turn answering the one before."""
    keyed = _keyed(messages, "turn")
    pos = F.row_number().over(Window.partitionBy("t").orderBy(*_order()))
    links = keyed.select("t", pos.alias("pos"))
    links = links.select("t", "pos", F.when(F.col("pos") > 1, F.col("pos") - 1).alias("up"), F.lit(0.0).alias("score"))
    return _format(_whole(keyed, _paths(write_table(links, "links"), 1)))


def format_trees(messages: DataFrame, top: int = 1) -> DataFrame:
    """Reply trees (tree_id, node_id, parent_id, role, text, score) as their ``top`` best paths.

    Paths go from a root to a leaf and are ranked by summed score, then length, then the leaf's
    place. A message without a parent, or whose parent is not in the tree, is a root. Rows that
    repeat a node_id are messages of their own; replies to that id answer the first. Messages on
    a circle of parents lie on no path. Null tree_id: one tree; null role and text: empty; null
    score: 0; a null node_id is no one's parent. An empty table gives no rows; other columns are
    ignored.

    A conversation is one value and has to fit in a task, its tree need not; everything before the
    texts meet their paths moves ids only.
    """
    keyed = _keyed(messages, "node_id")
    pos = F.row_number().over(Window.partitionBy("t").orderBy(*_order()))
    nodes = write_table(keyed.select("t", "node", "parent_id", "score", pos.alias("pos")), "nodes")
    first = nodes.where(F.col("node").isNotNull()).groupBy("t", F.col("node").alias("parent_id")).agg(F.min("pos").alias("up"))
    links = nodes.join(first, ["t", "parent_id"], "left").select("t", "pos", "up", F.coalesce("score", F.lit(0.0)).alias("score"))
    return _format(_chosen(keyed, _paths(write_table(links, "links"), top)))


def _ancestors(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(t, pos, length, total) of each message's path from its root, and the jumps (t, pos, up) by round.

    Round k holds for each message its ancestor 2**k steps up and the sums over the steps between.
    """
    now = links.select("t", "pos", "up", F.lit(1).cast("long").alias("length"), F.col("score").alias("total"))
    done, jumps = now.where(F.col("up").isNull()).drop("up"), []
    longest = links.agg(F.max("pos")).first()[0] or 0
    while 1 << len(jumps) <= 2 * longest:
        active = now.where(F.col("up").isNotNull())
        if active.isEmpty():
            break
        jumps.append(active.select("t", "pos", "up"))
        far = now.select("t", F.col("pos").alias("up"), F.col("up").alias("next"), F.col("length").alias("more"), F.col("total").alias("rest"))
        step = active.join(far, ["t", "up"]).select(
            "t", "pos", F.col("next").alias("up"), (F.col("length") + F.col("more")).alias("length"), (F.col("total") + F.col("rest")).alias("total")
        )
        now = write_table(step.unionByName(now.where(F.col("up").isNull())), "ancestors")
        done = now.where(F.col("up").isNull()).drop("up")
    return done, jumps


def _paths(links: DataFrame, top: int) -> DataFrame:
    """(t, rank, pos, back): the positions on each chosen path and how many steps they lie before its end."""
    ends, jumps = _ancestors(links)
    parents = links.where(F.col("up").isNotNull()).select("t", F.col("up").alias("pos")).distinct()
    best = Window.partitionBy("t").orderBy(F.desc("total"), F.desc("length"), "pos")
    leaves = ends.join(parents, ["t", "pos"], "left_anti").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    steps = leaves.select("t", "rank", "pos", F.lit(0).cast("long").alias("back"))
    for k in range(len(jumps) - 1, -1, -1):
        steps = write_table(steps, "paths")
        further = steps.join(jumps[k], ["t", "pos"]).select("t", "rank", F.col("up").alias("pos"), (F.col("back") + (1 << k)).alias("back"))
        steps = steps.unionByName(further)
    return steps


def _whole(keyed: DataFrame, steps: DataFrame) -> DataFrame:
    """The turns of paths that hold every message of their tree: one shuffle of the texts."""
    ordered = F.sort_array(F.collect_list(F.struct("back", "pos")), asc=False)
    places = steps.groupBy("t", "rank").agg(F.transform(ordered, lambda x: x["pos"]).alias("places"))
    messages = keyed.groupBy("t").agg(
        F.min("tree_id").alias("tree_id"),
        F.sort_array(F.collect_list(F.struct("node", "role", "h", "text"))).alias("all"),
    )
    both = messages.join(places.hint("shuffle_hash"), "t")
    return bind(both, turns=F.transform("places", lambda p: F.get(F.col("all"), p - 1))).drop("all", "places")


def _chosen(keyed: DataFrame, steps: DataFrame) -> DataFrame:
    """The turns of some paths of a tree: only their messages are gathered, however wide the tree."""
    pos = F.row_number().over(Window.partitionBy("t").orderBy(*_order()))
    path = keyed.select("t", pos.alias("pos"), "tree_id", "role", "text").join(steps.hint("shuffle_hash"), ["t", "pos"])
    return path.groupBy("t", "rank").agg(
        F.min("tree_id").alias("tree_id"),
        F.sort_array(F.collect_list(F.struct("back", "role", "text")), asc=False).alias("turns"),
    )


def _format(both: DataFrame) -> DataFrame:
    parts = bind(both, parts=F.transform("turns", lambda m: F.struct(
        F.concat(escape_role(m["role"]), F.lit("\n")).alias("head"), escape(m["text"]).alias("body"), (m["role"] == "assistant").alias("learned"))))
    block = lambda p: F.concat(F.lit(OPEN), p["head"], p["body"], F.lit(CLOSE + "\n"))
    mask = lambda p: F.struct((F.length(p["head"]) + 1).alias("start"), F.when(p["learned"], F.length(p["body"])).otherwise(0).alias("length"))
    return parts.select(
        "tree_id", "rank", F.array_join(F.transform("parts", block), "").alias("formatted"), F.transform("parts", mask).alias("loss")
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """What :func:`format_trees` returns, with ``turns`` (role, text) and ``learned`` read back.

    ``loss`` has for each turn the span, in code points of the turn's block, that is learned;
    length 0 means none. ``learned`` is the unescaped text of these spans.
    """
    blocks = bind(formatted, blocks=F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, F.size("loss")))

    def turn(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        body = F.substring_index(F.substr(block, F.length(head) + 2), CLOSE, 1)
        return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))

    learned = F.zip_with("blocks", "loss", lambda b, m: unescape(F.substr(b, m["start"], m["length"])))
    return bind(blocks, turns=F.transform("blocks", turn), learned=F.array_join(learned, "")).drop("blocks")
