"""The prefix trie of conversations: one row for each distinct sequence of first turns, with totals of its subtree.

Names. A prefix is told apart by two 64-bit sums (xor) of hashes of its turns and their places, so prefixes are
running sums and need no recursion. A node is named by its smallest member and its depth: who is the smallest member
of a node is that of every node below it on its own path, so the nodes of one conversation are one stretch.

Rollup by centroid decomposition of the forest of parent edges. In a component with n nodes, the centroid is the
deepest node with more than n / 2 nodes in its subtree. The total of its subtree, within the component, is added to
every node from the centroid up to the component's top; then the centroid goes, and what hung below it and what is
left above it are components of at most half the size. A node's totals are complete when it is a centroid itself:
whatever lay below it was added once, when it was split off. Sizes of subtrees come from the members: each tells how
many nodes of its own lie below; they are kept up by taking the centroid's size off the same path.

How it runs. Components with more than `most` nodes are split by Spark, all of them in each round, so that rounds
grow with the logarithm of the input and the components never with it; whether a node lies below a centroid or on its
path is a lookup of the centroid's depth on the path of the node's, or the centroid's, smallest member. Smaller
components are decomposed inside tasks, one after another. A conversation or a first turn that a third of all rows
share is never a join key of one task (plans.hot_keys), long conversations are numbered and hashed in stretches, and
the ids of a node with many ends are joined piece by piece.

Defined results: null roles and texts are empty; turns are ordered by turn (null first), those of one turn by the
hash of role and text; rows without a conversation id belong to no conversation and are left out; every other id is
a member of the root, if only by rows that the rebuilding leaves out; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..plans.hot_keys import hot_keys, measured_hot_keys, unique_join
from ..plans.ordering import Ordered
from .arrays import folder_of, known_to_workers

#: The test tables' rebuilding: conversations of a hundred share up to five first turns.
HUNDRED, HEADS = 100, 6
#: Depths that one window hashes, nodes that a task decomposes alone, and ids of one piece of text.
STRETCH = 1024
MOST_NODES = 1 << 14
PIECE = 4096
_NODE = ["conv_id", "depth"]
_PREFIX = ["depth", "p", "q"]
_TOP = ["top_conv", "top_depth"]


def laid_out(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, n: place in the whole table, one, two: hashes, chars) and conversations (conv_id, first n, own: turns)."""
    empty = F.lit("")
    rows = conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), empty).alias("role"), F.coalesce(F.col(f"`{text}`"), empty).alias("text"),
    ).where("conv_id is not null")
    rows = rows.select("conv_id", "turn", F.xxhash64("role", "text").alias("one"), F.xxhash64(F.lit(1), "text", "role").alias("two"), F.length("text").cast("long").alias("chars"))
    # Equal rows are told apart, so that many of them are still dealt over many tasks.
    ordered = Ordered(rows.withColumn("tie", F.monotonically_increasing_id()), "conv_id", "turn", "one", "two", "tie")
    turns = Ordered.plain(ordered.numbered("n")).select("conv_id", "n", "one", "two", "chars")
    return turns, folder_of(turns.groupBy("conv_id").agg(F.min("n").alias("first"), F.count("*").alias("own")))


def plain(conversations: DataFrame, **names: str) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, one, two, chars, reach) and conversations (conv_id, reach: its turns) as they are."""
    turns, convs = laid_out(conversations, **names)
    convs = convs.withColumn("reach", F.col("own"))
    placed = unique_join(turns, convs, ["conv_id"], hot_keys(convs, "own", turns.count()))
    return placed.select("conv_id", (F.col("n") - F.col("first") + 1).alias("depth"), "one", "two", "chars", "reach"), convs.select("conv_id", "reach")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As `plain`, but the first turns of c, crc32(c) % HEADS of them, are replaced by those of c - c % HUNDRED (% has the sign of c)."""
    turns, convs = laid_out(conversations)
    convs = convs.withColumns(
        {"heads": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS, "base": F.col("conv_id") - F.col("conv_id") % HUNDRED}
    )
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("heads", F.coalesce("base_own", F.lit(0))))
    convs = folder_of(convs.withColumn("reach", F.col("taken") + F.greatest(F.col("own") - F.col("heads"), F.lit(0))).drop("base_own"))
    placed = unique_join(turns, convs, ["conv_id"], hot_keys(convs, "own", turns.count())).withColumn("place", F.col("n") - F.col("first"))
    columns = ["conv_id", "depth", "one", "two", "chars", "reach"]
    rest = placed.where("place >= heads").withColumn("depth", F.col("taken") + F.col("place") - F.col("heads") + 1).select(columns)
    heads = placed.where(f"conv_id % {HUNDRED} = 0 and place < {HEADS - 1}").select(F.col("conv_id").alias("base"), "place", "one", "two", "chars")
    heads = heads.join(convs.select("base", "conv_id", "heads", "reach"), "base").where("place < heads")
    heads = heads.withColumn("depth", F.col("place") + 1).select(columns)
    return rest.unionByName(heads), convs.select("conv_id", "reach")


def _prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, p, q (the prefix), u, v (that of its parent), chars, reach; also of every conversation's root."""
    keyed = turns.withColumns(
        {"k": F.xxhash64("depth", "one", "two"), "l": F.xxhash64("two", "one", "depth"), "block": F.floor((F.col("depth") - 1) / STRETCH)}
    )
    blocks = keyed.groupBy("conv_id", "block").agg(F.bit_xor("k").alias("k"), F.bit_xor("l").alias("l"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = blocks.select("conv_id", "block", F.bit_xor("k").over(before).alias("k_ahead"), F.bit_xor("l").over(before).alias("l_ahead"))
    here = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    held = keyed.join(ahead.where("block > 0"), ["conv_id", "block"], "left")

    def running(key: str) -> Column:
        return F.bit_xor(key).over(here).bitwiseXOR(F.coalesce(f"{key}_ahead", F.lit(0)))

    held = held.withColumns({"p": running("k"), "q": running("l")})
    held = held.select("conv_id", "depth", "p", "q", F.col("p").bitwiseXOR(F.col("k")).alias("u"), F.col("q").bitwiseXOR(F.col("l")).alias("v"), "chars", "reach")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", *[zero.alias(c) for c in ("depth", "p", "q", "u", "v", "chars")], "reach")
    return folder_of(held.withColumn("depth", F.col("depth").cast("long")).unionByName(roots))


def nodes(turns: DataFrame, convs: DataFrame, most: int = MOST_NODES) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (longs), ends_sha256: one row a node."""
    known_to_workers(turns.sparkSession)
    members = _prefixes(turns, convs)
    ends = F.col("depth") == F.col("reach")
    found = members.groupBy(*_PREFIX).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("u").alias("u"), F.min("v").alias("v"),
        F.min("chars").alias("chars"), F.count_if(ends).alias("n_ends"),
    )
    found = folder_of(found)
    n_nodes, n_members = found.count(), members.count()

    children = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u").alias("p"), F.col("v").alias("q")).agg(F.count("*").alias("n_children"))
    found = found.join(children, _PREFIX, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    parents = found.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("p").alias("u"), F.col("q").alias("v"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = hot_keys(parents, "n_children", n_nodes).select("depth", "u", "v")
    found = unique_join(found, parents.drop("n_children"), ["depth", "u", "v"], hot, "left")

    # Nodes in each subtree: every member that is the smallest of some nodes tells how many of these lie below.
    tops = found.groupBy("conv_id").agg(F.min("depth").alias("own_from"))
    hot = hot_keys(convs, "reach", n_members)
    below = unique_join(members.select("conv_id", *_PREFIX, "reach"), tops, ["conv_id"], hot)
    below = below.withColumn("nodes", F.greatest(F.lit(0), F.col("reach") - F.greatest("depth", "own_from") + 1))
    sizes = below.groupBy(*_PREFIX).agg(F.sum("nodes").alias("size"))
    found = folder_of(found.join(sizes, _PREFIX).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")))

    tree = found.select(*_NODE, "parent_conv_id", (F.col("n_children") == 0).cast("long").alias("leaf"), "saved", "size")
    totals = _rolled_up(tree, found, members, n_nodes, n_members, max(most, n_nodes // 100_000))
    ends_of = _ends(members.where(ends).select(*_PREFIX, "conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    rows = found.join(totals, _NODE).join(ends_of, _PREFIX, "left")
    return rows.select(
        *_NODE, "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved_below").alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


def _ends(ends: DataFrame) -> DataFrame:
    """depth, p, q, ends_sha256 of the ids that end at each node: pieces of text first, then one stream of pieces a node."""

    def pieces(batches):
        node, ids = None, []
        for batch in batches:
            made = []
            for *key, conv_id in zip(*(column.to_pylist() for column in batch.columns)):
                if key != node or len(ids) >= PIECE:
                    made += [(*node, ids[0], ",".join(map(str, ids)))] if ids else []
                    node, ids = key, []
                ids.append(conv_id)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*made)], names=names)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, ids[0], ",".join(map(str, ids)))], names=names)

    names = [*_PREFIX, "first", "ids"]
    # Two readings could cut the ranges differently, but the pieces are made and used once.
    ordered = ends.repartitionByRange(*_PREFIX, "conv_id").sortWithinPartitions(*_PREFIX, "conv_id")
    cut = ordered.mapInArrow(pieces, "depth long, p long, q long, first long, ids string")

    def hashed(batches):
        node, digest = None, None
        for batch in batches:
            made = []
            for *key, _, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if key != node:
                    made += [(*node, digest.hexdigest())] if node else []
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*made)], names=[*_PREFIX, "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], names=[*_PREFIX, "ends_sha256"])

    streams = cut.repartition(*_PREFIX).sortWithinPartitions(*_PREFIX, "first")
    return streams.mapInArrow(hashed, "depth long, p long, q long, ends_sha256 string")


def decomposed(parents: list[int], sizes: list[int], weights: list[list[int]]) -> list[list[int]]:
    """Totals of every node's subtree in one tree, by centroid decomposition.

    Nodes come parents first (the top has parent -1); `sizes` are the nodes in each subtree, itself included.
    """
    sizes, totals = list(sizes), [[0] * len(parents) for _ in weights]
    branch = [-1] * len(parents)
    open_ = [list(range(len(parents)))] if parents else []
    while open_:
        component = open_.pop()
        top = component[0]
        half = sizes[top]
        centroid = next(node for node in reversed(component) if 2 * sizes[node] > half)
        # In each component the nodes stay parents first: branch tells what is left above (-1) or where below.
        above, pieces, under = [], {}, [centroid]
        for node in component:
            if node == centroid:
                branch[node] = node
                continue
            parent = parents[node]
            if node != top and parent == centroid:
                branch[node] = node
                pieces[node] = [node]
            elif node != top and branch[parent] >= 0:
                branch[node] = branch[parent]
                pieces[branch[node]].append(node)
            else:
                branch[node] = -1
                above.append(node)
                continue
            under.append(node)
        sums = [sum(weight[node] for node in under) for weight in weights]
        taken, node = sizes[centroid], centroid
        while True:
            for total, extra in zip(totals, sums):
                total[node] += extra
            if node != centroid:
                sizes[node] -= taken
            if node == top:
                break
            node = parents[node]
        for piece in (*pieces.values(), above):
            for node in piece:
                branch[node] = -1
            if piece:
                open_.append(piece)
    return totals


_OPEN = ["parent_conv_id", "leaf", "saved", "size", "leaves", "saved_below", *_TOP]


def _rolled_up(tree: DataFrame, found: DataFrame, members: DataFrame, n_nodes: int, n_members: int, most: int) -> DataFrame:
    """conv_id, depth, leaves, saved_below: totals of each subtree of the trie."""
    root = tree.agg(F.min("conv_id")).first()[0]  # the smallest of all ids
    zero = F.lit(0).cast("long")
    top = {"top_conv": F.lit(root).cast("long"), "top_depth": zero}
    live = tree.withColumns({"leaves": zero, "saved_below": zero, **top}).select(*_NODE, *_OPEN)
    done, small, paths = [], [], None
    live = folder_of(live) if n_nodes > most else live
    while n_nodes > most:
        whole = live.groupBy(*_TOP).agg(F.max("size").alias("whole")).where(F.col("whole") > most)
        # At most n_nodes / most rows, which is 100,000 however large the trie is.
        large = F.broadcast(folder_of(whole))
        small.append(live.join(large, _TOP, "left_anti"))
        if large.isEmpty():
            break
        if paths is None:
            paths = _paths(found, members, n_members)
        done_now, live = _split(live.join(large, _TOP), paths, root)
        done.append(done_now)
    small = small or [live]
    settled = _within_tasks(small)
    for part in done:
        settled = settled.unionByName(part)
    return settled


def _paths(found: DataFrame, members: DataFrame, n_members: int) -> DataFrame:
    """conv_id, depth, owner: which node the path of a smallest member passes at each depth."""
    names = found.select(*_PREFIX, F.col("conv_id").alias("owner"))
    hot = hot_keys(found, "n_convs", n_members).select(*_PREFIX)
    rows = unique_join(members.where("depth > 0").select("conv_id", *_PREFIX), names, _PREFIX, hot)
    smallest = found.select("conv_id").distinct()
    return folder_of(rows.join(smallest, "conv_id", "left_semi").select("conv_id", "depth", "owner"))


def _split(live: DataFrame, paths: DataFrame, root: int) -> tuple[DataFrame, DataFrame]:
    """One round: every component of `live` (with its size, `whole`) loses its centroid."""
    centroids = live.where("2 * size > whole").groupBy(*_TOP).agg(F.max_by(F.struct("conv_id", "depth", "size"), "depth").alias("c"))
    centroids = folder_of(centroids.select(*_TOP, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.size").alias("c_size")))
    rows = live.drop("whole").join(F.broadcast(centroids), _TOP)

    # On the path of its smallest member, does a node pass the centroid, and which child of it next?
    asked = rows.where("depth >= c_depth").select(*_TOP, "conv_id", "c_conv", "c_depth").distinct()
    at = paths.select("conv_id", F.col("depth").alias("c_depth"), F.col("owner").alias("at_centroid"))
    at = at.unionByName(asked.where("c_depth = 0").select("conv_id", "c_depth", F.lit(root).alias("at_centroid")).distinct())
    after = paths.select("conv_id", (F.col("depth") - 1).alias("c_depth"), F.col("owner").alias("next_conv"))
    told = asked.join(at, ["conv_id", "c_depth"]).where("at_centroid = c_conv").join(after, ["conv_id", "c_depth"], "left")
    told = folder_of(told.select(*_TOP, "conv_id", "next_conv", F.lit(True).alias("passes")))
    rows = folder_of(unique_join(rows, told, [*_TOP, "conv_id"], measured_hot_keys(live, *_TOP, "conv_id"), "left"))

    below = (F.col("depth") >= F.col("c_depth")) & F.coalesce("passes", F.lit(False))
    sums = rows.where(below).groupBy(*_TOP).agg(F.sum("leaf").alias("leaf_sum"), F.sum("saved").alias("saved_sum"))
    way = paths.join(F.broadcast(centroids.withColumnRenamed("c_conv", "conv_id")), "conv_id").where("depth <= c_depth and depth >= top_depth")
    way = way.select(*_TOP, F.col("owner").alias("conv_id"), "depth")
    way = way.unionByName(centroids.where("top_depth = 0").select(*_TOP, F.lit(root).alias("conv_id"), F.lit(0).cast("long").alias("depth")))
    way = way.join(F.broadcast(sums), _TOP)
    rows = rows.join(way, [*_TOP, *_NODE], "left")

    on_way, centroid = F.col("leaf_sum").isNotNull(), (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
    moved = below & ~centroid
    rows = rows.select(
        *_NODE, "parent_conv_id", "leaf", "saved", F.when(on_way & ~centroid, F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size"),
        (F.col("leaves") + F.coalesce("leaf_sum", F.lit(0))).alias("leaves"), (F.col("saved_below") + F.coalesce("saved_sum", F.lit(0))).alias("saved_below"),
        F.when(moved, F.col("next_conv")).otherwise(F.col("top_conv")).alias("top_conv"),
        F.when(moved, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"), centroid.alias("ready"),
    )
    rows = folder_of(rows)  # read twice: what is done and what goes on
    return rows.where("ready").select(*_NODE, "leaves", "saved_below"), rows.where("not ready").drop("ready")


def _within_tasks(parts: list[DataFrame]) -> DataFrame:
    """Totals in components of bounded size, with what earlier rounds have added."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.repartition(*_TOP).sortWithinPartitions(*_TOP, "depth", "conv_id")
    schema = rows.select(*_NODE, "leaves", "saved_below").schema
    arrow = to_arrow_schema(schema)

    def totals(component: list[tuple]) -> list[tuple]:
        at = {(c, d): i for i, (c, d, *_) in enumerate(component)}
        parents = [at.get((p, d - 1), -1) for _, d, p, *_ in component]
        leaves, saved = decomposed(parents, [r[5] for r in component], [[r[3] for r in component], [r[4] for r in component]])
        return [(r[0], r[1], r[6] + x, r[7] + y) for r, x, y in zip(component, leaves, saved)]

    def run(batches):
        top, component = None, []
        for batch in batches:
            made = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[-2:] != top:
                    made += totals(component)
                    top, component = row[-2:], []
                component.append(row)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made), arrow)], schema=arrow)
        if component:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*totals(component)), arrow)], schema=arrow)

    return rows.select(*_NODE, *_OPEN).mapInArrow(run, schema)
