"""Connected components by repeated contraction, and what near-duplicate
operators report of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links between node ids -> rows (node, root), one for each node
    that has a link; nodes share a root exactly when links connect them.

    Each round lets every node point to the least node of its neighbourhood,
    by a hashed order, and replaces both ends of every link by what they point
    to. Connected nodes stay connected, others stay apart, and about half of
    the nodes go, so the rounds number about the logarithm of the largest
    component. The pointers are then followed back, smallest table first. All
    state is in written tables; only the count of links left reaches the
    driver. Joins have plain exchanges on both sides, so a node with many
    links is split by adaptive execution.
    """
    links = written(_ordered(edges).distinct(), "links")
    pointers = []
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("to")))
        key = F.struct(F.xxhash64("to"), F.col("to").alias("to"))
        own = F.struct(F.xxhash64("node"), F.col("node").alias("to"))
        point = written(both.groupBy("node").agg(F.min(key).alias("k")).select(
            "node", F.least(F.col("k"), own).getField("to").alias("root")), "pointers")
        pointers.append(point)
        left = links.join(point.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        # written between the joins: the second has plain exchanges as well
        left = written(left.select(F.col("ra").alias("a"), "b"), "half-links")
        moved = left.join(point.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        links = written(_ordered(moved.select("a", F.col("rb").alias("b"))).distinct(), "links")
    if not pointers:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    roots = pointers.pop()
    while pointers:
        lower = pointers.pop()
        up = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = written(lower.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
    return roots


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def tree_links(parent: list[int]) -> list[tuple[int, int]]:
    """Few links that connect what ``parent`` (a union-find forest over 0, 1,
    ...) connects: every member with the first of its run of 32, and the firsts
    of runs with the first of all. No member gets more than 33 + runs links."""
    members: dict[int, list[int]] = {}
    for x in range(len(parent)):
        root = x
        while parent[root] != root:
            root = parent[root]
        parent[x] = root
        members.setdefault(root, []).append(x)
    links = []
    for group in members.values():
        for k, x in enumerate(group[1:], 1):
            links.append((group[k - k % 32] if k % 32 else group[0], x))
    return links


def forest(near) -> list[tuple[int, int]]:
    """Few links that connect what a symmetric boolean matrix connects."""
    parent, todo = list(range(len(near))), set(near.any(axis=1).nonzero()[0].tolist())
    while todo:
        start = todo.pop()
        stack = [start]
        while stack:
            for m in near[stack.pop()].nonzero()[0].tolist():
                if m in todo:
                    todo.discard(m)
                    parent[m] = start
                    stack.append(m)
    return tree_links(parent)


def linked_rows(keyed: DataFrame, row_id: str, found: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Rows (row_id, key) and what cells found (key, links, a, b) -> one row
    per row: row_id, n_links, component_id (the smallest id reached), kept, and
    ``more``: columns of ``keyed``, or root, the name of the component (ids may
    repeat, so component_id does not name it).

    Rows of one key are copies and link with each other. Counts go through
    the classes; only written tables meet in joins.
    """
    degree = found.where("key is not null").groupBy("key").agg(F.sum("links").alias("others"))
    roots = connected_components(found.where("a is not null").select("a", "b"))
    classes = keyed.groupBy("key").agg(F.count("*").alias("copies"), F.min(row_id).alias("low")).join(
        degree, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "root", F.coalesce("root", "key"))
    classes = written(classes, "classes")
    lowest = written(classes.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    of_class = written(classes.join(lowest, "root").select(
        "key", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id",
        *(c for c in more if c == "root")), "class-results")
    return keyed.select(row_id, "key", *(c for c in more if c != "root")).join(of_class, "key").select(
        row_id, "n_links", "component_id", F.col(row_id).eqNullSafe(F.col("component_id")).alias("kept"), *more)
