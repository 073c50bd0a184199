"""One group identifier for every record linked directly or through others.

Connected components by reduction: vertices of degree one are stripped again and again, maximal
chains of degree-two vertices are contracted in logarithmically many steps of pointer jumping
(list ranking), what remains is solved: in one task by union-find once it has at most CORE_LINKS links, before
that by contraction towards the smallest neighbour; and the removed vertices then take over the label of the
vertex they were removed towards, in reverse order.

Each step is a join of the shrinking edge table with itself; a hub of millions of links is split by
adaptive execution, its links are never gathered.  A group's smallest id is a plain minimum, reduced
before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.runtime import Scratch

CORE_LINKS = 500_000  #: links of a reduced core that one task solves, some 50 MB; a larger one is contracted further
#: An id: prefix S1-, S2- or S3- and eight digits, in any letter case, with any white space around it.
ID = r"(?U)^\s*([sS][123]-[0-9]{8})\s*$"
#: What stands between the ids of a list.
SEPARATORS = r"(?U)[,;|\s]+"


def clean_id(c):
    """The id in upper case, '' for anything else."""
    return F.upper(F.regexp_extract(F.coalesce(c, F.lit("")), ID, 1))


def list_ids(c):
    """The items of an id list, as they stand; commas, semicolons, bars and white space separate them."""
    return F.split(F.coalesce(c, F.lit("")), SEPARATORS)


def id_number(c):
    """An id's source and number as one long in the order of the ids, null for anything else."""
    clean = clean_id(c)
    return F.when(clean != "", F.substring(clean, 2, 1).cast("long") * 100_000_000 + F.substring(clean, 4, 8).cast("long"))


def number_id(n):
    """The id of an ``id_number``."""
    return F.concat(F.lit("S"), F.floor(n / 100_000_000).cast("string"), F.lit("-"), F.lpad((n % 100_000_000).cast("string"), 8, "0"))


def match_links(matches: DataFrame, key: str = "source1_entity_id", ids: str = "matched_entity_ids") -> DataFrame:
    """``a``, ``b``, as ``id_number``: a link for every valid id in every row's list, and (id, id) for each valid id, also one that is alone.

    Null, empty or malformed lists and keys give no link; valid ids of a row whose key is no id still
    occur as vertices.  A list is not gathered from other rows: repeated rows give repeated links, removed here.
    """
    rows = matches.select(id_number(F.col(f"`{key}`")).alias("a"), F.explode_outer(list_ids(F.col(f"`{ids}`"))).alias("b"))
    rows = rows.select("a", id_number(F.col("b")).alias("b"))
    ends = F.array(
        F.struct(F.col("a").alias("x"), F.col("a").alias("y")),
        F.struct(F.col("b").alias("x"), F.col("b").alias("y")),
        F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
    )
    return rows.select(F.explode(ends).alias("e")).select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct()


def record_groups(matches: DataFrame) -> DataFrame:
    """``entity_id``, ``group_id`` of every id in the lists of matches (see ``match_links``), in upper case."""
    found = group_links(match_links(matches))
    return found.select(number_id(F.col("entity_id")).alias("entity_id"), number_id(F.col("group_id")).alias("group_id"))


def _count(df: DataFrame) -> int:
    return df.count()


def group_links(links: DataFrame, max_rounds: int = 200, core_links: int = CORE_LINKS) -> DataFrame:
    """``entity_id``, ``group_id`` (the smallest id of the group) of each id in ``a`` or ``b`` of ``links``.

    Ids are of any one type with an order: strings, compared by their bytes, or numbers, which are faster.  Links with a
    null end count for the other end only; loops, repeated and reversed links do no harm; extra columns are ignored; an
    empty table gives an empty result.  core_links bounds what one task solves; it does not change the result.
    """
    scratch = Scratch(links.sparkSession, "groups")
    ends = links.select("a", "b")
    vertices = ends.select(F.explode(F.array("a", "b")).alias("v")).where("v IS NOT NULL").distinct()
    vertices = scratch.cut(vertices)
    edges = ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = scratch.cut(edges)
    layers: list[DataFrame] = []  # v, up: removed vertices and whom to ask for their label
    left = _count(edges)
    for _ in range(max_rounds):
        before = left
        for step in (_strip_leaves, _compress_chains):
            if left:
                edges, layer = step(scratch, edges)
                layers.append(layer)
                left = _count(edges)
        if not left:
            break
        if left <= core_links:
            layers.append(_solve_core(scratch, edges))
            break
        if left > before * 3 // 4:
            edges, layer = _contract_core(scratch, edges)
            layers.append(layer)
            left = _count(edges)
    else:
        raise RuntimeError("the reduction did not end")
    scratch.drop(edges)
    return _restore(scratch, vertices, layers)


def _solve_core(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Union-find in one task over a core that is known to be small."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}

        def find(v):
            while root.setdefault(v, v) != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        if root:
            rows = [(v, find(v)) for v in root if find(v) != v]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in rows], kind), pa.array([up for _, up in rows], kind)], ["v", "up"])

    kind = edges.schema["a"].dataType.simpleString()
    return scratch.cut(edges.coalesce(1).mapInArrow(solve, f"v {kind}, up {kind}"))


def _arcs(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("w")), F.struct(F.col("b").alias("u"), F.col("a").alias("w")))).alias("e")).select("e.*")


def _degrees(edges: DataFrame) -> DataFrame:
    """Degree of each vertex, and of its neighbours the smallest and largest (all of them where the degree is at most two)."""
    return _arcs(edges).groupBy("u").agg(F.count(F.lit(1)).alias("deg"), F.min("w").alias("lo"), F.max("w").alias("hi"))


def _strip_leaves(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Removes all vertices of degree one; of two leaves that are linked to each other the larger is removed."""
    one = _degrees(edges).where("deg = 1").select(F.col("u").alias("v"), F.col("lo").alias("up"))
    twin = one.select(F.col("v").alias("up"), F.col("up").alias("v"), F.lit(True).alias("both"))
    layer = one.join(twin, ["v", "up"], "left").where("both IS NULL OR v > up").select("v", "up")
    layer = scratch.cut(layer)
    gone = layer.select(F.least("v", "up").alias("a"), F.greatest("v", "up").alias("b"))
    out = scratch.cut(edges.join(gone, ["a", "b"], "left_anti"))
    scratch.drop(edges)
    return out, layer


def _compress_chains(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replaces each maximal chain of degree-two vertices by one link between its ends.

    Every chain vertex has two pointers, one a direction; each step of list ranking replaces a pointer by
    the pointer found there that leads on, until it shows an end that is no chain vertex.  A ring without
    end is known by its pointers coming round: each pointer also carries the smallest vertex passed, and
    once the steps passed exceed the number of chain vertices all of a ring know its smallest.
    """
    deg = _degrees(edges)
    chain = scratch.cut(deg.where("deg = 2").select(F.col("u").alias("v"), "lo", "hi"))
    n = _count(chain)
    if n == 0:
        return edges, chain.select("v", F.col("lo").alias("up"))
    # A pointer: at v, having come from ``back``, the chain leads to ``to``; ``last`` is the vertex before ``to``.
    pointers = chain.select(
        F.explode(
            F.array(
                F.struct("v", F.col("lo").alias("back"), F.col("hi").alias("to")),
                F.struct("v", F.col("hi").alias("back"), F.col("lo").alias("to")),
            )
        ).alias("p")
    ).select("p.*")
    pointers = pointers.withColumns({"last": F.col("v"), "low": F.col("v"), "open": F.lit(True)})
    inner = chain.select(F.col("v").alias("to"), F.lit(True).alias("inside"))
    pointers = pointers.join(inner, "to", "left").withColumn("open", F.col("inside").isNotNull()).drop("inside")
    pointers = scratch.cut(pointers)
    passed = 1
    while passed <= 2 * n and _count(pointers.where("open").limit(1)):
        new = scratch.cut(_jump(_jump(pointers)))
        scratch.drop(pointers)
        pointers = new
        passed *= 4
    # One row a chain vertex: its two ends; a ring's vertices have none and point at its smallest vertex.
    ends = pointers.groupBy("v").agg(
        F.min(F.when(~F.col("open"), F.col("to"))).alias("x"),
        F.max(F.when(~F.col("open"), F.col("to"))).alias("y"),
        F.min("low").alias("low"),
    )
    ends = scratch.cut(ends)
    scratch.drop(pointers)
    layer = scratch.cut(ends.select("v", F.coalesce("x", "low").alias("up")).where("v <> up"))
    within = chain.select("v")
    kept = (
        edges.join(within.withColumnRenamed("v", "a"), "a", "left_anti")
        .join(within.withColumnRenamed("v", "b"), "b", "left_anti")
        .select("a", "b")
    )
    short = ends.where("x IS NOT NULL AND x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    out = scratch.cut(kept.unionByName(short).distinct())
    scratch.drop(edges, ends, chain)
    return out, layer


def _jump(pointers: DataFrame) -> DataFrame:
    """Each open pointer moves on to where the pointer at its end leads."""
    # The pointer to follow sits at ``to`` and came from ``last``.
    onward = pointers.select(
        F.col("v").alias("to"), F.col("back").alias("last"), F.col("to").alias("to2"), F.col("last").alias("last2"), F.col("low").alias("low2"), F.col("open").alias("open2")
    )
    going = pointers.where("open").join(onward, ["to", "last"], "left")
    moved = going.select(
        F.coalesce("to2", "to").alias("to"),
        "v",
        "back",
        F.coalesce("last2", "last").alias("last"),
        F.least("low", F.coalesce("low2", "low")).alias("low"),
        F.coalesce("open2", F.lit(False)).alias("open"),
    )
    return pointers.where("NOT open").unionByName(moved)


def _contract_core(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hooks every vertex that has a smaller neighbour onto the smallest one, follows the hooks to their roots and relinks the roots.

    A vertex without smaller neighbour is a root; each other vertex is hooked onto a smaller one, so hooks have
    no circles, and pointer jumping finds the roots.  At least half of the vertices of every component vanish
    only on average, so ids are compared by a hash, whose smallest neighbour is spread over the graph.
    """
    arcs = _arcs(edges)
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    hooks = arcs.groupBy("u").agg(F.min(order("w")).alias("m")).select(F.col("u").alias("v"), F.when(F.col("m") < order("u"), F.col("m.id")).otherwise(F.col("u")).alias("up"))
    hooks = scratch.cut(hooks)
    while True:
        nxt = hooks.select(F.col("v").alias("up"), F.col("up").alias("up2"))
        new = scratch.cut(hooks.join(nxt, "up", "left").select("v", F.coalesce("up2", "up").alias("up"), (F.coalesce("up2", "up") != F.col("up")).alias("moved")))
        scratch.drop(hooks)
        hooks = new
        if not _count(hooks.where("moved").limit(1)):
            break
    hooks = hooks.select("v", "up")
    root = lambda side: hooks.select(F.col("v").alias(side), F.col("up").alias(f"{side}2"))
    moved = edges.join(root("a"), "a").join(root("b"), "b").where("a2 <> b2")
    out = scratch.cut(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct())
    layer = scratch.cut(hooks.where("v <> up"))
    scratch.drop(edges)
    return out, layer


def _restore(scratch: Scratch, vertices: DataFrame, layers: list[DataFrame]) -> DataFrame:
    """Labels of all vertices: those never removed are their own root, the others ask ``up``, last removed first."""
    removed = None
    for layer in layers:
        removed = layer if removed is None else removed.unionByName(layer)
    if removed is None:
        return vertices.select(F.col("v").alias("entity_id"), F.col("v").alias("group_id"))
    known = vertices.join(removed.select("v"), "v", "left_anti").select("v", F.col("v").alias("root"))
    # Each vertex is removed once and its ``up`` later: jump through all layers at once.
    table = scratch.cut(removed.select("v", F.col("up").alias("root")))
    for _ in range(64):
        nxt = table.select(F.col("v").alias("root"), F.col("root").alias("root2"))
        new = scratch.cut(table.join(nxt, "root", "left").select("v", F.coalesce("root2", "root").alias("root"), F.col("root2").isNotNull().alias("moved")))
        scratch.drop(table)
        table = new
        if not _count(table.where("moved").limit(1)):
            break
        table_cols = table.select("v", "root")
        table_cols.scratch_path = getattr(table, "scratch_path", None)
        table = table_cols
    labels = scratch.cut(known.unionByName(table.select("v", "root")))
    scratch.drop(table, vertices, *layers)
    low = labels.groupBy("root").agg(F.min("v").alias("group_id"))
    return labels.join(low, "root").select(F.col("v").alias("entity_id"), "group_id")
