"""The category graph: roots, canonical parents, ancestries, all addresses, labels.

Tables: ``nodes(id, ...)`` and ``edges(child, parent)``. Walks are frontier
joins; several levels go into one plan, which is then written to the shared
folder, so a graph takes a few jobs and not a few for each of its levels.
Addresses are counted, a number a node, before any of them is listed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from shelfspark.session import cut, laid, parts_for
from shelfspark.sources.products import numbered

SEPARATOR = "/"
MAX_ADDRESSES = 1000
#: Levels of a walk that one plan takes.
UNROLL = 4
#: Addresses that one task joins to strings.
FORMS_A_TASK = 1 << 18
#: Counts of addresses stop growing here; any bound is far below.
_FULL = 1 << 40


class AddressExplosionError(ValueError):
    """A node has more addresses than allowed; refused, never truncated."""


class CyclicGraphError(ValueError):
    """Addresses of a graph with cycles can be listed, not counted."""


def without(nodes: DataFrame, exclude: list[str]) -> DataFrame:
    return nodes.filter(~F.col("id").isin(*exclude)) if exclude else nodes


def valid_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct edges whose two ends are nodes."""
    ids = nodes.select("id")
    return edges.join(ids.withColumnRenamed("id", "child"), "child", "left_semi").join(ids.withColumnRenamed("id", "parent"), "parent", "left_semi").select("child", "parent").distinct()


def global_roots(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without a valid parent, whatever their language."""
    return nodes.select("id").join(valid_edges(nodes, edges).select(F.col("child").alias("id")), "id", "left_anti")


def depths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, depth``: fewest hops from a root. Where only cycles are left, the smallest unreached id becomes a root."""
    return _depths(*_laid(nodes, edges))


def _laid(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Distinct ids in buckets, valid edges in as many of their parent, and the number of these: walks send from
    parents, so that edges stay where they are."""
    nodes, edges = nodes.select("id"), edges.select("child", "parent")
    parts = parts_for(edges.sparkSession, max(nodes.count(), edges.count()))
    ids = laid(nodes.repartition(parts, "id").distinct(), "ids", "id", parts)
    hashed = lambda end: ids.withColumnRenamed("id", end).hint("shuffle_hash")
    known = edges.repartition(parts, "child").join(hashed("child"), "child", "left_semi").repartition(parts, "parent").join(hashed("parent"), "parent", "left_semi")
    return ids, laid(known.select("child", "parent").distinct(), "edges", "parent", parts), parts


def _depths(ids: DataFrame, edges: DataFrame, parts: int) -> DataFrame:
    children = edges.select(F.col("child").alias("id")).repartition(parts, "id")
    roots = cut(ids.join(children.hint("shuffle_hash"), "id", "left_anti").withColumn("depth", F.lit(0)), "depth")
    if roots.isEmpty():
        return _cyclic_depths(ids, edges, parts)
    seen = _reached(roots, edges)
    rest = laid(ids.join(seen.select("id").repartition(parts, "id").hint("shuffle_hash"), "id", "left_anti"), "unreached", "id", parts)
    if rest.isEmpty():
        return seen
    # What leads to an unreached node is unreached too.
    inside = edges.repartition(parts, "child").join(rest.withColumnRenamed("id", "child").hint("shuffle_hash"), "child", "left_semi").select("child", "parent")
    return seen.union(_cyclic_depths(rest, laid(inside.repartition(parts, "parent"), "inside", "parent", parts), parts).select("id", "depth"))


def _reached(start: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, depth``: fewest hops from ``start(id, depth 0)``, which is part of it.

    A plan goes several levels down and drops what was seen before at its end: a shortest way to a new node leads over
    new nodes only, so that those seen again on the way change nothing."""
    seen = frontier = cut(start.select("id", F.col("depth").cast("int").alias("depth")), "depth")
    depth = 0
    while True:
        level, levels = frontier.select("id"), []
        for j in range(1, UNROLL + 1):
            level = edges.join(level.withColumnRenamed("id", "parent"), "parent").select(F.col("child").alias("id")).distinct()
            levels.append(level.withColumn("depth", F.lit(depth + j)))
        new = reduce(DataFrame.union, levels).groupBy("id").agg(F.min("depth").alias("depth"))
        new = cut(new.join(seen.select("id"), "id", "left_anti"), "depth")
        seen, depth = seen.union(new), depth + UNROLL
        frontier = new.filter(F.col("depth") == depth)
        if frontier.isEmpty():
            return seen


def _cyclic_depths(rest: DataFrame, inside: DataFrame, parts: int) -> DataFrame:
    """``id, depth`` of nodes that no root reaches, all cycles at once: ``rest`` in buckets of the id, the edges to them in
    as many of the parent.

    Taking the smallest unreached id as a root, again and again, gives each node to the smallest id that reaches it:
    were that id itself reached by a smaller one, so were the node. So each node seeks the least pair of an id that
    reaches it and of the hops from there; all nodes on a shortest way have the same id. Only nodes whose pair changed
    send it on; messages alone move, to the buckets of their node."""
    best = rest.select("id", F.col("id").alias("least"), F.lit(0).alias("depth"), F.lit(True).alias("changed"))
    while True:
        front = best.filter("changed").select(F.col("id").alias("parent"), "least", "depth")
        # A node's own id is a bound, so that no greater one is sent to it.
        sent = inside.join(front.hint("shuffle_hash"), "parent").filter("least < child").select(F.col("child").alias("id"), F.struct("least", (F.col("depth") + 1).alias("depth")).alias("m"))
        got = sent.repartition(parts, "id").groupBy("id").agg(F.min("m").alias("m"))
        seen, better = Observation(), F.col("m").isNotNull() & (F.col("m") < F.struct("least", "depth"))
        rows = best.select("id", "least", "depth").join(got.hint("shuffle_hash"), "id", "left").withColumn("changed", better)
        rows = rows.select("id", *[F.when(F.col("changed"), F.col("m")[c]).otherwise(F.col(c)).alias(c) for c in ("least", "depth")], "changed")
        best = laid(rows, "least", "id", parts, seen, changed=F.count_if("changed"))
        if not seen.get["changed"]:
            return best.select("id", "depth")


def canonical(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, depth, parent``: of the parents nearer to a root the nearest, then the smallest; none for roots."""
    ids, edges, parts = _laid(nodes, edges)
    depth = _depths(ids, edges, parts)
    # The nearest parent is nearer than the node or none is.
    best = edges.join(depth.select(F.col("id").alias("parent"), F.col("depth").alias("up")).hint("shuffle_hash"), "parent").repartition(parts, "child")
    best = best.groupBy(F.col("child").alias("id")).agg(F.min(F.struct("up", "parent")).alias("best"))
    return depth.join(best.hint("shuffle_hash"), "id", "left").select("id", "depth", F.when(F.col("best.up") < F.col("depth"), F.col("best.parent")).alias("parent"))


def ancestry(canon: DataFrame) -> DataFrame:
    """``id, path``: the canonical chain from the root down to the node."""
    done = level = canon.filter("parent IS NULL").select("id", F.array("id").alias("path"))
    rest = cut(canon.filter("parent IS NOT NULL").select("id", "parent"), "canon")
    while True:
        levels = []
        for _ in range(UNROLL):
            level = rest.join(level.select(F.col("id").alias("parent"), "path"), "parent").select("id", F.array_append("path", F.col("id")).alias("path"))
            levels.append(level)
        new = cut(reduce(DataFrame.union, levels), "chain")
        longest = new.agg(F.max(F.size("path"))).first()[0]
        if longest is None:
            return done
        done, level = done.union(new), new.filter(F.size("path") == longest)


def intervals(chains: DataFrame) -> DataFrame:
    """``id, enter, leave, length``: the node's place in a walk of the canonical forest, parents before children, and
    the last place under it. A node lies under another exactly if its ``enter`` is in that one's ``(enter, leave]``.

    In order of their paths all that is under a node follows it at once, so one sort numbers the forest."""
    sizes = chains.select(F.explode("path").alias("id")).groupBy("id").agg(F.count("*").alias("size"))
    return numbered(chains, "path").join(sizes, "id").select("id", F.col("n").alias("enter"), (F.col("n") + F.col("size") - 1).alias("leave"), F.size("path").alias("length"))


def _walkable(nodes: DataFrame, edges: DataFrame, canon: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The roots, and the edges that addresses go along: none leads to a root."""
    roots = canon.filter("parent IS NULL").select("id")
    return roots, cut(valid_edges(nodes, edges).join(roots.withColumnRenamed("id", "child"), "child", "left_anti"), "walkable")


def address_counts(nodes: DataFrame, edges: DataFrame, canon: DataFrame, most: int | None = MAX_ADDRESSES) -> DataFrame:
    """``id, addresses, longest``: how many root-to-node paths each node has and the hops of the longest, on a graph
    without cycles, and no path is listed.

    Level by level each node adds up its parents' numbers. A node with more than ``most`` is refused at the level that
    brings it over; without a bound, numbers stop at 2^40. On a graph with cycles this is ``CyclicGraphError``.
    """
    roots, walkable = _walkable(nodes, edges, canon)
    return _counted(roots, walkable, most)


def _counted(roots: DataFrame, edges: DataFrame, most: int | None) -> DataFrame:
    done = level = roots.select("id", F.lit(1).cast("long").alias("n"), F.lit(0).alias("hops"))
    bound, hops, checked = 1, 0, 0
    while True:
        levels = []
        for j in range(1, UNROLL + 1):
            sums = edges.join(level.select(F.col("id").alias("parent"), "n"), "parent").groupBy(F.col("child").alias("id"))
            level = sums.agg(F.least(F.sum("n"), F.lit(_FULL)).cast("long").alias("n")).withColumn("hops", F.lit(hops + j))
            levels.append(level)
        new = cut(reduce(DataFrame.union, levels), "counts")
        largest = {r.hops: r.n for r in new.groupBy("hops").agg(F.max("n").alias("n")).collect()}
        done, hops = done.union(new), hops + UNROLL
        bound += sum(largest.values())
        if most is not None and bound > most:
            over = _totals(done).filter(F.col("addresses") > most).orderBy("id").first()
            if over and is_cyclic(edges):
                raise CyclicGraphError("walks around a cycle never end")
            if over:
                raise AddressExplosionError(f"{over.id} has {over.addresses} addresses or more")
        elif hops >= 2 * max(checked, 32):
            checked = hops
            if is_cyclic(edges):
                raise CyclicGraphError("walks around a cycle never end")
        if hops not in largest:
            return _totals(done)
        level = new.filter(F.col("hops") == hops)


def _totals(levels: DataFrame) -> DataFrame:
    return levels.groupBy("id").agg(F.least(F.sum("n"), F.lit(_FULL)).cast("long").alias("addresses"), F.max("hops").alias("longest"))


def is_cyclic(edges: DataFrame) -> bool:
    """Whether some edges lead around: those whose parent has no edge to it go, until none does or none is left."""
    left, n = edges, edges.count()
    while n:
        for _ in range(UNROLL):
            left = left.join(left.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi").select("child", "parent")
        left = cut(left, "trimmed")
        before, n = n, left.count()
        if n == before:
            return True
    return False


def addresses(nodes: DataFrame, edges: DataFrame, canon: DataFrame, most: int = MAX_ADDRESSES, chains: DataFrame | None = None) -> DataFrame:
    """``id, address_rank, path, is_primary``: every root-to-node path without a repeated node.

    The canonical chain (``chains``, if it is known already) comes first, the
    rest by length, then step by step. A node with more than ``most`` addresses
    stops the run. On a graph without cycles that shows before a path is listed,
    and the listing then goes down as many levels as were counted; on one with
    cycles each level is listed and counted by itself.
    """
    if most >= 1 << 16:
        raise ValueError("unions of addresses keep 16 bits for a rank")
    roots, walkable = _walkable(nodes, edges, canon)
    try:
        deepest = _counted(roots, walkable, most).agg(F.max("longest")).first()[0] or 0
        done = _listed(roots, walkable, deepest)
    except CyclicGraphError:
        done = _listed_around_cycles(roots, walkable, most)
    # Paths of different lengths come from different levels and edges are distinct, so no path is there twice.
    chains = ancestry(canon) if chains is None else chains
    rows = done.join(chains.withColumnRenamed("path", "chain"), "id").withColumn("is_primary", F.col("path") == F.col("chain"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("is_primary"), F.size("path"), "path"))
    return rows.select("id", rank.alias("address_rank"), "path", "is_primary")


def _listed(roots: DataFrame, edges: DataFrame, deepest: int) -> DataFrame:
    done = level = roots.select("id", F.array("id").alias("path"))
    for j in range(deepest):
        level = edges.join(level.withColumnRenamed("id", "parent"), "parent").select(F.col("child").alias("id"), F.array_append("path", F.col("child")).alias("path"))
        if j % UNROLL == UNROLL - 1:
            level = cut(level, "address")
        done = done.union(level)
    return done


def _listed_around_cycles(roots: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    done = level = roots.select("id", F.array("id").alias("path"))
    bound = 1
    while True:
        step = edges.join(level.withColumnRenamed("id", "parent"), "parent").filter(~F.array_contains("path", F.col("child")))
        level = cut(step.select(F.col("child").alias("id"), F.array_append("path", F.col("child")).alias("path")), "address")
        largest = level.groupBy("id").count().agg(F.max("count")).first()[0]
        if largest is None:
            return done
        done, bound = done.union(level), bound + largest
        over = exploded(done, most).orderBy("id").first() if bound > most else None
        if over:
            raise AddressExplosionError(f"{over.id} has {over.addresses} addresses")


def exploded(found: DataFrame, most: int = MAX_ADDRESSES) -> DataFrame:
    """Nodes with more than ``most`` of the listed addresses."""
    return found.groupBy("id").agg(F.count("*").alias("addresses")).filter(F.col("addresses") > most)


def address_stats(counts: DataFrame) -> DataFrame:
    """From ``address_counts``."""
    per = counts.select("id", F.col("addresses").alias("n"))
    return per.agg(F.count("*").alias("nodes"), F.count_if(F.col("n") > 1).alias("multi_address_nodes"), F.coalesce(F.max("n"), F.lit(0)).alias("max_addresses"), F.coalesce(F.sum("n"), F.lit(0)).alias("addresses"))


def _capital(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))


def slug_label(node: Column) -> Column:
    """The part after the first colon in words; the id itself where nothing is left."""
    slug = F.regexp_replace(node, "^[^:]*:", "")
    words = F.trim(F.translate(slug, "-_", "  "))
    return F.when(words == "", node).otherwise(_capital(words))


def display_label(node: Column, names: list[Column]) -> Column:
    """The first name that is not blank, its first letter capital, else the slug; path separators become spaces."""
    name = F.coalesce(F.lit(None).cast("string"), *[F.nullif(F.trim(n), F.lit("")) for n in names])
    return F.replace(F.coalesce(_capital(name), slug_label(node)), F.lit(SEPARATOR), F.lit(" "))


def phantom_roots(canon: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Roots of the walked graph that the whole taxonomy does not have."""
    return canon.filter("parent IS NULL").select("id").join(global_roots(nodes, edges), "id", "left_anti")


def escaped(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("~"), F.lit("~0")), F.lit(SEPARATOR), F.lit("~1"))


def unescaped(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("~1"), F.lit(SEPARATOR)), F.lit("~0"), F.lit("~"))


#: Between the strings of a list that travels as one string.
BREAK = "\n"


def unlisted(text: Column) -> Column:
    """The strings of lists that were joined by ``BREAK``, repeats gone, in order of first sight."""
    found = F.array_distinct(F.split(text, BREAK, -1))
    back = lambda x: F.replace(F.replace(x, F.lit("~1"), F.lit(BREAK)), F.lit("~0"), F.lit("~"))
    return F.when(F.contains(text, F.lit("~")), F.transform(found, back)).otherwise(found)


def forms(found: DataFrame, labels: DataFrame) -> DataFrame:
    """``id, paths, nodes, told, lead``: each node's addresses in order of rank, one string of labels and one of nodes for
    each, separators inside labels and nodes escaped. All that an address's steps hold are beginnings of these strings,
    so products carry one string an address and not one a step. ``told`` is one string too: all these beginnings of
    labels, not escaped, each once, as ``unlisted`` reads them, the first address's ``lead`` in front; they are taken
    apart once a node here, and not once a product."""
    steps = found.select("id", "address_rank", F.posexplode("path").alias("step", "node")).join(labels.select(F.col("id").alias("node"), escaped(F.col("label")).alias("label")), "node")
    steps = steps.repartition(parts_for(found.sparkSession, found.count(), FORMS_A_TASK), "id")
    one = F.sort_array(F.collect_list(F.struct("step", escaped(F.col("node")).alias("node"), "label")))
    joined = lambda c: F.array_join(F.transform("s", lambda x: x[c]), SEPARATOR)
    whole = steps.groupBy("id", "address_rank").agg(one.alias("s")).select("id", F.struct("address_rank", joined("label").alias("path"), joined("node").alias("node")).alias("a"))
    rows = whole.groupBy("id").agg(F.sort_array(F.collect_list("a")).alias("a")).select("id", F.col("a.path").alias("paths"), F.col("a.node").alias("nodes"))
    every = F.array_distinct(F.flatten(F.transform("paths", beginnings)))
    listed = F.transform(every, lambda x: F.replace(F.replace(unescaped(x), F.lit("~"), F.lit("~0")), F.lit(BREAK), F.lit("~1")))
    return rows.withColumns({"told": F.array_join(listed, BREAK), "lead": F.size(F.split(F.col("paths")[0], SEPARATOR, -1))})


def beginnings(path: Column) -> Column:
    """The cumulative paths of an address's string, still escaped, the root's first."""
    return F.transform(F.split(path, SEPARATOR, -1), lambda _, i: F.call_function("substring_index", path, F.lit(SEPARATOR), i + 1))


def rendered(found: DataFrame, labels: DataFrame) -> DataFrame:
    """``id, address_rank, step, node, path``: each address's cumulative label paths, once per address."""
    return steps(forms(found, labels))


def steps(made: DataFrame, *more: str) -> DataFrame:
    """``rendered`` of ``forms``, with ``more`` of its columns."""
    each = made.select("id", *more, F.posexplode(F.arrays_zip("paths", "nodes")).alias("r", "a"))
    each = each.select("id", *more, (F.col("r") + 1).alias("address_rank"), F.posexplode(F.arrays_zip(beginnings(F.col("a.paths")), F.split("a.nodes", SEPARATOR, -1))).alias("step", "s"))
    return each.select("id", *more, "address_rank", "step", unescaped(F.col("s")["1"]).alias("node"), unescaped(F.col("s")["0"]).alias("path"))


def path_ceiling(found: DataFrame, labels: DataFrame, eligible: DataFrame) -> DataFrame:
    """How many distinct path strings the eligible nodes' addresses have: a bound for any catalog."""
    return rendered(found.join(eligible.select("id"), "id", "left_semi"), labels).agg(F.countDistinct("path").alias("distinct_paths"))


def path_bound(counts: DataFrame, chains_to: DataFrame) -> DataFrame:
    """How many paths lead to the nodes of ``chains_to(id)``, from ``address_counts``, none of them listed: with all
    ancestors of the eligible nodes there, no catalog has more path strings."""
    return counts.join(chains_to.select("id").distinct(), "id", "left_semi").agg(F.coalesce(F.sum("addresses"), F.lit(0)).alias("paths"))


def ancestors(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """``id``: the nodes of ``ids(id)`` and all that they lie under."""
    up = edges.select(F.col("parent").alias("child"), F.col("child").alias("parent"))
    return _reached(ids.select("id", F.lit(0).alias("depth")), up).select("id")
