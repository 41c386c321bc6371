"""Operator 13: a Merkle manifest of a table, with an inclusion proof for every row.

Rows of a group (say, a language) are leaves in order; every ``run`` consecutive nodes become
one parent until one node, the subroot, is left, and the subroots become one root likewise.
A node of level L carries the interval of leaf ranks [lo, hi) that it covers.  Parents are
attached to the nodes below them by a containment join that is bucketed by level (an equal
join on group, level and interval number, with the containment as its condition), and the
siblings of a proof are the interval difference: what is left of a parent's interval without
the child that covers the row.

Levels are worked off in bands of six: within a band an interval holds at most run^6 nodes of
the band's lowest level, so no key of any join or grouping has more rows than that, however
large a group is.  The proof of a row is that of its band followed by that of its ancestor in
the next band.  Ranks come from ``number_rows``, which spreads a hot group over partitions.

Defined cases: a null group is a group of its own, first in order; order columns that tie are
ordered by digest, and rows that tie in both have equal digests, so either order gives the same
tree; null ids come first; a lone leaf is its group's subroot, and a lone subroot the root;
a table without rows gives none.  All of it is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlab.llm.common import bounded_broadcast, written
from mentionlab.plans.ranking import number_rows

BAND = 6
_MEMBER = "struct<lo:bigint,hi:bigint,digest:string>"
_STEP = "struct<left:string,right:string>"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the columns, each ``-`` if null, else byte count, ``:``, value."""
    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the steps of its path give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def path_digest(path: Column) -> Column:
    """SHA-256 of a path's sibling digests, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def _levels(members: Column, count: Column, run: int) -> Column:
    """``count`` levels above the sorted ``members``, as an array that starts with the members."""
    def above(nodes: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.ceil(F.size(nodes) / F.lit(run)).cast("int") - 1)

        def parent(i: Column) -> Column:
            part = F.slice(nodes, i * run + 1, run)
            return F.struct(F.element_at(part, 1)["lo"].alias("lo"), F.element_at(part, -1)["hi"].alias("hi"),
                            F.sha2(F.concat_ws("", F.transform(part, lambda m: m["digest"])), 256).alias("digest"))

        return F.transform(numbers, parent)

    steps = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    start = F.array(members).cast(f"array<array<{_MEMBER}>>")
    return F.aggregate(steps, start, lambda acc, _: F.concat(
        acc, F.array(above(F.element_at(acc, -1))).cast(f"array<array<{_MEMBER}>>")))


def _height(n: Column, run: int, most: int) -> Column:
    """Levels above ``n`` leaves: the smallest h with run^h >= n."""
    height, bound, h = F.lit(0), 1, 0
    while bound < most:
        h += 1
        height = F.when(n > bound, F.lit(h)).otherwise(height)
        bound *= run
    return height.cast("int")


def forest(leaves: DataFrame, run: int) -> tuple[list[DataFrame], DataFrame]:
    """The trees over ``leaves`` (``g`` string, not null; ``pos`` rank in g; ``n`` size of g;
    ``digest``).

    Returns the paths by band, lowest first, as ``(g, idx, path)`` with ``idx`` the number of the
    band's lowest node, and the roots as ``(g, digest)``.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    spread = run ** BAND
    base = leaves.select("g", F.col("pos").alias("idx"), F.col("pos").alias("lo"), (F.col("pos") + 1).alias("hi"),
                         "digest", _height(F.col("n"), run, most).alias("height"))
    paths, roots, band, top = [], [base.filter("height = 0").select("g", "digest")], 0, 1
    while top < most:
        own = F.least(F.col("height") - band * BAND, F.lit(BAND))  # levels of the band that a group has
        member = F.struct("lo", "hi", "digest")
        chunks = base.filter(F.col("height") > band * BAND) \
            .groupBy("g", "height", F.expr(f"idx div {spread}").alias("chunk")) \
            .agg(F.sort_array(F.collect_list(member)).alias("members"))
        chunks = written(chunks.select("g", "height", "chunk", _levels(F.col("members"), own, run).alias("levels")),
                         "merkle_levels")

        # parents with their interval and children; one row a node of the band's upper levels
        level = chunks.select("g", "chunk", "levels", F.explode(F.sequence(F.lit(1), own)).alias("level"))
        child = F.element_at("levels", F.col("level"))
        parents = level.select("g", "chunk", "level", child.alias("children"),
                               F.posexplode(F.element_at("levels", F.col("level") + 1)).alias("i", "node"))
        parents = parents.select(
            "g", "level", F.expr(f"chunk * {spread} div cast(power({run}, level) as bigint) + i").alias("bucket"),
            F.col("node.lo").alias("p_lo"), F.col("node.hi").alias("p_hi"),
            F.slice("children", F.col("i") * run + 1, F.lit(run)).alias("children"))

        # the band's lowest nodes, once for every level above them: the bucket is the interval's number
        below = chunks.select("g", "height", "chunk", F.posexplode(F.element_at("levels", 1)).alias("i", "node"))
        below = below.select("g", (F.col("chunk") * spread + F.col("i")).alias("idx"), F.col("node.lo").alias("lo"),
                             F.col("node.hi").alias("hi"), F.explode(F.sequence(F.lit(1), own)).alias("level"))
        below = below.withColumn("bucket", F.expr(f"idx div cast(power({run}, level) as bigint)"))
        held = below.join(parents, ["g", "level", "bucket"]).filter("p_lo <= lo AND hi <= p_hi")

        def rest(side: Column) -> Column:
            return F.concat_ws("", F.transform(F.filter("children", lambda c: side(c)), lambda c: c["digest"]))

        steps = held.select("g", "idx", "level", rest(lambda c: c["hi"] <= F.col("lo")).alias("left"),
                            rest(lambda c: c["lo"] >= F.col("hi")).alias("right"))
        paths.append(steps.groupBy("g", "idx").agg(
            F.sort_array(F.collect_list(F.struct("level", "left", "right"))).alias("steps"))
            .select("g", "idx", F.transform("steps", lambda s: F.struct(s["left"].alias("left"),
                                                                        s["right"].alias("right"))).alias("path")))
        last = F.element_at(F.element_at("levels", -1), 1)
        tops = chunks.select("g", "height", F.col("chunk").alias("idx"), last["lo"].alias("lo"), last["hi"].alias("hi"),
                             last["digest"].alias("digest"))
        roots.append(tops.filter(F.col("height") <= (band + 1) * BAND).select("g", "digest"))
        base, band, top = tops, band + 1, top * spread
    found = roots[0]
    for r in roots[1:]:
        found = found.unionByName(r)
    return paths, found


def _with_path(rows: DataFrame, paths: list[DataFrame], run: int) -> DataFrame:
    """``rows`` (``g``, ``pos``) with ``path``, the steps of all bands from the lowest up."""
    spread = run ** BAND
    above = None
    for lower in reversed(paths[1:]):  # a path of a band goes on with that of the node's ancestor
        if above is not None:
            up = above.select("g", F.col("idx").alias("up"), F.col("path").alias("rest"))
            lower = lower.withColumn("up", F.expr(f"idx div {spread}")).join(up, ["g", "up"], "left") \
                .select("g", "idx", F.concat("path", F.coalesce("rest", F.array().cast(f"array<{_STEP}>"))).alias("path"))
        above = lower
    none = F.array().cast(f"array<{_STEP}>")
    if not paths:
        return rows.withColumn("path", none)
    own = paths[0].select("g", F.col("idx").alias("pos"), "path")
    out = rows.join(own, ["g", "pos"], "left").withColumn("path", F.coalesce("path", none))
    if above is not None:
        up = above.select("g", F.col("idx").alias("up"), F.col("path").alias("rest"))
        out = out.withColumn("up", F.expr(f"pos div {spread}")).join(up, ["g", "up"], "left") \
            .withColumn("path", F.concat("path", F.coalesce("rest", none))).drop("up", "rest")
    return out


def merkle_manifest(rows: DataFrame, group: str, order: Sequence[str], digest: str, keep: Sequence[str] = (),
                    run: int = 2) -> DataFrame:
    """``keep`` and the leaf's ``digest`` with ``subroot``, ``root`` and ``path`` of every row.

    ``digest`` is a column of leaf digests (see :func:`leaf_digest`), ``group`` a column of text;
    ``path`` lists, from the leaf's level through the subroot to the root, the concatenated
    digests ``left`` and ``right`` of the node; :func:`fold` goes up on it.
    """
    if run < 2:
        raise ValueError("a run holds at least two nodes")
    names = {c: f"k{i}" for i, c in enumerate(dict.fromkeys([*keep, *order]))}
    key = F.coalesce(F.concat(F.lit("s"), F.col(group)), F.lit("n"))  # null first, then bytewise
    plain = rows.select(key.alias("g"), F.col(digest).alias("digest"), *[F.col(c).alias(n) for c, n in names.items()])
    leaves = number_rows(plain, ["g"], [*[F.col(names[c]).asc_nulls_first() for c in order], "digest"], size_col="n")
    leaves = written(leaves, "merkle_leaves")
    paths, found = forest(leaves, run)
    subroots = written(found, "merkle_subroots")
    tops = subroots.withColumnRenamed("g", "g0").withColumn("g", F.lit(""))
    tops = written(number_rows(tops, ["g"], ["g0"], size_col="n"), "merkle_tops")
    top_paths, root = forest(tops, run)
    upper = _with_path(tops.select("g", "pos", "g0", "digest"), top_paths, run)
    upper = upper.join(F.broadcast(root.select("g", F.col("digest").alias("root"))), "g")  # one row
    upper = written(upper.select(F.col("g0").alias("g"), F.col("digest").alias("subroot"), "root",
                                 F.col("path").alias("upper")), "merkle_upper")
    out = _with_path(leaves.select("g", "pos", "digest", *names.values()), paths, run)
    out = out.join(bounded_broadcast(upper, 10_000), "g")
    return out.select(*[F.col(names[c]).alias(c) for c in keep], F.col("digest").alias(digest), "subroot", "root",
                      F.concat("path", "upper").alias("path"))
