"""Merkle manifest of a dataset: a content-addressed store and proofs by descent.

A row's leaf is the digest of its fields.  The leaves of a group, in the order
of a key, are the lowest level of a tree in which every ``FANOUT`` consecutive
nodes have one parent, the digest of their digests; what remains is the group's
subroot, and the subroots in the order of the groups are the leaves of one more tree.

The store has a record for each node at every ``SPAN``-th level: its digest and
the levels of nodes between it and the next record's.  Requests descend from a
root by the digits of their rank: a record is fetched by digest, the digit says
which child is taken, and the other children of each run on the way are
collected.  Requests that agree in their leading digits descend as one row
until they part, so the rows fetched for a level are no more than its records
and no digest is asked for by many rows.  A path is collected from the root
down, one segment a record, and reversed at the end.

No group is ever one task's: ranks come from a range partitioning over all groups
and counts per partition, and parents are grouped by their few children.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.links import look_up
from snapmart.llm.tables import saved
from snapmart.operators.sizing import fits_broadcast

FANOUT = 2
# Levels of the tree between two records of the store.
SPAN = 4

LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A field as the leaf digest reads it: ``-`` if null, else bytes, a colon and the value."""
    spelled = value.cast("string")
    sized = F.concat(F.octet_length(spelled).cast("string"), F.lit(":"), spelled)
    return F.when(spelled.isNull(), "-").otherwise(sized)


def digest_of(*fields: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the fields of a row."""
    return F.sha2(F.concat(*map(field, fields)), 256)


def _joined(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def group_key(value: Column) -> Column:
    """A text that sorts as the values do, bytewise with null first, and is never null."""
    return F.coalesce(F.concat(F.lit("+"), value.cast("string")), F.lit(""))


@dataclass(frozen=True)
class Forest:
    """Trees of all groups: the leaves with their ranks, the records, and a subroot a group."""

    leaves: DataFrame  # group, rank, digest and the other columns of the rows
    records: list[DataFrame]  # digest, levels; the lowest first
    roots: DataFrame  # group, n (leaves), height (records on the way), digest


@dataclass(frozen=True)
class Manifest:
    """The trees of all groups, the tree of their subroots, and the root (null without rows)."""

    rows: Forest
    groups: Forest
    root: str | None


def _attach(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Join rows, which may all have one key, to a side with one row a key."""
    if fits_broadcast(known):
        return rows.join(F.broadcast(known), key)
    return look_up(rows, known, key, "inner")


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank`` (from 0) within ``group``, by the order and then the digest, and ``n``, the group's size.

    Rows are dealt to ranges of (group, order), numbered inside their range,
    and moved up by what the ranges before hold of the same group: a table of
    one row for each range and group.  Rows alike in all of these get ranks of
    their own.
    """
    spark = nodes.sparkSession
    named = saved(nodes.withColumn("_row", F.monotonically_increasing_id()), "merkle-nodes")
    keys = [F.col("group"), *(F.col(c).asc_nulls_first() for c in order), F.col("digest"), F.col("_row")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = named.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop("_row")
    # The number has the range in its upper bits and the place in the range in its lower ones.
    placed = saved(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), "merkle-places")
    placed = placed.withColumn("_part", F.concat_ws(":", F.shiftright("_place", 33), "group"))
    parts = placed.groupBy("_part", "group").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_held")
    )
    before = Window.partitionBy("group").orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        "_part",
        (F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_held").over(Window.partitionBy("group")).alias("n"),
    )
    return (
        _attach(placed, saved(shifts, "merkle-shifts"), "_part")
        .withColumn("rank", F.col("_place") + F.col("_shift"))
        .drop("_part", "_place", "_shift")
    )


def _levels(n: Column, fanout: int, span: int) -> Column:
    """Levels that a record over ``n`` nodes of a group's level spans."""
    most = F.lit(span)
    for levels in range(span - 1, -1, -1):
        most = F.when(n <= fanout**levels, levels).otherwise(most)
    return most


def _parents(nodes: Column, fanout: int) -> Column:
    last = F.ceil(F.size(nodes) / F.lit(fanout)).cast("int") - 1
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: _joined(F.slice(nodes, i * fanout + 1, fanout))
    )


def grown(nodes: DataFrame, order: list[str], fanout: int = FANOUT, span: int = SPAN) -> Forest:
    """The trees over rows with ``group`` and ``digest``, one a group.

    Each round turns the nodes of a level into the nodes ``span`` levels above,
    grouping by their common record, of ``fanout ** span`` rows at most.
    """
    width = fanout**span
    leaves = saved(ranked(nodes, order), "merkle-leaves")
    level = leaves.select("group", "rank", "digest", "n")
    largest = leaves.agg(F.max("n").alias("n")).first()["n"] or 0
    sizes = leaves.where("rank = 0").select("group", F.col("n").alias("_leaves"))
    records, done, height = [], [], 0
    while True:
        done.append(level.where("n = 1").select("group", "digest", F.lit(height).alias("height")))
        if largest <= 1:
            break
        below = (
            level.where("n > 1")
            .groupBy("group", F.floor(F.col("rank") / width).alias("rank"), "n")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("rank").alias("at"), "digest"))).alias("_nodes"))
            .withColumn("_up0", F.col("_nodes.digest"))
            .withColumn("_span", _levels(F.col("n"), fanout, span))
        )
        top, inner = F.col("_up0"), [F.col("_up0")]
        for i in range(1, span + 1):
            # Above the last level of a group's tree nothing is hashed.
            below = below.withColumn(
                f"_up{i}", F.when(F.col("_span") >= i, _parents(F.col(f"_up{i - 1}"), fanout))
            )
            top = F.coalesce(F.col(f"_up{i}"), top)
            inner.append(F.col(f"_up{i}"))
        # From the record's own node (left out) down to its lowest level.
        listed = F.slice(F.reverse(F.filter(F.array(*inner), lambda x: x.isNotNull())), 2, span)
        made = saved(
            below.select("group", "rank", "n", top[0].alias("digest"), listed.alias("levels")),
            "merkle-records",
        )
        records.append(made.select("digest", "levels"))
        level = made.select("group", "rank", "digest", F.ceil(F.col("n") / width).alias("n"))
        largest, height = -(-largest // width), height + 1
    roots = done[0]
    for frame in done[1:]:
        roots = roots.union(frame)
    roots = roots.join(sizes, "group").withColumnRenamed("_leaves", "n")
    return Forest(leaves, records, saved(roots, "merkle-roots"))


def manifest(
    rows: DataFrame, group: str, order: list[str], fanout: int = FANOUT, span: int = SPAN
) -> Manifest:
    """The manifest of rows with a ``digest``: a tree for each value of a column, and one over them.

    A null is a group of its own, before all others; values are ordered bytewise.
    """
    trees = grown(rows.withColumn("group", group_key(F.col(group))), order, fanout, span)
    subroots = trees.roots.select(F.lit("").alias("group"), F.col("group").alias("of"), "digest")
    top = grown(subroots, ["of"], fanout, span)
    root = top.roots.first()
    return Manifest(trees, top, root["digest"] if root else None)


def _run_of(nodes: Column, at: Column, fanout: int) -> Column:
    """The step of a path at a node: its place in its run, and the run's others from left to right."""
    place = F.pmod(at, F.lit(fanout)).cast("int")
    first = at.cast("int") - place
    others = F.concat(
        F.slice(nodes, first + 1, place), F.slice(nodes, first + place + 2, F.lit(fanout - 1) - place)
    )
    return F.struct(place.alias("place"), others.alias("others"))


def _segment(levels: Column, digit: Column, fanout: int) -> Column:
    """The steps from a record's node down to the child that the digit names."""
    return F.transform(
        levels,
        lambda nodes, i: _run_of(
            nodes, F.floor(digit / F.pow(F.lit(fanout), F.size(levels) - 1 - i)), fanout
        ),
    )


_PATH = "array<struct<place: int, others: array<string>>>"


def paths(
    forest: Forest, requests: DataFrame, starts: DataFrame, fanout: int = FANOUT, span: int = SPAN
) -> DataFrame:
    """Adds ``path`` to requests (group, rank): the steps from the group's start down to the leaf.

    ``starts`` has group, digest, height and the path so far of each subroot.
    """
    width = fanout**span
    block = F.floor(F.col("rank") / width)
    front = None
    for height in range(len(forest.records), 0, -1):
        new = starts.where(F.col("height") == height).select(
            "group", F.lit(0).cast("bigint").alias("rank"), "digest", "path"
        )
        front = new if front is None else front.union(new)
        wanted = requests.select(
            "group", F.floor(F.col("rank") / width**height).alias("rank")
        ).distinct()
        front = front.join(wanted, ["group", "rank"], "left_semi").join(
            forest.records[height - 1], "digest"
        )
        if height > 1:
            lowest = F.element_at("levels", -1)
            children = F.transform(
                lowest,
                lambda child, i: F.struct(
                    (F.col("rank") * width + i).alias("rank"),
                    child.alias("digest"),
                    F.concat("path", _segment(F.col("levels"), i, fanout)).alias("path"),
                ),
            )
            front = front.select("group", F.explode(children).alias("c")).select("group", "c.*")
    alone = starts.where("height = 0").select(
        "group", F.lit(0).cast("bigint").alias("_block"), "path", F.array().cast("array<array<string>>").alias("levels")
    )
    if front is not None:
        alone = alone.union(front.select("group", F.col("rank").alias("_block"), "path", "levels"))
    met = requests.withColumn("_block", block).join(
        alone.withColumnRenamed("path", "_above"), ["group", "_block"]
    )
    own = _segment(F.col("levels"), F.pmod("rank", F.lit(width)), fanout)
    return met.withColumn("path", F.concat("_above", own)).drop("_block", "_above", "levels")


def proofs(
    made: Manifest, requests: DataFrame | None = None, fanout: int = FANOUT, span: int = SPAN
) -> DataFrame:
    """Adds ``proof`` and ``subroot`` to requested leaves (all leaves if none are named).

    Requests are rows of ``made.rows.leaves``.  A proof has a step for each level from
    the leaf via its subroot to the root: the node's ``place`` among the children
    of its parent, and the digests of the ``others`` from left to right.
    """
    spark = made.rows.leaves.sparkSession
    requests = made.rows.leaves if requests is None else requests
    root = spark.createDataFrame([("", made.root)], "group string, digest string")
    start = root.join(F.broadcast(made.groups.roots.select("group", "height")), "group").withColumn(
        "path", F.array().cast(_PATH)
    )
    groups = paths(made.groups, made.groups.leaves.select("group", "rank", "of"), start, fanout, span)
    starts = saved(
        groups.select(F.col("of").alias("group"), "path").join(
            made.rows.roots.select("group", "digest", "height"), "group"
        ),
        "merkle-starts",
    )
    found = paths(made.rows, requests, starts, fanout, span)
    subroots = made.rows.roots.select("group", F.col("digest").alias("subroot"))
    return _attach(found, subroots, "group").withColumn("proof", F.reverse("path")).drop("path")


def folded(leaf: Column, proof: Column, fanout: int = FANOUT) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        proof,
        leaf,
        lambda node, step: _joined(
            F.concat(
                F.slice(step["others"], 1, step["place"]),
                F.array(node),
                F.slice(step["others"], step["place"] + 1, fanout),
            )
        ),
    )


def verified_documents(docs: DataFrame, tampered: Column) -> DataFrame:
    """Leaf, subroot, root, proof and the root folded from each document as it may have been tampered with.

    Where ``tampered`` holds, 1 is added to n_chars before the document is
    checked against the manifest of the given ones.  Null fields are digested as
    ``-`` and stay null; a null lang is a group of its own, null ids come first,
    repeated rows are leaves of their own, long texts are digested whole, other
    columns are not read, and an empty table gives no rows.
    """
    bumped = F.when(tampered, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(
        F.col("n_chars").cast("decimal(20,0)")
    )
    fields = [F.col(c) for c in LEAF_FIELDS]
    changed = [bumped if c == "n_chars" else F.col(c) for c in LEAF_FIELDS]
    leaves = docs.select(
        "doc_id",
        "lang",
        digest_of(*fields).alias("digest"),
        F.when(tampered & F.col("n_chars").isNotNull(), digest_of(*changed)).alias("changed"),
    )
    made = manifest(leaves, "lang", ["doc_id"])
    shown = F.coalesce("changed", "digest")
    return proofs(made).select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(made.root).cast("string").alias("root"),
        "proof",
        folded(shown, F.col("proof")).alias("folded_root"),
    )
