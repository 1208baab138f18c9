"""Merkle dataset manifest: a content-addressed DAG over a table, and proofs by descent from its root.

A row is a leaf: sha256 of its fields.  Per group (``source``) the leaves, in ascending order of the
id, are hashed in runs of three, level by level, up to the group's subroot; the subroots, in order of
their groups, likewise up to the root.

* Building: five levels at a time.  243 neighbouring nodes meet in one group and become a *page*: the
  digest-to-children records of the subtree above them, stored under the digest of its top.
  ``records`` lists them as plain (digest, children) rows.
* Proofs: a request for a leaf descends from the root.  Its rank, written in base three, names the child
  to take in every record; the children not taken are collected.  Requests with the same leading digits
  go down as one row until they part, so a page is looked up once by its digest, whatever the number of
  requests below it.  A page's piece of the path is put in front of the pieces above it, so a finished
  path runs from the leaf to the root.

The rank of a leaf in its group comes from a range partitioning (a hot group spreads over many
partitions) and one small table of counts per partition and group.

Defined results: fields that are null count as ``-``; a null text is not tampered with, nor is a row
without id; a null group is one of its own, the first; rows without id come first; rows of one id are
ordered by their leaf, equal rows have equal leaves and differ in place alone; a table of one row has
its leaf as root and an empty path; an empty table gives no rows.  Only the five named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlab.llm.common import keep, small

FAN = 3                         # children of a node
LEVELS = 5                      # levels of a page
PAGE = FAN ** LEVELS            # nodes under a page
STEP = "array<struct<left:string,right:string>>"


@dataclass
class Forest:
    """Pages of all trees of a table by tier (0: over the leaves) and the top digest of every tree."""
    tiers: list
    tops: DataFrame             # g, digest, size


@dataclass
class Manifest:
    leaves: DataFrame           # g (group), pos (rank in it), size, doc_id, leaf, tampered
    groups: Forest              # one tree per group
    order: DataFrame            # g, pos: place of a group's subroot under the root
    top: Forest                 # the tree over the subroots
    root: str | None            # None: empty table


def _field(name: str, value: Column | None = None) -> Column:
    text = (F.col(name) if value is None else value).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list, text: str | None = None, value: Column | None = None) -> Column:
    """sha256 of the fields; ``value`` stands in for the column ``text``."""
    return F.sha2(F.concat(*[_field(c, value if c == text else None) for c in columns]), 256)


def leaves_of(docs: DataFrame, group: str = "source", id_column: str = "doc_id", text: str = "text",
              columns: tuple = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """(g, doc_id, leaf, tampered): a row's leaf, and its leaf after the tampering (the text's line
    ends deleted where two divides the crc32 of the id, else none)."""
    columns = list(columns)
    even = F.crc32(F.col(id_column).cast("string").cast("binary")) % 2 == 0
    altered = F.when(even, leaf_digest(columns, text, F.replace(F.col(text), F.lit("\n"), F.lit(""))))
    return (docs.select(F.col(group).alias("g"), F.col(id_column).alias("doc_id"), leaf_digest(columns).alias("leaf"),
                        altered.alias("altered"))
            .select("g", "doc_id", "leaf", F.coalesce("altered", "leaf").alias("tampered")))


def ranked(df: DataFrame, order: list) -> DataFrame:
    """``pos``: the rank, from 0, of a row among those of its ``g``, in ascending order of the columns
    ``order``; ``size``: the number of those rows."""
    keys = [F.col(c).asc_nulls_first() for c in ["g", *order]]
    rows = keep(keep(df).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    runs = rows.groupBy("g", part.alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("g").alias("run_g"), "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                       F.sum("n").over(Window.partitionBy("g")).alias("size"))
    joined = rows.withColumn("run", part).join(small(runs), F.col("g").eqNullSafe(F.col("run_g")) & (F.col("run") == F.col("part")))
    return joined.withColumn("pos", F.col("before") + F.col("place") - F.col("first")).drop(
        "place", "run", "run_g", "part", "first", "before")


def _height(size: Column) -> Column:
    """Levels of a page when ``size`` nodes of the tree lie under its tier."""
    height = F.lit(LEVELS)
    for h in range(LEVELS - 1, 0, -1):
        height = F.when(size <= FAN ** h, F.lit(h)).otherwise(height)
    return height


def _levels(nodes: Column, height: Column) -> Column:
    """Digests of all levels of a page, the lowest first."""
    def above(acc, _):
        last = F.element_at(acc, -1)
        runs = F.sequence(F.lit(0), F.floor((F.size(last) - 1) / FAN).cast("int"))
        return F.concat(acc, F.array(F.transform(runs, lambda j: F.sha2(F.concat_ws("", F.slice(last, j * FAN + 1, F.lit(FAN))), 256))))
    return F.aggregate(F.sequence(F.lit(1), height), F.array(nodes), above)


def build(nodes: DataFrame) -> Forest:
    """Trees over (g, pos, size, digest)."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    tops, tiers = nodes.where("size = 1").select("g", "digest"), []
    while most > 1:
        grouped = nodes.where("size > 1").groupBy("g", F.expr(f"pos div {PAGE}").alias("page"), "size").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "digest"))), lambda s: s["digest"]).alias("nodes"))
        pages = keep(grouped.select("g", F.col("page").alias("pos"), F.expr(f"(size + {PAGE - 1}) div {PAGE}").alias("size"),
                                    _levels(F.col("nodes"), _height(F.col("size"))).alias("levels"))
                     .withColumn("digest", F.element_at(F.element_at("levels", -1), 1)))
        tiers.append(pages)
        nodes = pages.select("g", "pos", "size", "digest")
        tops = tops.unionByName(nodes.where("size = 1").select("g", "digest"))
        most = -(-most // PAGE)
    return Forest(tiers, tops)


def records(forest: Forest) -> DataFrame:
    """The stored DAG as rows (digest, children)."""
    out = None
    for pages in forest.tiers:
        level = pages.select(F.posexplode(F.slice("levels", 2, F.size("levels") - 1)).alias("l", "digests"), "levels")
        nodes = level.select(F.posexplode("digests").alias("i", "digest"), F.element_at("levels", F.col("l") + 1).alias("below"))
        rows = nodes.select("digest", F.slice("below", F.col("i") * FAN + 1, F.lit(FAN)).alias("children"))
        out = rows if out is None else out.unionByName(rows)
    return out.dropDuplicates(["digest"]) if out is not None else None


def _segment(levels: Column, j: Column) -> Column:
    """The children not taken on the way to node ``j`` of a page's lowest level, lowest first: of each
    run the digests left and right of the one taken."""
    powers = F.array(*[F.lit(FAN ** k) for k in range(LEVELS)])

    def step(level):
        i = F.floor(j / F.element_at(powers, level)).cast("int")
        run = (F.floor(i / FAN) * FAN).cast("int")
        row = F.element_at(levels, level)
        return F.struct(F.concat_ws("", F.slice(row, run + 1, i - run)).alias("left"),
                        F.concat_ws("", F.slice(row, i + 2, run + FAN - 1 - i)).alias("right"))
    return F.transform(F.sequence(F.lit(1), F.size(levels) - 1), step)


def descend(requests: DataFrame, forest: Forest, start: DataFrame) -> DataFrame:
    """Follow requests (g, pos, ...) down from ``start`` (g, digest, size, path, ...: one row per tree,
    ``size`` its leaves).  Adds ``digest`` (the leaf found) and ``path`` (leaf to root) to the requests."""
    carried = [c for c in start.columns if c not in ("g", "digest", "path")]
    state = start.withColumn("prefix", F.lit(0).cast("long"))
    wanted = [requests]
    for _ in forest.tiers[1:]:
        wanted.append(wanted[-1].select("g", F.expr(f"pos div {PAGE}").alias("pos")).distinct())
    if not forest.tiers:
        wanted = [requests]
    for t in range(max(0, len(forest.tiers) - 1), -1, -1):
        if forest.tiers:
            pages = forest.tiers[t].groupBy(F.col("digest").alias("stored")).agg(F.first("levels").alias("levels"))
            state = state.join(pages, F.col("digest") == F.col("stored"), "left").drop("stored")
        else:
            state = state.withColumn("levels", F.lit(None).cast("array<array<string>>"))
        # a tree has pages in this tier if more than one of its nodes lies under it
        lost = (F.col("size") > PAGE ** t) & F.col("levels").isNull()
        state = state.select(F.col("g").alias("tree"), "prefix", "path", F.col("digest").alias("above"), *carried,
                             F.when(lost, F.raise_error(F.lit("a record of the manifest is missing")).cast("array<array<string>>"))
                             .otherwise(F.col("levels")).alias("levels"))
        met = wanted[t].join(state, F.col("g").eqNullSafe(F.col("tree")) & (F.expr(f"pos div {PAGE}") == F.col("prefix")))
        j = (F.col("pos") % PAGE).cast("int")
        passed = F.col("levels").isNull()
        met = met.withColumn("digest", F.when(passed, F.col("above")).otherwise(F.element_at(F.element_at("levels", 1), j + 1)))
        met = met.withColumn("path", F.concat(F.when(passed, F.array().cast(STEP)).otherwise(_segment(F.col("levels"), j)), "path"))
        if t:
            state = met.select("g", F.col("pos").alias("prefix"), "digest", "path", *carried)
        else:
            state = met.drop("tree", "prefix", "above", "levels")
    return state


def manifest(docs: DataFrame, **names) -> Manifest:
    """Build the manifest of a table (see ``leaves_of`` for the column names)."""
    leaves = keep(ranked(leaves_of(docs, **names), ["doc_id", "leaf"]))
    groups = build(leaves.select("g", "pos", "size", F.col("leaf").alias("digest")))
    sizes = leaves.where("pos = 0").select(F.col("g").alias("sized"), "size")
    tops = keep(groups.tops.join(sizes, F.col("g").eqNullSafe(F.col("sized"))).drop("sized"))
    order = keep(ranked(tops.select(F.lit(0).alias("g"), F.col("g").alias("name"), F.col("digest"), F.col("size").alias("leaves")), ["name"]))
    top = build(order.select("g", "pos", "size", "digest"))
    root = top.tops.first()
    return Manifest(leaves, Forest(groups.tiers, tops), order, top, root["digest"] if root else None)


def proofs(made: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Paths of ``requests`` (g, pos and any other columns; default: all leaves) by descent from the
    root: adds digest, subroot and path (array of left and right siblings, leaf to root)."""
    requests = made.leaves.drop("size") if requests is None else requests
    begin = made.top.tops.select("g", "digest", F.array().cast(STEP).alias("path")).withColumn(
        "size", F.lit(made.order.count()).cast("long"))
    subroots = descend(made.order.select("g", "pos", "name", "leaves"), made.top, begin)
    start = keep(subroots.select(F.col("name").alias("g"), "digest", F.col("digest").alias("subroot"), "path",
                                 F.col("leaves").alias("size")))
    return descend(requests, made.groups, start).drop("size")


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def verified_rows(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the tampered leaf) and verified per row."""
    made = manifest(docs)
    siblings = F.concat_ws("", F.transform("path", lambda s: F.concat(s["left"], s["right"])))
    return (proofs(made).select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(made.root).cast("string").alias("root"),
                                F.sha2(siblings, 256).alias("proof_sha256"), fold(F.col("tampered"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
