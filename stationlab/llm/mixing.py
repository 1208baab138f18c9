"""Mixing sources to target weights: Pareto order sampling.

A mix takes ``share`` percent of all words (repeats counted), split over the
sources by weight; no source is taken more than ``most`` times, and what that
leaves over is shared by weight among the others.  Within a source every
document gets the same number of certain whole copies, floor(target / size);
the rest is a sample without replacement of unequal inclusion probabilities:
p = w / (w + c), growing with the document's words w, where c puts the mean
document's odds at f / (1 - f) for the fraction f left to take.  Documents are
ranked by the odds of a uniform number (a hash of doc_id, text and copy) divided
by the odds of p, and the first ones whose words make up the rest are chosen: the
size of the sample is fixed, only its members are random.

No source is gathered in one task: the cut of a source is found in two rounds of
sums over 4096 rank intervals (each a partially aggregated shuffle), and only the
rows of the one small interval that the cut falls into are ordered.

Defined results: a null text has size 0 and takes 0; a null source is a source of
its own, after all others; rows that are equal throughout count as copies 1, 2, ...
and are drawn independently; an empty table gives an empty result; other columns
are not read by ``pareto_mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlab.llm.common import fresh, keep, small, word_count

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_TIMES = 2
EACH = 10_000           # copies numbered at a time
CELLS = 4096


def sizes_of(docs: DataFrame, text: str = "text", source: str = "source", id_column: str = "doc_id") -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                       F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.col(text).isNull().alias("no_text"),
                       word_count(text).alias("size"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: int = SHARE_PERCENT, most: int = MOST_TIMES) -> DataFrame:
    """One row per source: source_size, n_docs, weight, target.

    Sources fill up in the order of most * size / weight; the first k of them stop
    at their cap, where k is the least number that leaves no other above its own.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    all_rows = Window.partitionBy()
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("rank").asc())
    filled = order.rowsBetween(Window.unboundedPreceding, -1)
    t = (totals.withColumn("rank", F.row_number().over(rank)).withColumn("weight", choice)
         .withColumn("cap", (F.col("source_size") * most).cast("double"))
         .withColumn("all_words", F.sum("source_size").over(all_rows))
         .withColumn("all_weights", F.sum("weight").over(all_rows))
         .withColumn("caps_before", F.coalesce(F.sum("cap").over(filled), F.lit(0.0)))
         .withColumn("weights_before", F.coalesce(F.sum("weight").over(filled), F.lit(0.0))))
    level = (F.col("all_words") * share / 100.0 - F.col("caps_before")) / (F.col("all_weights") - F.col("weights_before"))
    # the first source that is not above its cap at its own level sets the level of all after it
    t = t.withColumn("level", level).withColumn("free", F.col("weight") * F.col("level") <= F.col("cap"))
    t = t.withColumn("final_level", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level"))))
                     .over(all_rows)["level"])
    t = t.withColumn("target", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(
        F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("final_level"), F.col("cap")))))
    return t.select("source", "source_size", "n_docs", "weight", "target")


def _numbered(sizes: DataFrame) -> DataFrame:
    """Equal rows as one row with their number; draws are numbered within it."""
    groups = sizes.groupBy("doc_id", "source", "digest", "no_text", "size").agg(F.count("*").alias("n_same"))
    # in two steps: no array grows with the number of a row's copies
    parts = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_same") - 1) / EACH))))
    last = F.least(F.col("n_same"), (F.col("part") + 1) * EACH)
    return parts.withColumn("copy", F.explode(F.sequence(F.col("part") * EACH + 1, last))).drop("n_same", "part")


def _ranked(draws: DataFrame, targets: DataFrame) -> DataFrame:
    """The draws with their source's values, certain copies and rank key in [0, 1)."""
    t = targets.select(F.col("source").alias("s"), "source_size", "target",
                       F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
                       .cast("long").alias("whole"), "n_docs")
    t = t.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    d = draws.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    text = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("digest"), F.col("copy").cast("string"))
    number = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    u = (number + 0.5) / F.lit(float(1 << 48))
    f = F.col("rest") / F.col("source_size")
    c = (F.col("source_size") / F.col("n_docs")) * (1.0 - f) / f
    p = F.col("size") / (F.col("size") + c)
    q = (u / (1.0 - u)) / (p / (1.0 - p))
    takes_part = (F.col("rest") > 0) & (F.col("size") > 0)
    return d.withColumn("key", F.when(takes_part, q / (1.0 + q)))


def _cut(rows: DataFrame, targets_left: DataFrame, level: int) -> DataFrame:
    """Per source the interval in which its words reach what is left, and the words before it."""
    cell = F.least(F.floor(F.col("key") * F.lit(float(CELLS ** level))), F.lit(CELLS ** level - 1)).cast("long")
    sums = rows.groupBy("source", "rest", cell.alias("cell")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.join(targets_left, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    sums = sums.withColumn("before", F.col("before_cells") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
    reach = sums.filter(F.col("before") < F.col("rest"))
    last = reach.groupBy("source").agg(F.max(F.struct("cell", "before")).alias("at"))
    return last.select(F.col("source").alias("t_source"), F.col("at.cell").alias("cut_cell"), F.col("at.before").alias("before_cells"))


def pareto_draws(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per draw: doc_id, source, digest, no_text, size, copy, source_size, target, copies taken."""
    ranked = keep(_ranked(_numbered(sizes), targets))
    taking = ranked.filter(F.col("key").isNotNull())
    start = targets.select(F.col("source").alias("t_source"), F.lit(0).cast("long").alias("before_cells"))
    first = _cut(taking, start, 1)

    def inside(rows: DataFrame, cut: DataFrame, level: int, how: str) -> DataFrame:
        cell = F.least(F.floor(F.col("key") * F.lit(float(CELLS ** level))), F.lit(CELLS ** level - 1)).cast("long")
        return rows.join(cut, F.col("source").eqNullSafe(F.col("t_source"))).filter(
            cell == F.col("cut_cell") if how == "at" else cell < F.col("cut_cell"))

    first = small(first)
    near = inside(taking, first, 1, "at").drop("cut_cell", "t_source", "before_cells")
    second = small(_cut(near, first.drop("cut_cell"), 2))
    cells = inside(near, second, 2, "at")
    upto = Window.partitionBy("source").orderBy("key", "doc_id", "digest", "copy").rowsBetween(Window.unboundedPreceding, -1)
    edge = (cells.withColumn("words_before", F.col("before_cells") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
            .filter(F.col("words_before") + F.col("size") / 2.0 <= F.col("rest"))
            .groupBy("source").agg(F.max(F.struct("key", "doc_id", "digest", "copy")).alias("last")))
    cuts = small(second.join(edge, F.col("source").eqNullSafe(F.col("t_source")), "left").select("t_source", "cut_cell", "last"))
    cell = F.least(F.floor(F.col("key") * F.lit(float(CELLS ** 2))), F.lit(CELLS ** 2 - 1)).cast("long")
    mine = F.struct("key", "doc_id", "digest", "copy")
    chosen = F.coalesce((cell < F.col("cut_cell")) | ((cell == F.col("cut_cell")) & (mine <= F.col("last"))), F.lit(False))
    out = ranked.join(cuts, F.col("source").eqNullSafe(F.col("t_source")), "left")
    copies = F.col("whole") + F.when(F.col("key").isNotNull() & chosen, 1).otherwise(0)
    return out.select("doc_id", "source", "digest", "no_text", "size", "copy", "source_size", "target", copies.cast("long").alias("copies"))


def pareto_mix(docs: DataFrame, weights=WEIGHTS, share: int = SHARE_PERCENT, most: int = MOST_TIMES, text: str = "text",
               source: str = "source", id_column: str = "doc_id") -> DataFrame:
    """Per row: doc_id, size, source_size, target (its source's) and taken (words of it in the mix)."""
    sizes = sizes_of(docs, text, source, id_column)
    targets = small(source_targets(sizes, weights, share, most))
    drawn = pareto_draws(sizes, targets)
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: int = SHARE_PERCENT, most: int = MOST_TIMES, text: str = "text",
                    source: str = "source", id_column: str = "doc_id") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns kept.

    Rows equal in id, source and text share a group's draws; those that differ in other columns take
    them in the order of a hash of all columns (as JSON), so no row is lost and reruns agree."""
    sizes = sizes_of(docs, text, source, id_column)
    targets = small(source_targets(sizes, weights, share, most))
    drawn = pareto_draws(sizes, targets)
    per_group = (drawn.groupBy("doc_id", "source", "digest", "no_text")
                 .agg(F.sum("copies").alias("copies"), F.count("*").alias("n_same")))
    names = {c: fresh(docs, c) for c in ("m_doc", "m_source", "m_digest", "m_none", "m_copies", "m_same", "m_each")}
    g = keep(per_group.select(*[F.col(a).alias(names[b]) for a, b in zip(
        ("doc_id", "source", "digest", "no_text", "copies", "n_same"),
        ("m_doc", "m_source", "m_digest", "m_none", "m_copies", "m_same"), strict=True)]))
    c = {k: F.col(f"`{v}`") for k, v in names.items()}
    same = (F.col(id_column).cast("long").eqNullSafe(c["m_doc"]) & F.col(source).cast("string").eqNullSafe(c["m_source"])
            & (F.md5(F.coalesce(F.col(text), F.lit(""))) == c["m_digest"]) & (F.col(text).isNull() == c["m_none"]))

    def repeated(rows: DataFrame, groups: DataFrame) -> DataFrame:
        joined = rows.join(groups, same)
        return (joined.filter(c["m_copies"] > 0)
                .withColumn(names["m_each"], F.explode(F.sequence(F.lit(1).cast("long"), c["m_copies"]))).select(*docs.columns))

    single = repeated(docs, g.filter(c["m_same"] == 1))
    several = g.filter(c["m_same"] > 1)
    if several.isEmpty():
        return single
    each = ["m_doc", "m_source", "m_digest", "m_none"]
    k, variant, number = [names[x] for x in each], fresh(docs, "m_variant"), fresh(docs, "m_number")
    rows = docs.join(several, same).withColumn(variant, F.xxhash64(F.to_json(F.struct(*[F.col(f"`{x}`") for x in docs.columns]))))
    kinds = rows.groupBy(*k, variant).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*k).orderBy(variant).rowsBetween(Window.unboundedPreceding, 0)
    kinds = kinds.withColumn("end", F.sum("n").over(upto))
    parts = kinds.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / EACH))))
    begin = F.col("end") - F.col("n") + F.col("part") * EACH
    numbered = parts.withColumn(number, F.explode(F.sequence(begin + 1, F.least(F.col("end"), begin + EACH))))
    mine = F.col(number) == F.col("copy")
    for x, y in zip(each, ("doc_id", "source", "digest", "no_text"), strict=True):
        mine = mine & F.col(names[x]).eqNullSafe(drawn[y])
    taken = numbered.join(drawn, mine).groupBy(*k, variant).agg(F.sum("copies").alias("copies"))
    t = {x: f"t_{i}" for i, x in enumerate([*k, variant])}
    alike, copies = F.lit(True), fresh(docs, "m_taken")
    for x, y in t.items():
        alike = alike & F.col(x).eqNullSafe(F.col(y))
    taken = taken.select(*[F.col(x).alias(y) for x, y in t.items()], F.col("copies").alias(copies))
    one = rows.dropDuplicates([*k, variant]).join(taken, alike).filter(F.col(copies) > 0)       # rows of a kind are equal in all columns
    return single.unionByName(one.withColumn(names["m_each"], F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns))
