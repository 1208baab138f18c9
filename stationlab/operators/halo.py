"""Row-based windows over few, very long partitions, without one task per key.

Every window in this library is *row-based* per station (lag 24 = 24 rows
back, not 24 hours).  ``Window.partitionBy(region)`` is exact but puts a whole
station history in one task: with 10 stations a 1000-executor cluster runs 10
tasks, and a station holding a third of all rows is a third of the data in one
task.  Here rows are instead cut into (key, time bucket) pieces, each piece
gets a copy of the ``halo`` rows that precede it (taken from as many earlier
buckets as needed, because a bucket may hold fewer than ``halo`` rows), the
window runs per piece, and the copies are dropped.  Results equal the plain
per-key window row for row.

Unbounded reach (forward / backward fill) is two-phase: the last / first
non-null per bucket is aggregated into the small bucket table, carried across
buckets with a window over that table, and joined back together with the
bucket offsets (one aggregate, one join for numbering and fills together).

Sizes: the bucket table has one row per (key, bucket), i.e. it grows with the
time span, not with the rows per bucket.  Its joins are plain joins; AQE turns
them into broadcast joins only after measuring the materialised side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.search import floor_entry_of

BKT, RN, IDX, HALO = "_bkt", "_rn", "_idx", "_halo"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _bucket_table(d: DataFrame, k: list[str], ordering, fill: list[str]) -> DataFrame:
    """(key, bucket) -> count, offsets, ordinal and fill carries.

    Aggregated straight from the input (partial aggregation before the
    shuffle), then windowed per key over the small result.
    """
    # a bare timestamp keeps max_by / min_by in the hash aggregate (a struct
    # ordering would force a sort-based aggregate over the whole input)
    okey = ordering[0] if len(ordering) == 1 else F.struct(*ordering)
    wk = Window.partitionBy(*k).orderBy(BKT)
    wk_rev = Window.partitionBy(*k).orderBy(F.col(BKT).desc())
    return (d.groupBy(*k, BKT).agg(
                F.count(F.lit(1)).alias("_n"),
                *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(f"_last_{c}") for c in fill],
                *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(f"_first_{c}") for c in fill])
            .withColumn("_end", F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_start", F.col("_end") - F.col("_n"))
            .withColumn("_ord", F.row_number().over(wk))
            # carries across buckets: running frames only (forward, and
            # forward over descending buckets for the back fill)
            .withColumns({f"_in_{c}": F.last(f"_last_{c}", ignorenulls=True)
                          .over(wk.rowsBetween(Window.unboundedPreceding, -1)) for c in fill})
            .withColumns({f"_out_{c}": F.last(f"_first_{c}", ignorenulls=True)
                          .over(wk_rev.rowsBetween(Window.unboundedPreceding, -1)) for c in fill})
            .drop(*[f"_last_{c}" for c in fill], *[f"_first_{c}" for c in fill]))


def _halo_targets(buckets: DataFrame, k: list[str], halo: int) -> DataFrame:
    """Per source bucket, the later buckets that need some of its last rows.

    Each destination takes the ``halo`` rows before its start; they come from
    at most ``halo`` earlier buckets (every bucket holds a row), so each list
    has at most ``halo`` entries.
    """
    src = buckets.select(*k, BKT, F.col("_ord").alias("_src_ord"), F.col("_end").alias("_src_end"))
    dst = buckets.select(*k, F.col(BKT).alias("_dst_bkt"), F.col("_ord").alias("_dst_ord"),
                         F.col("_start").alias("_dst_start"))
    return (src.withColumn("_dst_ord", F.explode(F.sequence(F.col("_src_ord") + 1, F.col("_src_ord") + halo)))
            .join(dst, [*k, "_dst_ord"])
            .where(F.col("_dst_start") - halo < F.col("_src_end"))
            .groupBy(*k, BKT)
            .agg(F.collect_list(F.struct(F.col("_dst_bkt").alias("b"), F.col("_dst_start").alias("s")))
                 .alias("_targets")))


REFINE = ("hour", "minute", "second", "millisecond", "microsecond")
# bucket starts sent to the tasks as sorted arrays: at most this many bytes
MAX_START_BYTES = 8 << 20
_ZERO = "timestamp_ntz'1970-01-01 00:00:00'"


def _micros(c: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {_ZERO}, `{c}`)")


class Starts:
    """Sorted starts per key, searched in the tasks."""

    def __init__(self, rows: DataFrame, k: list[str], start: str):
        self.k = k
        self.fits = 8 * rows.count() <= MAX_START_BYTES
        self.entries: dict = {}
        if self.fits:
            table = rows.select(self._key().alias("k"), _micros(start).alias("s")).orderBy("k", "s").toArrow()
            at = table.column("s").to_numpy()
            for name, own in _runs(table.column("k").to_pylist()):
                self.entries[name] = at[own]

    def _key(self) -> Column:
        return F.to_json(F.struct(*self.k))

    def floor(self, order: str) -> Column:
        """The start at or before a row's time, of its key; NULL if there is none."""
        if not self.entries:
            return F.lit(None).cast("timestamp_ntz")
        keyed = F.lit(True)
        for c in self.k:
            keyed = keyed & F.col(c).isNotNull()
        found = floor_entry_of(self.entries, F.when(keyed, self._key()), _micros(order))
        return F.timestamp_add("MICROSECOND", found, F.expr(_ZERO))


def _runs(names: list):
    """(name, slice) of each run of equal names."""
    first = 0
    for i in range(1, len(names) + 1):
        if i == len(names) or names[i] != names[first]:
            yield names[first], slice(first, i)
            first = i


def assign_buckets(df: DataFrame, key, order: str, target_rows: int, base: str = "day",
                   refine: tuple[str, ...] = REFINE) -> DataFrame:
    """Add ``_bkt``: contiguous, time-ordered buckets of under ``2 * target_rows`` rows.

    Level by level (``base`` unit, then each ``refine`` unit):

    * rows per (key, unit) come from a hash aggregate (a small table);
    * consecutive light units are packed until they reach ``target_rows``
      (``floor(rows before / target)`` within the parent, on that small
      table), so sparse history does not make tiny buckets (each bucket
      carries up to ``halo`` copied rows);
    * a unit with more than ``target_rows`` rows (a hot day: one station
      holding a third of the data) goes to the next, finer level, which
      aggregates only the rows of hot units and is skipped when none is hot.

    A bucket's key is the timestamp its range starts at; ranges are disjoint,
    so ordering by ``_bkt`` is ordering by time.  Only rows of one key and one
    microsecond cannot be told apart and stay in one bucket.

    The starts, one per bucket, are sorted arrays that go to the tasks, and a row
    finds its own by binary search: assigning buckets moves no rows.  They are not
    literals of the plan, whose texts hold every literal many times over.  Beyond
    ``MAX_START_BYTES`` of starts the rows are joined to the table of units.
    """
    from ..session import materialize
    k = _keys(key)
    levels, open_rows, starts = (base, *refine), df, None
    for i, unit in enumerate(levels):
        last = i == len(levels) - 1
        grp = [*k] + (["_p"] if i else [])
        src = open_rows.withColumn("_u", F.date_trunc(unit, F.col(order)))
        if i:
            src = src.withColumn("_p", F.date_trunc(levels[i - 1], F.col(order)))
        wp = Window.partitionBy(*grp).orderBy("_u")
        units = (src.groupBy(*grp, "_u").agg(F.count(F.lit(1)).alias("_c"))
                 .withColumn("_before", F.coalesce(F.sum("_c").over(wp.rowsBetween(Window.unboundedPreceding, -1)),
                                                   F.lit(0)))
                 .withColumn("_pack", F.floor(F.col("_before") / F.lit(target_rows)))
                 .withColumn("_hot", F.lit(False) if last else F.col("_c") > target_rows))
        packs = units.where(~F.col("_hot")).groupBy(*grp, "_pack").agg(F.min("_u").alias("_start"))
        found = materialize(packs.select(*k, "_start", F.lit(False).alias("_hot")).unionByName(
            units.where("_hot").select(*k, F.col("_u").alias("_start"), "_hot")))
        closed = found.where(~F.col("_hot"))
        starts = closed if starts is None else starts.unionByName(closed)
        hot = found.where("_hot")
        if hot.isEmpty():
            break
        held = Starts(hot, k, "_start")
        if not held.fits:
            return _assign_by_join(df, key, order, target_rows, base, refine)
        # the rows of hot units: the greatest hot start at or before their unit is the unit itself
        probe = df.withColumn("_u", F.date_trunc(unit, F.col(order)))
        open_rows = probe.where(F.coalesce(held.floor("_u") == F.col("_u"), F.lit(False))).drop("_u")
    held = Starts(starts, k, "_start")
    return df.withColumn(BKT, held.floor(order)) if held.fits else _assign_by_join(df, key, order, target_rows, base, refine)


def _assign_by_join(df: DataFrame, key, order: str, target_rows: int, base: str, refine: tuple[str, ...]) -> DataFrame:
    """``assign_buckets`` with a join per level, for more starts than a plan should carry."""
    from ..session import materialize
    k = _keys(key)
    levels = (base, *refine)
    d = df.withColumn(BKT, F.lit(None).cast("timestamp_ntz")).withColumn("_open", F.lit(True))
    parent = None
    for i, unit in enumerate(levels):
        last = i == len(levels) - 1
        d = d.withColumn("_u", F.date_trunc(unit, F.col(order)))
        grp = [*k] + (["_p"] if parent else [])
        src = d.where("_open")
        if parent:
            src = src.withColumn("_p", F.date_trunc(parent, F.col(order)))
        wp = Window.partitionBy(*grp).orderBy("_u")
        units = (src.groupBy(*grp, "_u").agg(F.count(F.lit(1)).alias("_c"))
                 .withColumn("_before", F.coalesce(F.sum("_c").over(wp.rowsBetween(Window.unboundedPreceding, -1)),
                                                   F.lit(0)))
                 .withColumn("_pack", F.floor(F.col("_before") / F.lit(target_rows)))
                 .withColumn("_hot", F.lit(False) if last else F.col("_c") > target_rows))
        packs = units.where(~F.col("_hot")).groupBy(*grp, "_pack").agg(F.min("_u").alias("_start"))
        umap = materialize(units.join(packs, [*grp, "_pack"], "left").select(*k, "_u", "_hot", "_start"))
        d = (d.join(umap, [*k, "_u"], "left")
             .withColumn(BKT, F.when(F.col("_open") & ~F.col("_hot"), F.col("_start")).otherwise(F.col(BKT)))
             .withColumn("_open", F.col("_open") & F.coalesce(F.col("_hot"), F.lit(False)))
             .drop("_hot", "_start"))
        if umap.where("_hot").isEmpty():
            break
        parent = unit
    return d.drop("_u", "_open")


def _with_buckets(df: DataFrame, key, order: str, unit: str, target_rows: int | None) -> DataFrame:
    if target_rows is None:
        return df.withColumn(BKT, F.date_trunc(unit, F.col(order)))
    return assign_buckets(df, key, order, target_rows, base=unit)


def bucket_table(df: DataFrame, key, order: str, unit: str = "day", tie: tuple[str, ...] = (),
                 fill: list[str] | None = None) -> DataFrame:
    """The (key, bucket) table ``index_rows`` needs, computed once.

    One row per (key, time bucket): small next to the data (it grows with the
    time span, not the row count), so it is checkpointed and reused by the
    offset join and the halo-target lists instead of being recomputed.
    """
    from ..session import materialize
    k = _keys(key)
    ordering = [F.col(order), *[F.col(t) for t in tie]]
    d = df if BKT in df.columns else df.withColumn(BKT, F.date_trunc(unit, F.col(order)))
    return materialize(_bucket_table(d, k, ordering, list(fill or [])))


def largest_key(df: DataFrame, key) -> int:
    """Rows in the largest key: one aggregate (map-side combined), one number back."""
    r = df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return int(r or 0)


def choose_method(df: DataFrame, key, max_rows_per_task: int) -> str:
    """"window" while the largest key fits one task, else "halo"."""
    return "window" if largest_key(df, key) <= max_rows_per_task else "halo"


def index_rows(df: DataFrame, key, order: str, unit: str = "day", tie: tuple[str, ...] = (),
               fill: list[str] | None = None, halo: int = 0,
               buckets: DataFrame | None = None, fill_mode: str = "both",
               target_rows: int | None = None) -> DataFrame:
    """Number rows within their key without a per-key task, fill, add halo copies.

    Output: the input columns plus ``_bkt`` (time bucket), ``_idx`` (1-based
    row position inside the key) and ``_halo``.  Rows with ``_halo`` true are
    copies of the ``halo`` rows preceding each bucket, filed under that
    bucket, so ``bucket_window`` sees at least ``halo`` predecessors for every
    original row.

    ``fill`` columns are forward- then back-filled within the key (P14 +
    P15): in-bucket values ride on the numbering window, values crossing
    bucket borders ride on the bucket aggregate.

    Buckets: fixed ``unit`` ranges, or with ``target_rows`` the adaptive
    buckets of ``assign_buckets`` (packed light days, split hot ones).

    Shuffles of the rows: two.  By (key, bucket) for the numbering, and with
    their copies by (key, bucket) again for the final window; the bucket
    table and the unit counts are small.
    """
    k = _keys(key)
    fill = list(fill or [])
    ordering = [F.col(order), *[F.col(t) for t in tie]]
    d = _with_buckets(df, key, order, unit, target_rows)
    if buckets is None:
        buckets = bucket_table(d, key, order, unit, tie, fill)
    side = buckets.select(*k, BKT, "_start", "_end", *[f"_in_{c}" for c in fill],
                          *[f"_out_{c}" for c in fill])
    if halo:
        side = side.join(_halo_targets(buckets, k, halo), [*k, BKT], "left")
    w = Window.partitionBy(*k, BKT).orderBy(*ordering)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    # back fill = forward fill over descending order: a running frame, linear
    # (an unbounded-following frame is re-evaluated for every row)
    rev = (Window.partitionBy(*k, BKT).orderBy(*[c.desc() for c in ordering])
           .rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumns({RN: F.row_number().over(w),
                       **{f"_ff_{c}": F.last(c, ignorenulls=True).over(run) for c in fill},
                       **{f"_bf_{c}": F.last(c, ignorenulls=True).over(rev) for c in fill}})
    d = (d.join(side, [*k, BKT])
         .withColumn(IDX, F.col("_start") + F.col(RN))
         .withColumns({c: F.coalesce(*_fill_parts(c, fill_mode)) for c in fill})
         .drop(*[f"_{p}_{c}" for p in ("ff", "bf", "in", "out") for c in fill]))
    if not halo:
        return d.withColumn(HALO, F.lit(False))
    own = F.array(F.struct(F.col(BKT).alias("b"), F.lit(False).alias("h")))
    copies = F.transform(
        F.filter(F.coalesce(F.col("_targets"), F.array()), lambda t: F.col(IDX) > t["s"] - halo),
        lambda t: F.struct(t["b"].alias("b"), F.lit(True).alias("h")))
    return (d.withColumn("_t", F.explode(F.concat(own, copies)))
            .withColumn(BKT, F.col("_t.b")).withColumn(HALO, F.col("_t.h"))
            .drop("_t", "_targets"))


def _fill_parts(c: str, mode: str):
    fwd = [F.col(f"_ff_{c}"), F.col(f"_in_{c}")]
    bwd = [F.col(f"_bf_{c}"), F.col(f"_out_{c}")]
    return {"forward": fwd, "backward": bwd, "both": fwd + bwd}[mode]


def windowed(df: DataFrame, columns, reach: int, key="region", order: str = "datetime",
             method: str = "auto", unit: str = "day", fill: list[str] | None = None,
             fill_mode: str = "both", max_rows_per_task: int = 2_000_000,
             target_rows: int | None = None) -> DataFrame:
    """Add row-based window columns per key, in the plain or the bucketed form.

    ``columns(w, pos)`` returns ``{name: Column}`` built on the window spec
    ``w`` (ordered by time within the key); ``pos`` is the row's 1-based
    position in its key.  ``reach`` is how many preceding rows any of the
    columns looks at.  ``fill`` columns are filled first (``fill_mode``
    forward / backward / both).  ``method``: "window", "halo" or "auto"
    (plain while the largest key fits ``max_rows_per_task`` rows; beyond it
    adaptive buckets of a quarter of that, see ``assign_buckets``).  Rows whose
    key or time is NULL stay in both forms, unfilled, with NULL window columns.
    """
    k = _keys(key)
    fill = list(fill or [])
    keyed = F.col(order).isNotNull()
    for c in k:
        keyed = keyed & F.col(c).isNotNull()
    unkeyed = df.where(~keyed)
    if not unkeyed.isEmpty():       # set aside: they belong to no bucket and feed no other row
        out = windowed(df.where(keyed), columns, reach, key, order, method, unit, fill, fill_mode,
                       max_rows_per_task, target_rows)
        return out.unionByName(unkeyed, allowMissingColumns=True)
    if method == "auto":
        method = choose_method(df, key, max_rows_per_task)
        if method == "halo" and target_rows is None:
            target_rows = max(max_rows_per_task // 4, 64 * max(reach, 1))
    if method == "window":
        w = Window.partitionBy(*k).orderBy(order)
        d = df
        if fill:
            pre = w.rowsBetween(Window.unboundedPreceding, 0)
            post = Window.partitionBy(*k).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
            parts = {"forward": lambda c: [F.last(c, True).over(pre)],
                     "backward": lambda c: [F.last(c, True).over(post)],
                     "both": lambda c: [F.last(c, True).over(pre), F.last(c, True).over(post)]}[fill_mode]
            d = d.withColumns({c: F.coalesce(*parts(c)) for c in fill})
        return d.withColumns(columns(w, F.row_number().over(w))) if columns else d
    if method != "halo":
        raise ValueError(f"unknown method {method!r}")
    ext = index_rows(df, key, order, unit, fill=fill, halo=reach, fill_mode=fill_mode,
                     target_rows=target_rows)
    w = bucket_window(key)
    out = ext.withColumns(columns(w, F.col(IDX))) if columns else ext
    return drop_helpers(out.where(~F.col(HALO)))


def bucket_window(key) -> Window:
    return Window.partitionBy(*_keys(key), BKT).orderBy(IDX)


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(BKT, RN, IDX, HALO, "_start", "_end")
