"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct word shingles (64-bit hashes); documents of equal
sets are one class, so copies never meet in pairs.  The global order of all shingles
(their hashes) is cut into fragments, and overlaps are counted fragment by fragment:

1. Shingles of the first fragment are dealt out once, by shingle, and stored nowhere else (texts
   are hashed again instead).  There, a shingle that only one class holds is missing from any
   partner.  A class of n shingles may miss n - ceil(t n) at most; classes that miss more in this
   fragment alone are done.  (Rows: 1 / fragments of all shingles.)
2. For the classes left, shingles of one class only are counted over all fragments,
   and each class's prefix, its rarest n - ceil(t n) + 1 shingles (frequency, then
   hash), links it to the least class that has the shingle in its prefix too.  Two
   linked classes share such a shingle, so every true pair lies in one cluster.
3. A cluster is dealt out in blocks of ``BLOCK`` classes; every pair of blocks is one task
   that counts the partial overlaps of all its pairs separately per fragment, sums them
   per pair, and tests 100 * overlap >= percent * union exactly.  It returns the
   number of links and a spanning forest of them, never the pairs.
4. Connected components of the forests give each class its component.

Nothing is capped: large clusters become more block pairs.  Class ids are 64-bit hashes of
the sorted set, with its size.

Defined results: words are lower-cased (A-Z) runs ``[^\\x20\\x09-\\x0D]+``; fewer words
than a shingle are one shingle; null, empty and wordless texts have size 0, are linked with
nothing and form components of their own; rows with the same set are one component,
repeated rows included; a component whose doc_ids are all null has a null id; an empty
table gives an empty result; other columns are not read by ``jaccard_components``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlab.llm.common import LOWER, U64, WordHashes, column_bytes, fresh, keep, keep_table, shingle_hashes, slices, small
from stationlab.llm.components import components

BLOCK = 1500
CELLS = 4_000_000       # of a dense fragment of a block pair


def fragments_for(percent: int) -> int:
    """Fragments of the order, so that the first holds about twice what a partner may miss."""
    return max(2, -(-100 // (2 * max(1, 100 - percent))))


def shingle_set(data: bytes | None, hashes: WordHashes, k: int) -> np.ndarray:
    words = data.translate(LOWER).split() if data else []
    return np.unique(shingle_hashes(hashes(words), k)) if words else np.zeros(0, U64)


def class_id(values: np.ndarray) -> int:
    import xxhash
    return int(np.int64(U64(xxhash.xxh3_64_intdigest(values.tobytes(), seed=len(values)))))


def first_fragment(values: np.ndarray, fragments: int) -> np.ndarray:
    return values[:np.searchsorted(values, U64((1 << 64) // fragments))]


def least_partner_share(n, percent: int):
    """The least overlap with any partner: ceil(percent * n / 100)."""
    return -(-n * percent // 100)


def _texts(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("rid"), F.col(text).alias("text"))


def document_classes(docs: DataFrame, k: int, percent: int, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row: doc_id, rid (hash of the text), cls, n (set size) and n_first (of them in the first fragment)."""
    fragments = fragments_for(percent)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, most=4 << 20):
                rows = []
                for data in column_bytes(part, "text"):
                    s = shingle_set(data, hashes, k)
                    rows.append((class_id(s) if len(s) else None, len(s), len(first_fragment(s, fragments))))
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(x, pa.int64()) for x in c]], ["doc_id", "rid", "cls", "n", "n_first"])

    return _texts(docs, text, id_column).mapInArrow(run, "doc_id long, rid long, cls long, n long, n_first long")


class Met:
    """Whether a task has met a class (up to a million are remembered; the others count as new)."""

    def __init__(self, most: int = 1_000_000):
        self.most, self.seen = most, set()

    def __call__(self, cls: int) -> bool:
        if cls in self.seen:
            return True
        if len(self.seen) < self.most:
            self.seen.add(cls)
        return False


def least_size(percent: int) -> int:
    """The size of the smallest sets that may be linked with another set."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def _shingles(texts: DataFrame, k: int, least: int = 1, fragments: int = 1) -> DataFrame:
    """(cls, shingle) of the texts with ``least`` shingles or more: all of them, or those of the first of several fragments."""
    def run(batches):
        hashes, met = WordHashes(), Met()
        for batch in batches:
            for part in slices(batch, most=4 << 20):
                out, classes = [], []
                for data in column_bytes(part, "text"):
                    s = shingle_set(data, hashes, k)
                    if len(s) < least:
                        continue
                    c = class_id(s)
                    if not met(c):          # copies met by this task say nothing new
                        out.append((first_fragment(s, fragments) if fragments > 1 else s).astype(np.int64))
                        classes.append(np.full(len(out[-1]), c, np.int64))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(classes)), pa.array(np.concatenate(out))], ["cls", "shingle"])

    return texts.select("text").mapInArrow(run, "cls long, shingle long")


def _survivors(texts: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Classes that the first fragment does not rule out: cls, n, and a row (rid, doc_id) that holds the set."""
    least = max(1, least_size(percent))
    of_shingle = Window.partitionBy("shingle")
    # dealt by shingle once: holders are compared, and repeats of a class dropped, where the rows lie
    e = _shingles(texts, k, least, fragments_for(percent)).repartition("shingle")
    several = e.withColumn("lo", F.min("cls").over(of_shingle)).withColumn("hi", F.max("cls").over(of_shingle)).filter("lo < hi")
    shared = several.select("shingle", "cls").distinct().groupBy("cls").agg(F.count("*").alias("n_shared"))
    classes = (rows.filter(F.col("n") >= least).groupBy("cls")
               .agg(F.first("n").alias("n"), F.first("n_first").alias("n_first"), F.min(F.struct("rid", "doc_id")).alias("at")))
    may_miss = F.col("n") - F.ceil(F.col("n") * percent / 100)
    return (classes.join(shared, "cls", "left").filter(F.col("n_first") - F.coalesce("n_shared", F.lit(0)) <= may_miss)
            .select("cls", "n", F.col("at.rid").alias("rid"), F.col("at.doc_id").alias("at_doc")))


def class_components(docs: DataFrame, rows: DataFrame, k: int, percent: int, text: str = "text", id_column: str = "doc_id",
                     block: int = BLOCK) -> DataFrame:
    """(cls, root, n_links) of the classes that may have a partner."""
    source = _texts(docs, text, id_column)
    left = small(_survivors(source, rows, k, percent))
    texts = source.join(left.select("rid", "at_doc"), "rid").filter(F.col("doc_id").eqNullSafe(F.col("at_doc"))).select("text")
    may_miss = F.col("n") - F.ceil(F.col("n") * percent / 100)
    missed = F.col("n") - F.size("shingles")
    of_shingle = Window.partitionBy("shingle")
    # dealt by shingle once for the frequencies, then by class once; a class's shared shingles are one row, rarest first
    shared = (_shingles(texts, k).repartition("shingle").distinct()
              .withColumn("df", F.count("*").over(of_shingle)).filter("df > 1"))
    sets = keep_table(shared.repartition("cls").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("ranked"))
                      .join(left.select("cls", "n"), "cls").select("cls", "n", F.col("ranked.shingle").alias("shingles"))
                      .filter(missed <= may_miss))
    prefix = sets.select("cls", F.explode(F.slice("shingles", F.lit(1), (may_miss + 1 - missed).cast("int"))).alias("shingle"))
    heads = prefix.repartition("shingle").withColumn("a", F.min("cls").over(of_shingle))
    clusters = components(heads.select("a", F.col("cls").alias("b")).filter("a < b"))
    sizes = clusters.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = small(clusters.join(sizes, "root"))
    dealt = (sets.join(placed, F.col("cls") == F.col("node"))
             .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "n", "shingles"))

    def verify(table: pa.Table) -> pa.Table:
        return linked(table, percent)

    found = keep(dealt.groupBy("root", "i", "j").applyInArrow(verify, "cls long, head long, n_links long"))
    joined = components(found.filter("head < cls").select(F.col("head").alias("a"), F.col("cls").alias("b")))
    n_links = found.groupBy("cls").agg(F.sum("n_links").alias("n_links"))
    return n_links.join(joined, F.col("cls") == F.col("node"), "left").select(
        "cls", F.coalesce("root", "cls").alias("root"), "n_links")


def partial_overlaps(places: np.ndarray, owners: np.ndarray, left: np.ndarray, right: np.ndarray, n_places: int) -> np.ndarray:
    """Overlaps of all (left, right) rows: fragments of the order are counted one by one and summed.

    ``places`` and ``owners``: place in the order and row of every element; ``left`` and
    ``right``: number of a row on either side, -1 if it is not there.
    """
    n_left, n_right = int(left.max(initial=-1)) + 1, int(right.max(initial=-1)) + 1
    total = np.zeros((n_left, n_right), np.float32)
    order = np.argsort(places, kind="stable")
    places, owners = places[order], owners[order]
    step = max(64, CELLS // max(1, n_left + n_right))
    for a in range(0, n_places, step):
        lo, hi = np.searchsorted(places, (a, a + step))
        p, o = places[lo:hi] - a, owners[lo:hi]
        used, p = np.unique(p, return_inverse=True)
        counts = np.bincount(p)
        few = counts[p] <= 24
        if few.any():       # a shingle of few rows: its pairs one by one
            begin = np.flatnonzero(np.concatenate(([True], p[few][1:] != p[few][:-1])))
            rows, sizes = o[few], np.diff(np.concatenate((begin, [int(few.sum())])))
            for width in np.unique(sizes):
                own = rows[begin[sizes == width][:, None] + np.arange(width)]
                x, y = left[own][:, :, None], right[own][:, None, :]
                ok = (x >= 0) & (y >= 0)
                x, y = np.broadcast_arrays(x, y)
                np.add.at(total, (x[ok], y[ok]), 1.0)
        many = ~few
        if many.any():
            used, q = np.unique(p[many], return_inverse=True)
            l, r = left[o[many]], right[o[many]]
            x, y = np.zeros((n_left, len(used)), np.float32), np.zeros((n_right, len(used)), np.float32)
            x[l[l >= 0], q[l >= 0]] = 1.0
            y[r[r >= 0], q[r >= 0]] = 1.0
            total += x @ y.T
    return total


def linked(table: pa.Table, percent: int) -> pa.Table:
    """One pair of blocks: per class its number of links here and the least class it reaches through them."""
    cls = table.column("cls").to_numpy()
    n = table.column("n").to_numpy()
    own = table.column("own").to_numpy()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    order = np.argsort(cls, kind="stable")
    cls, n, own = cls[order], n[order], own[order]
    lists = table.column("shingles").combine_chunks().take(pa.array(order))
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    names, places = np.unique(values, return_inverse=True)
    owners = np.repeat(np.arange(len(cls)), sizes)
    in_left, in_right = own == i, own == j
    left = np.where(in_left, np.cumsum(in_left) - 1, -1)
    right = np.where(in_right, np.cumsum(in_right) - 1, -1)
    overlap = partial_overlaps(places, owners, left, right, len(names)).astype(np.int64)
    n_left, n_right = n[in_left], n[in_right]
    link = 100 * overlap >= percent * (n_left[:, None] + n_right[None, :] - overlap)
    a, b = np.flatnonzero(in_left), np.flatnonzero(in_right)
    if i == j:
        np.fill_diagonal(link, False)
    degree = np.zeros(len(cls), np.int64)
    degree[a] += link.sum(axis=1)
    if i != j:
        degree[b] += link.sum(axis=0)
    head = np.arange(len(cls))
    x, y = np.nonzero(link)
    x, y = a[x], b[y]
    while len(x):       # least row reached; halves the paths every round
        least = np.minimum(head[x], head[y])
        new = head.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        np.minimum.at(new, head[x], least)
        np.minimum.at(new, head[y], least)
        new = new[new]
        if np.array_equal(new, head):
            break
        head = new
    some = degree > 0
    return pa.table({"cls": pa.array(cls[some], pa.int64()), "head": pa.array(cls[head[some]], pa.int64()), "n_links": pa.array(degree[some])})


def _rows_with_roots(docs: DataFrame, k: int, percent: int, text: str, id_column: str, block: int) -> DataFrame:
    rows = keep_table(document_classes(docs, k, percent, text, id_column))
    found = small(class_components(docs, rows, k, percent, text, id_column, block))
    return rows.drop("n_first").join(found, "cls", "left").withColumn("root", F.coalesce("root", "cls"))


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, text: str = "text", id_column: str = "doc_id",
                       block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least doc_id reached through links, its own included) and n_links
    (other sets that its set is linked with)."""
    rows = _rows_with_roots(docs, k, percent, text, id_column, block)
    least = small(rows.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
                  .filter("n > 1").drop("n"))
    return rows.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", id_column: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each component, that of the least doc_id (ties: least hash of the text, then of
    all columns, as JSON); wordless rows stay."""
    rows = _rows_with_roots(docs, k, percent, text, id_column, block)
    worded = rows.filter(F.col("root").isNotNull())
    best = worded.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("best"), F.count("*").alias("n"))
    out = best.filter("n > 1")
    l_doc, l_rid = fresh(docs, "l_doc"), fresh(docs, "l_rid")
    # rows to drop: of components with several rows, all that are not the best; equal best rows are told apart below
    losers = small(worded.join(small(out), "root").groupBy("doc_id", "rid")
                   .agg(F.max((F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("rid") == F.col("best.rid"))).cast("int")).alias("is_best"),
                        F.count("*").alias("n_same"))
                   .select(F.col("doc_id").alias(l_doc), F.col("rid").alias(l_rid), "is_best", "n_same"))
    source, rid = F.col(f"`{id_column}`").cast("long"), F.xxhash64(F.col(f"`{text}`"))
    same = source.eqNullSafe(F.col(l_doc)) & (rid == F.col(l_rid))
    kept = docs.join(losers.filter("is_best = 0 or n_same > 1").select(l_doc, l_rid), same, "left_anti")
    again = losers.filter("is_best = 1 and n_same > 1").select(l_doc, l_rid)
    if again.isEmpty():
        return kept
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = (docs.join(again, same, "left_semi").groupBy(source.alias("i"), rid.alias("r"))
             .agg(F.min_by(every, F.xxhash64(F.to_json(every))).alias("row")))
    return kept.unionByName(first.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
