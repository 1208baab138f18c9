"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is a set of paragraph digests (64-bit; the second occurrence of a paragraph counts as another
item).  A sketch deals every item to one cell in each of three tables; a cell holds the number of its
items and the sums, modulo 2^64, of their digests and of a check hash.  The cells of two versions
subtract: what both hold cancels out.  Peeling then recovers the rest: a cell with one item names it, its
removal from its other cells leaves further cells with one.  Where cells remain, the sketch was too small
for the difference, and both versions are sketched again with tables four times as large.

* ``fingerprints(docs)``: the base sketch (three tables of ``BASE`` cells) of every text, as base64.
* ``compare_versions(df, a, b)``: of two text columns the digests found in one only, and their likeness:
  items in both, divided by items in either.
* ``edited_versions(docs)``: every document against a text edited with the document next to it, and
  against that document.  Documents meet their neighbour by range: the first key of every range of
  (id, text hash) is counted out beforehand, and the row that bears it is also dealt to the range before.

A paragraph is a line; longer ones are cut behind sentence marks, and after ``MOST`` bytes without one.
Blank lines count nothing.

Defined results: a null text is empty; an empty text has a sketch of zeros; two texts without paragraphs
are alike (1.0), one without and one with are not (0.0).  Documents go by descending id, rows without id
last, rows of one id by the hash of their text; a table of one document has itself as its neighbour.
Equal texts have equal fingerprints.  Other columns are not read; ``compare_versions`` keeps those named.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import U64, column_list, mix64, slices

BASE = 8                        # cells of each table of the base sketch
TABLES = 3
MOST = 240
PIECE = re.compile(rb"[^\n.!?]{1,%d}[.!?]*|[.!?]{1,%d}" % (MOST, MOST))
CELL = np.dtype([("count", "<i4"), ("digest", "<u8"), ("check", "<u4")])
CHECK, AGAIN = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)


def paragraphs(text: bytes) -> list:
    """Paragraphs of a text, blank ones left out."""
    return [p for p in map(bytes.strip, PIECE.findall(text)) if p]


class Items:
    """Paragraph digests of a list of texts (as bytes): ``owner`` (its place in the list) and ``key``."""

    def __init__(self, texts: list):
        digest = xxhash.xxh3_64_intdigest
        found = [[digest(p) for p in paragraphs(t)] for t in texts]
        self.sizes = np.array([len(f) for f in found], np.int64)
        owner = np.repeat(np.arange(len(texts)), self.sizes)
        key = np.array([k for f in found for k in f], U64)
        order = np.lexsort((key, owner))
        owner, key = owner[order], key[order]
        if len(key):                                        # the k-th occurrence in a text is an item of its own
            new = np.ones(len(key), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
            place = np.arange(len(key))
            k = place - np.maximum.accumulate(np.where(new, place, 0))
            key = np.where(k > 0, mix64(key + k.astype(U64) * AGAIN), key)
        self.owner, self.key = owner, key
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def of(self, owners: np.ndarray) -> tuple:
        """(place in ``owners``, key) of the items of some texts."""
        n = self.sizes[owners]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(np.arange(len(owners)), n), self.key[np.repeat(self.starts[owners], n) + inner]


class Sketches:
    """Cells of ``n`` sketches with three tables of ``size`` cells each."""

    def __init__(self, n: int, size: int):
        self.n, self.size, self.width = n, size, TABLES * size
        self.count = np.zeros(n * self.width, np.int64)
        self.digest = np.zeros(n * self.width, U64)
        self.check = np.zeros(n * self.width, U64)

    def places(self, owner: np.ndarray, key: np.ndarray):
        for t in range(TABLES):
            at = mix64(key + U64(t * 1_000_003 + self.size)) % U64(self.size)
            yield owner * self.width + t * self.size + at.astype(np.int64)

    def add(self, owner: np.ndarray, key: np.ndarray, sign: np.ndarray | int = 1) -> list:
        """Add items (sign -1: take out); returns the cells met."""
        signed = np.broadcast_to(np.asarray(sign, np.int64), key.shape)
        factor = signed.astype(U64)                         # -1 is 2^64 - 1
        digest, check, met = key * factor, mix64(key ^ CHECK) * factor, []
        for at in self.places(owner, key):
            np.add.at(self.count, at, signed)
            np.add.at(self.digest, at, digest)
            np.add.at(self.check, at, check)
            met.append(at)
        return met

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(0, self.size)
        out.n, out.count = self.n, self.count - other.count
        out.digest, out.check = self.digest - other.digest, self.check - other.check
        return out

    def take(self, owners: np.ndarray) -> Sketches:
        cells = (owners[:, None] * self.width + np.arange(self.width)).ravel()
        out = Sketches(0, self.size)
        out.n, out.count, out.digest, out.check = len(owners), self.count[cells], self.digest[cells], self.check[cells]
        return out

    def peel(self) -> tuple:
        """Empty the cells as far as they go: (owner, key, sign) of the items, and which sketches came out whole."""
        owners, keys, signs = [], [], []
        cells = np.arange(len(self.count))
        while len(cells):
            cells = cells[np.abs(self.count[cells]) == 1]
            sign = self.count[cells]
            key = self.digest[cells] * sign.astype(U64)
            pure = self.check[cells] * sign.astype(U64) == mix64(key ^ CHECK)
            owner, key, sign = cells[pure] // self.width, key[pure], sign[pure]
            if not len(key):
                break
            order = np.lexsort((key, owner))                # an item may be alone in several cells
            owner, key, sign = owner[order], key[order], sign[order]
            new = np.ones(len(key), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
            owner, key, sign = owner[new], key[new], sign[new]
            owners.append(owner)
            keys.append(key)
            signs.append(sign)
            cells = np.unique(np.concatenate(self.add(owner, key, -sign)))
        left = (self.count != 0) | (self.digest != 0) | (self.check != 0)
        whole = ~left.reshape(self.n, self.width).any(axis=1) if self.n else np.zeros(0, bool)
        join = [np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((owners, np.int64), (keys, U64), (signs, np.int64))]
        return *join, whole

    def texts(self) -> list:
        """Every sketch as base64 of its cells (number, digest sum, lower half of the check sum)."""
        cells = np.empty(len(self.count), CELL)
        cells["count"], cells["digest"], cells["check"] = self.count, self.digest, self.check & U64(0xFFFFFFFF)
        data, step = cells.tobytes(), self.width * CELL.itemsize
        return [base64.b64encode(data[i * step:(i + 1) * step]).decode() for i in range(self.n)]


def sketch(items: Items, owners: np.ndarray, size: int) -> Sketches:
    out = Sketches(len(owners), size)
    out.add(*items.of(owners))
    return out


class Difference:
    """What the texts ``a[i]`` and ``b[i]`` have not in common, recovered from their sketches."""

    def __init__(self, a: Items, a_at: np.ndarray, b: Items, b_at: np.ndarray, base: Sketches):
        found = ([], [], [])
        self.cells = np.full(len(a_at), base.width)
        pending, difference, size = np.arange(len(a_at)), base, base.size
        while True:
            owner, key, sign, whole = difference.peel()
            done = whole[owner]
            for out, x in zip(found, (pending[owner[done]], key[done], sign[done]), strict=True):
                out.append(x)
            pending = pending[~whole]
            if not len(pending):
                break
            size *= 4                                       # too small: both versions anew, larger
            self.cells[pending] = TABLES * size
            difference = sketch(a, a_at[pending], size).minus(sketch(b, b_at[pending], size))
        self.owner, self.key, self.sign = map(np.concatenate, found)
        n, total = len(a_at), a.sizes[a_at] + b.sizes[b_at]
        self.n = np.bincount(self.owner, minlength=n)
        self.likeness = np.where(total > 0, (total - self.n) / np.maximum(total + self.n, 1), 1.0)

    def only(self, sign: int) -> list:
        """Per pair the recovered digests of one side (1: only in a, -1: only in b), as signed integers, ascending."""
        mine = self.sign == sign
        owner, key = self.owner[mine], self.key[mine].view(np.int64)
        order = np.lexsort((key, owner))
        return np.split(key[order], np.searchsorted(owner[order], np.arange(1, len(self.n))))


def _string(values) -> pa.Array:
    return pa.array(values, pa.string())


def fingerprints(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_paragraphs, fingerprint."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                items = Items([t.encode() for t in column_list(piece, "text")])
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(items.sizes), _string(sketch(items, np.arange(len(items.sizes)), BASE).texts())],
                    ["doc_id", "n_paragraphs", "fingerprint"])
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_paragraphs long, fingerprint string")


def compare_versions(df: DataFrame, a: str, b: str, keep_columns: tuple = ()) -> DataFrame:
    """The ``keep_columns``, then fingerprint_a, fingerprint_b, only_a, only_b (recovered digests),
    likeness and cells (of the sketch that could be peeled)."""
    kept = list(keep_columns)
    names = ["fingerprint_a", "fingerprint_b", "only_a", "only_b", "likeness", "cells"]

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "__a"):
                texts = [[t.encode() for t in column_list(piece, c)] for c in ("__a", "__b")]
                x, y = map(Items, texts)
                at = np.arange(piece.num_rows)
                one, two = sketch(x, at, BASE), sketch(y, at, BASE)
                found = Difference(x, at, y, at, one.minus(two))
                digests = [pa.array(found.only(s), pa.list_(pa.int64())) for s in (1, -1)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(i) for i in range(len(kept))] + [_string(one.texts()), _string(two.texts()), *digests,
                                                                   pa.array(found.likeness), pa.array(found.cells)],
                    [f"__{i}" for i in range(len(kept))] + names)
    fields = [f"__{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)] + [
        "fingerprint_a string, fingerprint_b string, only_a array<long>, only_b array<long>, likeness double, cells long"]
    rows = df.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(kept)],
                     *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((a, "__a"), (b, "__b"))])
    return rows.mapInArrow(run, ", ".join(fields)).toDF(*kept, *names)


# a document's place: rows without id last, greater ids first, then the hash of the text
ORDER = ["no_id", "down", "tie"]


def with_neighbours(rows: DataFrame) -> DataFrame:
    """(doc_id, text, halo), dealt so that every partition holds a run of the documents in order, sorted,
    and behind it (``halo``) the first document of the next run; behind the last run the first of all."""
    spark = rows.sparkSession
    rows = rows.select("doc_id", "text", F.col("doc_id").isNull().alias("no_id"),
                       F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("down"), F.xxhash64("text").alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select(*ORDER).repartitionByRange(parts, *ORDER)
    firsts = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*ORDER)).alias("k")).collect()
    bounds = sorted(tuple(r["k"]) for r in firsts)          # one key a partition
    n = max(1, len(bounds))

    @F.pandas_udf("array<int>")
    def runs(no_id, down, tie):
        import pandas as pd
        out = []
        for key in zip(no_id.tolist(), down.tolist(), tie.tolist(), strict=True):
            run = bisect_right(bounds, key) - 1
            out.append([run, (run - 1) % n + n] if bounds[run] == key else [run])
        return pd.Series(out)
    # a run's number plus n: the row is the halo of that run
    dealt = rows.withColumn("run", F.explode(runs(*ORDER))).withColumn("halo", F.col("run") >= n)
    return (dealt.repartitionById(n, F.col("run") % n).sortWithinPartitions("halo", *ORDER).select("doc_id", "text", "halo"))


def edited_versions(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the
    numbers of paragraphs and of recovered differing digests, per document."""
    def block(rows):
        texts = [t for _, t, _ in rows]
        mine = np.flatnonzero([not halo for _, _, halo in rows[:-1]])
        edited = [texts[i][:len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][:len(texts[i]) // 2] for i in mine]
        changed = [t.encode() for t in edited]
        items, versions = Items([t.encode() for t in texts]), Items(changed)
        every, at = np.arange(len(rows)), np.arange(len(mine))
        base, other = sketch(items, every, BASE), sketch(versions, at, BASE)
        own = base.take(mine)
        to_edited = Difference(items, mine, versions, at, own.minus(other))
        to_next = Difference(items, mine, items, mine + 1, own.minus(base.take(mine + 1)))
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][0] for i in mine], pa.int64()), pa.array([len(texts[i]) for i in mine], pa.int64()),
             _string([hashlib.sha256(t).hexdigest() for t in changed]), _string(own.texts()), _string(other.texts()),
             pa.array(to_edited.likeness), pa.array(to_next.likeness), pa.array(items.sizes[mine]),
             pa.array(to_edited.n.astype(np.int64)), pa.array(to_next.n.astype(np.int64))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
             "n_paragraphs", "n_changed", "n_apart"])

    def run(batches):
        held = []                                           # the last row waits for its neighbour
        for batch in batches:
            for piece in slices(batch, most=4 << 20):
                held += zip(*(column_list(piece, c) for c in ("doc_id", "text", "halo")), strict=True)
                if len(held) > 1:
                    yield block(held)
                    held = held[-1:]

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return with_neighbours(rows).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
             "near_next double, n_paragraphs long, n_changed long, n_apart long")
