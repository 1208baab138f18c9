"""Benchmark decontamination: prefix-filtered set join of item windows with documents.

A window is 13 consecutive words of an item (a shorter item is one window).  It
occurs in a document only if all its shingles (5 words, fewer in shorter windows)
do, so one necessary shingle finds every occurrence: the window's rarest, by the
number of its occurrences over all documents.  The steps:

1. count, over all whole documents, the occurrences of every benchmark shingle;
2. order the shingles of each window by rarity and keep its prefix, one shingle,
   with its place in the window;
3. join the documents' shingles with the prefixes; the place fixes where the
   window would lie, which must be inside the document (length and positional
   bound); verify the words of the window one by one;
4. mark the words of every occurrence; collect the items.

Only benchmark data is broadcast, in blocks of at most ``BLOCK_WINDOWS`` windows
(about 100 MB); a larger benchmark is joined block by block, each adding
to the marks of the one before, so the result never depends on the block size.

Defined results: null and empty texts have no words, no hits and are clean; an
item without words has no window; items of equal words are all reported, once per
item_id (a null item_id is reported as an empty string); an empty benchmark
leaves every document clean; repeated rows are judged alike; other columns are
not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import U64, column_bytes, column_list, keep, shingle_hashes, slices

WINDOW_WORDS = 13
SHINGLE_WORDS = 5
BLOCK_WINDOWS = 500_000
# Contaminated: hit words are at least 1 / HIT_SHARE of the words.
HIT_SHARE = 20
# Words are runs of 0-9, a-z and non-ASCII after lower-casing A-Z: all else becomes a space.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(data: bytes | None) -> list:
    return data.translate(WORDS).split() if data else []


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: words (joined by a space) and the ids of the items that hold them."""
    def cut(batches):
        for batch in batches:
            ids, texts = [], []
            for i, data in zip(column_list(batch, "id"), column_bytes(batch, "text"), strict=True):
                w = words_of(data)
                for k in range(max(1, len(w) - WINDOW_WORDS + 1) if w else 0):
                    ids.append(i)
                    texts.append(b" ".join(w[k:k + WINDOW_WORDS]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["id", "words"])

    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(cut, "id string, words string").groupBy("words").agg(F.sort_array(F.collect_set("id")).alias("items"))


class Block:
    """One block of windows in the form the tasks search with."""

    def __init__(self, rows: list):
        self.windows = [r["words"].encode().split() for r in rows]
        self.items = [list(r["items"]) for r in rows]
        self.words: dict = {}
        for w in self.windows:
            for x in w:
                self.words.setdefault(x, len(self.words) + 1)
        self.by_size: dict = {}         # shingle size -> windows of it
        for i, w in enumerate(self.windows):
            self.by_size.setdefault(min(SHINGLE_WORDS, len(w)), []).append(i)
        self.grams = {k: np.unique(np.concatenate([self.shingles(self.windows[i], k) for i in own])) for k, own in self.by_size.items()}
        self.prefix: dict = {}

    def ids(self, words: list) -> np.ndarray:
        """Number of each word among the block's words, 0 for any other."""
        get = self.words.get
        return np.array([get(w, 0) for w in words], U64)

    def shingles(self, words: list, k: int) -> np.ndarray:
        return shingle_hashes(self.ids(words), k)

    def occurrences(self, ids: np.ndarray, k: int, wanted: np.ndarray):
        """(places in a document, places in ``wanted``) of the shingles found there."""
        n = len(ids) - k + 1
        if n < 1:
            return None
        known = ids > 0
        runs = np.convolve(known, np.ones(k, np.int64), "valid") == k if k > 1 else known
        places = np.flatnonzero(runs)
        if not len(places):
            return None
        h = shingle_hashes(ids, k)[places]
        at = np.searchsorted(wanted, h)
        at[at == len(wanted)] = 0
        hit = wanted[at] == h
        return (places[hit], at[hit]) if hit.any() else None

    def choose(self, counts: dict) -> None:
        """Keep each window's rarest shingle (ties: least hash) and its place."""
        for k, own in self.by_size.items():
            chosen: dict = {}
            for i in own:
                h = self.shingles(self.windows[i], k).tolist()
                best = min(range(len(h)), key=lambda j: (counts.get((k, h[j]), 0), h[j], j))
                if counts.get((k, h[best]), 0):          # a shingle that no document has: no occurrence
                    chosen.setdefault(h[best], []).append((i, best))
            keys = np.array(sorted(chosen), U64)
            self.prefix[k] = (keys, [chosen[int(x)] for x in keys])
        self.numbers = [self.ids(w) for w in self.windows]

    def find(self, words: list) -> tuple:
        """(hit marks, item ids) of one document."""
        hit, items = np.zeros(len(words), bool), set()
        ids = self.ids(words)
        if not ids.any():
            return hit, items
        for k, (keys, windows) in self.prefix.items():
            found = self.occurrences(ids, k, keys) if len(keys) else None
            if found is None:
                continue
            for place, at in zip(*(x.tolist() for x in found), strict=True):
                for i, offset in windows[at]:
                    start, own = place - offset, self.numbers[i]
                    if start < 0 or start + len(own) > len(ids):       # does not fit here
                        continue
                    if np.array_equal(ids[start:start + len(own)], own):
                        hit[start:start + len(own)] = True
                        items.update(self.items[i])
        return hit, items


def _counted(texts: DataFrame, block) -> dict:
    """Occurrences over all documents of the block's shingles."""
    def count(batches):
        b = block.value
        sums = {k: np.zeros(len(g), np.int64) for k, g in b.grams.items()}
        for batch in batches:
            for data in column_bytes(batch, "text"):
                ids = b.ids(words_of(data))
                if ids.any():
                    for k, g in b.grams.items():
                        found = b.occurrences(ids, k, g)
                        if found is not None:
                            np.add.at(sums[k], found[1], 1)
        for k, s in sums.items():
            some = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), k)), pa.array(b.grams[k][some].astype(np.int64)), pa.array(s[some])], ["k", "gram", "n"])

    rows = texts.mapInArrow(count, "k long, gram long, n long").groupBy("k", "gram").agg(F.sum("n").alias("n")).collect()
    return {(r["k"], r["gram"] & (1 << 64) - 1): r["n"] for r in rows}


def _blocks(windows: DataFrame, most: int):
    """The windows in blocks of about ``most``, each read by itself."""
    n = windows.count()
    parts = -(-n // most)
    for p in range(parts):
        yield windows.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == p).collect()


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_spans array<array<long>>, items array<string>"


def find_windows(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "doc_id",
                 block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per row: ``id_column``, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans ([first word,
    word after the last]) and the items found."""
    state = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"),
                        F.lit(None).cast("array<array<long>>").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    broadcasts = _prepared(state.select("text"), benchmark, block_windows)
    for shared in broadcasts[:-1]:
        state = keep(_marked(state, shared))
    last = broadcasts[-1:]          # marked in the same pass that makes the results
    kind = docs.schema[id_column].dataType.simpleString()

    def results(batches):
        for batch in batches:
            for part in slices(batch):
                texts, spans, items = column_bytes(part, "text"), column_list(part, "spans"), column_list(part, "items")
                words = [words_of(t) for t in texts]
                for shared in last:
                    _mark(shared.value, words, spans, items)
                rows = [_result(len(w), x, y) for w, x, y in zip(words, spans, items, strict=True)]
                cols = list(zip(*rows, strict=True))
                types = [pa.int64()] * 3 + [pa.string(), pa.bool_(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
                    [id_column, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans", "items"])

    return state.mapInArrow(results, f"{id_column} {kind}, {RESULT}")


def _prepared(texts: DataFrame, benchmark: DataFrame, most: int) -> list:
    """Broadcast blocks with their prefixes chosen."""
    sc = texts.sparkSession.sparkContext
    out = []
    for rows in _blocks(keep(item_windows(benchmark)), most):
        if rows:
            block = Block(rows)
            first = sc.broadcast(block)
            counts = _counted(texts, first)
            first.unpersist()
            block.choose(counts)
            out.append(sc.broadcast(block))
    return out


def _spans(hit: np.ndarray) -> list:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return edge.reshape(-1, 2).tolist()


def _mark(block: Block, words: list, spans: list, items: list) -> None:
    """Add one block's occurrences to the rows' spans and items."""
    for i, w in enumerate(words):
        hit, found = block.find(w)
        if found:
            for x, y in spans[i] or ():
                hit[x:y] = True
            spans[i], items[i] = _spans(hit), sorted(found.union(items[i] or ()))


def _marked(state: DataFrame, shared) -> DataFrame:
    """``state`` with one block's occurrences added to its spans and items."""
    def mark(batches):
        b = shared.value
        for batch in batches:
            for part in slices(batch):
                spans, items = column_list(part, "spans"), column_list(part, "items")
                _mark(b, [words_of(t) for t in column_bytes(part, "text")], spans, items)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))],
                    ["id", "text", "spans", "items"])

    return state.mapInArrow(mark, state.schema)


def _result(n: int, spans: list | None, items: list | None) -> tuple:
    hit, items = sum(b - a for a, b in spans or ()), items or []
    return (n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), contaminated(hit, n), spans or [], items)


def contaminated(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and HIT_SHARE * n_hit >= n_words


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept; no shuffle of documents.

    With several blocks the marks of a row must meet, so its text's result is looked up by
    the text's digest.
    """
    texts = docs.select(F.col(text).cast("string").alias("text"))
    broadcasts = _prepared(texts, benchmark, block_windows)
    if not broadcasts:
        return docs

    def verdict(batches):
        blocks = [s.value for s in broadcasts]
        for batch in batches:
            for part in slices(batch, text):
                clean = []
                for data in column_bytes(part, text):
                    words = words_of(data)
                    hit = np.zeros(len(words), bool)
                    for b in blocks:
                        hit |= b.find(words)[0]
                    clean.append(not contaminated(int(hit.sum()), len(words)))
                yield part.filter(pa.array(clean, pa.bool_()))

    if len(broadcasts) == 1:
        return docs.mapInArrow(verdict, docs.schema)
    digest = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    bad = (find_windows(docs.withColumn(text, F.col(text).cast("string")).select(digest.alias("digest"), F.col(text).alias("text")),
                        benchmark, id_column="digest", block_windows=block_windows)
           .filter("contaminated").select("digest").distinct())
    return docs.join(bad, digest == bad["digest"], "left_anti").select(*docs.columns)
