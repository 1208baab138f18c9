"""Substring dedup: content-defined chunks found in several documents.

A gear hash rolls over the words of a whole text: h = (h << 1) + gear(word).  A
cut lies after every word where bits 4 and 5 of h are zero; these bits depend
on the last 6 words alone, so an insertion moves only the cuts near it, and equal
passages are cut alike wherever they stand.  Every cut opens a chunk that runs to
the first cut at least ``MIN_WORDS`` on (variable length; a stretch without cuts is
cut every ``MAX_GAP`` words), so a repeated passage holds whole chunks that its
copies hold too.  Chunks are deduplicated by digest (104 bits and the length):

* a partially aggregated shuffle of digests keeps those of two or more documents,
* a join marks the chunks with such a digest (skewed digests are split by AQE),
* the marked chunks of a document are merged into spans of words;
* a span shorter than the report's least length is not dropped yet, for its chunks lie inside the passage:
  every document that holds such a chunk gives all windows of the least length around it, and those
  found in two or more documents join the spans.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; null, empty and short texts
(under ``MIN_WORDS`` words) hold no chunk; rows with the same doc_id are one
document; rows without doc_id cannot be named and are not searched by
``repeated_spans``; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import U64, WordHashes, column_bytes, column_list, fresh, keep_table, mix64, slices, small

MIN_WORDS = 12
MAX_GAP = 64
REPORT_WORDS = 20
GEAR_BITS, GEAR_MASK = 6, 0b110000
# Fixed odd multipliers of the two digests.
BASE_1, BASE_2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def cut_points(gear: np.ndarray, max_gap: int = MAX_GAP) -> np.ndarray:
    """Word positions where chunks may begin or end: 0, the gear's cuts, and the end."""
    n = len(gear)
    low = (gear & U64(63)).astype(np.uint8)
    h = low.copy()
    for j in range(1, min(GEAR_BITS, n)):
        h[j:] += low[:n - j] << np.uint8(j)
    cuts = np.concatenate(([0], np.flatnonzero((h & np.uint8(GEAR_MASK)) == 0) + 1, [n]))
    cuts = np.unique(cuts)
    gaps = np.diff(cuts)
    if (gaps > max_gap).any():
        wide = np.flatnonzero(gaps > max_gap)
        more = [np.arange(cuts[i] + max_gap, cuts[i + 1], max_gap) for i in wide]
        cuts = np.unique(np.concatenate([cuts, *more]))
    return cuts


_POWERS: dict = {}


def powers(base: int, n: int) -> tuple:
    """base ** 0..n and its inverse's powers, modulo 2 ** 64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 15)
        inverse = pow(base, -1, 1 << 64)
        made = []
        for b in (base, inverse):
            p = np.full(size, U64(b))
            p[0] = 1
            made.append(np.cumprod(p, dtype=U64))
        have = _POWERS[base] = tuple(made)
    return have


def digests(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial digest of words[start:end], the same wherever it stands."""
    up, down = powers(base, len(words))
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(words * up[:len(words)], dtype=U64)))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def chunks_of(words: np.ndarray, min_words: int = MIN_WORDS) -> tuple:
    """(starts, lengths, digest 1, digest 2) of the chunks of one text."""
    cuts = cut_points(words)
    at = np.searchsorted(cuts, cuts + min_words)
    whole = at < len(cuts)
    starts, ends = cuts[whole], cuts[at[whole]]
    return starts, ends - starts, digests(words, starts, ends, BASE_1), digests(words, starts, ends, BASE_2)


def laid(lists: list) -> tuple:
    """(words, first places of the texts, text of every place) of many texts in one array.

    One idle place after every text keeps its end apart from the next one's begin.
    """
    idle = np.zeros(1, U64)
    sizes = np.array([len(words) + 1 for words in lists])
    return np.concatenate([part for words in lists for part in (words, idle)]), np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)


def chunks_of_texts(spread: np.ndarray, begins: np.ndarray, text_of: np.ndarray, min_words: int = MIN_WORDS, max_gap: int = MAX_GAP,
                    bases: tuple = (BASE_1, BASE_2)) -> tuple:
    """(places, lengths, digests by base) of the chunks of many texts that are ``laid`` out; as ``chunks_of`` for each."""
    n = len(spread)
    place = np.arange(n) - begins[text_of]
    idle = np.zeros(n, bool)
    idle[np.concatenate((begins[1:], [n])) - 1] = True
    low = (spread & U64(63)).astype(np.uint8)
    h = low.copy()
    for j in range(1, min(GEAR_BITS, n)):
        h[j:] += np.where(place[j:] >= j, low[:n - j] << np.uint8(j), np.uint8(0))
    mark = idle.copy()
    mark[begins] = True
    mark[1:] |= ((h[:-1] & np.uint8(GEAR_MASK)) == 0) & ~idle[:-1]
    cuts = np.flatnonzero(mark)
    wide = np.flatnonzero(np.diff(cuts) > max_gap)          # from a text's end to the next begin it is one
    if len(wide):
        mark[np.concatenate([np.arange(cuts[i] + max_gap, cuts[i + 1], max_gap) for i in wide])] = True
        cuts = np.flatnonzero(mark)
    at = np.minimum(np.searchsorted(cuts, cuts + min_words), len(cuts) - 1)
    starts, ends = cuts, cuts[at]
    whole = (ends - starts >= min_words) & (text_of[starts] == text_of[ends])
    starts, ends = starts[whole], ends[whole]
    return (starts, ends - starts, *[digests(spread, starts, ends, base) for base in bases])


def placed_rows(d1: np.ndarray, d2: np.ndarray, ids: list, at: np.ndarray, begins: np.ndarray, text_of: np.ndarray) -> pa.RecordBatch:
    """digest, check, doc, start (in its text) of some places of texts that are ``laid`` out."""
    text = text_of[at]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in (d1.astype(np.int64), d2.astype(np.int64), np.array(ids, np.int64)[text], (at - begins[text]).astype(np.int32))],
        ["digest", "check", "doc", "start"])


def chunk_rows(docs: DataFrame, text: str = "text", id_column: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per chunk: digest, check (more digest bits and the length), doc, start."""
    source = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text).alias("text")).filter(F.col("doc").isNotNull())

    def cut(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                ids, words = [], []
                for doc, data in zip(column_list(part, "doc"), column_bytes(part, "text"), strict=True):
                    own = data.split() if data else []
                    if len(own) >= min_words:
                        ids.append(doc)
                        words.append(hashes(own))
                if ids:
                    spread, begins, text_of = laid(words)
                    at, sizes, d1, d2 = chunks_of_texts(spread, begins, text_of, min_words)
                    check = ((d2 >> U64(24)) << U64(16)) | sizes.astype(U64)
                    yield placed_rows(d1, check, ids, at, begins, text_of)

    return source.mapInArrow(cut, "digest long, check long, doc long, start int")


CHUNKS = "array<struct<a:int,digest:long,check:long,first:long,last:long>>"


def marked_chunks(docs: DataFrame, text: str, id_column: str, min_words: int) -> DataFrame:
    """One row per document with chunks of two or more documents: doc, chunks (place, digests, first and last doc)."""
    rows = chunk_rows(docs, text, id_column, min_words)
    shared = (rows.groupBy("digest", "check").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
              .filter(F.col("first") < F.col("last")))
    hits = rows.join(shared, ["digest", "check"])
    return hits.groupBy("doc").agg(F.collect_list(F.struct(F.col("start").alias("a"), "digest", "check", "first", "last")).alias("chunks"))


def split_spans(per_doc: DataFrame, report_words: int, later: bool) -> DataFrame:
    """doc, first (least of its chunks' first documents), long (spans of the least length or more), short (the chunks
    of the other spans).  ``later``: only chunks that an earlier document holds."""
    def run(batches):
        for batch in batches:
            out = []
            for doc, chunks in zip(column_list(batch, "doc"), column_list(batch, "chunks"), strict=True):
                own = [c for c in chunks if not later or c["first"] < doc]
                if not own:
                    continue
                spans = np.array([(c["a"], c["a"] + (c["check"] & 65535)) for c in own], np.int64)
                got = merged(spans)
                enough = got[:, 1] - got[:, 0] >= report_words
                inside = enough[np.searchsorted(got[:, 0], spans[:, 0], side="right") - 1]
                out.append((doc, min(c["first"] for c in own), got[enough].tolist(),
                            [c for c, fine in zip(own, inside.tolist(), strict=True) if not fine]))
            if out:
                chunk = pa.struct([("a", pa.int32()), ("digest", pa.int64()), ("check", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
                types = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(chunk)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 ["doc", "first", "long", "short"])

    return per_doc.mapInArrow(run, f"doc long, first long, long array<array<long>>, short {CHUNKS}")


def window_rows(docs: DataFrame, asked: DataFrame, text: str, id_column: str, min_words: int, report_words: int) -> DataFrame:
    """digest, check, doc, start of the windows of ``report_words`` words around the chunks that ``asked`` (id,
    chunks' digests) names."""
    source = (docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text).alias("text"))
              .join(asked.withColumnRenamed("id", "doc"), "doc"))

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                ids, words, names = [], [], []
                for doc, data, own in zip(column_list(part, "doc"), column_bytes(part, "text"), column_list(part, "names"), strict=True):
                    split = data.split() if data else []
                    if len(split) >= report_words:
                        ids.append(doc)
                        words.append(hashes(split))
                        names.append(np.array(own, np.int64).view(U64))
                if not ids:
                    continue
                spread, begins, text_of = laid(words)
                at, sizes, d1 = chunks_of_texts(spread, begins, text_of, min_words, bases=(BASE_1,))
                short = sizes < report_words
                at, sizes, d1 = at[short], sizes[short], d1[short]
                # a text's names count for its own chunks
                salt = mix64(np.arange(1, len(ids) + 1).astype(U64))
                named = np.isin(d1 ^ salt[text_of[at]], np.concatenate([own ^ k for own, k in zip(names, salt, strict=True)]))
                at, sizes = at[named], sizes[named]
                if not len(at):
                    continue
                first = begins[text_of[at]]
                last = first + np.array([len(w) for w in words])[text_of[at]] - report_words
                low, high = np.maximum(first, at + sizes - report_words), np.minimum(at, last)
                count = high - low + 1
                at = np.unique(np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum()))
                d1, d2 = (digests(spread, at, at + report_words, base) for base in (BASE_1, BASE_2))
                yield placed_rows(d1, d2, ids, at, begins, text_of)

    return source.mapInArrow(run, "digest long, check long, doc long, start int")


MOST_BYTES = 16 << 20        # of digests sent to all executors


def bounded(asked: DataFrame) -> DataFrame:
    """Asked documents with their digests: broadcast up to ``MOST_BYTES``, joined by id beyond."""
    size = asked.agg(F.sum(F.size("names") * 8 + 40).alias("b")).first()["b"] or 0
    return F.broadcast(asked) if size <= MOST_BYTES else asked


def whole_spans(docs: DataFrame, text: str, id_column: str, min_words: int, report_words: int, later: bool = False) -> DataFrame:
    """doc, first, long (spans), starts (of windows to add to the spans; null where there are none)."""
    per_doc = keep_table(marked_chunks(docs, text, id_column, min_words))
    found = keep_table(split_spans(per_doc, report_words, later))
    short = small(found.select(F.explode("short").alias("c")).select("c.digest", "c.check").distinct())
    holders = (per_doc.select(F.col("doc").alias("id"), F.explode("chunks").alias("c")).select("id", "c.digest", "c.check")
               .join(short, ["digest", "check"]))
    asked = bounded(keep_table(holders.groupBy("id").agg(F.collect_set("digest").alias("names"))))
    rows = window_rows(docs, asked, text, id_column, min_words, report_words)
    shared = (rows.groupBy("digest", "check").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
              .filter(F.col("first_doc") < F.col("last_doc")).drop("last_doc"))
    more = rows.join(shared, ["digest", "check"])
    if later:
        more = more.filter(F.col("doc") > F.col("first_doc"))
    more = more.groupBy("doc").agg(F.collect_list("start").alias("starts"))
    return found.select("doc", "first", "long").join(more, "doc", "left")


def with_windows(long: list, starts: list | None, report_words: int) -> np.ndarray:
    spans = [*long, *([a, a + report_words] for a in starts or [])]
    return merged(np.array(spans, np.int64)) if spans else np.zeros((0, 2), np.int64)


def repeated_spans(docs: DataFrame, text: str = "text", id_column: str = "doc_id", min_words: int = MIN_WORDS,
                   report_words: int = REPORT_WORDS) -> DataFrame:
    """Documents that share passages: doc_id, n_spans, n_repeated_words, spans ([first word, word after the
    last]; spans of at least ``report_words`` words), first_doc_id (least doc_id that holds one of the chunks).
    """
    spans = whole_spans(docs, text, id_column, min_words, report_words)

    def merge(batches):
        for batch in batches:
            out = []
            for doc, first, long, starts in zip(*(column_list(batch, c) for c in ("doc", "first", "long", "starts")), strict=True):
                got = with_windows(long, starts, report_words)
                if len(got):
                    out.append((doc, len(got), int((got[:, 1] - got[:, 0]).sum()), got.tolist(), first))
            if out:
                cols = list(zip(*out, strict=True))
                types = [pa.int64()] * 3 + [pa.list_(pa.list_(pa.int64())), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                                 ["doc_id", "n_spans", "n_repeated_words", "spans", "first_doc_id"])

    return spans.mapInArrow(merge, "doc_id long, n_spans long, n_repeated_words long, spans array<array<long>>, first_doc_id long")


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of [a, b) spans, in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate(([True], spans[1:, 0] > reach[:-1])))
    return np.stack((spans[new, 0], reach[np.concatenate((new[1:] - 1, [len(spans) - 1]))]), axis=1)


def without_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id", min_words: int = MIN_WORDS,
                    report_words: int = REPORT_WORDS) -> DataFrame:
    """``docs`` with the repeated spans cut out of every document but the one with the least doc_id of
    those that hold the passage; all columns kept, rows without doc_id as they are."""
    r_doc, r_long, r_starts = (fresh(docs, c) for c in ("r_doc", "r_long", "r_starts"))
    later = (whole_spans(docs, text, id_column, min_words, report_words, later=True)
             .select(F.col("doc").alias(r_doc), F.col("long").alias(r_long), F.col("starts").alias(r_starts)))
    joined = docs.join(later, docs[id_column].cast("long") == later[r_doc], "left").drop(r_doc)

    def cut(batches):
        for batch in batches:
            texts = column_bytes(batch, text)
            for i, (long, starts) in enumerate(zip(column_list(batch, r_long), column_list(batch, r_starts), strict=True)):
                if long or starts:
                    texts[i] = cut_words(texts[i], with_windows(long or [], starts, report_words))
            names = [c for c in batch.schema.names if c not in (r_long, r_starts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x if x is None else x.decode() for x in texts], pa.string()) if c == text
                 else batch.column(batch.schema.get_field_index(c)) for c in names], names)

    return joined.mapInArrow(cut, docs.schema)


def cut_words(data: bytes, spans: np.ndarray) -> bytes:
    """The text without the words of the spans and the white space inside them."""
    points = np.frombuffer(data, np.uint8)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    edge = np.diff(np.concatenate(([1], space.astype(np.int8), [1])))
    begins, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    out, at = [], 0
    for a, b in spans.tolist():
        out.append(data[at:begins[a]])
        at = int(ends[b - 1])
    out.append(data[at:])
    return b"".join(out)
