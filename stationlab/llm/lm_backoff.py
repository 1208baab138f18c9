"""LM scoring: stupid-backoff scores from relational n-gram counts.

Texts are read as token ids of a public vocabulary (pieces of words), so n-gram keys are
exact integers.  Documents are encoded where they lie and dealt, as compressed ids, into
blocks of about ``BLOCK_BYTES`` of text:

1. every block gives its distinct n-grams (orders 1 to 3) with their counts in the block,
   one packed row for each hash partition of the count tables (about one partition per
   ``BUCKET_BYTES`` of text, so a partition's size does not grow with the corpus);
2. a partition's count table is the sum of these rows by key; n-grams of order 2 and 3
   that occur less than ``least_count`` times in the whole corpus are left out (1: none);
3. the table is joined to the blocks' n-grams of the partition in the same pass, and every
   packed row is answered by the counts of its keys outside the block, in the row's order,
   so that keys travel once;
4. with them each document's n-grams are scored and summed:
   S(c | a b) = n(abc) / n(ab) if abc is in the table, else 0.4 S(c | b);
   S(c | b) = n(bc) / n(b) if bc is in the table, else 0.4 n(c) / N.

Every n-gram is pre-aggregated per block, so a frequent n-gram has one entry per
block, not one per occurrence, and all tables grow with the corpus.  Packed rows hold at
least one n-gram each, so there are never more of them than of blocks' n-grams.

Defined results: null and empty texts have 0 tokens, score 0 and a null mean; repeated
rows count as often as they stand; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import U64, column_bytes, mix64, slices, tokenizer_path
from stationlab.llm.word_tokens import WordEncoder

VOCABULARY = "word_bpe_49k.json"
ORDER = 3
BACKOFF = 0.4
LEAST_COUNT = 2
BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 4 << 20
# An n-gram's key: its ids in 16-bit fields, the order above them.
SHIFT, ORDER_AT = 16, 48
ALL_TOKENS = 0            # the key whose count is the number of tokens


def keys_of(ids: np.ndarray, place: np.ndarray, order: int) -> np.ndarray:
    """The keys of the n-grams that end at each token; -1 where a document is too short.

    ``place``: the token's place in its document.
    """
    acc = ids | order << ORDER_AT
    for back in range(1, order):
        acc[back:] |= ids[:len(ids) - back] << (SHIFT * back)
    acc[place < order - 1] = -1
    return acc


def _ids(packed: list) -> tuple:
    """(ids of all documents in a row, the tokens' places in their documents, sizes of the documents)."""
    import zstandard
    open_ = zstandard.ZstdDecompressor().decompress
    data = [open_(p) if p else b"" for p in packed]
    sizes = np.array([len(d) // 2 for d in data], np.int64)
    ids = np.frombuffer(b"".join(data), np.uint16).astype(np.int64)
    place = np.arange(len(ids), dtype=np.int32) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.int32)
    return ids, place, sizes


def pack(values: np.ndarray) -> bytes:
    """64-bit integers, the bytes of equal rank side by side, compressed."""
    import zstandard
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


class Grams:
    """A block's distinct n-grams: ``keys`` and ``counts``, ascending by key, and per order where its tokens' keys stand."""

    def __init__(self, ids: np.ndarray, place: np.ndarray, buckets: int):
        keys, counts, self.place, self.rank = [np.array([ALL_TOKENS])], [np.array([len(ids)])], place, []
        begin, order_of = 1, np.arange(len(ids), dtype=np.int32)
        short = ids.astype(np.uint16)
        for order in range(1, ORDER + 1):
            # sorted by the ids from the last back: each order's sort goes on from the one before (16-bit radix passes)
            back = np.zeros_like(short)
            back[order - 1:] = short[:len(short) - order + 1]
            order_of = order_of[np.argsort(back[order_of], kind="stable")]
            at = order_of[place[order_of] >= order - 1]
            k = keys_of(ids, place, order)[at]
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            first = np.flatnonzero(new)
            rank = np.empty(len(ids), np.int32)
            rank[at] = np.cumsum(new, dtype=np.int32) + np.int32(begin - 1)
            keys.append(k[first])
            counts.append(np.diff(np.append(first, len(k))))
            self.rank.append(rank[place >= order - 1])
            begin += len(first)
        self.keys, self.counts = np.concatenate(keys), np.concatenate(counts)
        bucket = (mix64(self.keys.astype(U64)) % U64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)
        #: the n-grams by hash partition, then key; the partitions held and where each one begins
        self.dealt = np.argsort(bucket, kind="stable")
        bucket = bucket[self.dealt]
        self.starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        self.buckets = bucket[self.starts].astype(np.int32)

    def at_tokens(self, values: np.ndarray, order: int) -> np.ndarray:
        """Of ``values`` by key, the one of the n-gram that ends at each token; 0 where there is none."""
        out = np.zeros(len(self.place))
        out[self.place >= order - 1] = values[self.rank[order - 1]]
        return out


def _blocks(docs: DataFrame, path: str, text: str, id_column: str, n: int) -> DataFrame:
    """(block, doc_id, packed ids) in ``n`` blocks; the row's place spreads equal rows over the blocks."""
    rows = docs.select(F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.col(text)), F.lit(n)).cast("int").alias("block"),
                       F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def encode(batches):
        import zstandard
        enc, press = WordEncoder(path), zstandard.ZstdCompressor(level=1).compress
        if enc.size > 1 << SHIFT:
            raise ValueError("the vocabulary does not fit the key's fields")
        for batch in batches:
            for part in slices(batch):
                packed = [press(enc.encode(t)) if t else None for t in column_bytes(part, "text")]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], ["block", "doc_id", "packed"])

    return rows.mapInArrow(encode, "block int, doc_id long, packed binary")


def backoff_scores(docs: DataFrame, vocabulary: str | None = None, text: str = "text", id_column: str = "doc_id",
                   block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, least_count: int = LEAST_COUNT) -> DataFrame:
    """Per row: doc_id, n_tokens, n_order3, n_order2, n_order1 (tokens scored at each order), log_score (natural
    log, summed) and mean_log_score.  N-grams of order 2 and 3 with fewer than ``least_count`` occurrences are not used."""
    path = vocabulary or tokenizer_path(VOCABULARY)
    total = docs.agg(F.sum(F.octet_length(text))).collect()[0][0] or 0
    blocks = _blocks(docs, path, text, id_column, max(1, -(-total // block_bytes)))
    buckets = max(1, -(-total // bucket_bytes))

    def count(table: pa.Table) -> pa.Table:
        ids, place, _ = _ids(table.column("packed").to_pylist())
        g = Grams(ids, place, buckets)
        parts_of = [(pack(np.diff(g.keys[at], prepend=0)), pack(g.counts[at])) for at in np.split(g.dealt, g.starts[1:])]
        return pa.table({
            "bucket": pa.array(g.buckets), "block": pa.array(np.full(len(g.buckets), table.column("block")[0].as_py(), np.int32)),
            "keys": pa.array([k for k, _ in parts_of], pa.binary()), "counts": pa.array([c for _, c in parts_of], pa.binary())})

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grams = blocks.groupBy("block").applyInArrow(count, "bucket int, block int, keys binary, counts binary").repartition(parts, "bucket")

    def look_up(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpack(k)) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([unpack(c) for c in table.column("counts").to_pylist()])
        ends = np.cumsum([len(k) for k in keys])
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        elsewhere = np.bincount(at, counts).astype(np.int64)[at] - counts
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "elsewhere": pa.array([pack(e) for e in np.split(elsewhere, ends[:-1])], pa.binary())})

    answers = grams.groupBy("bucket").applyInArrow(look_up, "block int, bucket int, elsewhere binary")

    def score(docs_of: pa.Table, answers_of: pa.Table) -> pa.Table:
        if not docs_of.num_rows:
            return _scores([], [], [], [], [], [])
        ids, place, sizes = _ids(docs_of.column("packed").to_pylist())
        g = Grams(ids, place, buckets)
        answers_of = answers_of.sort_by("bucket")
        if not np.array_equal(answers_of.column("bucket").to_numpy(), g.buckets):
            raise ValueError("a block's counts are not those of its documents")
        totals = g.counts.copy()
        totals[g.dealt] += np.concatenate([unpack(e) for e in answers_of.column("elsewhere").to_pylist()])
        n_all = int(totals[0])
        pruned = np.where((g.keys >> ORDER_AT < 2) | (totals >= least_count), totals, 0)

        # what a token costs for the orders above its own that fit in its document
        fits = np.minimum(place, ORDER - 1)
        history = g.at_tokens(pruned, 1)
        value = np.log(history / max(n_all, 1)) + fits * np.log(BACKOFF)
        level = np.ones(len(ids), np.int8)
        for o in range(2, ORDER + 1):
            here = g.at_tokens(pruned, o)
            seen = np.flatnonzero(here > 0)
            value[seen] = np.log(here[seen] / history[seen - 1]) + (fits[seen] - (o - 1)) * np.log(BACKOFF)
            level[seen] = o
            history = here
        doc = np.repeat(np.arange(len(sizes)), sizes)
        total = np.bincount(doc, value, len(sizes))
        per_level = [np.bincount(doc, level == o, len(sizes)).astype(np.int64) for o in (3, 2, 1)]
        return _scores(docs_of.column("doc_id"), sizes, *per_level, total)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "doc_id long, n_tokens long, n_order3 long, n_order2 long, n_order1 long, log_score double, mean_log_score double")


def _scores(doc_ids, sizes, three, two, one, total) -> pa.Table:
    mean = [round(float(t) / int(n), 9) if n else None for t, n in zip(total, sizes, strict=True)]
    return pa.table({
        "doc_id": doc_ids if isinstance(doc_ids, pa.ChunkedArray) else pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()),
        "n_order3": pa.array(three, pa.int64()), "n_order2": pa.array(two, pa.int64()), "n_order1": pa.array(one, pa.int64()),
        "log_score": pa.array([round(float(t), 6) for t in total], pa.float64()), "mean_log_score": pa.array(mean, pa.float64())})
