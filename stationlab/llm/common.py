"""Small helpers shared by the operators of this subpackage.

Rows travel as Arrow batches (``mapInArrow``); every helper takes whole texts.
Words are found in the UTF-8 bytes: ``bytes.split`` cuts at exactly the code
points 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlab.session import checkpoint_dir

U64 = np.uint64
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))   # A-Z to a-z, the rest as is


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; set to a folder under the
    working directory only where it is unset (local runs)."""
    return checkpoint_dir(spark, os.path.abspath("spark-checkpoints")).rstrip("/")


def keep(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage: a reliable checkpoint in the shared folder.

    ``checkpoint`` alone would run the plan twice, so the (small) rows pass
    through the executors' storage, spilling to disk, while it is written.
    """
    shared_folder(df.sparkSession)
    held = df.persist()
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out


def keep_table(df: DataFrame) -> DataFrame:
    """As ``keep`` for large rows: a Parquet table in the shared folder, written once and read by column."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def column_bytes(batch: pa.RecordBatch, name: str) -> list:
    """A string column as bytes; null stays None."""
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def column_list(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batch: pa.RecordBatch, text: str = "text", most: int = 8 << 20):
    """Cut a batch into runs of rows with at most about ``most`` text bytes."""
    sizes = [len(x) if x else 0 for x in column_bytes(batch, text)]
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


LONG_WORD = 64          # bytes of the longest word that is remembered


class WordHashes:
    """64-bit hash of a word, remembered up to a bound and then started anew; long words are hashed each time."""

    def __init__(self, most: int = 400_000):
        self.most, self.known = most, {}

    def __call__(self, words: list) -> np.ndarray:
        import xxhash
        known, long = self.known, {}
        new = set(words).difference(known)
        if new:
            if len(known) + len(new) > self.most:
                known.clear()
                new = set(words)
            digest = xxhash.xxh3_64_intdigest
            for w in new:
                if len(w) <= LONG_WORD:
                    known[w] = digest(w)
                else:
                    long[w] = digest(w)
        find = known.__getitem__ if not long else (lambda w: known[w] if len(w) <= LONG_WORD else long[w])
        return np.fromiter(map(find, words), dtype=U64, count=len(words))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (every input bit reaches every output bit)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` word hashes; fewer words: the whole sequence as one."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    acc = np.full(n - k + 1, U64(k), dtype=U64)
    for j in range(k):
        acc = mix64(acc * U64(0x9E3779B97F4A7C15) + words[j:n - k + 1 + j])
    return acc


def word_count(text: str | Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, null: 0."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


# A join side is sent to all executors only below this many (narrow) rows, about 20 MB.
SMALL_ROWS = 250_000


def small(df: DataFrame) -> DataFrame:
    """A narrow side, computed once and counted: broadcast up to ``SMALL_ROWS``, joined by shuffle beyond."""
    held = keep(df)
    return F.broadcast(held) if held.count() <= SMALL_ROWS else held
