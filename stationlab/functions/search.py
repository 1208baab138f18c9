"""Binary search over sorted starts that travel with the tasks, beside the plan."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# tasks get this module's functions by value: executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def floor_places(starts: np.ndarray, values: np.ndarray) -> tuple:
    """Per value the greatest of the sorted ``starts`` that is at most it, and which values have none."""
    at = np.searchsorted(starts, values, side="right") - 1
    return starts[np.maximum(at, 0)] if len(starts) else np.zeros(len(values), np.int64), at < 0


def floor_entry(starts: np.ndarray, value: Column) -> Column:
    """The greatest of the sorted ``starts`` (64-bit) that is at most ``value``; NULL if none.

    No join and no shuffle, and no literal in the plan: Spark broadcasts starts of more than 1 MB."""
    @F.arrow_udf("long")
    def floor_start(v: pa.Array) -> pa.Array:
        found, none = floor_places(starts, pc.fill_null(v, 0).to_numpy(zero_copy_only=False))
        return pa.array(found, pa.int64(), mask=none | pc.is_null(v).to_numpy(zero_copy_only=False))
    return floor_start(value)


def floor_entry_of(starts: dict, key: Column, value: Column) -> Column:
    """``floor_entry`` among the starts of the row's key (text -> sorted starts)."""
    @F.arrow_udf("long")
    def floor_start(k: pa.Array, v: pa.Array) -> pa.Array:
        coded = pc.dictionary_encode(k)
        code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
        values = pc.fill_null(v, 0).to_numpy(zero_copy_only=False)
        found, none = np.zeros(len(values), np.int64), np.ones(len(values), bool)
        for i, name in enumerate(coded.dictionary.to_pylist()):
            mine = np.flatnonzero(code == i)
            if name in starts:
                found[mine], none[mine] = floor_places(starts[name], values[mine])
        return pa.array(found, pa.int64(), mask=none | pc.is_null(v).to_numpy(zero_copy_only=False))
    return floor_start(key, value)
