"""Arrays of a fixed length summed over all tasks: counters of hash buckets, and bitmaps.

Their length is a parameter, so they may go to the driver and to every task whatever the input's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SLICES = 64


def summed(rows: DataFrame, length: int, count: Callable[[pa.RecordBatch, np.ndarray], None], kind: type = np.int64) -> np.ndarray:
    """Sum over the tasks of the arrays that ``count`` fills, batch by batch.  ``kind`` has eight bytes."""
    width = -(-length // _SLICES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(width * _SLICES, kind)
        for batch in batches:
            count(batch, held)
        for i in range(_SLICES):
            part = held[i * width : (i + 1) * width]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pa.compress(part.tobytes(), "zstd", asbytes=True)], pa.binary())], ["slice", "block"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(width, kind)
        for block in table.column("block"):
            total += np.frombuffer(pa.decompress(block.as_py(), width * 8, "zstd", asbytes=True), kind)
        return pa.table({"slice": table.column("slice")[:1], "block": pa.array([pa.compress(total.tobytes(), "zstd", asbytes=True)], pa.binary())})

    out = np.zeros(width * _SLICES, kind)
    parts = rows.mapInArrow(work, "slice int, block binary").groupBy("slice").applyInArrow(merge, "slice int, block binary")
    for row in parts.collect():
        out[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(pa.decompress(bytes(row["block"]), width * 8, "zstd", asbytes=True), kind)
    return out[:length]
