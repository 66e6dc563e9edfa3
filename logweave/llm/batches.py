"""Runs of equal keys in sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of sorted batches with equal ``keys`` (no nulls), together. Holds one run at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = np.append(0, np.flatnonzero(new)).tolist()
        for s, e in zip(starts, [*starts[1:], b.num_rows]):
            key = [c[s] for c in cols]
            if held and key != last:
                yield _joined(held)
                held = []
            last = key
            held.append(b.slice(s, e - s))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
