"""Rows of a sorted stream of batches, group by group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def starts(rows: pa.Table, keys: Sequence[str]) -> list[int]:
    """Rows at which a new key begins, the first one included. Nulls are equal."""
    if not rows.num_rows:
        return []
    new = np.zeros(rows.num_rows - 1, bool)
    for key in keys:
        a, b = rows[key].slice(1), rows[key].slice(0, rows.num_rows - 1)
        differ = pc.fill_null(pc.not_equal(a, b), True).to_numpy()
        new |= differ & ~(pc.is_null(a).to_numpy() & pc.is_null(b).to_numpy())
    return [0, *(np.flatnonzero(new) + 1).tolist()]


def whole(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """The rows again, with no group cut in two, and where each group begins, and the number of rows."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        first = starts(rows, keys)
        if len(first) > 1:
            yield rows.slice(0, first[-1]), first
        held = rows.slice(first[-1]) if first else rows
    if held is not None and held.num_rows:
        yield held, [0, held.num_rows]
