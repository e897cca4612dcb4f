"""Working through sorted partitions group by group, many small groups at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _changes(table: pa.Table, names: list[str]) -> np.ndarray:
    """For each row but the first: does any of the columns differ from the row before?"""
    n = table.num_rows - 1
    differs = np.zeros(n, dtype=bool)
    for name in names:
        before, here = table.column(name).slice(0, n), table.column(name).slice(1, n)
        same = pc.fill_null(pc.equal(before, here), False)
        both_null = pc.and_(pc.is_null(before), pc.is_null(here))
        differs |= ~pc.or_(same, both_null).to_numpy(zero_copy_only=False)
    return differs


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold only whole groups, with the index where each group starts.

    ``batches`` are the rows of a partition sorted by ``names``. What is held back is
    the group that the next batch may continue.
    """
    held: list[pa.Table] = []
    starts: list[np.ndarray] = []  # of the held tables, counted from the first held row
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        if held:
            joined = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), table])
            new = np.flatnonzero(_changes(joined, names))
        else:
            new = np.r_[0, np.flatnonzero(_changes(table, names)) + 1]
        if held and len(new):
            cut = int(new[-1])
            whole = pa.concat_tables([*held, table.slice(0, cut)]).combine_chunks()
            yield whole, np.concatenate([*starts, size + new[:-1]])
            held, starts, size = [], [], 0
            table, new = table.slice(cut), np.zeros(1, dtype=np.int64)
        held.append(table)
        starts.append(size + new)
        size += table.num_rows
    if held:
        yield pa.concat_tables(held).combine_chunks(), np.concatenate(starts)
