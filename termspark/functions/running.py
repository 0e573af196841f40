"""Sums of the rows before, inside groups of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _differ(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays differ; NULL equals NULL only."""
    unequal = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(unequal, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def sums_before(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Structs of group columns and of whole numbers, groups together: the sums of the group's rows before each.

    Only the last row's group and its sums go from batch to batch.
    """
    last, carried = None, {}
    for groups, values in batches:
        if not len(groups):
            yield pa.StructArray.from_arrays([values.field(i) for i in range(values.type.num_fields)], fields=list(values.type))
            continue
        columns = [groups.field(i) for i in range(groups.type.num_fields)]
        begins = np.zeros(len(groups), bool)
        begins[0] = last != [c[0].as_py() for c in columns]
        for column in columns:
            begins[1:] |= _differ(column[1:], column[:-1])
        run, at = np.cumsum(begins), np.flatnonzero(begins)
        made = []
        for n, field in enumerate(values.type):
            value = values.field(n).to_numpy(zero_copy_only=False)
            before = np.cumsum(value) - value
            # run 0 goes on from the batch before
            before = before - np.concatenate([[-carried.get(n, 0)], before[at]])[run]
            carried[n] = before[-1] + value[-1]
            made.append(pa.array(before, field.type))
        last = [c[-1].as_py() for c in columns]
        yield pa.StructArray.from_arrays(made, fields=list(values.type))
