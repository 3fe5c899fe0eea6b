"""Count, sum, squared deviations, minimum and maximum of many columns at once.

A node has more than a hundred sensors and five aggregates of each; that many
aggregate columns are too much for generated code.  Here they are five matrices,
a row for each group and a column for each variable, and numpy reduces whole Arrow
batches.  Rows are reduced in the task that reads them, then the partial rows are
shuffled by their keys, once, and reduced again.  A partial row of one reading is that
reading, not five times as much.

Squared deviations merge by the deviations of the parts' means from the common
mean, so nothing is lost where the mean is large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The mergeable aggregates, in the order of a state's matrices.
KINDS = ("count", "sum", "tot_sq_dev", "min", "max")
#: Cells (rows x variables) that a task reduces at once, collects before it reduces them again, and hands on at once.
#: Reducing takes some twenty times as many bytes as a matrix of so many doubles has.
CELLS = 1 << 18
#: Rows of a group that are still put together one by one.
SHORT = 8


def group_numbers(keys: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's group by its ``keys``, and the first row of each group; groups are numbered as they first come."""
    rows = len(keys[0]) if keys else 0
    place = np.zeros(rows, np.int64)
    for key in keys:
        own = pc.dictionary_encode(key, null_encoding="encode")
        if len(own.dictionary) > 1:
            # Numbers stay below the square of the rows.
            code = place * len(own.dictionary) + own.indices.to_numpy(zero_copy_only=False)
            place = pc.dictionary_encode(pa.array(code)).indices.to_numpy().astype(np.int64)
    first = np.zeros(place.max(initial=-1) + 1, np.int64)
    first[place[::-1]] = np.arange(rows)[::-1]
    return place, first


def _over(op: np.ufunc, x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``op`` over the rows of each group; groups of ``size`` rows lie one after another.

    Short groups go row by row, all at once: ``reduceat`` costs as much for two rows as for some twenty.
    """
    starts = np.cumsum(size) - size
    made = x[starts]
    short = size <= SHORT
    for k in range(1, size[short].max(initial=1)):
        more = np.flatnonzero(short & (size > k))
        made[more] = op(made[more], x[starts[more] + k])
    if not short.all():
        own = size[~short]
        made[~short] = op.reduceat(x[np.repeat(~short, size)], np.cumsum(own) - own, axis=0)
    return made


@dataclass
class State:
    """Keys of some rows, and a matrix of each aggregate; all but the count are nan where it is 0."""

    keys: list[pa.Array]
    parts: list[np.ndarray]

    def __len__(self) -> int:
        return len(self.parts[0])

    @classmethod
    def of_values(cls, keys: list[pa.Array], values: np.ndarray) -> State:
        """Each row of ``values`` a group of its own; nan is missing."""
        there = ~np.isnan(values)
        return cls(keys, [there.astype(np.int64), values, np.where(there, 0.0, np.nan), values, values])

    @classmethod
    def joined(cls, states: list[State]) -> State:
        keys = [pa.concat_arrays(k) for k in zip(*[s.keys for s in states], strict=True)]
        return cls(keys, [np.concatenate(p) for p in zip(*[s.parts for s in states], strict=True)])

    def sliced(self, start: int, stop: int) -> State:
        return State([k.slice(start, stop - start) for k in self.keys], [p[start:stop] for p in self.parts])

    def reduced(self) -> State:
        """One row for each group, in the order in which groups first come."""
        place, first = group_numbers(self.keys)
        if len(first) == len(place):
            return self
        size = np.bincount(place)
        several = size > 1
        rows = np.argsort(place, kind="stable")[np.repeat(several, size)]
        size = size[several]
        # A matrix may stand for several aggregates.
        taken = {id(p): p[rows] for p in self.parts}
        count, total, dev, low, high = (taken[id(p)] for p in self.parts)
        missing = count == 0
        n = _over(np.add, count, size)
        s = _over(np.add, np.where(missing, 0, total), size)
        with np.errstate(all="ignore"):
            off = total / count - np.repeat(s / n, size, axis=0)
        off *= off
        off *= count
        off += dev
        off[missing] = 0
        m2 = _over(np.add, off, size)
        none = n == 0
        s[none], m2[none] = np.nan, np.nan
        # These leave out nan where there is another value.
        parts = [p[first] for p in self.parts]
        for own, made in zip(parts, [n, s, m2, _over(np.fmin, low, size), _over(np.fmax, high, size)], strict=True):
            own[several] = made
        return State([k.take(pa.array(first)) for k in self.keys], parts)


def _collected(states: Iterator[State], hand_on: Callable[[State], tuple[State | None, State | None]]) -> Iterator[State]:
    """States put together until they have CELLS, then reduced; ``hand_on`` says what of that goes and what stays."""
    waiting: list[State] = []
    for state in states:
        if not len(state):
            continue
        waiting.append(state)
        if sum(s.parts[0].size for s in waiting) >= CELLS:
            goes, stays = hand_on(State.joined(waiting).reduced())
            if goes is not None:
                yield goes
            waiting = [stays] if stays is not None else []
    if waiting:
        yield State.joined(waiting).reduced()


def _partial(state: State) -> tuple[State | None, State | None]:
    """Few groups are kept for more rows to come, many are handed on."""
    return (state, None) if state.parts[0].size > CELLS // 2 else (None, state)


def _all_but_last(state: State) -> tuple[State | None, State | None]:
    """In sorted input only the last group may have more rows."""
    return (state.sliced(0, len(state) - 1) if len(state) > 1 else None), state.sliced(len(state) - 1, len(state))


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most CELLS cells: a batch has as many rows, however wide they are."""
    rows = max(1, CELLS // width)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _matrix(batch: pa.RecordBatch, start: int, width: int) -> np.ndarray:
    return np.column_stack([batch.column(start + k).to_numpy(zero_copy_only=False) for k in range(width)])


def _lists(matrix: np.ndarray, there: np.ndarray) -> pa.Array:
    """The rows of ``matrix`` as lists, null where not ``there``."""
    offsets = pa.array(np.r_[0, np.cumsum(there * matrix.shape[1])], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix[there]).ravel()), mask=pa.array(~there))


def _shuffled(partial: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """Partial states by their keys, reduced to one row of 5 x variables columns for each group."""
    width, n = len(variables), len(keys)

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[State]:
        for batch in _pieces(batches, width):
            parts = [batch.column(n + k).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for k in range(5)]
            state = State.of_values([batch.column(k) for k in range(n)], parts[1])
            several = batch.column(n).is_valid().to_numpy(zero_copy_only=False)
            if several.any():
                state.parts = [p.copy() for p in state.parts]
                for own, given in zip(state.parts, parts, strict=True):
                    own[several] = given if len(given) < len(own) else given[several]
            yield state

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for state in _collected(states(batches), _all_but_last):
            count, *others = state.parts
            columns = []
            for v in range(width):
                columns.append(pa.array(np.ascontiguousarray(count[:, v])))
                columns += [pa.array(np.ascontiguousarray(x[:, v]), from_pandas=True) for x in others]
            yield pa.RecordBatch.from_arrays([*state.keys, *columns], names=names)

    names = [*keys, *[f"{v}_{k}" for v in variables for k in KINDS]]
    types = [f"`{k}` {partial.schema[k].dataType.simpleString()}" for k in keys]
    types += [f"`{v}_{k}` {'long' if k == 'count' else 'double'}" for v in variables for k in KINDS]
    return partial.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tasks, ", ".join(types))


def reduced(df: DataFrame, keys: list[str], variables: list[str], merge: bool) -> DataFrame:
    """Mergeable aggregates ``variable_kind`` of each group of ``keys``, which must not be empty.

    From readings, or with ``merge`` from finer groups' aggregates.
    """
    sources = [f"{v}_{k}" for k in KINDS for v in variables] if merge else variables
    cols = [F.col(f"`{c}`").cast("double").alias(f"__{k}") for k, c in enumerate(sources)]
    rows = df.select(*keys, *cols)
    n, width = len(keys), len(variables)

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[State]:
        for batch in _pieces(batches, width):
            own = [batch.column(k) for k in range(n)]
            if merge:
                count, *others = [_matrix(batch, n + k * width, width) for k in range(5)]
                yield State(own, [np.nan_to_num(count).astype(np.int64), *others])
            else:
                yield State.of_values(own, _matrix(batch, n, width))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A piece's five matrices are reduced before they are put beside others.
        for state in _collected((s.reduced() for s in states(batches) if len(s)), _partial):
            everywhere = np.ones(len(state), bool)
            several = everywhere if merge else (state.parts[0] > 1).any(axis=1)
            lists = [_lists(p, everywhere if kind == "sum" else several) for kind, p in zip(KINDS, state.parts, strict=True)]
            yield pa.RecordBatch.from_arrays([*state.keys, *lists], names=[*keys, *KINDS])

    types = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    types += [f"`{k}` array<{'long' if k == 'count' else 'double'}>" for k in KINDS]
    return _shuffled(rows.mapInArrow(tasks, ", ".join(types)), keys, variables)
