"""Order statistics, counts and averages over sliding windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField, StructType


def rolling_windows(rows: DataFrame, key: str, place: str, number: str, value: str, windows: dict[int, dict[str, str]], positive: str | None = None, marks: dict[str, tuple[str, int]] | None = None, only: str | None = None) -> DataFrame:
    """``rows`` with figures of ``value`` over the last so many places, for each of ``windows``.

    A window's dict names its columns: ``median`` (interpolated), ``average`` and ``valid`` (how many there are) of the values that are not null, ``rows`` and
    ``positive`` (rows, and those of them where the boolean column ``positive`` holds). ``marks`` are further counts: name to (boolean column, places).
    ``rows`` must come in partitions that hold whole keys, as a window over the key leaves them (its order is kept, not made again); ``number`` counts
    a key's rows from 1, and ``place`` is what windows are measured in (session numbers, or the row's own number). A window
    is a sorted list that a value enters and leaves by bisection, so a row costs the logarithm of the window, and its sum, and a task holds one window
    of values, however long a key's history is. A median or average of no values is null. With ``only``, a
    boolean column, other rows enter the windows but are not returned; figures are then made of the windows of returned rows only, so that other rows cost no Python. ``positive`` and marked columns are not returned. Every column of ``rows`` passes through
    Python: select before what is needed.
    """
    marks = marks or {}
    inner = {only, positive, *[c for c, _ in marks.values()]}
    fields = [f for f in rows.schema.fields if f.name not in inner]
    columns = [f.name for f in fields]
    made = [(n, what, name) for n, named in windows.items() for what, name in named.items()]
    new = [StructField(name, DoubleType() if what in ("median", "average") else LongType()) for _, what, name in made] + [StructField(k, LongType()) for k in marks]
    kinds = [pa.float64() if isinstance(f.dataType, DoubleType) else pa.int64() for f in new]

    def mean(kept: list[float]) -> float:
        from math import fsum

        try:
            return fsum(kept) / len(kept)
        except (OverflowError, ValueError):  # infinite values, or a sum beyond the doubles
            return sum(kept) / len(kept)

    def run_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = [c for c in dict.fromkeys([positive, *[c for c, _ in marks.values()]]) if c]
        reach = max([*windows, *[n for _, n in marks.values()]])
        held = None  # the rows before a batch that its windows may hold
        for batch in batches:
            if not batch.num_rows:
                continue
            col = lambda name, b=batch: b.column(b.schema.get_field_index(name))
            yes = lambda name: pc.fill_null(col(name), False).to_numpy(zero_copy_only=False)
            there = col(value).is_valid().to_numpy(zero_copy_only=False)
            values = pc.fill_null(col(value).cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
            now = [col(place).cast(pa.int64()).to_numpy(), col(number).to_numpy() == 1, there, values, *[yes(c) for c in flags]]
            before = 0 if held is None else len(held[0])
            at, first, there, values, *up = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            key = np.cumsum(first)
            low = at.min()
            wide = int(at.max() - low) + reach + 2
            line = key * wide + (at - low)  # ascends through keys and places
            i = np.flatnonzero(yes(only)) + before
            begin = {n: np.searchsorted(line, line[i] - n, "right") for n in {*windows, *[n for _, n in marks.values()]}}
            total = {c: np.concatenate(([0], np.cumsum(x))) for c, x in zip(flags, up, strict=True)}
            valid, kept = np.concatenate(([0], np.cumsum(there))), values[there]
            found = []
            for n, named in windows.items():
                lo = begin[n]
                a, b = valid[lo].tolist(), valid[i + 1].tolist()
                for what in named:
                    if what == "median":
                        out = []
                        for x, y in zip(a, b, strict=True):
                            w = np.sort(kept[x:y])
                            out.append((float(w[(y - x - 1) // 2]) + float(w[(y - x) // 2])) / 2 if y > x else None)
                    elif what == "average":
                        out = [mean(kept[x:y].tolist()) if y > x else None for x, y in zip(a, b, strict=True)]
                    else:
                        out = i + 1 - lo if what == "rows" else valid[i + 1] - valid[lo] if what == "valid" else total[positive][i + 1] - total[positive][lo]
                    found.append(out)
            found += [total[c][i + 1] - total[c][begin[n]] for c, n in marks.values()]
            near = (key == key[-1]) & (at > at[-1] - reach)
            held = [x[near] for x in (at, first, there, values, *up)]
            own = pa.RecordBatch.from_arrays([col(c) for c in columns], columns).filter(pa.array(yes(only)))
            yield pa.RecordBatch.from_arrays([*own.columns, *[pa.array(x, t) for x, t in zip(found, kinds, strict=True)]], [*columns, *[f.name for f in new]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_left, insort
        from collections import deque

        states = {n: ([], deque(), deque()) for n in windows}
        marked = {k: deque() for k in marks}
        for batch in batches:
            col = lambda name, b=batch: b.column(b.schema.get_field_index(name))
            at, first, values = (col(c).to_pylist() for c in (place, number, value))
            ups = col(positive).to_pylist() if positive else [False] * len(at)
            found = []
            for n, named in windows.items():
                kept, queue, positives = states[n]
                out = {what: [] for what in named}
                figures = {"median": lambda k=kept: (k[(len(k) - 1) // 2] + k[len(k) // 2]) / 2 if k else None, "average": lambda k=kept: mean(k) if k else None, "valid": kept.__len__, "rows": queue.__len__, "positive": positives.__len__}
                adds = [(out[what].append, figures[what]) for what in named]
                for p, f, v, up in zip(at, first, values, ups, strict=True):
                    if f == 1:
                        kept.clear()
                        queue.clear()
                        positives.clear()
                    last = p - n
                    while queue and queue[0][0] <= last:
                        gone = queue.popleft()[1]
                        if gone is not None:
                            del kept[bisect_left(kept, gone)]
                    while positives and positives[0] <= last:
                        positives.popleft()
                    queue.append((p, v))
                    if v is not None:
                        insort(kept, v)
                    if up:
                        positives.append(p)
                    for add, figure in adds:
                        add(figure())
                found += [out[what] for what in named]
            for k, (column, n) in marks.items():
                held, out = marked[k], []
                for p, f, yes in zip(at, first, col(column).to_pylist(), strict=True):
                    if f == 1:
                        held.clear()
                    while held and held[0] <= p - n:
                        held.popleft()
                    if yes:
                        held.append(p)
                    out.append(len(held))
                found.append(out)
            yield pa.RecordBatch.from_arrays([*[col(c) for c in columns], *[pa.array(x, t) for x, t in zip(found, kinds, strict=True)]], [*columns, *[f.name for f in new]])

    return rows.sortWithinPartitions(key, place).mapInArrow(run_few if only else run, StructType(fields + new))


def rolling_medians(rows: DataFrame, key: str, place: str, number: str, value: str, windows: dict[str, int], only: str | None = None) -> DataFrame:
    """``rows`` with the interpolated median of ``value`` over the last so many places, a column for each of ``windows`` (see ``rolling_windows``)."""
    first = {n: name for name, n in reversed(windows.items())}
    made = rolling_windows(rows, key, place, number, value, {n: {"median": name} for n, name in first.items()}, only=only)
    columns = [c for c in rows.columns if c != only]
    return made.select(*columns, *[made[first[n]].alias(name) for name, n in windows.items()])
