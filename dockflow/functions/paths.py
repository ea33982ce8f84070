"""Whole trajectories: column builders for walks and tracked totals, and the moments
of a pair of paths, computed for many rows at once in Arrow batches.

Each keeps the meaning of the SQL expressions it is written for: ``greatest`` and
``least`` pass over nulls, NaN is the largest number, an unknown count is in no
state but normal.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from dockflow.params import HOUR

# Workers get these functions themselves, wherever the package lies.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CONTEXTS = 48
#: Walks and pairs that a kernel takes at once, so that their values stay in the processor's cache.
_ROWS, _PAIRS = 1024, 64
#: Below every number: a clamp at a floor makes the floor of it, as it does of a null.
_UNKNOWN = -np.inf
_DAY = 24 * HOUR

_COUNTS = ("n", "empty_tp", "empty_fp", "empty_fn", "full_tp", "full_fp", "full_fn", "same_state")
_SUMS = ("abs_err", "sq_err", "rel_err", "s_t", "s_p", "s_tt", "s_pp", "s_tp", "near_t", "near_p", "min_true", "max_true", "min_pred", "max_pred")
#: What ``moments`` gives for a pair of paths.
MOMENTS = (*_COUNTS, *_SUMS)
MOMENTS_DDL = ", ".join([f"{c} bigint" for c in _COUNTS] + [f"{c} double" for c in _SUMS])


def _doubles(values: pa.Array, null: float) -> np.ndarray:
    """Numbers as doubles, ``null`` for nulls."""
    values = pc.cast(values, pa.float64())
    return (pc.fill_null(values, null) if values.null_count else values).to_numpy(zero_copy_only=False)


def _whole(values: pa.Array, null: int) -> np.ndarray:
    values = pc.cast(values, pa.int64())
    return (pc.fill_null(values, null) if values.null_count else values).to_numpy(zero_copy_only=False)


def _sizes(lists: pa.Array) -> np.ndarray:
    """Elements of each list, none for a null."""
    return _whole(pc.list_value_length(lists), 0)


def _begins(sizes: np.ndarray) -> np.ndarray:
    """Where each list begins among all elements, and where the last one ends."""
    begins = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=begins[1:])
    return begins


def _lists(values: np.ndarray, sizes: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """Lists of doubles; those of ``missing`` rows are null, unknown values too."""
    unknown = values == _UNKNOWN
    items = pa.array(values, pa.float64(), mask=unknown if unknown.any() else None)
    mask = pa.array(missing) if missing is not None and missing.any() else None
    return pa.ListArray.from_arrays(pa.array(_begins(sizes), pa.int32()), items, mask=mask)


def _walk_kernel(start, high, steps, flows, context, begin, seconds: int):
    """(values, sizes) of x <- min(high, max(0, x + flow)); ``flows`` has a row of
    flows by context, or of one flow."""
    sizes = np.maximum(steps, 1)
    found = []
    for a in range(0, len(start), _ROWS):
        b = min(a + _ROWS, len(start))
        longest = int(sizes[a:b].max())
        path = np.empty((longest, b - a))
        path[0] = x = start[a:b]
        mine, row = flows[a:b], np.arange(b - a)
        if context:
            begins, of = np.unique(begin[a:b], return_inverse=True)
            at = begins[:, None] // 1_000_000 + seconds * np.arange(longest)
            weekend = (at // _DAY + 3) % 7 >= 5
            contexts = at % _DAY // HOUR * 2 + weekend
        for i in range(1, longest):
            flow = mine[row, contexts[of, i]] if context else mine[:, 0]
            x = np.fmin(high[a:b], np.maximum(0.0, x + flow))
            path[i] = x
        whole = path.T
        found.append(whole.ravel() if (sizes[a:b] == longest).all() else whole[np.arange(longest) < sizes[a:b, None]])
    return np.concatenate(found) if found else np.empty(0), sizes


def clamped_walk(start: Column, capacity: Column, steps: Column, flow: Column) -> Column:
    """Array of x <- min(capacity, max(0, x + flow)) from ``start`` on, of ``steps``
    values and at least one."""

    @F.arrow_udf("array<double>")
    def walk(start: pa.Array, capacity: pa.Array, steps: pa.Array, flow: pa.Array) -> pa.Array:
        flows = _doubles(flow, _UNKNOWN)[:, None]
        return _lists(*_walk_kernel(_doubles(start, _UNKNOWN), _doubles(capacity, np.nan), _whole(steps, 1), flows, False, None, HOUR))

    return walk(start, capacity, steps, flow)


def clamped_context_walk(
    start: Column, capacity: Column, steps: Column, seen: Column, other: Column, begin: Column, seconds: int
) -> Column:
    """The same with the flow of each step's (hour, weekend) context, out of ``seen``,
    the flows of all contexts or null; ``other`` where a context has none.
    ``begin`` is the time of the first value."""

    @F.arrow_udf("array<double>")
    def walk(start: pa.Array, capacity: pa.Array, steps: pa.Array, seen: pa.Array, other: pa.Array, begin: pa.Array) -> pa.Array:
        flows = np.repeat(_doubles(other, _UNKNOWN)[:, None], CONTEXTS, axis=1)
        own, known = seen.flatten(), seen.is_valid().to_numpy(zero_copy_only=False)
        there = own.is_valid().to_numpy(zero_copy_only=False).reshape(-1, CONTEXTS)
        flows[known] = np.where(there, _doubles(own, 0.0).reshape(-1, CONTEXTS), flows[known])
        begin = _whole(pc.cast(begin, pa.timestamp("us")), 0)
        return _lists(*_walk_kernel(_doubles(start, _UNKNOWN), _doubles(capacity, np.nan), _whole(steps, 1), flows, True, begin, seconds))

    return walk(start, capacity, steps, seen, other, begin)


def tracked_total(start: Column, steps: Column, nets: Column) -> Column:
    """Array of x <- max(0, x + net) at every one of ``steps`` steps, from ordered
    sparse ``nets`` (step, net); steps without one repeat the last value."""

    @F.arrow_udf("array<double>")
    def track(start: pa.Array, steps: pa.Array, nets: pa.Array) -> pa.Array:
        sizes, last = _sizes(nets), np.maximum(_whole(steps, 1), 1)
        entries, begins = nets.flatten(), _begins(sizes)
        step, net = _whole(entries.field("step"), 0), _doubles(entries.field("net"), _UNKNOWN)
        # Values of a row: its start, then one after each net.
        at = _begins(sizes + 1)
        value, until = np.empty(at[-1]), np.empty(at[-1], np.int64)
        x = _doubles(start, _UNKNOWN).copy()
        value[at[:-1]] = x
        rows, k = np.flatnonzero(sizes > 0), 0
        while len(rows):
            entry = begins[rows] + k
            x[rows] = np.maximum(0.0, x[rows] + net[entry])
            until[at[rows] + k] = step[entry]
            k += 1
            value[at[rows] + k] = x[rows]
            rows = rows[sizes[rows] > k]
        # A value holds until the next net's step, the last one until the end.
        until[at[1:] - 1] = last
        since = np.zeros_like(until)
        since[1:] = until[:-1]
        since[at[:-1]] = 0
        held = np.maximum(until - since, 0)
        whole = np.add.reduceat(held, at[:-1]) if len(x) else held
        return _lists(np.repeat(value, held), whole, pc.is_null(steps).to_numpy(zero_copy_only=False))

    return track(start, steps, nets)


def _pair_moments(true: np.ndarray, pred: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of each row of two matrices; states lie up to ``low`` and from ``high`` on."""
    near_t, near_p = true[:, 0].copy(), pred[:, 0].copy()
    err, size = true - pred, np.abs(true)
    far = np.abs(err)
    t, p = true - near_t[:, None], pred - near_p[:, None]
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    count = lambda x: np.count_nonzero(x, axis=1)
    te, pe = true <= low, pred <= low
    tf, pf = (true >= high) & ~te, (pred >= high) & ~pe
    return {
        "n": np.full(len(true), true.shape[1]),
        "empty_tp": (etp := count(te & pe)),
        "empty_fp": count(pe) - etp,
        "empty_fn": count(te) - etp,
        "full_tp": (ftp := count(tf & pf)),
        "full_fp": count(pf) - ftp,
        "full_fn": count(tf) - ftp,
        "same_state": etp + ftp + count(~(te | tf | pe | pf)),
        "abs_err": far.sum(axis=1),
        "sq_err": dot(err, err),
        "rel_err": (far / (size + 1.0)).sum(axis=1),
        "s_t": t.sum(axis=1),
        "s_p": p.sum(axis=1),
        "s_tt": dot(t, t),
        "s_pp": dot(p, p),
        "s_tp": dot(t, p),
        "near_t": near_t,
        "near_p": near_p,
        "min_true": np.fmin.reduce(true, axis=1),
        "max_true": true.max(axis=1),
        "min_pred": np.fmin.reduce(pred, axis=1),
        "max_pred": pred.max(axis=1),
    }


def _cells(true: pa.Array, pred: pa.Array):
    """(true, pred, sizes): the values at steps where both paths have one."""
    ts, ps = _sizes(true), _sizes(pred)
    t, p = true.flatten(), pred.flatten()
    if not t.null_count and not p.null_count and (ts == ps).all():
        return _doubles(t, 0.0), _doubles(p, 0.0), ts
    sizes = np.minimum(ts, ps)
    begins = _begins(sizes)
    inside = np.arange(begins[-1]) - np.repeat(begins[:-1], sizes)
    pick = lambda values, of: values.take(pa.array(np.repeat(_begins(of)[:-1], sizes) + inside))
    t, p = pick(t, ts), pick(p, ps)
    both = pc.and_(t.is_valid(), p.is_valid()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    return _doubles(t, 0.0)[both], _doubles(p, 0.0)[both], np.bincount(row[both], minlength=len(sizes))


def moments(true: pa.Array, pred: pa.Array, capacity: pa.Array, empty: float, full: float) -> dict[str, np.ndarray]:
    """``MOMENTS`` of each pair of paths, over the steps at which both have a value; sums
    are about the first of them. Thresholds are shares of ``capacity``, both inclusive, and empty wins."""
    capacity = _doubles(capacity, np.nan)
    # Any number is below NaN, so a count is empty there.
    low = np.where(np.isnan(capacity * empty), np.inf, capacity * empty)
    high = np.where(np.isnan(capacity * full), np.inf, capacity * full)
    t, p, sizes = _cells(true, pred)
    begins = _begins(sizes)
    out = {c: np.zeros(len(sizes), np.int64 if c in _COUNTS else np.float64) for c in MOMENTS}
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        for a in range(0, len(rows), _PAIRS):
            some = rows[a : a + _PAIRS]
            if some[-1] - some[0] + 1 == len(some):
                all_of = slice(begins[some[0]], begins[some[-1] + 1])
                mine = t[all_of].reshape(-1, size), p[all_of].reshape(-1, size)
            else:
                at = begins[some][:, None] + np.arange(size)
                mine = t[at], p[at]
            for c, values in _pair_moments(*mine, low[some, None], high[some, None]).items():
                out[c][some] = values
    return out
