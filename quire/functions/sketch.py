"""Rolling names of stretches and minimisers, for seeds of exact matches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit names of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def code_arrays(column: pa.Array) -> list[np.ndarray]:
    """The codes of every text of a column, a null as none: views of one byte each where all are ASCII, else code points."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(column) or (raw[ends[0] : ends[-1]] < 128).all():
        return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return [np.frombuffer((x or "").encode("utf-32-le"), np.uint32) for x in column.to_pylist()]


_powers = (np.ones(1, _U), np.ones(1, _U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers, at least ``n``, of the base and of its inverse; kept as long as the process."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 14)
        _powers = tuple(np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, b, _U)]), dtype=_U) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _powers


def window_names(codes: np.ndarray, k: int) -> np.ndarray:
    """64-bit name of every window of ``k`` codes."""
    n = len(codes) - k + 1
    if n < 1:
        return np.zeros(0, _U)
    up, down = powers(len(codes))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(codes.astype(_U) + _U(_BASE)) * up[: len(codes)], dtype=_U)])
    return mix((sums[k:] - sums[:-k]) * down[:n])


def minimisers(codes: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and names of the least window of every ``reach`` neighbours: equal stretches of ``k + reach - 1`` share one.

    A shorter sequence gives its least window. Of equal windows the last is taken.
    """
    names = window_names(codes, k)
    if not len(names):
        return np.zeros(0, np.int64), names
    width = min(reach, len(names))
    packed = (names & ~_U(0xFFFFFF)) | (_U(0xFFFFFF) - (np.arange(len(names), dtype=_U) & _U(0xFFFFFF)))
    done, low = 1, packed
    while done < width:
        step = min(done, width - done)
        low = np.minimum(low[:-step], low[step:])
        done += step
    kept = np.flatnonzero(np.isin(packed, np.unique(low)))
    return kept, names[kept]


def least_windows(codes: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For every stretch of ``k + reach - 1`` codes the offset of its least window of ``k``, and the names of all windows.

    Equal stretches have their least window at the same place; of equal windows it is the last.
    """
    names = window_names(codes, k)
    n = len(names) - reach + 1
    if n < 1:
        return np.zeros(0, np.int64), names
    low = (names & ~_U(0xFFFFFF)) | (_U(0xFFFFFF) - (np.arange(len(names), dtype=_U) & _U(0xFFFFFF)))
    done = 1
    while done < reach:
        step = min(done, reach - done)
        low = np.minimum(low[:-step], low[step:])
        done += step
    at = np.arange(n)
    return at + ((_U(0xFFFFFF) - (low & _U(0xFFFFFF))).astype(np.int64) - at) % (1 << 24), names
