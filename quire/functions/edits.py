"""Edit distances of many pairs at once: the bit-parallel columns of Myers, a row of words for every pair."""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Words of the table of letters, and columns between two looks at what can be given up.
_WORDS, _LOOK = 1 << 18, 16


def _matrix(codes: list[np.ndarray], letters: np.ndarray) -> np.ndarray:
    """Places of the codes among ``letters``, a row for each text; what isn't there, and the end, has the place behind."""
    end = int(letters[-1]) + 1
    raw = np.full((len(codes), max(map(len, codes))), end, np.uint32)
    for row, x in zip(raw, codes, strict=True):
        row[: len(x)] = x
    places = np.full(end + 1, len(letters), np.int32)
    places[letters] = np.arange(len(letters))
    return places.take(np.minimum(raw, end, out=raw))


def _least(pv: np.ndarray, mv: np.ndarray, m: np.ndarray, rest: np.ndarray, j: int) -> np.ndarray:
    """Lower bound of the distances after ``j`` columns, by every eighth row: neighbours differ by at most two on the way."""
    up, down = (np.bitwise_count(np.ascontiguousarray(x.T).view(np.uint8)).astype(np.int32) for x in (pv, mv))
    steps = up - down
    rows = np.arange(0, 8 * steps.shape[1] + 1, 8)
    ways = np.concatenate([np.full((len(m), 1), j, np.int32), j + np.cumsum(steps, axis=1)], axis=1) + np.abs((m[:, None] - rows) - rest[:, None])
    return np.where(rows <= m[:, None], ways, 1 << 30).min(axis=1) - 14


def _columns(a: list[np.ndarray], b: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """``distances`` of texts that aren't empty, of which those of ``a`` fill the same number of words."""
    letters = np.flatnonzero(np.bincount(np.concatenate(a)))
    size, words = len(letters) + 1, -(-max(map(len, a)) // 64)
    m, n = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    left, right = _matrix(a, letters), _matrix(b, letters).T.copy()
    table = np.zeros(len(a) * size * words, _U)
    base = np.arange(len(a)) * size
    for i in range(left.shape[1]):  # the letter behind the end is never read: its bits are cleared below
        table[(base + left[:, i]) * words + i // 64] |= _U(1 << (i % 64))
    table = table.reshape(-1, words)
    table[base + size - 1] = 0
    pv, mv = np.full((words, len(a)), ~_U(0)), np.zeros((words, len(a)), _U)
    out, own, score = np.full(len(a), -1), np.arange(len(a)), m.astype(np.int64)
    bit, here = ((m - 1) % 64).astype(_U), base
    for j in range(int(n.max())):
        eq = np.ascontiguousarray(table.take(here + right[j], 0).T)
        xv = eq | mv
        x = eq & pv
        x += pv
        over, whole = x < pv, x == ~_U(0)
        for w in range(1, words - 1):  # a carry into a whole word goes on
            over[w] |= whole[w] & over[w - 1]
        x[1:] += over[:-1]
        x ^= pv
        x |= eq
        mh = pv & x
        x |= pv
        ph = np.invert(x, out=x)
        ph |= mv
        score += ((ph[-1] >> bit) & _U(1)).view(np.int64)
        score -= ((mh[-1] >> bit) & _U(1)).view(np.int64)
        high, low = ph[:-1] >> _U(63), mh[:-1] >> _U(63)
        ph <<= _U(1)
        mh <<= _U(1)
        ph[0] |= _U(1)
        ph[1:] |= high
        mh[1:] |= low
        mv = ph & xv
        xv |= ph
        pv = np.invert(xv, out=xv)
        pv |= mh
        ended = np.flatnonzero(n == j + 1)
        if len(ended):
            out[own[ended]] = np.where(score[ended] <= most[ended], score[ended], -1)
        if j % _LOOK == _LOOK - 1:
            keep = (n > j + 1) & (_least(pv, mv, m, n - j - 1, j + 1) <= most)
            own, score, bit, here, m, n, most = (x[keep] for x in (own, score, bit, here, m, n, most))
            pv, mv, right = pv[:, keep], mv[:, keep], right[:, keep]
        if not len(own):
            break
    return out


def distances(a: list[np.ndarray], b: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Edit distance of every two texts (arrays of codes), -1 where it is above ``most``."""
    m, n = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    out = np.maximum(m, n)
    out[out > most] = -1  # holds where one is empty
    full = np.flatnonzero((m > 0) & (n > 0))
    full = full[np.lexsort((n[full], m[full]))]
    k = 0
    while k < len(full):
        words = -(-int(m[full[k]]) // 64)
        part = full[k : k + max(1, min(512, _WORDS // (32 * words)))]
        part = part[m[part] <= 64 * words]
        k += len(part)
        out[part] = _columns([a[i] for i in part], [b[i] for i in part], most[part])
    return out
