"""Long exact spans that texts of different documents have in common, by recompression.

Round by round, equal runs of a symbol and then pairs of adjacent symbols are named by a hash of their parts, and
the named block replaces its parts. Whether two neighbours merge depends on nothing but their names, and only symbols of
a bounded length take part in a round, so equal substrings get equal symbols except within ``MARGIN`` characters of
their ends. As names are hashes of what they stand for, they are the same in every task: a round needs no exchange, and
the low rounds, whose names every text has, run within the tasks. The last round joins the symbols that follow a local
minimum into one high-level symbol of up to ``span`` characters, named by the names of its parts: every window of the
wanted length holds one, the same at the same place in every text that holds the window.

1. ``anchors``: the high-level symbols. The exchange is left to their names: those that occur in two documents are
   found by a minimum and a maximum per name, combined before the shuffle.
2. The windows around shared symbols are verified in cells of ``CELL`` neighbours: what all windows of a cell have in
   common is a necessary part, what they cover together a sufficient one.
3. Only where a cell has a shared necessary part and no shared sufficient part, the cells of that necessary part are
   tested window by window.

All tests compare 64-bit names of whole stretches. Windows of cells found are merged per document. No group of
equal names is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.sketch import mix, powers
from quire.operators.intervals import periods_and_gaps
from quire.session import Scratch

#: Rounds: what is named, and up to which length a symbol takes part. At an end of a common stretch each round leaves one
#: symbol uncertain, so the lengths sum to 11 characters of margin; positions deep inside a long run need 9 more.
ROUNDS = (("run", 1), ("pair", 1), ("pair", 2), ("pair", 3), ("pair", 4))
MARGIN, DEEP, CELL = 20, 9, 16
#: Characters handled at once; longer texts are cut into stretches that overlap by a window.
TILE = 1 << 19
_POS = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


class _Names:
    """Names of all stretches of one sequence (of characters, or of symbols) in constant time each."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        up, self.down = powers(n)
        self.symbols = mix(codes.astype(_U) + _U(_BASE))
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(self.symbols * up[:n], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray, tag: int = 0) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + _U(tag))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def symbols_of(characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and names of the symbols after all rounds; ``characters`` are the names of the single ones.

    A run longer than ``DEEP`` is cut into its first ``DEEP`` characters and single ones behind them, so that what is deep
    inside it is named alike wherever it ends.
    """
    start = np.arange(len(characters))
    name = characters
    for k, (kind, most) in enumerate(ROUNDS):
        size = np.diff(start, append=len(characters))
        active = size <= most
        both = active[:-1] & active[1:]
        if kind == "run":
            joined = both & (name[:-1] == name[1:])
            heads = np.flatnonzero(np.concatenate([[True], ~joined]))
            times = np.diff(heads, append=len(name)).astype(_U)
            name = np.where(times > 1, mix(name[heads] + times * _U(0xD6E8FEB86659FD93)), name[heads])
        else:
            left = mix(name ^ _U(_BASE * (k + 1) % (1 << 64))) >> _U(63) == 0
            joined = both & left[:-1] & ~left[1:]
            second = np.concatenate([[False], joined])
            heads = np.flatnonzero(~second)
            head = name[heads]
            pairs = np.concatenate([joined, [False]])[heads]
            after = name[np.minimum(heads + 1, len(name) - 1)]
            name = np.where(pairs, mix(head * _U(3) + mix(after + _U(k + 1))), head)
        start = start[heads]
    size = np.diff(start, append=len(characters))
    if (long := np.flatnonzero(size > DEEP)).size:
        name = name.copy()
        name[long] = mix(characters[start[long]] + _U(1))
        more = np.concatenate([np.arange(start[i] + DEEP, start[i] + size[i]) for i in long])
        start, name = np.concatenate([start, more]), np.concatenate([name, mix(characters[more] + _U(2))])
        order = np.argsort(start)
        start, name = start[order], name[order]
    return start, name


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    done, out = 1, a
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def _shape(length: int) -> tuple[int, int]:
    """Characters that a high-level symbol covers at most, and places that the first one of a window may have."""
    span = max(CELL, (length - 2 * MARGIN) * 4 // 10)
    return span, length - 2 * MARGIN - span + 1


def _anchors(length: int):
    span, reach = _shape(length)

    def tile(docs: list, texts: list[str], bases: list[int]) -> pa.RecordBatch:
        codes = [_codes(t) for t in texts]
        sizes = np.array([len(c) for c in codes])
        off = np.concatenate([[0], np.cumsum(sizes)])
        names = _Names(np.concatenate(codes))
        n = off[-1]
        start, name = symbols_of(names.symbols)
        # The symbols from each start that end within its span, as one.
        last = np.searchsorted(np.append(start[1:], n), start + span, "right")
        key = _Names(name).of(np.arange(len(start)), last)
        high = np.zeros(n, _U)
        high[start] = key
        p, key = (x[(start >= MARGIN) & (start + span + MARGIN <= n)] for x in (start, key))
        value = np.full(n, ~_U(0))
        value[p] = (key & ~_POS) | (_POS - p.astype(_U))
        low = _sliding_min(value, reach)  # of the places w .. w + reach - 1
        w = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(off[:-1], off[1:], strict=True)])
        at = (_POS - (low[w + MARGIN] & _POS)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (w[1:] != w[:-1] + 1)]))
        end = np.append(cut[1:], len(w)) - 1
        first, last, at = w[cut], w[end], at[cut]
        doc = np.searchsorted(off, first, side="right") - 1
        where = at - off[doc] + np.array(bases)[doc]
        packed = (where << 24) | ((at - MARGIN - last) << 12) | (at - MARGIN - first)
        return pa.RecordBatch.from_arrays(
            [pa.array(high[at].view(np.int64)), pa.array([docs[d] for d in doc], pa.int64()), pa.array(packed)], ["key", "doc", "at"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, texts, bases, size = [], [], [], 0
        for b in batches:
            for doc, whole in zip(b.column("doc").to_pylist(), b.column("text"), strict=True):
                t = whole.as_py()
                for a in range(0, len(t) - length + 1, TILE):
                    part = t[a : a + TILE + length - 1]
                    if docs and size + len(part) >= TILE + length:  # a tile's places have 20 bits
                        yield tile(docs, texts, bases)
                        docs, texts, bases, size = [], [], [], 0
                    docs.append(doc), texts.append(part), bases.append(a)
                    size += len(part)
        if docs:
            yield tile(docs, texts, bases)

    return run


def _cells(length: int):
    """Necessary and sufficient names of the cells of windows around the shared anchors of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, text, at in zip(b.column("doc").to_pylist(), b.column("text"), b.column("at"), strict=True):
                packed = np.unique(at.values.to_numpy())
                place, hi, lo = packed >> 24, packed & 4095, (packed >> 12) & 4095
                many = hi // CELL - lo // CELL + 1
                row = np.repeat(np.arange(len(packed)), many)
                cell = (lo // CELL)[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                top = place[row] - MARGIN - cell * CELL  # the last window of the cell
                w0 = top - CELL + 1
                wa = np.maximum(w0, place[row] - MARGIN - hi[row])
                wb = np.minimum(top, place[row] - MARGIN - lo[row])
                out.append((doc, _stretch_names(text.as_py(), top, w0 + length, 1), *_sufficient(text.as_py(), w0, length), ((w0 + CELL) << 8) | ((wa - w0) << 4) | (wb - w0)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array([o[0] for o in out]), [len(o[1]) for o in out])),
                        pa.array(np.concatenate([o[1] for o in out]).view(np.int64)),
                        pa.array(np.concatenate([o[2] for o in out]).view(np.int64), mask=~np.concatenate([o[3] for o in out])),
                        pa.array(np.concatenate([o[4] for o in out])),
                    ],
                    ["doc", "need", "enough", "cell"],
                )

    return run


def _stretch_names(text: str, a: np.ndarray, b: np.ndarray, tag: int) -> np.ndarray:
    """Names of the stretches [a, b), ascending in a, tile by tile for very long texts."""
    if len(text) <= 2 * TILE:
        return _Names(_codes(text)).of(a, b, tag)
    out = np.empty(len(a), _U)
    order = np.argsort(a, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(a[order] // TILE)) + 1):
        base = int(a[group].min())
        out[group] = _Names(_codes(text[base : int(b[group].max())])).of(a[group] - base, b[group] - base, tag)
    return out


def _sufficient(text: str, w0: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    inside = (w0 >= 0) & (w0 + CELL - 1 + length <= len(text))
    a = np.where(inside, w0, 0)
    return _stretch_names(text, a, np.where(inside, a + CELL - 1 + length, 0), 2), inside


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, keys, starts = [], [], []
            for doc, text, cells in zip(b.column("doc").to_pylist(), b.column("text"), b.column("cells"), strict=True):
                c = np.unique(cells.values.to_numpy())
                w0 = (c >> 8) - CELL
                wa, wb = w0 + ((c >> 4) & 15), w0 + (c & 15)
                many = wb - wa + 1
                w = np.unique(np.repeat(wa, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
                docs.append(np.full(len(w), doc)), starts.append(w), keys.append(_stretch_names(text.as_py(), w, w + length, 3))
            if docs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(docs)), pa.array(np.concatenate(starts))], ["key", "doc", "s"])

    return run


def _in_two(rows: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that occur in at least two documents."""
    ends = rows.groupBy(key).agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    return ends.where("lo < hi").select(key)


def shared_spans(docs: DataFrame, length: int = 150) -> DataFrame:
    """Maximal unions of overlapping or touching windows of ``length`` characters that occur in another document.

    ``docs``: ``doc_id`` (integer) and ``text``; further columns are ignored. Windows are compared verbatim, case
    and white space included. Returns ``doc_id, span_start, span_end``: 0-based, end exclusive. Texts that are
    null or shorter than ``length`` have none; a repetition inside one document alone is none; rows repeated
    under one ``doc_id`` are one document. Names have 64 bits: among ``n`` different stretches compared, the chance
    that any two share one is about ``n * n / 2**65``. ``length`` must be between 100 and 4000.
    """
    if not 100 <= length <= 4000:
        raise ValueError("length must be between 100 and 4000")
    scratch = Scratch(docs.sparkSession, "spans")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").where(F.col("doc").isNotNull() & (F.length("text") >= length))
    anchors = scratch.cut(texts.mapInArrow(_anchors(length), "key long, doc long, at long"))
    places = anchors.join(_in_two(anchors, "key"), "key").groupBy("doc").agg(F.collect_list("at").alias("at"))
    cells = scratch.cut(texts.join(places, "doc").select("doc", "text", "at").mapInArrow(_cells(length), "doc long, need long, enough long, cell long"))
    scratch.drop(anchors)
    likely = scratch.cut(cells.join(_in_two(cells, "need"), "need").select("doc", "need", "enough", "cell"))
    enough = _in_two(likely.where("enough is not null"), "enough").withColumn("whole", F.lit(True))
    judged = scratch.cut(likely.join(enough, "enough", "left").select("doc", "need", "cell", F.col("whole").isNotNull().alias("whole")))
    scratch.drop(cells, likely)
    w0 = F.shiftright("cell", 8) - CELL
    first, last = w0 + F.shiftright("cell", 4).bitwiseAND(F.lit(15)), w0 + F.col("cell").bitwiseAND(F.lit(15))
    whole = judged.where("whole").select("doc", first.alias("s"), (last + length).alias("e"))
    # A window of an open cell may occur in a cell that is whole through a third document, so all cells with its
    # necessary part take part.
    undecided = judged.where("not whole").select("need").distinct()
    open_cells = judged.join(undecided, "need").groupBy("doc").agg(F.collect_list("cell").alias("cells"))
    single = scratch.cut(texts.join(open_cells, "doc").select("doc", "text", "cells").mapInArrow(_windows(length), "key long, doc long, s long"))
    found = single.join(_in_two(single, "key"), "key").select("doc", "s", (F.col("s") + length).alias("e"))
    merged = periods_and_gaps(whole.unionAll(found).select(F.col("doc").cast("string").alias("entity"), "s", "e"))
    return merged.where("kind = 'period'").select(F.col("entity").cast("long").alias("doc_id"), F.col("s").cast("int").alias("span_start"), F.col("e").cast("int").alias("span_end"))


def shared_totals(docs: DataFrame, length: int = 150) -> DataFrame:
    """Characters of every document and how many of them lie in spans shared elsewhere (zero if none)."""
    spans = shared_spans(docs, length).groupBy("doc_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"), F.count("*").alias("spans"))
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    return sizes.join(spans, "doc_id", "left").select("doc_id", "chars", F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"), F.coalesce("spans", F.lit(0)).alias("spans"))
