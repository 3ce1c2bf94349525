"""Splitting of oversized texts at natural boundaries, with an overlap between consecutive pieces.

The text starts as atomic segments whose boundaries have a strength: paragraph, sentence, line, word, or none.
Adjacent pairs wait in a heap and the weakest boundary is merged away first (then the smaller pair, then the
leftmost) while the combined size, plus the overlap that every piece but the first takes from its predecessor, fits.
Since all boundaries inside a sentence are weaker than its ends, a sentence that fits may start as one segment
without changing the result; only sentences that don't fit start as words, and words that don't fit are cut.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 6000, 200
CUT, WORD, LINE, SENTENCE, PARAGRAPH = range(5)
#: Ends of sentences and everything stronger; a boundary lies behind the white space that follows.
_STRONG = re.compile(r"(?<!\s)\s*\n[^\S\n]*(?:\r?\n\s*)+|(?<=[.!?…])[\"”’»)\]]*\s+")
_WEAK = re.compile(r"(\s*\n\s*)|(\s+)")


def _atoms(text: str, room: int) -> tuple[list[int], list[int]]:
    """Ends of the atomic segments and the strength of the boundary at each end."""
    ends: list[int] = []
    kinds: list[int] = []

    def words(a: int, b: int) -> None:
        at = a
        for m in _WEAK.finditer(text, a, b):
            if m.end() < b:
                cut_long(at, m.end())
                ends.append(m.end())
                kinds.append(LINE if m[1] else WORD)
                at = m.end()
        cut_long(at, b)

    def cut_long(a: int, b: int) -> None:
        for x in range(a + room, b, room):
            ends.append(x)
            kinds.append(CUT)

    at = 0
    for m in _STRONG.finditer(text):
        if m.end() == at or m.end() >= len(text):
            continue
        if m.end() - at > room:
            words(at, m.end())
        ends.append(m.end())
        kinds.append(PARAGRAPH if m[0].count("\n") > 1 else SENTENCE)
        at = m.end()
    if len(text) - at > room:
        words(at, len(text))
    ends.append(len(text))
    kinds.append(PARAGRAPH)
    return ends, kinds


def piece_ends(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[int]:
    """Ends of the pieces' own parts; a piece also takes the ``overlap`` characters before its own part.

    A first piece must leave ``overlap`` characters to its successor, so it is given the same room as the others
    plus the overlap that it doesn't need.
    """
    if len(text) <= limit:
        return [len(text)]
    room = limit - overlap
    ends, kinds = _atoms(text, room)
    n = len(ends)
    start = [0, *ends[:-1]]
    nxt = list(range(1, n + 1))
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(kinds[i], ends[i + 1] - start[i], i, ends[i], ends[i + 1]) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        _, size, i, mid, end = heapq.heappop(heap)
        j = nxt[i]
        if not alive[i] or ends[i] != mid or j >= n or ends[j] != end or end - start[i] != size:
            continue
        if size > (limit if start[i] == 0 else room):
            continue
        alive[j] = False
        ends[i], kinds[i] = ends[j], kinds[j]
        nxt[i] = nxt[j]
        if nxt[i] < n:
            k = nxt[i]
            prev[k] = i
            heapq.heappush(heap, (kinds[i], ends[k] - start[i], i, ends[i], ends[k]))
        if (k := prev[i]) >= 0:
            heapq.heappush(heap, (kinds[k], ends[i] - start[k], k, ends[k], ends[i]))
    return [ends[i] for i in range(n) if alive[i]]


def split_oversized(docs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """Pieces of every text with more than ``limit`` characters (code points).

    ``docs``: ``doc_id``, ``text``; further columns are ignored. Returns ``doc_id, piece, start, end`` and the
    ``text`` of each piece: 0-based, end exclusive, at most ``limit`` characters, each piece starting ``overlap``
    characters before the last one ended. Pieces end at the strongest boundaries that the merging left; only a
    run without white space that is longer than a piece is cut inside. Null, empty and fitting texts give no
    rows. Rows are handled one by one: repeated ``doc_id`` give repeated pieces.
    """
    if not 0 <= overlap < limit / 2:
        raise ValueError("overlap must be less than half the limit")

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "piece", "start", "end"] + ["text"] * with_text
        for f in frames:
            rows = []
            for doc, text in zip(f["doc_id"], f["text"], strict=True):
                start = 0
                for k, end in enumerate(piece_ends(text, limit, overlap)):
                    rows.append((doc, k, start, end, text[start:end])[: len(columns)])
                    start = max(0, end - overlap)
            yield pd.DataFrame(rows, columns=columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    big = docs.select("doc_id", "text").where(F.length("text") > limit)
    return big.mapInPandas(pieces, f"doc_id {kind}, piece int, start int, end int" + ", text string" * with_text)
