"""Texts that share most of their word shingles: near-duplicates with small edits.

Two exact ways to find all pairs with a Jaccard similarity of at least a threshold, over sets of word shingles:

``deletion variants`` (the default of ``near_copies``): a set is cut into segments by a hash of its members, so few
that two similar sets differ by at most one member in one of them. Each segment is indexed as it is and with every
single member left out; equal variants make a candidate. It is selective where segments stay large: for thresholds
of about 0.7 and more.

``prefixes`` (``similar_pairs``): shingles have one global order, long words first, as these are rare; two similar
sets share a shingle among the first few of both. For a threshold of 0.6, where segments would shrink to one or two
shingles, this indexes a third of what the variants need.

Copies with one set of shingles form a class and take part once, so any number of copies is never compared.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.sketch import mix
from quire.llm.components import components
from quire.session import Scratch

_U = np.uint64
_WORD = re.compile(r"[^\W_]+")  # letters and digits


class _Words:
    """Name and length of each word; kept while a task runs, up to a bound."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def names(self, words: list[str]) -> np.ndarray:
        get = self.known.get
        out = [get(w) for w in words]
        if None in out:
            from xxhash import xxh3_64_intdigest

            if len(self.known) > 500_000:
                self.known.clear()
            for k, w in enumerate(words):
                if out[k] is None:
                    out[k] = self.known[w] = (xxh3_64_intdigest(w) & ~0x3F) | min(63, len(w))
        return np.array(out, _U)


def _shingle_sets(width: int):
    """Rows ``id, cls, grams``: the distinct shingles of each text in the global order, as 32-bit names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for b in batches:
            words = [_WORD.findall(t.as_py().lower()) for t in b.column("text")]
            counts = np.array([len(w) for w in words], np.int64)
            names = cache.names([x for w in words for x in w])
            if len(names) < width:
                continue
            rec = np.repeat(np.arange(len(words)), counts)
            size = names & _U(63)
            n = len(names) - width + 1
            gram, letters = np.zeros(n, _U), np.zeros(n, np.int64)
            for k in range(width):
                gram = mix(gram * _U(0x9E3779B97F4A7C15) + names[k : k + n])
                letters += size[k : k + n].astype(np.int64)
            inside = rec[:n] == rec[width - 1 :]
            rec, gram, letters = rec[:n][inside], gram[inside], letters[inside]
            # One key for the order: long words first, then by name; equal shingles are neighbours.
            key = ((_U(0x3FF) - np.minimum(letters, 0x3FF).astype(_U)) << _U(54)) | (gram >> _U(10))
            order = np.lexsort((key, rec))
            rec, key, gram = rec[order], key[order], gram[order]
            new = np.concatenate([[True], (rec[1:] != rec[:-1]) | (key[1:] != key[:-1])])[: len(rec)]
            rec, gram = rec[new], gram[new]
            start = np.flatnonzero(np.concatenate([[True], rec[1:] != rec[:-1]])[: len(rec)])
            if not len(start):
                continue
            with np.errstate(over="ignore"):
                cls = mix(np.add.reduceat(mix(gram + _U(1)), start)).view(np.int64)
            offsets = np.append(start, len(rec)).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(offsets), pa.array((gram >> _U(32)).astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(rec[start])), pa.array(cls), grams], ["id", "cls", "grams"])

    return run


def _least(share: float, size: Column) -> Column:
    """The least whole number that is at least ``share`` of ``size``; the margin is for fractions that aren't exact."""
    return F.ceil(size * share - 1e-9).cast("int")


def _classes(texts: DataFrame, width: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """All members ``id, rep`` and the sets ``id, grams`` of one representative per class (and of others).

    ``rep`` is the least ``id`` with the same set of shingles; only representatives are used further.
    """
    rows = texts.select(F.col("id").cast("long").alias("id"), "text").where("id is not null and text is not null")
    sets = scratch.cut(rows.mapInArrow(_shingle_sets(width), "id long, cls long, grams array<int>"))
    least = sets.groupBy("cls").agg(F.min("id").alias("rep"))
    members = scratch.cut(sets.select("id", "cls").join(least, "cls").select("id", "rep").distinct())
    return members, sets.select("id", "grams")


#: Parts of the segments that are indexed one after another, so that the keys of one part exist at once.
PARTS = 4
#: Passes over the candidate pairs: each moves that share of the sets, so fewer files exist at once.
PASSES = 2


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """The candidate pairs ``a, b`` whose sets are similar enough; rows repeated under one id make no difference."""
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    common = F.size(F.array_intersect("ga", "gb"))
    parts = []
    for k in range(PASSES):
        mine = lambda c: F.pmod(F.xxhash64(F.lit(1), F.col(c)), F.lit(PASSES)) == k  # noqa: B023, E731
        left = sets.where(mine("id")).select(F.col("id").alias("a"), F.col("grams").alias("ga"))
        both = pairs.where(mine("a")).join(left, "a").join(right, "b")
        parts.append(scratch.cut(both.where(common >= _least(threshold / (1 + threshold), F.size("ga") + F.size("gb"))).select("a", "b").distinct()))
    return parts[0].unionAll(parts[1])


def similar_classes(texts: DataFrame, width: int = 3, threshold: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """Members ``id, rep`` of all classes, and the pairs ``a, b`` of similar representatives, by prefixes.

    Of a pair, the larger set offers its first ``n - ceil(t n) + 1`` shingles and the smaller one its first
    ``n - ceil(2 t / (1 + t) n) + 1``; these have one in common. Sets of equal size compare by ``id``. A match
    counts only if what follows it in both sets can still make up the overlap.
    """
    scratch = Scratch(texts.sparkSession, "nearcopies")
    members, sets = _classes(texts, width, scratch)
    reps = members.where("id = rep").select("id")
    n = F.size("grams")
    short = sets.select("id", n.alias("n"), F.slice("grams", 1, n - _least(threshold, n) + 1).alias("first")).join(reps, "id", "left_semi")
    table = scratch.cut(short.select("id", "n", F.posexplode("first").alias("at", "gram")).select("gram", "id", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("at")).alias("w")))
    size, place = (lambda w: F.shiftright(w, 32).cast("int")), (lambda w: F.col(w).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    # Both sides have the same columns, so they read one exchange, and a hot shingle's partition can be split.
    big = table.select("gram", F.col("id").alias("a"), F.col("w").alias("wa"))
    small = table.select("gram", F.col("id").alias("b"), F.col("w").alias("wb"))
    na, nb, ia, ib = size("wa"), size("wb"), place("wa"), place("wb")
    need = _least(threshold / (1 + threshold), na + nb)
    fits = ((na > nb) | ((na == nb) & (F.col("a") > F.col("b")))) & (nb >= _least(threshold, na))
    early = ib <= nb - _least(2 * threshold / (1 + threshold), nb)
    # One condition on both sides: split, it would be pushed below the exchange and make two of it.
    match = big.join(small, "gram").where(F.when(fits, early & (F.least(na - ia, nb - ib) >= need)))
    pairs = scratch.cut(match.select("a", "b").distinct())
    scratch.drop(table)
    return members, _verified(pairs, sets, threshold, scratch)


def similar_pairs(texts: DataFrame, width: int = 3, threshold: float = 0.6) -> DataFrame:
    """All pairs ``a < b`` of different ``id`` whose sets of ``width``-word shingles have Jaccard >= ``threshold``.

    ``texts``: ``id`` (integer), ``text``; further columns are ignored. Words are runs of letters and digits of
    the lower-cased text. Null texts and those of fewer than ``width`` words have no pair; rows repeated under one
    ``id`` (with the same text) count once. Shingles are compared by 32-bit names: a pair's overlap is overstated
    with a chance of about the product of the set sizes over ``2**32``. Classes of equal sets are expanded into
    pairs at the end.
    """
    members, found = similar_classes(texts, width, threshold)
    x = members.select(F.col("rep").alias("a"), F.col("id").alias("x"))
    y = members.select(F.col("rep").alias("b"), F.col("id").alias("y"))
    across = found.join(x, "a").join(y, "b").select("x", "y")
    several = members.groupBy("rep").count().where("count > 1").select("rep")
    inner = members.join(several, "rep")
    within = inner.select("rep", F.col("id").alias("x")).join(inner.select("rep", F.col("id").alias("y")), "rep").where("x < y").select("x", "y")
    return across.unionAll(within).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _variants(threshold: float, part: int, parts: int, deletions: bool):
    """Keys of the segments of each set, for its own size class and for that of larger partners.

    Sizes fall into classes that grow by ``1 / threshold``; the larger set of a pair fixes the class ``c``. At most
    ``h = floor((1 - t) / (1 + t) * 2 * top(c))`` members differ, so among ``h // 2 + 1`` segments one differs by at
    most one: it is equal in both, or equal to the other's without one member. So the segments as they are meet those and, with
    ``deletions``, the ones with a member left out. The empty variant selects nothing and isn't indexed. Two sets could meet
    in it alone only if both have a segment of at most one member: such sets are also indexed by their prefixes
    (see ``similar_classes``). Only the segments of this ``part`` of ``parts`` are indexed.
    """
    step = math.log(1 / threshold)

    def size_class(n: np.ndarray) -> np.ndarray:
        return np.ceil(np.log(n) / step - 1e-9).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("grams")
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint32).astype(_U)
            counts = np.diff(lists.offsets.to_numpy())
            ids = b.column("id").to_numpy()
            rec = np.repeat(np.arange(len(counts)), counts)
            own = size_class(counts)
            keys, owners, weak = [], [], np.zeros(len(counts), bool)
            for ahead in (0, 1):
                c = own + ahead
                top = np.floor(np.exp(c * step) + 1e-6)
                segments = (np.floor((1 - threshold) / (1 + threshold) * 2 * top + 1e-9) // 2 + 1).astype(np.int64)
                spread = mix(flat + _U(0xA24BAED4963EE407))
                seg = (spread >> _U(33)).astype(np.int64) % segments[rec]
                first = np.concatenate([[0], np.cumsum(segments)])
                place = first[rec] + seg
                value = mix(flat * _U(0x9FB21C651E98DF25) + _U(7))
                inside = np.bincount(place, minlength=first[-1])
                with np.errstate(over="ignore"):
                    sums = np.zeros(first[-1], _U)
                    np.add.at(sums, place, value)
                    who = np.repeat(np.arange(len(counts)), segments)
                    number = np.arange(first[-1]) - first[who]
                    tag = mix(number.astype(_U) * _U(1 << 20) + c[who].astype(_U))
                    mine = number % parts == part
                    whole, left = (inside > 0) & mine, (inside[place] > 1) & mine[place] & deletions
                    keys += [mix(sums + tag)[whole], mix(sums[place] - value + tag[place])[left]]
                owners += [ids[who[whole]], ids[rec[left]]]
                weak |= np.bincount(who[inside < 2], minlength=len(counts)) > 0
            at = np.arange(len(flat)) - lists.offsets.to_numpy()[:-1][rec]
            early = (part == 0) & weak[rec] & (at <= counts[rec] - np.ceil(threshold * counts[rec] - 1e-9))
            keys.append(mix(flat[early] + _U(0xC2B2AE3D27D4EB4F)))
            owners.append(ids[rec[early]])
            key, owner = np.concatenate(keys).view(np.int64), np.concatenate(owners)
            for k in range(0, len(key), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(key[k : k + 100_000]), pa.array(owner[k : k + 100_000])], ["key", "id"])

    return run


def near_copies(texts: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per text with its group: ``id, rep, group, links``.

    ``rep`` is the least ``id`` with the same set of shingles, ``links`` the number of other classes that are
    similar to its class, ``group`` the least ``id`` that is linked directly or through others. Inputs and null
    handling as for ``similar_pairs``; texts too short for a shingle stand alone. By deletion variants.
    """
    scratch = Scratch(texts.sparkSession, "variants")
    members, sets = _classes(texts, width, scratch)
    one = scratch.cut(sets.join(members.where("id = rep").select("id"), "id", "left_semi"))
    found = []
    for part in range(PARTS):
        keys = lambda deletions, name: one.mapInArrow(_variants(threshold, part, PARTS, deletions), "key long, id long").withColumnRenamed("id", name)  # noqa: B023, E731
        met = keys(False, "x").join(keys(True, "y"), "key").where("x <> y")
        found.append(scratch.cut(met.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()))
    pairs = scratch.cut(reduce(lambda x, y: x.unionAll(y), found).distinct())
    scratch.drop(*found)
    links = _verified(pairs, one, threshold, scratch)
    groups = components(links.select(F.format_string("%020d", "a").alias("src"), F.format_string("%020d", "b").alias("dst")))
    groups = groups.select(F.col("node").cast("long").alias("rep"), F.col("group_node").cast("long").alias("group"))
    degree = links.select("a").unionAll(links.select("b")).groupBy(F.col("a").alias("rep")).agg(F.count("*").alias("links"))
    alone = texts.select(F.col("id").cast("long").alias("id")).where("id is not null").distinct().join(members, "id", "left")
    all_ = alone.select("id", F.coalesce("rep", "id").alias("rep")).join(groups, "rep", "left").join(degree, "rep", "left")
    return all_.select("id", "rep", F.coalesce("group", "rep").alias("group"), F.coalesce("links", F.lit(0)).alias("links"))
