"""Scalar functions against vectors derived by hand."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions import alphabet, edits, nodes


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column).first()[0]


@pytest.mark.parametrize(
    ("name", "text", "codes"),
    [("eng", "Hello, World!", "SHAAYMYTAC"), ("fin", "Äiti", "WCDC"), ("fin", "baari", "BBPC"), ("eng_space", "no. 1 on", "WYXDDYW"), ("ENG", "", "")],
)
def test_encode(spark, name, text, codes):
    assert one(spark, alphabet.encode(F.col("t"), name), t=text) == codes


def test_unknown_alphabet():
    with pytest.raises(ValueError):
        alphabet.alphabet("klingon")


def test_register(spark):
    alphabet.register_alphabet("two", "ab", "XY")
    assert one(spark, alphabet.encode(F.col("t"), "two"), t="Abc") == "XY"
    with pytest.raises(ValueError):
        alphabet.register_alphabet("bad", "aa", "XY")


def test_mask_and_back(spark):
    assert one(spark, alphabet.mask(F.col("t")), t="Hq-o") == "hXXo"
    assert one(spark, alphabet.unencode(F.lit("SHAAYW"), "eng"), t="") == "hellon"
    assert one(spark, alphabet.normalised(F.col("t")), t=" A  b\n\tc ") == "a b c"


@pytest.mark.parametrize(
    ("start", "end", "text", "at"),
    [(1, 10, "ello, Worl", (1, 11)), (0, 10, "Hello, Worl", (0, 11)), (5, 6, ",", (5, 6)), (5, 8, ", Wo", (5, 9)), (1, 11, "ello, World", (1, 12)), (2, 3, None, None), (3, 2, None, None), (1, 99, None, None)],
)
def test_span(spark, start, end, text, at):
    raw = "Hello, World!"
    col = alphabet.span_of(alphabet.positions(F.col("t")), F.length("t"), F.lit(start), F.lit(end))
    found = one(spark, col, t=raw)
    assert (found and tuple(found)) == at
    if at:
        assert raw[slice(*at)] == text


def test_span_exact(spark):
    col = alphabet.span_of(alphabet.positions(F.col("t")), F.length("t"), F.lit(1), F.lit(10), "exact")
    assert tuple(one(spark, col, t="Hello, World!")) == (0, 12)


def test_node_strings(spark):
    assert one(spark, nodes.node_string(F.col("d"), F.lit(1), F.lit(2)), d="a") == "a___1_2"
    assert tuple(one(spark, nodes.parse_node(F.col("n")), n=" x__y___3_ 14")) == ("x__y", 3, 14)
    assert tuple(one(spark, nodes.parse_node(F.col("n")), n="nonsense")) == (None, None, None)
    assert one(spark, nodes.ascii_id(F.col("d")), d="aäb") == "ab"
    assert one(spark, nodes.old_form(F.col("n")), n="a_0_10___1_2") == "a__0_10___1_2"
    assert one(spark, nodes.old_form(F.col("n")), n="a___1_2_ext") == "a_ext___1_2"


def test_natural_order(spark):
    df = spark.createDataFrame([("d10",), ("d9",), ("d1b",), ("a",)], ["d"])
    assert [r.d for r in df.orderBy(nodes.natural_key(F.col("d"))).collect()] == ["a", "d1b", "d9", "d10"]


def test_edit_distances_of_many_pairs():
    """Texts that end before, at and behind the ends of words, far ones, empty ones, several alphabets at once."""

    def one_by_one(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng, pairs = random.Random(31), []
    for k in range(300):
        letters = ("ab", "abcdefghijklmnop", "abä€𝄞")[k % 3]
        a = [rng.choice(letters) for _ in range(rng.choice([0, 1, 62, 63, 126, 127, 190]) + rng.randrange(4))]
        b = list(a) if k % 4 else [rng.choice(letters) for _ in range(rng.randrange(200))]
        for _ in range(rng.randrange(50)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice(["", *letters])
        pairs.append(("".join(a), "".join(b), int(len(a) * rng.choice([0.05, 0.25, 0.5, 2]))))
    codes = [[np.frombuffer(p[i].encode("utf-32-le"), np.uint32) for p in pairs] for i in (0, 1)]
    want = [d if (d := one_by_one(a, b)) <= most else -1 for a, b, most in pairs]
    assert edits.distances(*codes, np.array([p[2] for p in pairs])).tolist() == want and 50 < sum(d >= 0 for d in want) < 290
    assert edits.distances([], [], np.zeros(0, int)).tolist() == []
