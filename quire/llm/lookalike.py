"""One form for texts that look the same: skeletons of confusable characters.

A text is decomposed, every character is replaced by the prototype of its look-alike class, and the result is
decomposed again. Texts with the same skeleton look the same. The classes are those of the public table of confusable
characters, as Spark's own Unicode library has it, less what must stay distinct: visible accents, letter case, digits
against letters, and letters of one script.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quire.session import Scratch

# Signs, and letters of the Latin script itself that differ by a font at most, above what they look like.
OTHER = "ɑɡӏɩıℓ‐‑‒−ʼ՚‚․ᴏᴄᴠᴡᴢѵᴜօսհոցՕՏ"
OTHER_AS = "agliıl---−’’‚.ocvwzvuouhngOS"
#: Characters without width, besides the format characters.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍᠎᠏ㅤﾠ"
#: Format characters that are seen.
SEEN = frozenset([*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD, *range(0xFFF9, 0xFFFC)])
#: The letters that a reader of Greek or Cyrillic tells apart, from one to the other.
ALPHABETS = {"GREEK": "Αω", "CYRILLIC": "Ѐџ"}
#: Kinds of compatibility decomposition that don't change what is seen.
SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<noBreak>")


def _characters() -> Iterator[str]:
    for cp in range(0x20, 0x110000):
        if not 0xD800 <= cp < 0xF900 and unicodedata.category(chr(cp)) not in ("Cc", "Cn", "Co"):
            yield chr(cp)


def confusables(spark: SparkSession) -> dict[str, str]:
    """Prototype of every character that the public table of confusables maps to another one, decomposed."""
    checker = getattr(spark._jvm, "com.ibm.icu.text.SpoofChecker$Builder")().build()
    all_ = list(_characters())
    images = checker.getSkeleton("\n".join(all_)).split("\n")  # a line feed is its own prototype and keeps marks apart
    return {c: x for c, x in zip(all_, images, strict=True) if x != unicodedata.normalize("NFD", c)}


def _kind(c: str) -> str:
    """Letter of a case, other letter, digit, or other sign."""
    category = unicodedata.category(c)
    return {"Lu": "Lu", "Lt": "Lu", "Ll": "Ll", "Nd": "Nd"}.get(category, "L" if category[0] == "L" else category[0])


def _script(c: str) -> str:
    return unicodedata.name(c, "").split(" ")[0]


def prototypes(images: dict[str, str]) -> dict[str, str]:
    """What each character is folded to; ``images`` as of ``confusables``.

    Widths, fonts and spaces fold by their decomposition, format characters vanish. A letter folds to the letter of its class
    that stands for all: the ASCII one of its kind (class ``l``: I for capitals, 1 for digits), else the prototype, if that is a
    single letter of its kind from another script. Where several letters of one of ``ALPHABETS`` would fold to one letter, only
    that does with which the other case agrees. Ligatures and numerals fold to the letters that
    they are made of.
    """
    ascii_of: dict[str, list[str]] = defaultdict(list)
    for cp in range(0x21, 0x7F):
        ascii_of[images.get(chr(cp), chr(cp))].append(chr(cp))
    out: dict[str, str] = {}
    goals: dict[tuple[str, str, str], list[str]] = defaultdict(list)
    for c in _characters():
        if c < "\x80":
            continue
        category, plain = unicodedata.category(c), unicodedata.normalize("NFKD", c)
        how = unicodedata.decomposition(c).split(" ")[0]
        if category == "Zs":
            out[c] = " "
        elif category == "Cf" and ord(c) not in SEEN or 0xFE00 <= ord(c) <= 0xFE0F or 0xE0100 <= ord(c) <= 0xE01EF:
            out[c] = ""
        elif how in SAME_LOOK:
            out[c] = plain
        elif category[0] in "LN" and c in images:
            if how == "<compat>" and plain.isascii() and "".join(images.get(x, x) for x in plain) == images[c]:
                out[c] = plain
                continue
            like = [x for x in ascii_of.get(images[c], ()) if _kind(x) == _kind(c)] or ([x for x in ascii_of.get(images[c], ()) if x.isalpha()][:1] if _kind(c) in ("L", "N") else [])
            if not like and len(images[c]) == 1 and not images[c].isascii() and _kind(images[c]) == _kind(c):
                like = [images[c]]
            if like and _script(like[0]) != _script(c):
                goals[like[0], _script(c), _kind(c)].append(c)
    other = lambda x: x.lower() if x.isupper() else x.upper()
    for (to, script, _), letters in goals.items():
        first, last = ALPHABETS.get(script, "\0\0")
        agree = [c for c in letters if other(c) != c and images.get(other(c), other(c)) in (other(to), images.get(other(to)))]
        rivals = [c for c in letters if first <= c <= last]
        lost = [c for c in rivals if len(agree) != 1 or c not in agree] if len(rivals) > 1 else []
        out |= {c: to for c in letters if c not in lost}
    out |= {a: b for a, b in zip(OTHER, OTHER_AS, strict=True) if a != b}
    return out | dict.fromkeys(INVISIBLE, "")


_tables: dict[str, dict[str, str]] = {}


def table_of(spark: SparkSession) -> dict[str, str]:
    """The prototypes, built once on the driver; a few thousand entries, sent with the tasks."""
    if "" not in _tables:
        _tables[""] = prototypes(confusables(spark))
    return _tables[""]


class Skeleton:
    """Skeletons by a table of prototypes; the image of each character is kept."""

    def __init__(self, table: dict[str, str]):
        self.table = table
        self.images: dict[str, str] = {}

    def image(self, c: str) -> str:
        """Skeleton of one character: decomposed, replaced, decomposed again."""
        if c not in self.images:
            out = "".join(self.table.get(x, x) for x in unicodedata.normalize("NFD", self.table.get(c, c)))
            self.images[c] = unicodedata.normalize("NFD", out)
        return self.images[c]

    def __call__(self, text: str) -> str:
        """Skeleton of one text; plain ASCII is its own.

        The few different characters beyond ASCII are replaced one after another. Marks are put into canonical order
        at the end where the text had any of its own.
        """
        if text.isascii():
            return text
        marks = False
        for c in {c for c in set(text) if c > "\x7f"}:
            marks = marks or unicodedata.combining(c) > 0
            if (new := self.image(c)) != c:
                text = text.replace(c, new)
        return unicodedata.normalize("NFD", text) if marks else text

    def canonical(self, text: str) -> str:
        """The skeleton in composed form: the one consistent form of all texts that look like this one."""
        return unicodedata.normalize("NFC", self(text))


def with_canonical_text(docs: DataFrame, column: str = "text", to: str = "canonical") -> DataFrame:
    """``docs`` with the consistent form of ``column`` in ``to``; a null stays null, an empty text empty."""

    table = table_of(docs.sparkSession)

    @F.pandas_udf(StringType())
    def fold(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        skeleton = Skeleton(table)
        for texts in batches:
            yield texts.map(skeleton.canonical, na_action="ignore")

    return docs.withColumn(to, fold(F.col(column)))


def _digests(table: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton = Skeleton(table)
        for b in batches:
            texts = [t.as_py() for t in b.column("text")]
            skel = [blake2b(skeleton(t).encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
            own = [blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(skel, pa.binary()), pa.array(own, pa.binary())], ["doc_id", "skel", "own"])

    return run


def lookalike_classes(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, skel, own`` of the documents whose skeleton is shared by at least two different texts.

    ``skel`` and ``own`` are 128-bit digests. The test is a minimum and a maximum per skeleton, combined before
    the shuffle: copies of one text, however many, are never gathered. Null texts are left out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").where("text is not null").mapInArrow(_digests(table_of(docs.sparkSession)), f"doc_id {kind}, skel binary, own binary")
    rows = scratch.cut(rows)
    several = rows.groupBy("skel").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo <> hi").select("skel")
    return scratch.cut(rows.join(several, "skel").select("doc_id", "skel", "own"))


def lookalike_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, rep, forms``: of every document of ``lookalike_classes`` the least id that looks the same, and of how many texts.

    One row per document, however many look alike; nothing is paired.
    """
    members = lookalike_classes(docs, Scratch(docs.sparkSession, "lookalike"))
    sums = members.groupBy("skel", "own").agg(F.min("doc_id").alias("least")).groupBy("skel").agg(F.min("least").alias("rep"), F.count("*").alias("forms"))
    return members.join(sums, "skel").select("doc_id", "rep", "forms")


def lookalike_pairs(docs: DataFrame) -> DataFrame:
    """Pairs ``doc_a < doc_b`` of documents whose texts differ as stored but have the same skeleton.

    Texts are paired as classes of identical copies first and the classes expanded afterwards, so identical texts
    are never compared. Null texts have no pair; repeated ``doc_id`` of one text count once; further columns are
    ignored; an empty table gives no rows.
    """
    members = lookalike_classes(docs, Scratch(docs.sparkSession, "lookalike"))
    classes = members.select("skel", "own").distinct()
    a = classes.select("skel", F.col("own").alias("own_a"))
    b = classes.select("skel", F.col("own").alias("own_b"))
    pairs = a.join(b, "skel").where("own_a < own_b")
    left = members.select("skel", F.col("own").alias("own_a"), F.col("doc_id").alias("x"))
    right = members.select("skel", F.col("own").alias("own_b"), F.col("doc_id").alias("y"))
    found = pairs.join(left, ["skel", "own_a"]).join(right, ["skel", "own_b"]).where("x <> y")
    return found.select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b")).distinct()
