"""Reduced alphabets and the way back from encoded offsets to the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of each alphabet and what they are encoded as, position by position.
ALPHABETS: dict[str, tuple[str, str]] = {
    "fin": ("ävaismdheufwoyljnrkptz", "WVBCHNZSGKWYITFREPMQDX"),
    "eng": ("untbdgfsmwipoehrlkcayjv", "EWRVCZNFKMGIYHSTAXBWQDP"),
    "eng_space": ("oatfwhlvy erispcbmdgu.n", "YWRNMSAPQDHTGFIBVKCZEXW"),
}


def register_alphabet(name: str, letters: str, codes: str) -> None:
    """Add or replace an alphabet: lower-case ``letters`` and their upper-case ``codes``, position by position."""
    if len(letters) != len(codes) or len(set(letters)) != len(letters) or letters != letters.lower() or codes != codes.upper():
        raise ValueError("an alphabet needs different lower-case letters and as many upper-case codes")
    ALPHABETS[name.lower()] = (letters, codes)


def alphabet(name: str) -> tuple[str, str]:
    """Letters and codes of an alphabet; the name's case doesn't matter, an unknown one is an error."""
    try:
        return ALPHABETS[name.lower()]
    except KeyError:
        raise ValueError(f"no alphabet {name!r}; known: {', '.join(ALPHABETS)}") from None


def _class(letters: str) -> str:
    return "[^" + "".join("\\" + c if c in "\\]^-[&." else c for c in letters) + "]"


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def encode(text: Column, name: str = "eng", preprocess: bool = False) -> Column:
    """Encoded text: lower-cased, letters outside the alphabet dropped, the others replaced by their codes."""
    letters, codes = alphabet(name)
    return F.translate(F.regexp_replace(normalised(text) if preprocess else F.lower(text), _class(letters), ""), letters, codes)


def mask(text: Column, name: str = "eng") -> Column:
    """Lower-cased text with ``X`` for every letter outside the alphabet."""
    return F.regexp_replace(F.lower(text), _class(alphabet(name)[0]), "X")


def soft_masked(encoded: Column, name: str = "eng_space", letter: str = " ") -> Column:
    """Encoded text with the code of ``letter`` in lower case: alignments may cross it, but shouldn't start there."""
    letters, codes = alphabet(name)
    code = codes[letters.index(letter)]
    return F.translate(encoded, code, code.lower())


def unencode(encoded: Column, name: str = "eng") -> Column:
    """Letters for codes, the first letter of the alphabet where several share a code: the loss stays."""
    letters, codes = alphabet(name)
    first: dict[str, str] = {}
    for c, k in zip(letters, codes, strict=True):
        first.setdefault(k, c)
    return F.translate(encoded, "".join(first), "".join(first.values()))


def positions(text: Column, name: str = "eng") -> Column:
    """0-based offset in the lower-cased text of every encoded letter."""
    letters = F.lit(alphabet(name)[0])
    marked = F.transform(F.split(F.lower(text), ""), lambda c, i: F.when((c != "") & (F.instr(letters, c) > 0), i))
    return F.filter(marked, lambda i: i.isNotNull())


def span_of(where: Column, size: Column, start: Column, end: Column, mode: str = "compat") -> Column:
    """Raw offsets ``struct(i0, i1)``, end exclusive, of an encoded span; null where it can't be told.

    ``where``: the ``positions`` of the text, ``size``: its length. In ``compat`` mode ``start`` letters are skipped
    and the span ends before the letter ``end``, as the alignments' offsets are used in clusters: it begins at once
    behind the letter ``start`` and lacks the last letter. ``exact`` mode takes ``start`` and ``end`` as 1-based and
    inclusive and gives exactly these letters and what stands between them.
    """
    at = lambda k: F.try_element_at(where, F.when(k > 0, k.cast("int")))
    if mode == "exact":
        i0, i1 = at(start), at(end) + 1
        return F.when(i0.isNotNull() & i1.isNotNull() & (start <= end), F.struct(i0.cast("int").alias("i0"), i1.cast("int").alias("i1")))
    a, b = start, end - 1
    i0 = F.when((a == 0) & (size > 0), F.lit(0)).when(a > 0, at(a) + 1)
    i0 = F.when(i0 < size, i0)
    next_letter = at(a + 1)
    i1 = F.when(b > a, at(b) + 1).when((b == a) & (next_letter.isNull() | (next_letter != i0)), i0 + 1)
    i1 = F.when(i1 < size, i1)
    return F.when(i0.isNotNull() & i1.isNotNull(), F.struct(i0.cast("int").alias("i0"), i1.cast("int").alias("i1")))
