"""Repair of text that was decoded with another encoding than it was written in.

Characters are mapped back to the bytes of a legacy encoding. Where these bytes form maximal well-formed multibyte
spans, which a byte-structure automaton (a regular expression per encoding) finds, exactly those spans are decoded
anew; spans may be wrapped several times. A span counts if what it decodes to is text by its characters' categories and
scripts, and isn't what two or three sound characters may look like by chance: see ``_belief``.

Two kinds of damage have no multibyte structure and are found by words: single-byte text read with another
single-byte encoding (a word counts if it becomes a known word), and replacement characters (the original is
restored where exactly one known word fits).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Encodings that multibyte text is read with by mistake, in the order in which they are tried.
CODECS = ("cp1252", "cp437", "cp850", "cp1251", "mac_roman")
#: Pairs (written, read) of single-byte encodings.
SINGLE = (("cp1252", "mac_roman"),)
# Letters and signs that are believed wherever they come out, in Cyrillic surroundings too.
LETTERS = "äöåÄÖÅéèêëàâçùûüîïôœæøñáíóúßÉÈÊËÀÂÇÙÛÜÎÏÔŒÆØÑÁÍÓÚÿŸ"
SIGNS = "“”‘’‚„«»‹›–—…°£½¼¾§·€¢¥©®™±×\xa0\xad•"
FRACTIONS = "½¼¾"
#: Letters that are never what a wrongly read single byte looks like, as the languages at hand have them.
OWN = "ßäöåéüç"
LAYERS = 3

_ORDINARY = frozenset(LETTERS + SIGNS)
_LATIN1 = frozenset(c for c in map(chr, range(0xC0, 0x100)) if c.isalpha())


def _group(c: str) -> str:
    """Script of a letter (Latin beyond Latin-1 apart), else its general category."""
    category = unicodedata.category(c)
    if category[0] not in "LM":
        return category
    script = unicodedata.name(c, "").split(" ")[0]
    if script in ("CJK", "HIRAGANA", "KATAKANA", "HANGUL"):
        return "EAST ASIAN"
    if script == "LATIN" and c > "ÿ" and c not in _ORDINARY:
        return "EXTENDED" if c < "ɐ" or "Ḁ" <= c <= "ỿ" else "PHONETIC"
    return script


def _belief(out: str, codec: str, before: str, span: str, after: str) -> tuple[int, str]:
    """Whether a decoded span is text: 2 yes, 1 if the same text has a sure one of the same group, 0 no; and its group.

    A single pair of sound characters may look like a wrongly read one: a capital letter and a quotation mark, say. So one
    letter of a further script, or of the Latin one beyond Latin-1, is sure only inside a word of small letters, if
    what stands for it doesn't begin with a space; two letters of one script side by side are sure.
    """
    if any(unicodedata.category(c)[0] == "C" and c != "\xad" for c in out):
        return 0, ""
    odd = [c for c in out if c not in _ORDINARY and not (c in _LATIN1 and codec != "cp1251")]
    groups = {_group(c) for c in odd}
    if not odd:
        return 2, "LATIN"
    if len(groups) > 1 and not all(c > "\U0001f000" or unicodedata.category(c) in ("Mn", "Cf") for c in odd):
        return 0, ""
    group = _group(odd[0])
    if all(c > "\U0001f000" for c in odd):
        return 2, group
    if not odd[0].isalpha():
        return 1, "LATIN"
    if sum(map(str.isalpha, out)) > 1 or group == "EXTENDED" and before.islower() and after.islower() and not span[:1].isspace():
        return 2, group
    return 1, group


@lru_cache(16)
def _bytes_of(codec: str) -> dict[str, int]:
    """Byte of each non-ASCII character; bytes that the encoding leaves open are the control characters."""
    out = {}
    for b in range(0x80, 0x100):
        out[chr(b) if codec == "cp1252" else ""] = b
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    out.pop("", None)
    return out


@lru_cache(16)
def automaton(codec: str) -> tuple[re.Pattern, re.Pattern]:
    """Maximal runs of well-formed multibyte sequences, and single sequences, in the characters of ``codec``."""
    table = _bytes_of(codec)
    # For cp1252, a control character and the letter of the same byte may both stand for it.
    of = lambda a, b: "[" + "".join(re.escape(c) for c, x in table.items() if a <= x <= b) + "]"
    tail = of(0x80, 0xBF)
    two, three, four = of(0xC2, 0xDF) + tail, of(0xE0, 0xEF) + tail * 2, of(0xF0, 0xF4) + tail * 3
    one = f"(?:{two}|{three}|{four})"
    return re.compile(f"{one}+"), re.compile(one)


def _decoded(span: str, codec: str) -> str | None:
    table = _bytes_of(codec)
    try:
        return bytes(table[c] for c in span).decode("utf-8")
    except UnicodeDecodeError:
        return None


def _restored(span: str, codec: str, layers: int, before: str, after: str) -> tuple[str, int, str] | None:
    """What ``span`` was before, with the belief in it and its group; None if that isn't text."""
    out = _decoded(span, codec)
    if out is None:
        return None
    if layers > 1 and (deeper := _one_layer(out, ("cp1252",), layers - 1, [])) != out and all(c < "\x80" or _belief(c, codec, "", "", "")[0] for c in deeper):
        return deeper, 2, _group(deeper[0])
    belief, group = _belief(out, codec, before, span, after)
    return (out, belief, group) if belief else None


def _one_layer(text: str, codecs: tuple[str, ...], layers: int, log: list[tuple[str, str, str]]) -> str:
    # The encoding whose automaton covers the most goes first.
    covered = {codec: sum(m.end() - m.start() for m in automaton(codec)[0].finditer(text)) for codec in codecs}
    for codec in sorted((c for c in codecs if covered[c]), key=lambda c: -covered[c]):
        runs, single = automaton(codec)
        found: list[tuple[int, int, str, int, str]] = []

        def add(m: re.Match, codec: str = codec, found: list = found) -> bool:
            before, after = m.string[max(0, m.start() - 1) : m.start()], m.string[m.end() : m.end() + 1]
            got = _restored(m[0], codec, layers, before, after)
            if got is None or codec == "cp1251" and got[0] in FRACTIONS and (before.isalpha() or after.isalpha()):
                return False  # two letters of a word, perhaps
            found.append((m.start(), m.end(), *got))
            return True

        for m in runs.finditer(text):
            if not add(m):
                for one in single.finditer(text, m.start(), m.end()):
                    add(one)
        sure = {group for *_, belief, group in found if belief > 1}
        parts, at = [], 0
        for a, b, new, belief, group in found:
            if belief > 1 or group in sure:
                log.append((codec, text[a:b], new))
                parts += [text[at:a], new]
                at = b
        text = "".join(parts) + text[at:]
    return text


@lru_cache(16)
def _reread(written: str, read: str) -> tuple[dict[int, str], re.Pattern]:
    """Character that each wrongly read one was, and a pattern for any of these."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            was, seen = bytes([b]).decode(written), bytes([b]).decode(read)
        except UnicodeDecodeError:
            continue
        if was != seen and seen.lower() not in OWN and (was in LETTERS or was in "“”‘’–—½°"):
            table[seen] = was
    return {ord(k): v for k, v in table.items()}, re.compile("[" + "".join(map(re.escape, table)) + "]")


_EDGE = re.compile(r"^\W+|[’']s\W*$|\W+$")


def _core(word: str) -> str:
    return _EDGE.sub("", _EDGE.sub("", word.lower()))


class Repairer:
    """Repairs one text after another; ``words`` are the known lower-case words of all languages."""

    def __init__(self, words: frozenset[str]):
        self.words = words
        self.by_length: dict[int, list[str]] = {}
        for w in words:
            if not w.isascii():
                self.by_length.setdefault(len(w), []).append(w)
        self.seen: dict[str, str | None] = {}

    def _single(self, text: str, log: list) -> str:
        for written, read in SINGLE:
            table, suspect = _reread(written, read)
            if not suspect.search(text):
                continue

            def word(m: re.Match, table: dict = table, suspect: re.Pattern = suspect) -> str:
                old = m[0]
                if not suspect.search(old):
                    return old
                if old in self.seen:
                    new = self.seen[old]
                else:
                    new = old.translate(table)
                    was, now = _core(old), _core(new)
                    good = was not in self.words and (now in self.words if now else len(old.strip(".,;:")) == 1 and new.strip(".,;:") in ("—", "–"))
                    # A closing possessive in place of a letter, and quotation marks in place of letters at both ends.
                    good = good or (was not in self.words and bool(re.fullmatch(r"\W*[^\W\d_]{2,}ís\W*|ì[\x21-\x7e]+î[.,;:]?", old)))
                    self.seen[old] = new = new if good else None
                if new is None:
                    return old
                log.append((read, old, new))
                return new

            text = re.sub(r"\S+", word, text)
        return text

    def _guess(self, m: re.Match) -> str:
        """The word with one or more lost characters, if one known word fits; a lost sign stays."""
        old = m[0]
        if old not in self.seen:
            low = old.lower()
            fits = [w for w in self.by_length.get(len(low), ()) if all(a == b or (a == "�" and b > "\x7f") for a, b in zip(low, w, strict=True))]
            new = fits[0] if len(fits) == 1 else None
            self.seen[old] = old if new is None else new.upper() if old.isupper() else new.capitalize() if old[0].isupper() else new
        return self.seen[old]

    def repair(self, text: str) -> tuple[str, list[tuple[str, str, str]]]:
        """The text as it was, where that can be told, and what was changed: (read as, span, original)."""
        if text.isascii():
            return text, []
        log: list[tuple[str, str, str]] = []
        out = _one_layer(text, CODECS, LAYERS, log)
        # A byte that the encoding leaves open was dropped: the third of a closing quotation mark.
        if "â€" in out:
            log += [("cp1252", "â€", "”")] * out.count("â€")
            out = out.replace("â€", "”")
        if not log or all(x[0] == "mac_roman" for x in log):
            out = self._single(out, log)
        if "�" in out:
            log += [("utf-8", "�", "")] * out.count("�")
            out = re.sub(r"[^\W\d_]*(?:�[^\W\d_]*)+", self._guess, out)
        return out, log


def repair_encoding(docs: DataFrame, words: frozenset[str]) -> DataFrame:
    """``doc_id, spans, read_as, restored`` of every text with at least one wrongly decoded stretch.

    ``docs``: ``doc_id``, ``text``; further columns are ignored. ``words``: known lower-case words, a fixed list.
    ``spans`` counts the stretches, ``read_as`` names the encodings they were read with, ``restored`` is the whole
    text with them decoded anew; what can't be told stays as it is. Null, empty and sound texts give no row.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fix = Repairer(words)
        for f in frames:
            rows = []
            for doc, text in zip(f["doc_id"], f["text"], strict=True):
                new, log = fix.repair(text)
                if log:
                    rows.append((doc, len(log), ",".join(sorted({x[0] for x in log})), new))
            if len(fix.seen) > 200_000:
                fix.seen.clear()
            yield pd.DataFrame(rows, columns=["doc_id", "spans", "read_as", "restored"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    odd = docs.select("doc_id", "text").where(F.col("text").rlike(r"[^\x00-\x7f]"))
    return odd.mapInPandas(run, f"doc_id {kind}, spans int, read_as string, restored string")
