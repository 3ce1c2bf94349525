"""Repair of text from scanned pages: broken words, misread letters, running headers and page numbers.

Words are looked up in a vocabulary trie that is intersected with a weighted Levenshtein automaton: a known
confusion of a scanner costs 1, any other substitution, insertion or deletion 2, and all words within the bound are
found. A word is misread if known confusions explain it, or if it differs in any one letter from just one known word.
Candidates are ranked by cost, then by how often the same text and the language have them. Page furniture, by its form
or because it recurs from page to page, is taken out, words broken at line and page ends are joined, and hard-wrapped lines
are reflowed into paragraphs.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What scanners read, and what was printed.
CONFUSIONS = {
    "c": ("e",), "o": ("a",), "!": ("i",), "f": ("t",), "u": ("n",), "0": ("o",), "n": ("u",), "1": ("l",), "b": ("h",), "ſ": ("s",), "5": ("s",),
    "rn": ("m",), "cl": ("d",), "9": ("g",), "e": ("c",), "m": ("in",), "h": ("b", "li"), "6": ("ö", "é"), "y": ("v",), "vv": ("w",), "2": ("z",), "8": ("b",), "ii": ("u",), "ë": ("è",), "í": ("ê",),
}
#: Lost accents: no sign of a scan by themselves, as spellings vary too.
ACCENTS = {"a": ("ä",), "è": ("é",)}
#: Signs at the end of a line that break a word, and those of them that compound words don't have.
HYPHENS, BREAKS_ONLY = "-¬–\xad=", "¬–\xad="
MONTHS = "january february march april may june july august september october november december".split()
#: A word that isn't in the lexicon is known if this share of its language's documents, and so many, have it.
SHARE, LEAST_DOCS = 0.015, 5
BOUND = 2
#: So many pages make a line that recurs a header, and numbers that count on the numbers of pages.
PAGES = 3

_TOKEN = re.compile(r"[^\s“”\".,;:—()’'\-¬–\xad£½°\[\]|/?=«»…]+")
_BREAK = re.compile(rf"(?<=[\w!])([{re.escape(HYPHENS)}]) ?\r?\n\s*(?=[^\W_])")
_TAIL = re.compile(r"[\w!]+")
_NUMBER_LINE = re.compile(r"(?m)^[ \t]*(?:\d{1,3}|\[Page \d{1,3}\]|p\. \d{1,3}|— \d{1,3} —)[ \t]*\r?$")
_HEADER_LINE = re.compile(
    r"(?m)^[ \t]*(?:\d{1,3} [^a-z\n]{4,60} — [^a-z\n]{3,9} \d{1,2}, \d{4}|[^\n|]{4,50} \| [ivxlc]*|(?=[^\W\d_])[^a-z\n]{6,50}[^\W\d_]\. \d{1,3}|(?:\S ){3,}\S {2,4}(?:\S ){2,}\S)[ \t]*\r?$"
)
_COUNT = re.compile(r"(?:[\W_]|\b(?:page|pag|p|seite|s|sid|sidan|sivu|стр|с)\b\.?)*(?P<n>\d{1,6})(?:\s*(?:of|/|von|av|sur|из)\s*\d{1,6})?[\W_]*", re.IGNORECASE)
_DATED_LINE = re.compile(r"(?m)^[ \t]*([^\W\d_]\S+ \S+), (\S{3,9}) \d{4}\.[ \t]*\r?$")


class Trie:
    """Vocabulary trie; ``search`` intersects it with the automaton of a misread word."""

    def __init__(self, words):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def search(self, token: str, confusions: dict[str, tuple[str, ...]], bound: int = BOUND, any_edit: bool = False) -> dict[str, int]:
        """All words that ``token`` may be a misreading of, with their least cost."""
        out: dict[str, int] = {}
        n = len(token)
        todo = [(self.root, 0, 0)]
        least: dict[tuple[int, int], int] = {}  # of each state, a node and a position
        while todo:
            node, i, cost = todo.pop()
            if least.get((id(node), i), bound + 1) <= cost:
                continue
            least[id(node), i] = cost
            if i == n:
                if "" in node and cost < out.get(node[""], bound + 1):
                    out[node[""]] = cost
            elif token[i] in node:
                todo.append((node[token[i]], i + 1, cost))
            if cost < bound:
                for size in (1, 2):
                    for true in confusions.get(token[i : i + size], ()) if i + size <= n else ():
                        at = node
                        for c in true:
                            at = at.get(c)
                            if at is None:
                                break
                        if at is not None:
                            todo.append((at, i + size, cost + 1))
                if any_edit and cost + 2 <= bound:
                    if i < n:
                        todo.append((node, i + 1, cost + 2))
                    for c, child in node.items():
                        if c:
                            todo.append((child, i, cost + 2))
                            if i < n and c != token[i]:
                                todo.append((child, i + 1, cost + 2))
        out.pop(token, None)
        return out


def _mend(body: str, joins) -> tuple[str, int]:
    """``body`` with the broken words joined for which ``joins(sign, word)`` holds, and their number."""
    out, at, count = [], 0, 0
    for m in _BREAK.finditer(body):
        first = m.start()
        while first > at and (body[first - 1].isalnum() or body[first - 1] in "_!"):
            first -= 1
        head, tail = body[first : m.start()], _TAIL.match(body, m.end())
        if tail and any(map(str.isalpha, head)) and any(map(str.isalpha, tail[0])) and joins(m[1], head + tail[0]):
            out.append(body[at : m.start()])
            at = m.end()
            count += 1
    return "".join(out) + body[at:], count


def _alike(a: str, b: str) -> bool:
    """Same name but for a few misread characters."""
    a, b = (re.sub(r"[\W_]", "", x).lower() for x in (a, b))
    return bool(b) and len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) <= len(b) // 4


def _repeated(text: str) -> list[tuple[int, int]]:
    """Spans of the lines that recur from page to page, and of the numbers that count the pages.

    A header stands at the edge of a paragraph each time and is the same but for its digits, on ``PAGES`` pages at least. Page
    numbers, whatever stands around them, count on from one to the next, so many at least.
    """
    lines = [(m.start(), m.end(), m[0].strip()) for m in re.finditer(r"(?m)^.*$", text)]
    numbers = [(k, int(m["n"])) for k, (_, _, x) in enumerate(lines) if x and (m := _COUNT.fullmatch(x))]
    out: set[int] = set()
    chain, counts = [], []  # lines and their numbers, which ascend
    for k, n in numbers:
        after = bisect_left(counts, n)
        if after and n - counts[after - 1] <= 2:
            del chain[after:], counts[after:]
        elif len(chain) < PAGES:
            chain, counts = [], []
        else:
            continue
        chain.append(k), counts.append(n)
        if len(chain) >= PAGES:
            out |= set(chain[-PAGES:])
    places: dict[str, list[int]] = {}
    for k, (_, _, x) in enumerate(lines):
        if len(x) > 3 and not x.endswith((".", ",", ";", "!", "?")):
            places.setdefault(re.sub(r"[\W\d_]+", " ", x).strip().lower(), []).append(k)
    edge = lambda k: not 0 < k < len(lines) - 1 or not lines[k - 1][2] or not lines[k + 1][2] or k - 1 in out or k + 1 in out
    for name, at in places.items():
        if name and len(at) >= PAGES and all(b - a > 2 for a, b in zip(at, at[1:], strict=False)) and all(map(edge, at)):
            out |= set(at)
    return [lines[k][:2] for k in sorted(out)]


def furniture(text: str, title: str | None) -> list[tuple[int, int]]:
    """Spans of the lines that are page numbers or running headers; ``title`` is the record's own, if known."""
    out = _repeated(text) if text.count("\n") > 2 * PAGES else []
    out += [m.span() for m in _NUMBER_LINE.finditer(text)] + [m.span() for m in _HEADER_LINE.finditer(text)]
    for m in _DATED_LINE.finditer(text):
        if m[2].lower() in MONTHS or (title and _alike(m[1], title)):
            out.append(m.span())
    if title:
        size = len(title)
        for m in re.finditer(r"(?m)^.+$", text) if title[:1] in text or title[-1:] in text else ():
            if abs(len(m[0].strip()) - size) <= 1 and _alike(m[0], title):
                out.append(m.span())
    return sorted(set(out))


class Reader:
    """Finds and repairs the noise of one text after another.

    ``lexicon``: known words by language; ``common``: share of documents by (language, word) for further words.
    """

    def __init__(self, lexicon: dict[str, frozenset[str]], common: dict[tuple[str, str], float]):
        self.lexicon = lexicon
        self.share = common
        self.words = {k: v | {w for lang, w in common if lang == k} for k, v in lexicon.items()}
        self.tries = {k: Trie(v) for k, v in self.words.items()}
        self.cache: dict[tuple[str, str], tuple[str | None, bool]] = {}
        self.near: dict[tuple[str, str], str | None] = {}
        self.off: dict[tuple[str, str], str | None] = {}
        self.letters = {k: set("".join(v)) for k, v in lexicon.items()}
        self.parts: dict[tuple[str, str, bool], bool] = {}

    def language(self, words: set[str]) -> str | None:
        """Language with most of the words; None if no more than two are known."""
        count, best = max((len(words & v), k) for k, v in self.lexicon.items())
        return best if count > 2 else None

    def misread(self, lang: str, token: str) -> tuple[str | None, bool]:
        """The likely word behind an unknown token, and whether more than accents differ."""
        key = (lang, token)
        if key not in self.cache:
            if len(self.cache) > 300_000:
                self.cache.clear()
            trie = self.tries[lang]
            found, sure = trie.search(token, CONFUSIONS, BOUND if len(token) > 5 else 1), True
            if not found:
                found, sure = trie.search(token, CONFUSIONS | {k: CONFUSIONS.get(k, ()) + v for k, v in ACCENTS.items()}, BOUND if len(token) > 5 else 1), False
                if found and len({c for c in token if c in ACCENTS}) and not trie.search(token, ACCENTS, BOUND):
                    sure = True  # an accent and a confusion
            best = min(found, key=lambda w: (found[w], -self.share.get((lang, w), 0.0), w)) if found else None
            self.cache[key] = (best, sure)
        return self.cache[key]

    def only_near(self, lang: str, token: str) -> str | None:
        """The one known word within the bound of any edits, if there is just one."""
        key = (lang, token)
        if key not in self.near:
            if len(self.near) > 300_000:
                self.near.clear()
            found = self.tries[lang].search(token, CONFUSIONS, BOUND, any_edit=True)
            self.near[key] = next(iter(found)) if len(found) == 1 else None
        return self.near[key]

    def one_letter_off(self, lang: str, token: str) -> str | None:
        """The known word from which ``token`` differs in one letter, and not by an accent, if the automaton for any edits finds just that one."""
        key = (lang, token)
        if key not in self.off:
            if len(self.off) > 300_000:
                self.off.clear()
            found = [w for w, cost in self.tries[lang].search(token, {}, BOUND, any_edit=True).items() if cost == BOUND and len(w) == len(token)]
            sure = len(found) == 1 and set(token) <= self.letters[lang] and _bare(found[0]) != _bare(token)
            self.off[key] = found[0] if sure else None
        return self.off[key]

    def part_of_word(self, lang: str, token: str, first: bool) -> bool:
        """Whether a token at the edge of a cut text may be the end (``first``) or the beginning of a known word."""
        key = (lang, token, first)
        if key not in self.parts:
            self.parts[key] = any(w.endswith(token) if first else w.startswith(token) for w in self.words[lang])
        return self.parts[key]

    def signs(self, text: str, title: str | None, cut: bool = False) -> dict:
        """What is noise in one text: furniture, broken words, misread words (surely, or by accents alone).

        ``cut``: the text was cut out of another, so its first and last word may be incomplete.
        """
        cuts = furniture(text, title)
        body = _without(text, cuts)
        lang = self.language(set(_TOKEN.findall(body.lower())))
        known = self.words.get(lang, frozenset())
        body, broken = _mend(body, self._joins(lang))
        wrong: list[tuple[str, str]] = []
        accents = 0
        if lang:
            if not body.isascii():
                body = unicodedata.normalize("NFC", body)
            tokens = _TOKEN.findall(body.lower())
            odd = set(tokens) - known
            odd = {t for t in odd if len(t) > 2 and not t.isdigit() and (t.isalpha() or _digits_inside(t)) and t not in MONTHS}
            if odd:
                guess = {t: self.misread(lang, t) for t in odd}
                # Names and words of other languages differ from known ones too: any other letter counts only in a word of four
                # or more that isn't written with a capital.
                small = {t for t in set(_TOKEN.findall(body)) if len(t) > 3 and t.isalpha() and t.islower()}
                guess |= {t: (w, True) for t, (x, _) in guess.items() if x is None and t in small and (w := self.one_letter_off(lang, t))}
                lost = {t for t, (w, _) in guess.items() if w is None}
                for k, t in enumerate(tokens):
                    if t in guess and t not in lost:
                        if cut and k in (0, len(tokens) - 1) and self.part_of_word(lang, t, k == 0):
                            continue
                        if lost and sum(x in lost for x in tokens[max(0, k - 6) : k + 7]) > 1:
                            continue  # foreign words around it
                        w, sure = guess[t]
                        wrong.append((t, w))
                        accents += not sure
        return {"furniture": cuts, "broken": broken, "misread": len(wrong) - accents, "accents": accents, "wrong": dict(wrong), "lang": lang}

    def _joins(self, lang: str | None):
        """Test of whether a sign at the end of a line breaks a word: a hyphen may belong to a compound."""
        known = self.words.get(lang, frozenset())

        def test(sign: str, word: str) -> bool:
            if sign in BREAKS_ONLY:
                return True
            low = unicodedata.normalize("NFC", word.lower())
            return low in known or (lang is not None and self.misread(lang, low)[0] is not None)

        return test

    def noisy(self, found: dict) -> bool:
        """Whether a text has a sign of a scan; a single lost accent is a spelling."""
        return bool(found["furniture"]) or found["broken"] > 0 or found["misread"] > 0 or found["accents"] > 1

    def repair(self, text: str, title: str | None, cut: bool = False) -> tuple[str, dict]:
        """The text in continuous paragraphs, and what was found; a text without noise comes back reflowed only."""
        found = self.signs(text, title, cut)
        lang = found["lang"]
        known = self.words.get(lang, frozenset())
        body = _without(text, found["furniture"])
        body, _ = _mend(body, self._joins(lang))
        body = re.sub(r"\r\n?", "\n", body)
        body = re.sub(r"(?<!\n)[ \t]*\n[ \t]*(?!\n)", " ", body)
        body = re.sub(r"\n[ \t]*\n\s*", "\n\n", body).strip()
        if self.noisy(found) and lang:
            here = Counter(_TOKEN.findall(body.lower()))
            wrong = found["wrong"]

            def fix(m: re.Match) -> str:
                low = unicodedata.normalize("NFC", m[0].lower())
                if low in wrong:
                    new = self._in_context(lang, low, here)
                elif len(low) > 4 and low.isalpha() and low not in known:
                    new = self.only_near(lang, low)
                else:
                    return m[0]
                if not new:
                    return m[0]
                return new.upper() if m[0].isupper() and len(m[0]) > 1 else new.capitalize() if m[0][0].isupper() else new

            body = _TOKEN.sub(fix, body)
        return body, found

    def _in_context(self, lang: str, token: str, here: Counter) -> str | None:
        found = self.tries[lang].search(token, CONFUSIONS | {k: CONFUSIONS.get(k, ()) + v for k, v in ACCENTS.items()}, BOUND if len(token) > 5 else 1)
        return min(found, key=lambda w: (found[w], -here[w], -self.share.get((lang, w), 0.0), w)) if found else None


def _bare(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


def _digits_inside(token: str) -> bool:
    """A word with signs or digits in place of letters; numbers with a unit and ordinals aren't."""
    return sum(c.isalpha() for c in token) * 2 >= len(token) and all(c.isalpha() or c in CONFUSIONS for c in token)


def _without(text: str, cuts: list[tuple[int, int]]) -> str:
    """Text without the lines of furniture; what stood on both sides of a page end becomes one paragraph again."""
    if not cuts:
        return text
    out, at = "", 0
    for a, b in cuts:
        if a < at:
            continue
        out += text[at:a]
        at = b + 1 if text[b : b + 1] == "\n" else b
        if out and not re.search(r"[.!?:”\"]\s*$", out):
            out = out.rstrip("\r\n") + "\n"
            while text[at : at + 1] in ("\n", "\r") and at < len(text):
                at += 1
    return out + text[at:]


def _counts(lexicon: dict[str, frozenset[str]]):
    """Documents per language and unknown word, summed over each batch; the word '' counts the documents."""
    reader = Reader(lexicon, {})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sums: Counter = Counter()
            for text in f["text"]:
                body = _BREAK.sub("\0", text.lower())  # no word holds a broken one
                if not body.isascii():
                    body = unicodedata.normalize("NFC", body)
                words = set(_TOKEN.findall(body))
                if lang := reader.language(words):
                    sums[lang, ""] += 1
                    sums.update((lang, w) for w in words - lexicon[lang] if w.isalpha() and len(w) > 2)
            yield pd.DataFrame([(*k, v) for k, v in sums.items()], columns=["lang", "word", "n"])

    return run


def common_words(docs: DataFrame, lexicon: dict[str, frozenset[str]]) -> dict[tuple[str, str], float]:
    """Words beyond the lexicon with their share of the documents of their language, over all documents.

    A word needs the share ``SHARE``, so there are at most (mean words of a document) / ``SHARE`` per language,
    whatever the number of documents: the list may be collected.
    """
    sums = docs.select("text").where("text <> ''").mapInPandas(_counts(lexicon), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    total = sums.where("word = ''").select("lang", F.col("n").alias("docs"))
    known = sums.where(f"word <> '' and n >= {LEAST_DOCS}").join(F.broadcast(total), "lang").where(F.col("n") >= SHARE * F.col("docs"))
    return {(r.lang, r.word): r.n / r.docs for r in known.collect()}


def scan_noise(records: DataFrame, lexicon: dict[str, frozenset[str]], common: dict[tuple[str, str], float], repaired: bool = False) -> DataFrame:
    """Records whose text holds noise of a scan.

    ``records``: ``record_kind``, ``record_id``, ``text``, ``title``; further columns are ignored. Texts of another kind
    than ``doc`` are taken as cut out of a document, at any letter. Returns
    ``record_kind, record_id, furniture, broken, misread`` (counts) of every record with at least one of them, and
    with ``repaired`` the text in continuous paragraphs. Null and empty texts give no row. Repeated records give
    repeated rows. Texts of no known language are searched for furniture and broken words only.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(lexicon, common)
        for f in frames:
            rows = []
            for kind, key, text, title in zip(f["record_kind"], f["record_id"], f["text"], f["title"], strict=True):
                cut = kind != "doc"
                if repaired:
                    new, found = reader.repair(text, title, cut)
                else:
                    new, found = None, reader.signs(text, title, cut)
                if reader.noisy(found):
                    rows.append((kind, key, len(found["furniture"]), found["broken"], found["misread"] + found["accents"], new)[: 5 + repaired])
            yield pd.DataFrame(rows, columns=["record_kind", "record_id", "furniture", "broken", "misread", "repaired"][: 5 + repaired])

    schema = "record_kind string, record_id long, furniture int, broken int, misread int" + ", repaired string" * repaired
    return records.select("record_kind", "record_id", "text", "title").where("text <> ''").mapInPandas(run, schema)
