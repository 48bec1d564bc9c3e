"""Personal data with offset-preserving deobfuscation.

Identifiers are detected in the text as it is, and once more in a normalised reading of it:
transducers replace look-alike characters, spelled digits and at/dot disguises, and every
replacement is kept with its source span. Spans found in the normalised reading are mapped back to
source characters, so results always refer to the given text.

One document is read at a time inside Arrow batches; there is no shuffle.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# ---------------------------------------------------------------- detection

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_CLUE = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ so that long runs cost linear time: the local part is
    the run of its characters in front of the @, behind the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done if domain else 0))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all identifiers, by start and kind; ends are exclusive."""
    if not _CLUE.search(text):
        return []
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            # More than 3 digits without leading zeros cannot be 255 or less.
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255
                   for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(_DIGITS.findall(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# ---------------------------------------------------------------- normalising transducers

# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "а": "a", "в": "b", "е": "e",
    "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "Α": "A", "Β": "B", "Ε": "E",
    "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ρ": "p", "ı": "i", "ɑ": "a", "ɡ": "g", "ꓳ": "O",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "·": ".",
}
INVISIBLE = "­​‌‍⁠﻿"
# The words for 0 to 9 in the four languages of the corpus.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine".split(),
    "null eins zwei drei vier fünf sechs sieben acht neun".split(),
    "zéro un deux trois quatre cinq six sept huit neuf".split(),
    "cero uno dos tres cuatro cinco seis siete ocho nueve".split(),
)
_DIGIT_OF = {word: str(k) for words in DIGIT_WORDS for k, word in enumerate(words)}
_DIGIT_WORD = "(?:" + "|".join(sorted(_DIGIT_OF, key=len, reverse=True)) + ")"
# A run of at least three single digits of which one at least is spelled.
# Single digits are taken as whole runs, also those that no spelled word follows ("rest" is then
# missing): no digit is the start of another attempt.
_SPELLED = re.compile(rf"(?i)\b(?:plus[ -]+)?{_DIGIT_WORD}(?:[ -]+(?:{_DIGIT_WORD}|[0-9])\b){{2,}}"
                      rf"|(?P<digits>(?<![\w])[0-9](?:[ -]+[0-9])*+)"
                      rf"(?P<rest>[ -]+{_DIGIT_WORD}(?:[ -]+(?:{_DIGIT_WORD}|[0-9])\b)+)?"
                      rf"|\b{_DIGIT_WORD}(?:[ -]+{_DIGIT_WORD}\b)*(?= +dot +|\.)"
                      rf"|(?<=\bdot ){_DIGIT_WORD}\b(?:[ -]+{_DIGIT_WORD}\b)*")
# Of a disguised identifier at least two neighbouring words are of these, whatever stands around
# it: a cheap test before the patterns.
_SPOKEN = frozenset([*_DIGIT_OF, *"0123456789", "dot", "plus"])
_SPELLED_TOKEN = re.compile(rf"(?i)\bplus\b[ -]*|{_DIGIT_WORD}\b|[ -]+|[0-9]")
_AT = r"(?:at|ät|arroba|@)"
_DOT = r"(?:dot|punkt|point|punto|\.)"
# Words that end no address: "at noon dot the end" is text.
_NO_LABEL = r"(?!(?:the|and|that|this|these|those|for|with|but|then|when|our|your|their|his|her)\b)"
# Bracketed forms stand for the sign anywhere; a bare " at " only where bare or bracketed dots
# make the domain, so that "look at example.com" stays text.
_SIGNS = re.compile(
    rf"(?i)(?P<at>\s?[\[({{<]\s?{_AT}\s?[\])}}>]\s?)"
    rf"|(?P<dot>\s?[\[({{<]\s?{_DOT}\s?[\])}}>]\s?)"
    rf"|(?<=[a-z0-9])(?P<bare_at> at )(?=[a-z0-9-]+(?: dot {_NO_LABEL}| ?[\[({{<]\s?{_DOT}\s?[\])}}>] ?)[a-z0-9])"
    rf"|(?<=[a-z0-9])(?P<bare_dot> +dot +){_NO_LABEL}(?=[a-z0-9])")

# The bare words of the other languages count only in a whole spelled address. "at ... point" stays
# text ("at this point in time"): a bare "point" needs an at that no English text has.
_BARE_DOT = rf" +(?:dot|punkt|point|punto) +{_NO_LABEL}"
_BRACKET_DOT = rf"\s?[\[({{<]\s?{_DOT}\s?[\])}}>]\s?"
_BARE_ADDRESS = re.compile(
    rf"(?i)(?<=[a-z0-9])(?:(?P<at> (?:at|ät|arroba|arr?obase) )"
    rf"|\s?[\[({{<]\s?{_AT}\s?[\])}}>]\s?|@)"
    rf"(?P<domain>[a-z0-9-]+(?:{_BARE_DOT}|{_BRACKET_DOT})[a-z0-9-]+"
    rf"(?:(?:{_BARE_DOT}|{_BRACKET_DOT}|\.)[a-z0-9-]+)*)")
_BARE_DOTS = re.compile(rf"(?i){_BARE_DOT}")


@functools.lru_cache(maxsize=1)
def _look_alikes() -> dict[str, str]:
    """Single characters that read as one ASCII character: by compatibility mapping (full-width,
    mathematical and circled forms), by digit value, and by the fixed table."""
    table = dict.fromkeys(INVISIBLE, "")
    for code in (*range(0x80, 0xD800), *range(0xF900, 0x20000)):
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c)
        digit = unicodedata.digit(c, None)
        if len(plain) == 1 and "!" <= plain <= "~":
            table[c] = plain
        elif digit is not None:
            table[c] = str(digit)
    return table | LOOKALIKES


class Reading:
    """A text after replacements; ``source`` maps its spans back through all layers."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]], below: Reading | None = None):
        self.below, self.starts, self.spans = below, [], []
        out, at, length = [], 0, 0
        for begin, end, new in edits:
            out += [text[at:begin], new]
            length += begin - at
            self.starts.append(length)
            length += len(new)
            self.spans.append((length, begin, end))
            at = end
        self.text = "".join([*out, text[at:]]) if edits else text

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source span of text[start:end], and whether it holds any replacement."""
        a, hit_a = self._back(start, False)
        b, hit_b = self._back(end, True)
        inside = bisect_right(self.starts, end - 1) - bisect_right(self.starts, start - 1)
        if self.below is None:
            return a, b, bool(hit_a or hit_b or inside)
        a, b, below = self.below.source(a, b)
        return a, b, bool(below or hit_a or hit_b or inside)

    def _back(self, position: int, is_end: bool) -> tuple[int, bool]:
        k = bisect_right(self.starts, position - 1 if is_end else position) - 1
        if k < 0:
            return position, False
        out_end, begin, end = self.spans[k]
        if position < out_end or is_end and position <= out_end and self.starts[k] < position:
            return (end if is_end else begin), True
        return end + position - out_end, False


def _look_alike_edits(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    table = _look_alikes()
    present = table.keys() & set(text)
    if not present:
        return []
    return [(m.start(), m.end(), table[m[0]])
            for m in re.finditer("[" + "".join(map(re.escape, present)) + "]", text)]


def _digit_edits(text: str) -> list[tuple[int, int, str]]:
    words = text.lower().replace("-", " ").split()
    if "11" not in "".join(["1" if w in _SPOKEN else "0" for w in words]):
        return []
    edits = []
    for m in _SPELLED.finditer(text):
        if m["digits"] and not m["rest"]:
            continue
        tokens = list(_SPELLED_TOKEN.finditer(text, m.start(), m.end()))
        for t in tokens:
            word = t[0].lower()
            if word.startswith("plus"):
                edits.append((t.start(), t.end(), "+"))
            elif not word.strip(" -"):
                edits.append((t.start(), t.end(), ""))
            elif not word.isdigit() or word not in "0123456789":
                edits.append((t.start(), t.end(), _DIGIT_OF[word]))
    return edits


def _sign_edits(text: str) -> list[tuple[int, int, str]]:
    lower = text.lower()
    bare = any(f" {word} " in lower for word in ("dot", "punkt", "point", "punto"))
    if not bare and not any(c in text for c in "[({<"):
        return []
    edits = {(m.start(), m.end(), "@" if m.lastgroup.endswith("at") else ".")
             for m in _SIGNS.finditer(text)}
    for m in _BARE_ADDRESS.finditer(text) if bare else ():
        if m["at"] and m["at"].lower() == " at " and " point " in m["domain"].lower():
            continue
        if m["at"]:
            edits.add((*m.span("at"), "@"))
        edits.update((d.start(), d.end(), ".") for d in _BARE_DOTS.finditer(text, *m.span("domain")))
    return sorted(edits)


def disguised(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of identifiers that only the normalised reading shows, in characters of
    ``text``."""
    reading = None
    for edits_of in (_look_alike_edits, _digit_edits, _sign_edits):
        current = reading.text if reading else text
        edits = edits_of(current)
        if edits:
            reading = Reading(current, edits, reading)
    if reading is None:
        return []
    found = []
    for start, kind, end in detect(reading.text):
        a, b, changed = reading.source(start, end)
        if changed:
            found.append((a, kind, b))
    return found


def personal_data(text: str | None) -> tuple[list, list]:
    """Base spans, and added spans that no base span of their kind covers wholly: a disguise in one
    part of an identifier often leaves a shorter base match in the rest."""
    base = detect(text or "")
    # Base spans of one kind do not overlap: only the last one that starts in front can cover.
    ends: tuple[list, ...] = tuple([] for _ in KINDS)
    starts: tuple[list, ...] = tuple([] for _ in KINDS)
    for x, kind, y in base:
        starts[kind].append(x)
        ends[kind].append(y)

    def covered(a: int, kind: int, b: int) -> bool:
        k = bisect_right(starts[kind], a) - 1
        return k >= 0 and b <= ends[kind][k]

    added = {span for span in disguised(text) if not covered(*span)} if text else ()
    return base, sorted(added)


# ---------------------------------------------------------------- Spark

def find_personal_data(docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Personal data of every whole text, one row per document row: ``id``, ``base`` and ``added``
    (arrays of (start, kind, end) in code points, end exclusive; kind is an index into ``KINDS``).

    Null counts as empty; a repeated row gives its result again; an empty table gives none; other
    columns are not looked at.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))

    def column(spans: list[list]) -> pa.Array:
        return pa.array([[{"start": a, "kind": k, "end": b} for a, k, b in s] for s in spans], span)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [personal_data(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), column([b for b, _ in both]), column([a for _, a in both])],
                ["id", "base", "added"])

    spans = "array<struct<start:long,kind:int,end:long>>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        scan, f"id {id_type}, base {spans}, added {spans}")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; of overlapping spans the
    first (and then the longest) decides."""
    out, at = [], 0
    for start, kind, end in sorted(spans, key=lambda s: (s[0], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
