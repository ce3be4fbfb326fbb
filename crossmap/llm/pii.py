"""Personal data with disguises: normalise, detect, map back to the source characters.

First the plain patterns are looked for in the text as it is. Then transducers
write a normalised copy and keep the source offset of each of its characters:
look-alike and mathematical letters, full-width characters and all decimal digits
become ASCII, invisible characters vanish, `[at]`, `(dot)` and words between
white space become @ and ., spelled digits become digits. The same patterns are
looked for in the copy, and what they find is mapped back to spans of the
source. A span that the plain patterns already cover adds nothing; plain spans
always stay.

Defined cases: a null text counts as empty and has no spans; equal rows give
equal rows; an empty table gives an empty result; texts of any length are
scanned whole in time that grows with their length; further columns can have
any names.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from crossmap.llm.common import column, slices, strings, with_fields

KINDS = ("email", "ip", "card", "phone")
MASKS = {kind: f"<{kind}>" for kind in KINDS}

# A run of the characters before @ starts an address wherever the scan stands in
# it, so the run is looked at backwards from each @: time grows with the text only.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            last = found.end()
            yield start, last
        else:
            last = at + 1
        at = text.find("@", last)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Spans of the plain patterns, by kind and then start."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Letters of other scripts that look like ASCII letters (fixed values: the pairs of look-alikes, Cyrillic, then Greek).
_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ɡ": "g", "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "Х": "X", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
    " ": " ", " ": " ", " ": " ", " ": " ",
}
_INVISIBLE = "­​‌‍⁠﻿"


def _ascii(char: str) -> str | None:
    """What stands for the character in the normalised text; None if it stays."""
    if char in _LOOKALIKES:
        return _LOOKALIKES[char]
    if char in _INVISIBLE:
        return ""
    if 0xFF01 <= ord(char) <= 0xFF5E:
        return chr(ord(char) - 0xFEE0)
    digit = unicodedata.decimal(char, None)
    if digit is not None:
        return str(digit)
    if unicodedata.decomposition(char).startswith("<font>"):  # mathematical letters
        plain = unicodedata.normalize("NFKC", char)
        plain = _LOOKALIKES.get(plain, plain)
        return plain if plain.isascii() else None
    return None


#: All characters that do not stay; the planes that hold digits and letters are the first two.
_SINGLE = {char: to for char in map(chr, range(0x80, 0x20000)) if (to := _ascii(char)) is not None}


_NUMBERS = {word: str(i) for i, word in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_NUMBER = "|".join(_NUMBERS)
#: White space is taken from its first character only, so that long runs of it are passed over once.
_GAP = r"(?:(?<!\s)\s+)?"
_OPEN, _CLOSE = r"[\[({<]\s*", r"\s*[\])}>]"
#: One disguise: a mark in brackets, a written @ or . between white space, or spelled digits.
#: It is itself the test whether a text is rewritten; what is looked at first are the characters that can begin one.
_DISGUISE = re.compile(
    rf"(?=[\s\[({{<])(?:{_GAP}{_OPEN}(?:(?P<at>at|@)|(?P<dot>dot|\.)){_CLOSE}\s*"
    rf"|(?<=[A-Za-z0-9_%+-])\s+(?P<at2>at)\s+(?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?:\s+dot\s+|\s*{_OPEN}dot{_CLOSE}\s*)[A-Za-z0-9-])"
    rf"|(?<=[A-Za-z0-9-])\s+(?P<dot2>dot|point)\s+(?=[A-Za-z0-9-]))"
    rf"|(?=[zotfsenp])\b(?:(?P<plus>plus)\s+(?=(?:{_NUMBER}|[0-9]+)\b)"
    rf"|(?P<run>(?:{_NUMBER})(?:[\s-]+(?:{_NUMBER}|[0-9]+))*)\b)",
    re.IGNORECASE,
)
_SPELLED = re.compile(rf"(?:{_NUMBER})|[0-9]+", re.IGNORECASE)
#: Characters of the first plane that do not stay, and all of the second one, of which some do.
_ODD = re.compile("[" + "".join(re.escape(c) for c in _SINGLE if ord(c) < 0x10000) + "\U00010000-\U0001FFFF]")


class Normalised:
    """A normalised text in which every character knows the source characters it stands for.

    Copied stretches keep one offset; a rewritten stretch knows its source start and end.
    """

    def __init__(self, source: str):
        pieces, self.begins, self.sources, self.ends, at = [], [], [], [], 0
        length = 0

        def add(text: str, start: int, end: int, copied: bool) -> None:
            nonlocal length
            if text:
                pieces.append(text)
                self.begins.append(length)
                self.sources.append(start)
                self.ends.append(None if copied else end)
                length += len(text)

        for m in _ODD.finditer(source):
            if m[0] not in _SINGLE:
                continue
            add(source[at:m.start()], at, m.start(), True)
            add(_SINGLE[m[0]], m.start(), m.end(), False)
            at = m.end()
        add(source[at:], at, len(source), True)
        self.text = "".join(pieces)

    def source_span(self, start: int, end: int) -> tuple[int, int]:
        return self._source(start)[0], self._source(end - 1)[1]

    def _source(self, at: int) -> tuple[int, int]:
        i = bisect_right(self.begins, at) - 1
        if self.ends[i] is not None:
            return self.sources[i], self.ends[i]
        place = self.sources[i] + at - self.begins[i]
        return place, place + 1

    def rewritten(self) -> "Normalised":
        """The copy with written marks and spelled digits replaced, still pointing to the first source."""
        out = object.__new__(Normalised)
        out.begins, out.sources, out.ends, pieces, length, at = [], [], [], [], 0, 0

        def copy(start: int, end: int) -> None:
            nonlocal length
            while start < end:
                i = bisect_right(self.begins, start) - 1
                stop = min(end, self.begins[i + 1] if i + 1 < len(self.begins) else len(self.text))
                out.begins.append(length)
                out.sources.append(self.sources[i] if self.ends[i] is not None else self.sources[i] + start - self.begins[i])
                out.ends.append(self.ends[i])
                pieces.append(self.text[start:stop])
                length += stop - start
                start = stop

        def put(text: str, start: int, end: int) -> None:
            nonlocal length
            span = self.source_span(start, end)
            out.begins.append(length)
            out.sources.append(span[0])
            out.ends.append(span[1])
            pieces.append(text)
            length += len(text)

        for m in _DISGUISE.finditer(self.text):
            copy(at, m.start())
            at = m.end()
            if m["at"] or m["at2"]:
                put("@", m.start(), m.end())
            elif m["dot"] or m["dot2"]:
                put(".", m.start(), m.end())
            elif m["plus"]:
                put("+", m.start("plus"), m.end("plus"))
            else:
                for x in _SPELLED.finditer(self.text, m.start("run"), m.end("run")):
                    if x[0].lower() in _NUMBERS:
                        put(_NUMBERS[x[0].lower()], x.start(), x.end())
                    else:
                        copy(x.start(), x.end())
        copy(at, len(self.text))
        out.text = "".join(pieces)
        return out


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and the spans that only the normalised text shows; both by kind and then start."""
    base = plain_spans(text)
    odd = not text.isascii() and _ODD.search(text)
    copy, more = (Normalised(text) if odd else None), []
    if copy:
        more.append(copy)
    if _DISGUISE.search(copy.text if copy else text):
        more.append((copy or _identity(text)).rewritten())
    added: list[Span] = []
    for variant in more:
        known = {kind: sorted((a, b) for k, a, b in base + added if k == kind) for kind in KINDS}
        reach = {kind: list(accumulate((b for _, b in own), max)) for kind, own in known.items()}
        for kind, start, end in plain_spans(variant.text):
            a, b = variant.source_span(start, end)
            before = bisect_right(known[kind], a, key=lambda s: s[0])
            if not before or reach[kind][before - 1] < b:
                added.append((kind, a, b))
    return base, sorted(added, key=lambda s: (KINDS.index(s[0]), s[1]))


def _identity(text: str) -> Normalised:
    out = object.__new__(Normalised)
    out.text, out.begins, out.sources, out.ends = text, [0], [0], [None]
    return out


def ordered(found: list[Span]) -> list[Span]:
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added): arrays of (kind, start, end) in code points, end exclusive, of every row."""
    kind = "array<struct<kind:string,start:int,end:int>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            both = [spans(text) for text in strings(part, "text")]
            columns = [[[{"kind": k, "start": a, "end": b} for k, a, b in x[i]] for x in both] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(x, arrow) for x in columns)], ["id", "base", "added"])

    rows = df.select(column(df, id_col).alias("id"), column(df, text_col).alias("text"))
    return rows.mapInArrow(find, with_fields(rows.select("id").schema, f"base {kind}, added {kind}")).withColumnRenamed("id", id_col)


def masked(text: str) -> str:
    """The text with every span, plain or disguised, replaced by the mark of its kind; overlapping spans become one."""
    found = sorted((a, -b, kind) for both in spans(text) for kind, a, b in both)
    out, at = [], 0
    for start, negative, kind in found:
        if start >= at:
            out += [text[at:start], MASKS[kind]]
        at = max(at, -negative)
    return "".join(out) + text[at:]


def mask(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with personal data in their texts replaced; null stays null, other columns stay as they are."""
    at, columns = df.columns.index(text_col), df.columns

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in slices([own], f"c{at}"):
                texts = [None if x is None else masked(x) for x in part.column(at).to_pylist()]
                arrays = [*part.columns[:at], pa.array(texts, part.column(at).type), *part.columns[at + 1:]]
                yield pa.RecordBatch.from_arrays(arrays, columns)

    return df.mapInArrow(replace, df.schema)
