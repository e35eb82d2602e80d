"""Personal data in whole texts, plain and disguised, with offsets into the source.

Plain identifiers are found on the text itself. Disguised ones are found on a normalised copy: a
transducer reads the text once and writes ASCII for homoglyphs, nothing for invisible characters,
digits for spelled digits, ``@`` and ``.`` for their disguises, keeping for every character written
the stretch of source it came from. The same detectors run on the copy and their spans are mapped
back; a span that a plain one of its kind contains is dropped. One that reaches beyond a plain span stays
beside it: the plain pattern then saw only a piece of the identifier.

Offsets are code points, ends exclusive. Null and empty texts have no spans. All detectors read a text
once, so very long texts cost time in proportion. Rows are independent: repeated rows give repeated
results, other columns are not looked at, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare

KINDS = ("email", "ip", "card", "phone")

# Each pattern consumes whole runs, so no text makes it look at a character many times.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){0,3}+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    odd = [int(c) for c in digits[-1::-2]]
    even = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Only the run of local characters before an ``@`` is looked at, from that run's start."""
    at, done = text.find("@"), 0
    while at >= 0:
        low = at
        while low > done and text[low - 1] in _LOCAL:
            low -= 1
        if low < at and (m := _EMAIL.match(text, low)) and m[1]:
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of plain identifiers by kind, leftmost and non-overlapping within a kind."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = list(_emails(text))
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if m[0].count(".") == 3 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                    out["ip"].append(m.span())
        for m in _CARD.finditer(text):
            digits = "".join(_DIGITS.findall(m[0]))
            if 16 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
                    out["phone"].append(m.span())
    return out


# Letters of other scripts that look like Latin ones, and the Latin letter each stands for.
HOMOGLYPHS = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S",
    "Т": "T", "Х": "X", "У": "Y", "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o",
    "р": "p", "ѕ": "s", "у": "y", "х": "x", "ԛ": "q", "ԝ": "w", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I",
    "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-",
    "‒": "-", "–": "-", " ": " ", " ": " ", " ": " ",
}
# Full-width forms and the digit blocks that start at these code points, by rule.
_DIGIT_BLOCKS = (0x0660, 0x06F0, 0x0966, 0xFF10, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)
_ONE = {**HOMOGLYPHS, **{chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}, **{chr(b + d): str(d) for b in _DIGIT_BLOCKS for d in range(10)}}
_INVISIBLE = "­​‌‍⁠﻿"

# The digits 0 to 9 in four languages.
SPELLED = {
    "en": "zero one two three four five six seven eight nine",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
_NUMBER = {w: str(d) for line in SPELLED.values() for d, w in enumerate(line.split())} | {"oh": "0"}
_WORD = "|".join(sorted(_NUMBER, key=lambda w: (-len(w), w)))
# A disguise in brackets is one wherever it stands; a bare word only between the parts of an address.
_AT = r"\(\s*at\s*\)|\[\s*at\s*\]|\{\s*at\s*\}|<\s*at\s*>|&#64;|&commat;"
_DOT = r"\(\s*(?:dot|punkt|punto|point)\s*\)|\[\s*(?:dot|punkt|punto|point|\.)\s*\]|\{\s*(?:dot|punkt|punto|point)\s*\}|<\s*dot\s*>|&#46;|&period;"
# The local part is consumed whether an address follows or not, so no chain of dots is read again.
_SAID_DOT = r"\s++(?i:dot)\s++"
_BARE = (
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:{_SAID_DOT}(?!(?i:at)\s)[A-Za-z0-9._%+-]++)*+"
    rf"(?P<address>(?:\s++(?P<at>(?i:at))\s++|@)[A-Za-z0-9-]++(?:(?:{_SAID_DOT}|\.)[A-Za-z0-9-]++)++)?+"
)
_HIDDEN = re.compile("[" + re.escape("".join(_ONE) + _INVISIBLE) + "]")
_BRACKETS = re.compile(f"(?P<at>{_AT})|(?P<dot>{_DOT})", re.I)
_BARE_ADDRESS = re.compile(_BARE)
_SAID = re.compile(r"\s++(at|dot)\s++", re.I)
_SPELLED_RUN = re.compile(rf"(?<![^\W_])(?:plus[ -]+)?(?:{_WORD})(?:[ -]+(?:dot[ ]+|(?:double|triple)[ ]+)?(?:{_WORD}|[0-9]+)(?![^\W_])){{3,}}", re.I)
_SPELLED_PART = re.compile(rf"plus[ -]+|[ ]*\bdot\b[ ]*|\b(?P<times>double|triple)[ ]+(?P<many>{_WORD}|[0-9])|{_WORD}|[ -]+", re.I)


class Copy:
    """A text being rewritten, with the source stretch of every character."""

    def __init__(self, text: str):
        self.text, self.first, self.last = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        if not edits:
            return
        out: list[str] = []
        first: list[int] = []
        last: list[int] = []
        at = 0
        for low, high, new in [*edits, (len(self.text), len(self.text), "")]:
            out.append(self.text[at:low])
            first.extend(self.first[at:low])
            last.extend(self.last[at:low])
            if new:
                out.append(new)
                first.extend([self.first[low]] * len(new))
                last.extend([self.last[high - 1]] * len(new))
            at = high
        self.text, self.first, self.last = "".join(out), first, last


def _brackets(text: str) -> list[tuple[int, int, str]]:
    """Disguises in brackets, with the white space around them."""
    edits: list[tuple[int, int, str]] = []
    for m in _BRACKETS.finditer(text):
        low, high = m.span()
        done = edits[-1][1] if edits else 0
        while low > done and text[low - 1].isspace():
            low -= 1
        while high < len(text) and text[high].isspace():
            high += 1
        edits.append((low, high, "@" if m["at"] else "."))
    return edits


def _bare(text: str, dots: list[int]) -> list[tuple[int, int, str]]:
    """Bare words in addresses; ``dots`` are the places in ``text`` of dots that stood in brackets.

    A bare "at" is one only if a dot of its address is disguised too.
    """
    edits = []
    for m in _BARE_ADDRESS.finditer(text):
        if not m["address"]:
            continue
        parts = [(m.start() + p.start(), m.start() + p.end(), "@" if p[1].lower() == "at" else ".") for p in _SAID.finditer(m[0])]
        i = bisect_left(dots, m.start())
        if not m["at"] or any(new == "." for _, _, new in parts) or (i < len(dots) and dots[i] < m.end()):
            edits += parts
    return edits


def _spelled(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for run in _SPELLED_RUN.finditer(text):
        low, n = run.start(), len(run[0])
        for part in _SPELLED_PART.finditer(run[0]):
            word = part[0].strip(" -").lower()
            if not word:
                # Between two digits the space goes, so that a spelled number reads as one.
                new = "" if 0 < part.start() and part.end() < n else part[0]
            elif word == "plus":
                new = "+"
            elif word == "dot":
                new = "."
            elif part["times"]:
                digit = part["many"].lower()
                new = _NUMBER.get(digit, digit) * (2 if part["times"].lower() == "double" else 3)
            else:
                new = _NUMBER[word]
            if new != part[0]:
                edits.append((low + part.start(), low + part.end(), new))
    return edits


def normalise(text: str) -> Copy | None:
    """The rewritten copy, or None where the text holds no disguise."""
    copy = Copy(text)
    if not text.isascii() and _HIDDEN.search(text):
        copy.rewrite([(m.start(), m.end(), _ONE.get(m[0], "")) for m in _HIDDEN.finditer(text)])
    dots: list[int] = []
    if any(c in copy.text for c in "([{<&"):
        edits, gone = _brackets(copy.text), 0
        for low, high, new in edits:
            if new == ".":
                dots.append(low - gone)
            gone += high - low - 1
        copy.rewrite(edits)
    lowered = copy.text.lower()
    words = set(lowered.split())
    if "dot" in words or (dots and "at" in words):
        copy.rewrite(_bare(copy.text, dots))
    said = lowered.replace("-", " ").split()
    if not _NUMBER.keys().isdisjoint(said) and sum(map(_NUMBER.__contains__, said)) >= 3:
        copy.rewrite(_spelled(copy.text))
    return None if copy.text is text else copy


def disguised(text: str, plain: dict[str, list[tuple[int, int]]], reaching: bool = False) -> dict[str, list[tuple[int, int]]]:
    """Spans of the source that only the rewritten copy shows, by kind.

    With ``reaching``, also those that overlap a plain span of their kind and are not contained in it.
    """
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    copy = normalise(text)
    if copy is None:
        return out
    for kind, spans in detect(copy.text).items():
        known = plain[kind]
        i = 0
        for low, high in spans:
            span = (copy.first[low], copy.last[high - 1])
            while i < len(known) and known[i][1] <= span[0]:
                i += 1
            if i == len(known) or known[i][0] >= span[1] or (reaching and (span[0] < known[i][0] or known[i][1] < span[1])):
                out[kind].append(span)
    return out


def _listed(spans: dict[str, list[tuple[int, int]]]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k in KINDS for a, b in spans[k]]


SPANS = "array<struct<kind: string, start: int, end: int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` with the spans of every row's text: ``plain`` ones and those ``added`` by rewriting."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            plain, added = [], []
            for t in b.column(1).to_pylist():
                base = detect(t or "")
                plain.append(_listed(base))
                added.append(_listed(disguised(t or "", base, reaching=True)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(plain, _SPANS), pa.array(added, _SPANS)], names=[key, "plain", "added"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, plain {SPANS}, added {SPANS}")


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    if not text:
        return text
    plain = detect(text)
    added = disguised(text, plain, reaching=True)
    spans = sorted((a, -b, k) for found in (plain, added) for k, each in found.items() for a, b in each)
    if not spans:
        return text
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, -b)
    return "".join([*out, text[at:]])


def redact_personal_data(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All columns of ``docs`` with personal data replaced in ``text``; ``length`` follows the new text."""
    prepare(docs.sparkSession)

    @F.pandas_udf("string")
    def replaced(texts):
        return texts.map(redact, na_action="ignore")

    out = docs.withColumn(text, replaced(F.col(text).cast("string")))
    if length and length in docs.columns:
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(F.col(text).isNull(), F.col(length)).otherwise(F.length(text).cast(kind)))
    return out
