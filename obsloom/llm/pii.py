"""Personal data in disguise, with the places of the source text.

A transducer rewrites a text step by step: look-alike letters become ASCII, invisible characters go,
disguised at and dot signs and spelled digits become plain ones. It keeps a list of its edits, so that a
place in the rewritten text maps back to characters of the source. Identifiers are searched in the source
text (the base spans) and in the rewritten one (the added spans).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from obsloom.llm.texts import pick

KINDS = ("email", "ip", "card", "phone")

# Characters that look like ASCII ones.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Ο": "O", "Ρ": "P", "Τ": "T",
    "‐": "-", "‑": "-", "．": ".", "。": ".", "․": ".", "＠": "@", "﹫": "@", "＋": "+", "﹢": "+",
}


def alike() -> dict[str, str]:
    """Characters and the ASCII ones that they stand for: the fixed ones, decimal digits of every script, and the font,
    full-width and small forms of letters, digits and signs, as the Unicode data have them."""
    found = {}
    for code in range(0x80, 0x110000):
        char = chr(code)
        digit = unicodedata.decimal(char, None)
        if digit is not None:
            found[char] = str(digit)
        elif unicodedata.decomposition(char).startswith(("<font>", "<wide>", "<small>")):
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and (plain.isascii() and (plain.isalnum() or plain in "@+.-_%")):
                found[char] = plain
    return found | LOOK_ALIKES


#: Words for the signs, in brackets or between words.
AT_WORDS, DOT_WORDS = "at|arroba", "dot|punkt|point|punto"

# Words for digits.
DIGIT_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}

_ALL_ALIKE = alike()
_TABLE = str.maketrans(_ALL_ALIKE)
#: ``re`` looks a character up in a table only where the class has none beyond U+FFFF, else it goes through all its ranges.
_ALIKE = re.compile("[" + re.escape("".join(c for c in _ALL_ALIKE if c <= "\uffff")) + "]")
_FAR = re.compile("[\U00010000-\U0010ffff]")
_UNSEEN = re.compile("[­​-‍⁠﻿]")
_WORD = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_ITEM = f"(?:{_WORD}|[0-9]{{1,4}})"
#: Four digit words or numbers or more in a row, two words among them; fewer are ordinary prose.
_SPELLED = re.compile(rf"(?i)(?<!\w)(?:plus[ ]|\+[ ]?)?{_ITEM}(?:[ ,-]{{1,2}}{_ITEM}){{3,}}(?!\w)")
_ONE_ITEM = re.compile(rf"(?i){_WORD}|plus|\+|[0-9]+")
_FEWEST_WORDS = 2
_PART = f"{_ITEM}(?:[ -]{_ITEM}){{0,2}}"
_SPELLED_IP = re.compile(rf"(?i)(?<!\w){_PART}(?:[ ](?:{DOT_WORDS})[ ]{_PART}){{3}}(?!\w)")
_ONE_DOT = re.compile(rf"(?i)[ ](?:{DOT_WORDS})[ ]")
_OPEN, _CLOSE = r"[ ]?[\[({<][ ]?", r"[ ]?[\])}>][ ]?"
_AT = re.compile(rf"(?i)(?<=[A-Za-z0-9]){_OPEN}(?:{AT_WORDS}|@){_CLOSE}(?=[A-Za-z0-9])")
_DOT = re.compile(rf"(?i)(?<=[A-Za-z0-9]){_OPEN}(?:{DOT_WORDS}|\.){_CLOSE}(?=[A-Za-z0-9])")
#: Without brackets only where at and dot stand together: "name at host dot org".
_SPACED = re.compile(
    rf"(?i)(?<![\w.])[A-Za-z0-9][A-Za-z0-9_+-]*(?:[ ](?:{DOT_WORDS})[ ][A-Za-z0-9_+-]+|\.[A-Za-z0-9_+-]+)*(?P<at>[ ](?:{AT_WORDS})[ ])"
    rf"[A-Za-z0-9-]+(?:(?:[ ](?:{DOT_WORDS})[ ]|\.)[A-Za-z0-9-]+)*[ ](?:{DOT_WORDS})[ ][A-Za-z]{{2,}}(?!\w)"
)
_SPACED_IP = re.compile(rf"(?i)(?<!\w)[0-9]{{1,3}}(?:[ ](?:{DOT_WORDS})[ ][0-9]{{1,3}}){{3}}(?!\w)")
_HINT = re.compile(rf"(?i)[\[({{<][ ]?(?:{AT_WORDS}|@|{DOT_WORDS}|\.)[ ]?[\])}}>]|[ ](?:{DOT_WORDS})[ ]")

_EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A run of digits is tried from its start only: where that fails, the rest of the run fails as well.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, leftmost and not overlapping, in linear time: from each @ to both sides."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            free = host.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def identifiers(text: str) -> list[Span]:
    """Spans (kind, start, end) by kind and then by start; failing matches are dropped and not tried again."""
    found: list[Span] = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return found


class Rewritten:
    """A text under edits, with the source places of its characters.

    ``starts`` are places in the rewritten text where a piece begins; the piece is copied from
    ``sources``, or (``copied`` false) stands for the source characters from there to the next piece.
    """

    def __init__(self, text: str):
        self.text, self.starts, self.sources, self.copied = text, [0], [0], [True]
        self.length = len(text)

    def source(self, place: int, end: bool = False) -> int:
        """Source place of a character's start, or (``end``) of the end of the one before ``place``."""
        at = place - 1 if end else place
        i = bisect_right(self.starts, at) - 1
        if self.copied[i]:
            return self.sources[i] + at - self.starts[i] + end
        if not end:
            return self.sources[i]
        return self.sources[i + 1] if i + 1 < len(self.sources) else self.length

    def edit(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the spans of the present text, given in order and not overlapping."""
        if not edits:
            return
        parts, starts, sources, copied, size, done = [], [], [], [], 0, 0

        def copy(a: int, b: int) -> None:
            nonlocal size
            while a < b:
                i = bisect_right(self.starts, a) - 1
                stop = min(b, self.starts[i + 1] if i + 1 < len(self.starts) else len(self.text))
                starts.append(size)
                sources.append(self.sources[i] + (a - self.starts[i] if self.copied[i] else 0))
                copied.append(self.copied[i])
                parts.append(self.text[a:stop])
                size += stop - a
                a = stop

        for a, b, new in edits:
            copy(done, a)
            if new:
                starts.append(size)
                sources.append(self.source(a))
                copied.append(False)
                parts.append(new)
                size += len(new)
            done = b
        copy(done, len(self.text))
        self.text, self.starts, self.sources, self.copied = "".join(parts), starts or [0], sources or [0], copied or [True]


def has_alike(text: str) -> bool:
    """Whether a character stands for an ASCII one."""
    return not text.isascii() and (_ALIKE.search(text) is not None or not _ALL_ALIKE.keys().isdisjoint(_FAR.findall(text)))


def deobfuscate(text: str) -> Rewritten | None:
    """The text without disguises, or None where it has none."""
    plain = text.translate(_TABLE) if has_alike(text) else text
    unseen = None if text.isascii() else _UNSEEN.search(plain)
    hint = _HINT.search(plain)
    said = DIGIT_WORDS.keys() & set(plain.lower().replace("-", " ").replace(",", " ").split(" "))
    spelled = said and (_SPELLED.search(plain) or _SPELLED_IP.search(plain))
    if plain is text and not (unseen or hint or spelled):
        return None
    out = Rewritten(plain)
    if unseen:
        out.edit([(m.start(), m.end(), "") for m in _UNSEEN.finditer(plain)])
    if said:
        out.edit([(m.start(), m.end(), ".".join(map(spelled_digits, _ONE_DOT.split(m[0])))) for m in _SPELLED_IP.finditer(out.text)])
    spans = list(_SPACED.finditer(out.text)) + list(_SPACED_IP.finditer(out.text))
    dots = {(m.start() + d.start(), m.start() + d.end(), ".") for m in spans for d in _ONE_DOT.finditer(m[0])}
    ats = {(*m.span("at"), "@") for m in spans if m.re is _SPACED}
    out.edit(sorted(dots | ats))
    out.edit([(m.start(), m.end(), "@") for m in _AT.finditer(out.text)])
    out.edit([(m.start(), m.end(), ".") for m in _DOT.finditer(out.text)])
    if said:
        out.edit([(m.start(), m.end(), spelled_digits(m[0])) for m in _SPELLED.finditer(out.text) if n_words(m[0]) >= _FEWEST_WORDS])
    return out


def spelled_digits(text: str) -> str:
    """The digits of words and numbers, after a plus sign if there is one."""
    items = (w[0].lower() for w in _ONE_ITEM.finditer(text))
    return "".join("+" if w in ("plus", "+") else w if w.isdigit() else str(DIGIT_WORDS[w]) for w in items)


def n_words(text: str) -> int:
    return sum(w[0].lower() in DIGIT_WORDS for w in _ONE_ITEM.finditer(text))


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Identifiers that only the text without disguises shows; those that touch a base span of their kind are left out."""
    out = deobfuscate(text)
    if out is None:
        return []
    # base spans of a kind are in order and apart, so the last one that begins before an end is the only one to look at
    begin, end_of = ({kind: [s[i] for s in base if s[0] == kind] for kind in KINDS} for i in (1, 2))
    found = []
    for kind, a, b in identifiers(out.text):
        start, end = out.source(a), out.source(b, end=True)
        before = bisect_left(begin[kind], end) - 1
        if before < 0 or end_of[kind][before] <= start:
            found.append((kind, start, end))
    return found


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_disguised long, base_sha256 string, spans string"
_FIELDS = pa.schema([
    ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in (*KINDS, "disguised")], ("base_sha256", pa.string()), ("spans", pa.string()),
])


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rank = {kind: i for i, kind in enumerate(KINDS)}
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = identifiers(text)
            more = disguised(text, base)
            every = sorted(base + more, key=lambda s: (rank[s[0]], s[1], s[2]))
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            rows.append((*counts, len(more), hashlib.sha256(span_text(base).encode()).hexdigest(), span_text(every)))
        columns = list(zip(*rows)) or [()] * 7
        arrays = [batch.column("doc_id").cast(pa.int64()), *[pa.array(c, f.type) for c, f in zip(columns, list(_FIELDS)[1:])]]
        yield pa.RecordBatch.from_arrays(arrays, schema=_FIELDS)


def pii_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts and spans of personal data.

    Returns doc_id, the counts of base spans, n_disguised (the added ones), base_sha256 and spans (all of
    them, as kind:start:end by kind and start, in characters of the source, end exclusive). Null and empty
    texts have no spans; repeated rows are reported each; an empty table gives no rows; other columns are
    not looked at.
    """
    return pick(docs, "doc_id", "text").mapInArrow(_report, SCHEMA)
