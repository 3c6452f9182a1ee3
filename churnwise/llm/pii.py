"""Personal data with offset-preserving deobfuscation.

Plain identifiers are found in the text as it is. A chain of transducers then rewrites the text into a normal form,
each reading what the one before wrote, so disguises compose:

1. characters: homoglyphs and full-width forms become ASCII, invisible characters go;
2. bracketed at/dot and @/. become @ and '.';
3. runs of spelled digits become digits;
4. spaced @ and spoken at/dot become @ and '.'.

Every step keeps, for each character it writes, the range of the source it came from. The same detectors run once
on the normal form, and a span maps back to all of its source characters. It counts only where a step changed
something inside it and where no plain span is touched, so plain spans always stay.

A text without any sign of a disguise costs one search of its column.

Kinds, in order: email, ip, card, phone. Matches are leftmost and non-overlapping per kind; a match that fails
its check is dropped without retry. All scans are linear in the text: an email is found from its @, and digit
runs are taken whole.

Defined results: null text is empty text and has no spans; every row is handled on its own, so repeated rows
get equal results; offsets count code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwise.llm.common import field

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, end, kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = "[0-9@]"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def find(text: str) -> list[Span]:
    """Plain spans, by start, then kind."""
    out = [(a, b, 0) for a, b in _emails(text)]
    out += [(*m.span(), 1) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    out += [(*m.span(), 2) for m in _CARD.finditer(text) if len(m[0]) >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


# --- the transducer --------------------------------------------------------------------------------------

# Letters of other scripts that look like ASCII ones, in alphabetical order of the ASCII letter.
_LOOKS = {"A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
          "a": "аα", "c": "с", "e": "е", "h": "һ", "i": "іı", "j": "ј", "k": "к", "o": "оο", "p": "рρ", "s": "ѕ", "x": "х", "y": "у", "v": "ν"}
# Digit words of English, French, Spanish and German, and what separators are called.
_DIGIT_WORDS = [
    ("zero", "oh", "zéro", "cero", "null"), ("one", "un", "uno", "eins"), ("two", "deux", "dos", "zwei"), ("three", "trois", "tres", "drei"),
    ("four", "quatre", "cuatro", "vier"), ("five", "cinq", "cinco", "fünf"), ("six", "seis", "sechs"), ("seven", "sept", "siete", "sieben"),
    ("eight", "huit", "ocho", "acht"), ("nine", "neuf", "nueve", "neun"),
]
_AT = ("at", "arroba", "arobase")
_DOT = ("dot", "point", "punto", "punkt", "period")
_PLUS = ("plus", "más", "mas")
_INVISIBLE = "­​‌‍⁠﻿"
_DASHES = "‐‑‒–−"
_BLANKS = "   "

_ONE = {look: plain for plain, looks in _LOOKS.items() for look in looks}
_ONE |= dict.fromkeys(_DASHES, "-") | dict.fromkeys(_BLANKS, " ") | {"。": ".", "｡": ".", "․": "."}
_VALUE = {w: str(d) for d, group in enumerate(_DIGIT_WORDS) for w in group}
_WORD = "|".join(sorted(_VALUE, key=len, reverse=True))
_SAID = rf"[ \t]*(?:(?:{'|'.join(_DOT)}|dash|{'|'.join(_AT)})[ \t]+)?"
_SEP = rf"[ \t]*(?:[-,]|\.(?=\w))?{_SAID}"
#: Four or more digits in a row of which at least the first is spelled; a shorter run is left as prose.
_SPELLED = re.compile(rf"(?<!\w)(?:(?:{'|'.join(_PLUS)})[ \t]+)?(?:{_WORD})(?:{_SEP}(?:{_WORD}|[0-9]+)(?!\w)){{3,}}", re.I)
#: An address of which any part is spelled.
_QUAD = rf"(?:[0-9]+|{_WORD})(?:\.(?:[0-9]+|{_WORD})){{3}}"
_SPELLED_PART = re.compile(rf"(?<![\w.]){_QUAD}(?!\w)", re.I)
_PIECE = re.compile(rf"(?P<d>{_WORD})(?!\w)|(?P<p>{'|'.join(_PLUS)})(?!\w)|(?P<o>{'|'.join(_DOT)})(?!\w)|(?P<h>dash|-)|(?P<n>[0-9]+)|[ \t,]+|\w+", re.I)
_OPEN, _CLOSE = r"(?<![ \t])[ \t]*[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_BRACKETED = re.compile(rf"{_OPEN}(?:(?P<a>{'|'.join(_AT)}|@)|(?P<o>{'|'.join(_DOT)}|\.)){_CLOSE}", re.I)
#: name at host dot tld, unbracketed: both words are needed, and the host's parts must be plain words.
_NAME = r"(?<![\w.%+-])[A-Za-z0-9_%+-]+"
_SPOKEN = re.compile(rf"{_NAME}(?:(?:[ \t]+(?:{'|'.join(_DOT)})[ \t]+|\.)[A-Za-z0-9_%+-]+)*+[ \t]+(?:{'|'.join(_AT)})[ \t]+[A-Za-z0-9-]+(?:[ \t]+(?:{'|'.join(_DOT)})[ \t]+[A-Za-z0-9-]+)+", re.I)
_SPOKEN_PART = re.compile(rf"[ \t]+(?:(?P<a>{'|'.join(_AT)})|(?P<o>{'|'.join(_DOT)}))[ \t]+", re.I)
#: name@host dot tld, where only the dots are spoken.
_SPOKEN_DOTS = re.compile(rf"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*+(?:[ \t]+(?:{'|'.join(_DOT)})[ \t]+[A-Za-z0-9-]+)+", re.I)
# Endings that make "name at host.ending" an address and not prose.
_ENDINGS = ("biz", "ch", "co", "com", "de", "edu", "es", "eu", "fr", "gov", "info", "io", "it", "mx", "net", "nl", "org", "uk", "us")
#: name at host.ending, where only the at is spoken.
_SPOKEN_AT = re.compile(rf"{_NAME}(?:\.[A-Za-z0-9_%+-]+)*+[ \t]+(?:{'|'.join(_AT)})[ \t]+(?:[A-Za-z0-9-]+\.)+(?:{'|'.join(_ENDINGS)})(?![\w-])", re.I)
_SPACED = re.compile(r"(?<=[A-Za-z0-9])[ \t]*+(?:@[ \t]+|(?<=[ \t])@[ \t]*+)(?=[A-Za-z0-9])")
_STRANGE = re.compile(_STRANGE_SET := "[" + "".join(c if c != "-" else r"\-" for c in [*_ONE, *_INVISIBLE]) + "！-～٠-٩۰-۹०-९①-⑨⁰-₉\U0001d400-\U0001d7ff]")
#: A cheap sign that a text may hold a disguise at all; searched in whole columns at once. Each transducer's own pattern
#: or its first part, without what looks around; İ is an i to Python's patterns only. A disguise of a disguise shows
#: by its strange characters or brackets.
_HINT = rf"(?i)[\[({{<][ \t]*(?:{'|'.join(_AT + _DOT)}|@|\.)|[ \t](?:{'|'.join(_AT)})[ \t]+[A-Za-z0-9-]+(?:[ \t]+(?:{'|'.join(_DOT)})[ \t]|\.)|@[A-Za-z0-9.-]+[ \t]+(?:{'|'.join(_DOT)})[ \t]|(?:{_WORD})(?:[ \t]*[-,.]?{_SAID}(?:{_WORD}|[0-9]+)){{3}}|{_QUAD}|[ \t]@|@[ \t]|İ"

Edit = tuple[int, int, str]  # start, end, written


def _characters(text: str) -> Iterator[Edit]:
    for m in _STRANGE.finditer(text):
        c = m[0]
        plain = "" if c in _INVISIBLE else _ONE.get(c) or unicodedata.normalize("NFKC", c)
        if plain and not plain.isascii():
            plain = str(unicodedata.digit(c, "")) or c
        if len(plain) <= 1 and plain != c:
            yield *m.span(), plain


def _brackets(text: str) -> Iterator[Edit]:
    for m in _BRACKETED.finditer(text):
        yield *m.span(), "@" if m["a"] else "."


def _value(word: str) -> str:
    return _VALUE[word.casefold().replace("i\u0307", "i").replace("ı", "i")]


def _spelled(text: str) -> Iterator[Edit]:
    for m in _SPELLED_PART.finditer(text):
        for p in _PIECE.finditer(text, *m.span()):
            if p["d"]:
                yield *p.span(), _value(p[0])
    for m in _SPELLED.finditer(text):
        for p in _PIECE.finditer(text, *m.span()):
            kind = p.lastgroup
            # a dash between digits is dropped: no detector needs it, and within a part of an address it would end the part
            written = _value(p[0]) if kind == "d" else {"p": "+", "o": ".", "n": p[0]}.get(kind, "")
            if written != p[0]:
                yield *p.span(), written


def _spaced(text: str) -> Iterator[Edit]:
    for m in _SPACED.finditer(text):
        yield *m.span(), "@"


def _spoken(text: str) -> Iterator[Edit]:
    found = [m.span() for pattern in (_SPOKEN, _SPOKEN_DOTS, _SPOKEN_AT) for m in pattern.finditer(text)]
    for span in found:
        for p in _SPOKEN_PART.finditer(text, *span):
            yield *p.span(), "@" if p["a"] else "."


#: The chain, in order.
_STEPS = (_characters, _brackets, _spelled, _spaced, _spoken)


class Normal:
    """A text in normal form. Of each character: the range of the source it stands for, and whether a step wrote it."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text), dtype=np.int32)
        self.ends = self.starts + np.int32(1)
        self.written = np.zeros(len(text), bool)
        for step in _STEPS:
            self._apply(sorted(step(self.text), key=lambda e: (e[0], -e[1])))

    def _apply(self, edits: list[Edit]) -> None:
        parts: list[str] = []
        arrays: tuple[list, list, list] = ([], [], [])
        at = 0

        def put(text: str, *columns: np.ndarray) -> None:
            parts.append(text)
            for into, column in zip(arrays, columns):
                into.append(column)

        for a, b, s in edits:
            if a < at:  # inside an edit that is made already
                continue
            put(self.text[at:a], self.starts[at:a], self.ends[at:a], self.written[at:a])
            put(s, np.full(len(s), self.starts[a]), np.full(len(s), self.ends[b - 1]), np.ones(len(s), bool))
            at = b
        if at:
            put(self.text[at:], self.starts[at:], self.ends[at:], self.written[at:])
            self.text = "".join(parts)
            self.starts, self.ends, self.written = (np.concatenate(x) for x in arrays)

    def spans(self) -> Iterator[Span]:
        """Source spans of what the detectors find in something that a step changed."""
        for a, b, kind in find(self.text):
            start, end = int(self.starts[a]), int(self.ends[b - 1])
            if end - start != b - a or self.written[a:b].any():
                yield start, end, kind


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, plain and added spans), each by start, then kind."""
    base = find(text)
    added: list[Span] = []
    hidden = sorted(set(Normal(text).spans()), key=lambda s: (s[2], s[0]))
    taken = bytearray(len(text)) if hidden else b""
    for a, b, _ in base if hidden else ():
        taken[a:b] = b"x" * (b - a)
    for a, b, kind in hidden:
        if not any(taken[a:b]):
            added.append((a, b, kind))
            taken[a:b] = b"x" * (b - a)
    return base, sorted([*base, *added], key=lambda s: (s[0], s[2]))


def spans_of(texts: pa.Array) -> Iterator[tuple[list[Span], list[Span]]]:
    """all_spans of each text; texts without any sign of an identifier or disguise are not looked at."""
    if not len(texts):
        return
    plain = pc.match_substring_regex(texts, _ANY)
    hidden = pc.or_(pc.match_substring_regex(texts, _HINT), pc.match_substring_regex(texts, _STRANGE_SET))
    for text, p, h in zip(texts, plain.to_pylist(), hidden.to_pylist()):
        if h:
            yield all_spans(text.as_py())
        elif p:
            base = find(text.as_py())
            yield base, base
        else:
            yield [], []


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, spans = [], [], []
        for base, every in spans_of(batch.column("text").fill_null("")):
            kinds = [k for _, _, k in base]
            counts.append([kinds.count(k) for k in range(4)])
            digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
            spans.append(listed(every))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4)), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
        )


def report(docs: DataFrame) -> DataFrame:
    """Per document: plain spans by kind, a digest of them, and all spans."""
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(_report, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans are replaced together."""
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = field(batch, "text")
        texts = [masked(t.as_py(), every) if every else t for t, (_, every) in zip(column, spans_of(column.fill_null("")))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([t if isinstance(t, str) else t.as_py() for t in texts], pa.string())], ["row", "text"])


def mask(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with personal data in `text` masked; n_chars, where present, follows the text."""
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.mapInArrow(_mask, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))
    text = {"text": F.col("text"), "n_chars": F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return rows.select(*[text.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
