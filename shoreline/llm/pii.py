"""Personal data in texts, with offset-preserving undoing of disguises.

Plain identifiers are found by four patterns on the text as it is.  Texts that a
transducer can change are then rewritten by small transducers, each of which emits
normalised characters along with the source span every one of them stands for:
compatibility forms, decimal digits of any script, look-alike letters of other
alphabets, invisible characters, spelled digits, and at/dot written in words or
brackets.  Identifiers detected in the rewritten text are mapped back to source
characters; those that a plain span of the same kind touches are dropped, so plain
spans stay as they are and others are added.

Defined cases: a null or empty text has no spans; an identifier repeated in a text
counts each time; repeated rows are reported each; very long texts are read whole; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Tried only where a run of digits begins: it matches from there or not at all.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    digits = _NOT_DIGIT.sub("", found)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def _emails(text: str) -> list[tuple[int, int]]:
    """The pattern's leftmost non-overlapping matches: each starts at the run of local
    characters before an at sign, so only those places are tried."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        spans += [("ip", *m.span()) for m in _IP.finditer(text) if _valid("ip", m.group())]
        spans += [("card", *m.span()) for m in _CARD.finditer(text) if _valid("card", m.group())]
        if "+" in text:
            spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if _valid("phone", m.group())]
    return spans


# --- undoing disguises ------------------------------------------------------------------

# Letters of other alphabets that look like a Latin one.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M",
    "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "İ": "I",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "·": ".",
}
# The digits as words, in the four languages of the documents.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5",
    "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5",
    "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_NUMBER = "|".join(sorted(SPELLED, key=len, reverse=True))
#: Spelled digits count in runs of three or more, or next to a digit.
_SPELLED_RUN = re.compile(
    rf"(?i)(?<![^\W\d_])(?:{_NUMBER}|[0-9])(?:[\x20.,-]{{1,2}}(?:{_NUMBER}|[0-9]+)(?![^\W\d_])){{2,}}")
_SPELLED_ONE = re.compile(rf"(?i){_NUMBER}")
#: A run of spaces is tried from its first one, so long runs are passed once.
_AT = re.compile(r"(?i)(?:(?<!\x20)\x20+|(?<=\x20)|(?<!\x20))[(\[{<][\x20]*(?:at|@|arroba)[\x20]*[)\]}>][\x20]*")
_DOT = re.compile(r"(?i)(?:(?<!\x20)\x20+|(?<=\x20)|(?<!\x20))[(\[{<][\x20]*(?:dot|punkt|point|punto|\.)[\x20]*[)\]}>][\x20]*")
#: Two or three numbers after the word are a time, price or date, not a host.
_AT_WORD = re.compile(
    r"(?i)(?<=[a-z0-9])\x20+(?:at|arroba)\x20+(?![0-9]+(?:\.[0-9]+){1,2}(?!\.?[a-z0-9-]))(?=[a-z0-9-]+(?:(?:\x20+(?:dot|punkt|punto)\x20+|\.)[a-z0-9-]+)+)")
_HOST = re.compile(r"(?i)[a-z0-9-]+(?:(?:\x20+(?:dot|punkt|punto)\x20+|\.)[a-z0-9-]+)+")
_SPACED_DOT = re.compile(r"\x20")
#: Words before it that make "name at host.com" an address.
_CALLS = re.compile(r"(?i)(?<![^\W\d_])(?:e-?mails?|mails?|mailto|write|contact|reach|correo|escrib\w*|contacto|courriel|"
                    r"écri\w*|contacte\w*|schreib\w*|kontakt\w*)(?![^\W\d_])")
#: How far before it such a word may stand.
_NEAR = 60
_DOT_WORD = re.compile(r"(?i)(?<=[a-z0-9])\x20+(?:dot|punkt|punto)\x20+(?=[a-z0-9-])")
#: What each of the patterns above needs, whatever follows; on text without odd characters.
_BRACKETED = re.compile(r"(?i)[(\[{<]\x20*(?:at|@|arroba|dot|punkt|point|punto|\.)\x20*[)\]}>]")
_SPELLED_PAIR = re.compile(
    rf"(?i)(?<![^\W\d_])(?:{_NUMBER})[\x20.,-]{{1,2}}(?:{_NUMBER}|[0-9])|[0-9][\x20.,-]{{1,2}}(?:{_NUMBER})")
_LATIN = re.compile(r"[A-Za-z0-9@.+]")


class Tape:
    """A text and, for each of its characters, the source span it stands for."""

    def __init__(self, text: str, starts: list[int] | None = None, stops: list[int] | None = None):
        self.text = text
        self.starts = list(range(len(text))) if starts is None else starts
        self.stops = list(range(1, len(text) + 1)) if stops is None else stops

    def rewrite(self, pieces) -> Tape:
        """``pieces``: (start, stop, replacement) in order, on this tape's text."""
        text, starts, stops, at = [], [], [], 0
        for a, b, new in pieces:
            text.append(self.text[at:a])
            starts += self.starts[at:a]
            stops += self.stops[at:a]
            if new:
                text.append(new)
                starts += [self.starts[a]] * len(new)
                stops += [self.stops[b - 1]] * len(new)
            at = b
        text.append(self.text[at:])
        return Tape("".join(text), starts + self.starts[at:], stops + self.stops[at:])


def _flat(c: str) -> str | None:
    """What a character stands for; None where it stays."""
    if unicodedata.category(c) == "Cf":
        return ""
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    flat = unicodedata.normalize("NFKC", c)
    return flat if flat != c and flat.isascii() else None


#: The common letters and marks that stay.  So does an ellipsis: it ends a phrase, and as
#: three dots it would join that phrase to the identifier after it.
_STAY = "".join(c for c in map(chr, (*range(0xA1, 0x180), *range(0x2018, 0x2020))) if _flat(c) is None) + "…"
_ODD = re.compile(f"[^\x00-\x7f{re.escape(_STAY)}]")


def _characters(tape: Tape) -> Tape:
    """Compatibility forms, digits of any script, look-alikes; invisible ones go."""
    out = [(m.start(), m.end(), new) for m in _ODD.finditer(tape.text)
           if (new := _flat(m.group())) is not None]
    return tape.rewrite(out) if out else tape


def _spelled(tape: Tape) -> Tape:
    """Runs of spelled digits become digits; what stands between two of them goes."""
    out = []
    for run in _SPELLED_RUN.finditer(tape.text):
        if not _SPELLED_ONE.search(run.group()):
            continue
        text, at = run.group(), run.start()
        for m in re.finditer(rf"(?i)({_NUMBER})|[\x20,-]+", text):
            out.append((at + m.start(), at + m.end(), SPELLED[m.group(1).lower()] if m.group(1) else ""))
    return tape.rewrite(out) if out else tape


def _is_address(text: str, m: re.Match) -> bool:
    """Whether the word "at" joins a name and a host, and is not that of "look at x.com": the
    host has a spelled dot, the name a digit or sign inside it, or a word before calls for
    an address."""
    host = _HOST.match(text, m.end())
    if host and _SPACED_DOT.search(host.group()):
        return True
    start = m.start()
    while start > 0 and text[start - 1] in _LOCAL and m.start() - start < 64:
        start -= 1
    name = text[start:m.start()].strip("._%+-")
    if not name.isalpha() and any(c.isalpha() for c in name):
        return True
    return _CALLS.search(text, max(0, start - _NEAR), start) is not None


def _signs(tape: Tape) -> Tape:
    for pattern, new in ((_AT, "@"), (_DOT, "."), (_AT_WORD, "@"), (_DOT_WORD, ".")):
        out = [(m.start(), m.end(), new) for m in pattern.finditer(tape.text)
               if m.start() < m.end() and (pattern is not _AT_WORD or _is_address(tape.text, m))]
        if new == "." and pattern is _DOT_WORD and "@" not in tape.text:
            out = [p for p in out if tape.text[p[0] - 1].isdigit() and tape.text[p[1]].isdigit()]
        if out:
            tape = tape.rewrite(out)
    return tape


def _disguised(text: str) -> bool:
    """Whether any transducer could change the text; false only where none does."""
    if not text.isascii() and _ODD.search(text):
        return True
    low = text.lower()
    return ((" at " in low or " arroba " in low) and _AT_WORD.search(text) is not None
            or " dot " in low or " punkt " in low or " punto " in low
            or any(c in text for c in "([{<") and _BRACKETED.search(text) is not None
            or _SPELLED_PAIR.search(text) is not None)


def added_spans(text: str, plain: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of disguised identifiers that no plain span of their kind touches."""
    if not _disguised(text):
        return []
    tape = _signs(_spelled(_characters(Tape(text))))
    if tape.text == text:
        return []
    taken = {k: sorted((a, b) for kind, a, b in plain if kind == k) for k in KINDS}
    out = []
    for kind, a, b in plain_spans(tape.text):
        start, stop = tape.starts[a], tape.stops[b - 1]
        i = bisect_left(taken[kind], (stop, -1))
        if i == 0 or taken[kind][i - 1][1] <= start:
            out.append((kind, start, stop))
    return out


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(plain spans, all spans) as (kind, start, end), by start and then kind."""
    text = text or ""

    def order(s):
        return s[1], KINDS.index(s[0]), s[2]

    plain = sorted(plain_spans(text), key=order)
    return plain, sorted(plain + added_spans(text, plain), key=order)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, plain and spans, arrays of (kind, start, end)."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def pack(found):
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in f] for f in found], span)

    def run(batches):
        for b in batches:
            both = [find(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pack([x[0] for x in both]), pack([x[1] for x in both])], ["id", "plain", "spans"])

    id_type = docs.schema[id_col].dataType.simpleString()
    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, plain {kind}, spans {kind}"))


def mask(text: str | None, found: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    text, out, at = text or "", [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = b
    return "".join([*out, text[at:]])


def digest(found: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()
