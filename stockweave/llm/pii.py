"""Personal data in texts, disguised or not, with spans in the text as given.

The fixed patterns are searched in the text itself. For disguises the text goes
through transducers that write a normal form and keep, for every character of
it, the span of the source it stands for: look-alike and compatibility
characters become ASCII, invisible ones vanish, spelled digits become digits,
and at/dot disguises become the signs. Identifiers found in the normal form are
mapped back; those that the fixed patterns have not already found are added.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import picked, rows_of

# Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9][0-9.]+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

# --- fixed values of the transducers ------------------------------------------

# Letters of other scripts that look like ASCII ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "п": "n", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "К": "K", "М": "M", "О": "O",
    "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "−": "-", "․": ".", "。": ".",
}
INVISIBLE = "­​‌‍⁠﻿"
# Spelled digits in the languages of the corpus.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}
AT_WORDS = ("at", "ät", "arroba", "arobase", "klammeraffe", "@")
DOT_WORDS = ("dot", "punkt", "punto", "point", ".")
# "at" is a word of its own, so without brackets it needs a dot of its language spelled before the
# last label, or a known last label. The others mean nothing but the sign and go with any dot.
WORD_PAIRS = (("at|ät", "dot|punkt"),)
SIGN_WORDS = ("arroba", "arobase", "klammeraffe")
# Last labels that are no words of the corpus' languages.
KNOWN_ENDS = (
    "com org net edu gov mil int info biz io dev app ai co uk de fr es nl pl ch eu us ca au jp cn "
    "ru br mx ar se dk fi cz pt gr ie nz kr za"
).split()
# What stands before "at" a site rather than before "at" an address.
NO_LOCAL_PARTS = frozenset(
    "us me you him her them it is are was were be been look looks looking meet met meets see seen "
    "visit visits find found available here there live online site website page shop more posted "
    "hosted arrive arrived works worked and or".split()
)
PLUS_WORDS = ("plus", "más")

_AT = "|".join(map(re.escape, AT_WORDS))
_DOT = "|".join(map(re.escape, DOT_WORDS))
_WORD_DOT = "|".join(DOT_WORDS[:-1])
_SPELLED = "|".join(sorted(SPELLED, key=len, reverse=True))
_ATOM = rf"(?:\b(?:{_SPELLED})\b|[0-9])"

# An at or dot in brackets, with the space around it.
_BRACKETED = re.compile(
    rf"[\[({{<]\x20{{0,2}}(?:(?P<at>{_AT})|(?P<dot>{_DOT}))\x20{{0,2}}[\])}}>]\x20{{0,3}}", re.IGNORECASE
)
# The words, where a local part and a domain of at least two labels stand around them.
_LABEL = r"[a-z0-9-]{1,63}"
_ANY_DOT = rf"(?:\x20+(?:{_WORD_DOT})\x20+|\.)"
_WORDED = [
    re.compile(
        rf"[a-z0-9._%+-]{{1,64}}(?P<at>\x20+(?:{at})\x20+)"
        rf"{_LABEL}(?:(?:\x20+(?:{dot})\x20+|\.){_LABEL})*\x20+(?:{dot})\x20+[a-z]{{2,24}}\b",
        re.IGNORECASE,
    )
    for at, dot in WORD_PAIRS
]
# From the at on; what stands before it is looked at only where this matches.
_SIGN = re.compile(
    rf"(?:(?<=\x20)(?:{'|'.join(SIGN_WORDS)})\x20+|(?<=\x20)@\x20*|@\x20+)"
    rf"(?={_LABEL}(?:{_ANY_DOT}{_LABEL})*{_ANY_DOT}[a-z]{{2,24}}\b)",
    re.IGNORECASE,
)
_PLAIN_AT = re.compile(
    rf"(?<=\x20)(?:at|ät)\x20+(?={_LABEL}(?:{_ANY_DOT}{_LABEL})*{_ANY_DOT}(?P<end>{'|'.join(KNOWN_ENDS)})\b(?![.-]?\w))",
    re.IGNORECASE,
)
_DOMAIN_WORDS = re.compile(rf"{_LABEL}(?:{_ANY_DOT}{_LABEL})*{_ANY_DOT}[a-z]{{2,24}}\b", re.IGNORECASE)
_LOCAL_BEFORE = re.compile(r"(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}\x20*$", re.IGNORECASE)
_WORDED_DOT = re.compile(rf"\x20+(?:{_WORD_DOT})\x20+", re.IGNORECASE)
# Runs of spelled and plain digits, at least four, with the signs and words between them.
_BETWEEN = rf"(?:[\x20,;/()-]|\b(?:{_WORD_DOT})\b|\.){{0,4}}"
_RUN = re.compile(
    rf"(?:(?:\b(?:{'|'.join(PLUS_WORDS)})\b|\+)\x20{{0,2}})?{_ATOM}(?:{_BETWEEN}{_ATOM}){{3,}}",
    re.IGNORECASE,
)
_RUN_PART = re.compile(
    rf"(?P<plus>\b(?:{'|'.join(PLUS_WORDS)})\b|\+)|(?P<spelled>\b(?:{_SPELLED})\b)|(?P<digit>[0-9])"
    rf"|(?P<dot>\x20*(?:\b(?:{_WORD_DOT})\b|\.)\x20*)|(?P<other>.)",
    re.IGNORECASE | re.DOTALL,
)
_SPELLED_WORD = re.compile(rf"\b(?:{_SPELLED})\b", re.IGNORECASE)
_DISGUISED = re.compile(
    "[" + "".join(map(re.escape, [*LOOK_ALIKES, *INVISIBLE])) + "！-～\U0001d400-\U0001d7ff①-⑨⓪⁰-⁹₀-₉]"
    r"|[^\D0-9]"  # decimal digits of any script
)


# --- the fixed patterns ---------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if k % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern; linear, as each belongs to one @ sign."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the fixed patterns, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for token in _NUMBERS.finditer(text):
        if token[0].count(".") >= 3:
            for m in _IP.finditer(text, token.start(), token.end()):
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                    out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


# --- transducers ----------------------------------------------------------------


class Mapped:
    """A normal form and the source span of each of its characters."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts: list[int] | range = range(len(text))
        self.ends: list[int] | range = range(1, len(text) + 1)
        self.changed: set[int] = set()  # source positions that a transducer rewrote

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans of the normal form, given in order, by other text."""
        if not edits:
            return
        parts, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            starts += [*self.starts[at:a], *[self.starts[a]] * len(new)]
            ends += [*self.ends[at:a], *[self.ends[b - 1]] * len(new)]
            self.changed.update(range(self.starts[a], self.ends[b - 1]))
            at = b
        parts.append(self.text[at:])
        self.text = "".join(parts)
        self.starts = [*starts, *self.starts[at:]]
        self.ends = [*ends, *self.ends[at:]]

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def plain_character(c: str) -> str:
    """ASCII form of a look-alike or compatibility character; empty if invisible."""
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if c.isdecimal():
        return str(unicodedata.digit(c))
    form = unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and form.isascii() else c


def _characters(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    found = [(m.start(), m.end(), plain_character(m[0])) for m in _DISGUISED.finditer(text)]
    return [x for x in found if x[2] != text[x[0] : x[1]]]


def _signs(text: str, low: str) -> list[tuple[int, int, str]]:
    out = []
    if any(c in text for c in "[({<") and any(w in low for w in (*AT_WORDS, *DOT_WORDS)):
        for m in _BRACKETED.finditer(text):
            start, free = m.start(), out[-1][1] if out else 0
            while start > max(free, m.start() - 3) and text[start - 1] == " ":
                start -= 1
            out.append((start, m.end(), "@" if m["at"] else "."))
    return out


def _words(text: str, low: str) -> list[tuple[int, int, str]]:
    out = []
    for (_, dots), pattern in zip(WORD_PAIRS, _WORDED):
        if not any(f" {w} " in low for w in dots.split("|")):
            continue
        for m in pattern.finditer(text):
            out.append((m.start("at"), m.end("at"), "@"))
            for d in _WORDED_DOT.finditer(text, m.end("at"), m.end()):
                out.append((d.start(), d.end(), "."))
    if any(w in low for w in SIGN_WORDS) or " @" in low or "@ " in low:
        out += _addresses(text, _SIGN)
    if " at " in low or " ät " in low:
        out += _addresses(text, _PLAIN_AT)
    out.sort()
    kept: list[tuple[int, int, str]] = []
    for x in out:
        if not kept or kept[-1][1] <= x[0]:
            kept.append(x)
    return kept


def _addresses(text: str, pattern: re.Pattern) -> list[tuple[int, int, str]]:
    """Edits of the ats of ``pattern`` with a local part before them, and of the dots behind."""
    out = []
    for m in pattern.finditer(text):
        before = _LOCAL_BEFORE.search(text, max(0, m.start() - 67), m.start())
        if before is None:
            continue
        domain = _DOMAIN_WORDS.match(text, m.end())
        if pattern is _PLAIN_AT:
            # a sentence that ends without a space ("at home.It") is no domain
            end = m["end"]
            if before[0].strip().lower() in NO_LOCAL_PARTS or not (end.islower() or m[0].strip().isupper()):
                continue
        out.append((before.start() + len(before[0].rstrip()), m.end(), "@"))
        out += [(d.start(), d.end(), ".") for d in _WORDED_DOT.finditer(text, m.end(), domain.end())]
    return out


def _may_spell(low: str) -> bool:
    """Whether a spelled digit stands next to, or one word away from, another digit."""
    for c in ",;/()-.+":
        low = low.replace(c, " ")
    words = low.split()
    spelled = [k for k, w in enumerate(words) if w in SPELLED]
    for k in spelled:
        for w in (*words[k + 1 : k + 3], *words[max(0, k - 2) : k]):
            if w in SPELLED or w[0] in "0123456789" or w[-1] in "0123456789":
                return True
    return False


def _digits(text: str) -> list[tuple[int, int, str]]:
    if not _may_spell(text.lower()):
        return []
    out = []
    for m in _RUN.finditer(text):
        if not _SPELLED_WORD.search(m[0]):
            continue
        last_digit = None  # where the digit before ended
        for p in _RUN_PART.finditer(text, m.start(), m.end()):
            kind = p.lastgroup
            if kind == "plus":
                out.append((p.start(), p.end(), "+"))
                last_digit = p.end()
            elif kind in ("spelled", "digit"):
                if last_digit is not None and last_digit < p.start():
                    out.append((last_digit, p.start(), ""))
                new = SPELLED[p[0].lower()] if kind == "spelled" else p[0]
                out.append((p.start(), p.end(), new))
                last_digit = p.end()
            elif kind == "dot":
                if last_digit is not None and last_digit < p.start():
                    out.append((last_digit, p.start(), ""))
                out.append((p.start(), p.end(), "."))
                last_digit = p.end()
    return [(a, b, new) for a, b, new in out if text[a:b] != new]


def disguised(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of identifiers that only the normal form shows."""
    form = Mapped(text)
    form.rewrite(_characters(form.text))
    low = form.text.lower()
    signs = _signs(form.text, low)
    if signs:
        form.rewrite(signs)
        low = form.text.lower()
    form.rewrite(_words(form.text, low))
    form.rewrite(_digits(form.text))
    if not form.changed:
        return []
    out = []
    for kind, a, b in identifiers(form.text):
        start, end = form.source(a, b)
        if any(x in form.changed for x in range(start, end)):
            out.append((kind, start, end))
    return out


def personal_data(text: str | None) -> list[tuple[int, int, int, bool]]:
    """(kind number, start, end, base) by kind, then start."""
    if not text:
        return []
    base = identifiers(text)
    more = disguised(text)
    if more:
        taken = [set() for _ in KINDS]
        for kind, a, b in base:
            taken[kind].update(range(a, b))
        more = [x for x in more if not any(p in taken[x[0]] for p in range(x[1], x[2]))]
    return sorted([(*x, True) for x in base] + [(*x, False) for x in more])


SPANS = "array<struct<kind:int,start:long,end:long,base:boolean>>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) for every row: spans in code points of the text, end exclusive.

    ``base`` marks the fixed patterns; the others were disguised. NULL and blank
    texts have none. Repeated rows give repeated rows, an empty table an empty
    one; NULL ids and further columns play no part.
    """
    rows = picked(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    kind = dict(rows.dtypes)["id"]
    span = pa.struct(
        [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in rows_of(batches):
            spans = [
                [dict(zip(("kind", "start", "end", "base"), s)) for s in personal_data(t)]
                for t in texts
            ]
            columns = [batch.column(0), pa.array(spans, type=pa.list_(span))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "spans"])

    return rows.mapInArrow(run, f"id {kind}, spans {SPANS}")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order given."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )
