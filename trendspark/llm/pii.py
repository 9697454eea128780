"""Personal data in texts, also where it is disguised, with places in the original text.

Four kinds are found as they stand: e-mail addresses, IPv4 addresses, card numbers and
phone numbers. Then transducers rewrite a disguised text: look-alike letters and digits
of other alphabets and widths, invisible characters, spelled digits, and spelled or
bracketed ``at`` and ``dot``. Each keeps, for every character that it writes, the span
of source characters it stands for; a match in the rewritten text is so mapped back.
Disguised finds are added to the plain ones, which stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, slices

KINDS = ("email", "ip", "card", "phone")

# fixed values: the identifiers looked for
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# fixed values: letters and signs that look like ASCII ones; full-width forms follow a rule
_LOOK_ALIKE = dict(
    zip(
        "аеорсухіјѕԁһԛԝАВЕКМНОРСТХЅІЈαοιρτυνκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ٠١٢٣٤٥٦٧٨٩०१२३४५६७८९＠﹫．。․‐‑‒–—−",
        "aeopcyxijsdhqwABEKMHOPCTXSIJaoiptuvkABEZHIKMNOPTYX01234567890123456789@@...------",
        strict=True,
    )
)
_LOOK_ALIKE |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
_INVISIBLE = "​‌‍⁠﻿­"
# a dash is no disguise by itself
_DISGUISED = re.compile("[" + re.escape("".join(c for c in _LOOK_ALIKE if c not in "‐‑‒–—−") + _INVISIBLE) + "]")

# fixed values: digits as words, in the languages of the corpus
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8",
    "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8",
    "nueve": "9",
}
_WORDS = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
# four spelled digits or more with a blank or hyphen between; fewer are prose
_SPELLED = re.compile(rf"(?<!\w)(?:{_WORDS})(?:[ -](?:{_WORDS}|[0-9])(?!\w)){{3,}}", re.IGNORECASE)
_SPELLED_UNIT = re.compile(rf"{_WORDS}|[0-9]", re.IGNORECASE)
_BRACKETED_AT = re.compile(r" ?[\[({<] ?(?:at|arroba|arobase|@) ?[\])}>] ?", re.IGNORECASE)
_BRACKETED_DOT = re.compile(r" ?[\[({<] ?(?:dot|punkt|point|punto|\.) ?[\])}>] ?", re.IGNORECASE)
# four numbers with a dot of any form between, each in digits or spelled
_OCTET = rf"(?:[0-9]{{1,3}}|(?:{_WORDS})(?:[ -](?:{_WORDS})){{0,2}})"
_DOT = r"(?: dot | ?[\[({<] ?(?:dot|punkt|point|punto|\.) ?[\])}>] ?|\.)"
_OCTETS = re.compile(rf"(?<![\w.]){_OCTET}(?:{_DOT}{_OCTET}){{3}}(?!\w)", re.IGNORECASE)
_OCTET_UNIT = re.compile(rf"{_WORDS}|[0-9]|{_DOT}", re.IGNORECASE)
# an address with its "at" and dots as signs, which may come from brackets, or bare words in any mixture
_MIXED = re.compile(
    r"(?<![\w.%+-])[A-Za-z0-9_%+-]+(?:(?: dot |\.)[A-Za-z0-9_%+-]+){0,20}( at (?!(?:the|a|an|my|our|your|this|that) )|@)"
    r"([A-Za-z0-9-]+(?:(?: dot |\.)[A-Za-z0-9-]+){0,20}(?: dot |\.)[A-Za-z]{2,})(?![\w-])",
    re.IGNORECASE,
)
_BARE_DOT = re.compile(r" dot ", re.IGNORECASE)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each sign ``@``: what stands before it is a run of
    allowed characters, cut where the last match ended."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = last + len(text[last:at].rstrip(_LOCAL)) if at - last < 4096 else _run_start(text, last, at)
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def _run_start(text: str, last: int, at: int) -> int:
    """As ``rstrip`` of what lies far apart, in steps."""
    step = 4096
    while True:
        begin = max(last, at - step)
        kept = text[begin:at].rstrip(_LOCAL)
        if kept or begin == last:
            return begin + len(kept)
        step *= 2


def _numbers(text: str) -> Iterator[tuple[str, int, int]]:
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p) < 9 and int(p) <= 255 or int(p.lstrip("0")[:4] or "0") <= 255 for p in m[0].split(".")):
                yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                yield "phone", *m.span()


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of the identifiers that stand in the text as they are."""
    found = [("email", *s) for s in _emails(text)]
    if _DIGIT.search(text):
        found.extend(_numbers(text))
    return found


class Rewriting:
    """A text in rewriting, with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        # four bytes a character
        self.starts = array("i", range(len(text)))
        self.ends = array("i", range(1, len(text) + 1))
        self.touched: list[tuple[int, int]] = []

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply ``start, end, new text`` in order; a new character stands for the whole replaced span."""
        if not edits:
            return
        text, starts, ends, at = [], array("i"), array("i"), 0
        for a, b, new in edits:
            text.append(self.text[at:a])
            starts.extend(self.starts[at:a])
            ends.extend(self.ends[at:a])
            self.touched.append((self.starts[a], self.ends[b - 1]))
            text.append(new)
            starts.extend([self.starts[a]] * len(new))
            ends.extend([self.ends[b - 1]] * len(new))
            at = b
        text.append(self.text[at:])
        starts.extend(self.starts[at:])
        ends.extend(self.ends[at:])
        self.text, self.starts, self.ends = "".join(text), starts, ends

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]

    def literal(self, at: int) -> bool:
        """Whether a character stands for one character of the source."""
        return self.ends[at] - self.starts[at] == 1


def _mixed_edits(out: Rewriting) -> list[tuple[int, int, str]]:
    """The edits that turn bare words of addresses into signs.

    A bare ``at`` needs a dot in disguise behind it: "seen at example.org" is prose. Behind a sign ``@`` bare dots
    count where the domain has no plain dot, which would end it: "a@b.org dot by dot".
    """
    edits: list[tuple[int, int, str]] = []
    for m in _MIXED.finditer(out.text):
        plain = [i for i in range(*m.span(2)) if out.text[i] == "." and out.literal(i)]
        signs = [i for i in range(*m.span(2)) if out.text[i] == "." and not out.literal(i)]
        dots = [(*d.span(), ".") for d in _BARE_DOT.finditer(out.text, m.start(), m.end())]
        behind = any(a >= m.start(2) for a, _, _ in dots)
        if m[1] == "@":
            if behind and not plain or dots and not behind and not out.literal(m.start(1)):
                edits.extend(dots)
        elif behind or signs:
            edits.extend(sorted([*dots, (*m.span(1), "@")]))
    return edits


def _octets(text: str) -> str:
    """Digits and points of a dotted number in any form."""
    units = (u.lower() for u in _OCTET_UNIT.findall(text))
    return "".join(u if u.isdigit() else _DIGIT_WORDS.get(u, ".") for u in units)


def rewrite(text: str) -> Rewriting | None:
    """The text with its disguises undone, or nothing if it has none."""
    looks = not text.isascii() and _DISGUISED.search(text) is not None
    bracketed = ("[" in text or "(" in text or "{" in text or "<" in text) and (_BRACKETED_AT.search(text) or _BRACKETED_DOT.search(text))
    spelled = _SPELLED.search(text) is not None
    bare = " dot " in text or " DOT " in text or " Dot " in text
    if not (looks or bracketed or spelled or bare):
        return None
    out = Rewriting(text)
    if looks:
        out.replace([(i, i + 1, _LOOK_ALIKE.get(c, "")) for i, c in enumerate(text) if c in _LOOK_ALIKE or c in _INVISIBLE])
    out.replace([(*m.span(), new) for m in _OCTETS.finditer(out.text) if (new := _octets(m[0])) != m[0]])
    out.replace(
        [(*m.span(), "".join(_DIGIT_WORDS.get(w.lower(), w) for w in _SPELLED_UNIT.findall(m[0]))) for m in _SPELLED.finditer(out.text)]
    )
    out.replace([(*m.span(), "@") for m in _BRACKETED_AT.finditer(out.text)])
    out.replace([(*m.span(), ".") for m in _BRACKETED_DOT.finditer(out.text)])
    out.replace(_mixed_edits(out))
    return out


def find_spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Plain spans, and all spans with the disguised ones; both ordered by start, then kind.

    A disguised find needs a rewritten character inside and is left out where a plain span
    of its kind covers it.
    """
    text = text or ""
    plain = plain_spans(text)
    found = list(plain)
    out = rewrite(text)
    if out:
        for kind, start, end in plain_spans(out.text):
            a, b = out.source(start, end)
            hidden = any(a < y and x < b for x, y in out.touched)
            if hidden and not any(k == kind and x <= a and b <= y for k, x, y in plain):
                found.append((kind, a, b))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(plain, key=order), sorted(set(found), key=order)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row.

    Counts and ``spans`` (``kind:start:end``, comma-joined, code points, end exclusive) hold
    plain and disguised finds; ``base_sha256`` is the digest of the plain ones alone. A
    null or empty text has none. Repeated rows come back as often as they occur; other
    columns are not read.
    """
    out = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                plain, found = find_spans(text)
                counts = (sum(s[0] == k for s in found) for k in KINDS)
                rows.append((doc, *counts, hashlib.sha256(_joined(plain).encode()).hexdigest(), _joined(found)))
            yield batch_of(out, list(zip(*rows, strict=True)))

    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return map_arrow(texts, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(text: str | None, label: str = "[{}]") -> str | None:
    """The text with each find replaced by its kind in brackets; overlapping finds are one."""
    if not text:
        return text
    parts, at, last = [], 0, None
    for kind, start, end in find_spans(text)[1]:
        if last is not None and start < at:
            at = max(at, end)
            continue
        parts += [text[at:start], label.format(kind.upper())]
        at, last = end, kind
    return "".join([*parts, text[at:]]) if parts else text


def mask_personal_data(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with personal data masked in the text; other columns and null texts stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_column)
            field = batch.schema.field(at)
            yield batch.set_column(at, field, pa.array([mask(t) for t in batch[text_column].to_pylist()], field.type))

    return map_arrow(docs, run, docs.schema)
