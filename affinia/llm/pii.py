"""Personal data in texts, also in disguise, with spans in the source text.

Four kinds are detected by patterns: e-mail addresses, IP addresses, card numbers and
phone numbers. The same patterns then run on a normalised text that undoes
disguises. Every step of the normaliser is a transducer that rewrites
parts of the text and keeps, for each character it puts out, the source
characters it stands for. Spans found in the normalised text are
mapped back by that. One that overlaps a plain finding of its kind, or contains no
rewritten part, adds nothing.

Steps: compatibility forms, look-alike letters and digits of other scripts become
ASCII, invisible characters go; "at" and "dot" in brackets, or as words where only an
address has them, become signs; in three or more digits in a row, spelled ones
become figures, "plus" before and "dot" between them signs.

Defined results: a null or empty text has no findings; repeated rows are
judged alike; other columns are not read. Offsets are code points. All patterns run
in linear time, and a task holds one slice of texts.
"""

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.arrays import slices

KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like ASCII ones.
LOOK_ALIKE = dict(
    zip(
        "АВЕКМНОРСТХУаеорсухіјѕԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρ․‐‑‒–—−∙·。",
        "ABEKMHOPCTXYaeopcyxijsdhqwABEZHIKMNOPTYXaovp.------...",
    )
)
INVISIBLE = "­​‌‍⁠﻿"

# Digits as words in four languages.
SPELLED = {
    word: str(digit)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for digit, word in enumerate(words.split())
}

_DIGIT = re.compile("[0-9]")
_FIGURES = frozenset("0123456789")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match of these begins where a run of digits does, so runs are read once.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_BRACKETS = re.compile(r"[\[({<] ?(?i:(at|arroba|@)|(dot|punkt|point|punto|\.)) ?[\])}>]")
# Spoken signs: between names in a chain that ends with a "dot", after a real "at" sign, or after a
# name that only an address would have.
_SPOKEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])(?:"
    r"[A-Za-z0-9._%+-]+( at |@)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?: dot [A-Za-z0-9-]+)+"
    r"|[A-Za-z0-9]+[._][A-Za-z0-9._%+-]*( at )[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)",
    re.IGNORECASE,
)
_AT_DOMAIN = re.compile(r" at [a-z0-9-]+\.[a-z0-9]")
_DOT = re.compile(" dot ", re.IGNORECASE)
_NUMBER = "|".join(sorted(SPELLED, key=len, reverse=True))
_SPELLED_WORD = re.compile(rf"(?<!\w)({_NUMBER})(?!\w)([ -](?=(?:{_NUMBER})(?!\w)))?|( dot )", re.IGNORECASE)
_SPELLED_RUN = re.compile(
    rf"(?:\b(plus) )?(?<!\w)(?:{_NUMBER}|[0-9])"
    rf"(?:(?: dot |[ .-]?)(?:(?<!\w)(?:{_NUMBER})(?!\w)|[0-9])){{2,}}(?!\w)",
    re.IGNORECASE,
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", found.end() if found else at + 1)


def _passes_luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _figures(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _is_ip(text: str) -> bool:
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in (x.lstrip("0") for x in text.split(".")))


def _is_card(text: str) -> bool:
    digits = _figures(text)
    return 16 <= len(digits) <= 19 and _passes_luhn(digits)


def _is_phone(text: str) -> bool:
    return 8 <= len(_figures(text)) <= 15


def plain(text: str) -> list[tuple[str, int, int]]:
    """Findings (kind, start, end) of the patterns, by kind and start."""
    found = [("email", *span) for span in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, pattern, holds in (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone)):
            if kind == "phone" and "+" not in text:
                continue
            found += [(kind, *m.span()) for m in pattern.finditer(text) if holds(m[0])]
    return found


class Mapped:
    """A rewritten text that knows the source characters of each of its own.

    Rewritten parts are kept as (start, end, source start, source end); what lies
    between them is unchanged and only shifted. A part becomes one character or
    none, so a later step never rewrites half of it.
    """

    def __init__(self, text: str):
        self.text = text
        self.parts: list[tuple[int, int, int, int]] = []

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of a span, and whether any of it was rewritten."""
        i = bisect_right(self.parts, start, key=lambda part: part[0]) - 1
        j = bisect_right(self.parts, end - 1, key=lambda part: part[0]) - 1
        touched = any(part[1] > start for part in self.parts[max(i, 0) : j + 1])
        return self._place(start, i, False), self._place(end, j, True), touched

    def _place(self, at: int, i: int, is_end: bool) -> int:
        if i < 0:
            return at
        start, end, source_start, source_end = self.parts[i]
        if at < end or (at == end and is_end):
            return source_end if is_end else source_start
        return source_end + at - end

    def rewrite(self, edits: list[tuple[int, int, str]]) -> "Mapped":
        """Replace spans of the text, in order and without overlap."""
        out, pieces, at, moved = Mapped(""), [], 0, 0
        kept = iter(self.parts)
        part = next(kept, None)
        for start, end, new in edits:
            while part and part[1] <= start:
                out.parts.append((part[0] + moved, part[1] + moved, *part[2:]))
                part = next(kept, None)
            source_start, source_end, _ = self.source(start, end)
            while part and part[0] < end:
                part = next(kept, None)
            pieces += [self.text[at:start], new]
            begin = start + moved
            moved += len(new) - (end - start)
            out.parts.append((begin, begin + len(new), source_start, source_end))
            at = end
        while part:
            out.parts.append((part[0] + moved, part[1] + moved, *part[2:]))
            part = next(kept, None)
        out.text = "".join([*pieces, self.text[at:]])
        return out


@cache
def _characters() -> dict[str, str]:
    """Characters to rewrite: invisible ones, look-alikes, and compatibility forms of ASCII."""
    table = {c: "" for c in INVISIBLE} | LOOK_ALIKE
    for code in range(0x80, 0x20000):
        new = unicodedata.normalize("NFKC", chr(code))
        if unicodedata.category(chr(code)) == "Nd":
            new = str(unicodedata.digit(chr(code)))
        if len(new) == 1 and new.isascii() and new.isprintable():
            table.setdefault(chr(code), new)
    return table


_WORD = re.compile(r"\w+")
_SPOKEN_WORDS = frozenset(SPELLED) | {"dot", "plus"}


def _folded(text: str) -> str:
    """In lower case as patterns that ignore case see it: their "i" matches two further letters."""
    return text.replace("İ", "i").replace("ı", "i").lower()


def _has_spelled_run(text: str) -> bool:
    """Whether ``_SPELLED_RUN`` may find something to rewrite; quick, and never wrongly false.

    A run consists of whole words that are spelled digits or end in a figure, with "dot" between two of
    them or "plus" before the first. A spelled digit in it has another of these words beside it.
    """
    words = _WORD.findall(_folded(text))
    if _SPOKEN_WORDS.isdisjoint(words):
        return False
    words += ["", ""]
    is_digit = lambda word: word in SPELLED or word[-1:] in _FIGURES
    for i, word in enumerate(words):
        if word in _SPOKEN_WORDS and (
            is_digit(words[i + 1]) and (word != "dot" or is_digit(words[i - 1]))
            or word in SPELLED and is_digit(words[i - 1])
        ):
            return True
    return False


def _spell(match: re.Match) -> list[tuple[int, int, str]]:
    """Figures for spelled digits, without what parts two of them; signs for "plus" and "dot"."""
    first = match.end(1) + 1 if match[1] else match.start()
    edits = [(match.start(1), first, "+")] if match[1] else []
    for word in _SPELLED_WORD.finditer(match.string, first, match.end()):
        edits.append((*word.span(), SPELLED[_folded(word[1])] if word[1] else "."))
    return edits


def normalised(text: str) -> Mapped | None:
    """The text without disguises, or None if it has none."""
    mapped = Mapped(text)
    if not text.isascii():
        table = _characters()
        if found := "".join(map(re.escape, table.keys() & set(text))):
            mapped = mapped.rewrite([(*m.span(), table[m[0]]) for m in re.finditer(f"[{found}]", text)])
    lowered, edits = mapped.text.lower(), []
    for m in _BRACKETS.finditer(mapped.text):
        start = m.start() - (mapped.text[m.start() - 1 : m.start()] == " ")
        end = m.end() + (mapped.text[m.end() : m.end() + 1] == " ")
        start = max(start, edits[-1][1]) if edits else start
        edits.append((start, end, "@" if m[1] else "."))
    mapped = mapped.rewrite(edits) if edits else mapped
    spoken = " dot " in lowered and (" at " in lowered or "@" in mapped.text)
    if spoken or _AT_DOMAIN.search(lowered):
        edits = []
        for m in _SPOKEN.finditer(mapped.text):
            start, end = m.span(1) if m[1] else m.span(2)
            edits += [(start, end, "@")] if end - start > 1 else []
            edits += [(*d.span(), ".") for d in _DOT.finditer(mapped.text, end, m.end())]
        mapped = mapped.rewrite(edits) if edits else mapped
    if _has_spelled_run(mapped.text):
        edits = [edit for m in _SPELLED_RUN.finditer(mapped.text) for edit in _spell(m)]
        mapped = mapped.rewrite(edits) if edits else mapped
    return mapped if mapped.parts else None


def disguised(text: str, known: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further findings in the normalised text, as spans of the source."""
    mapped = normalised(text)
    if mapped is None:
        return []
    taken = {kind: sorted((a, b) for k, a, b in known if k == kind) for kind in KINDS}
    found = []
    for kind, start, end in plain(mapped.text):
        a, b, touched = mapped.source(start, end)
        i = bisect_right(taken[kind], (b, -1)) - 1
        if touched and not (i >= 0 and taken[kind][i][1] > a):
            found.append((kind, a, b))
    return found


def _in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda span: (KINDS.index(span[0]), span[1], span[2]))


_SPAN = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())])
)
_SPANS = "array<struct<kind:string,start:long,end:long,plain:boolean>>"


def _texts(rows: pa.RecordBatch) -> list[str]:
    return [text or "" for text in rows.column("text").to_pylist()]


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, _, _ in slices(batches):
        spans = []
        for text in _texts(rows):
            base = plain(text)
            more = [(*span, False) for span in disguised(text, base)]
            both = _in_order([*((*span, True) for span in base), *more])
            spans.append([dict(zip(("kind", "start", "end", "plain"), span)) for span in both])
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(spans, _SPAN)], names=["doc_id", "spans"])


def findings(docs: DataFrame) -> DataFrame:
    """Columns doc_id and spans (kind, start, end, plain) of every document, by kind and start."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_detect, f"doc_id long, spans {_SPANS}")


def masked(text: str) -> str:
    """The text with the name of its kind in place of each finding.

    Findings that overlap become one, named after the first of them.
    """
    base = plain(text)
    spans = sorted((start, end, kind) for kind, start, end in [*base, *disguised(text, base)])
    merged: list[list] = []
    for start, end, kind in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    at, out = 0, []
    for start, end, kind in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def masked_documents(docs: DataFrame) -> DataFrame:
    """The documents with masked texts; ``n_chars`` follows, other columns stay.

    Every row stays, repeated ones too, and needs no id. A null text stays null and an empty one empty; a
    null ``n_chars`` stays null.
    """
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in slices(batches):
            old = rows.column("text")
            new = pa.array([None if t is None else masked(t) for t in old.to_pylist()], old.type)
            columns = [new if name == "text" else rows.column(i) for i, name in enumerate(names)]
            if "n_chars" in names:
                i = names.index("n_chars")
                columns[i] = pc.if_else(
                    pc.is_null(columns[i]), columns[i], pc.utf8_length(new).cast(columns[i].type)
                )
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)
