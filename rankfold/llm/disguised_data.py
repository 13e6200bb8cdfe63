"""Personal data in texts, plain or disguised, with the places it stands at.

Plain data is found in the text as it is. Disguises are undone by transducers that note, for
each stretch they rewrite, where it came from: one maps look-alike characters and drops
invisible ones, one joins spelled-out digits, one rewrites "at" and "dot". The same
identifiers are looked for in what comes out, and their spans are mapped back to source
characters. A disguised find is added unless a plain find of its kind covers it.

Positions are code points, ends exclusive. Every search takes time in proportion to the text,
also where a text is one long word or number.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rankfold.llm.common import map_texts, rewrite_texts

KINDS = ("email", "ip", "card", "phone")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str):
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        if (domain := _DOMAIN.match(text, at + 1)) is not None:
            start = at
            while start > done and not _NOT_LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at += 1
        # What stands before a sign that is no part of an address can begin none later.
        done = max(done, at)


def ips(text: str):
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        for hit in _IP.finditer(text, run.start(), run.end()):
            parts = [part.lstrip("0") or "0" for part in hit[0].split(".")]
            if all(len(part) <= 3 and int(part) <= 255 for part in parts):
                yield hit.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        double = int(digit) << (i & 1)
        total += double - 9 if double > 9 else double
    return total % 10 == 0


def cards(text: str):
    for hit in _CARD.finditer(text):
        if hit.end() - hit.start() >= 14:
            digits = hit[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield hit.span()


def phones(text: str):
    at = 0
    while (at := text.find("+", at)) >= 0:
        hit = _PHONE.match(text, at)
        if hit is None:
            at += 1
        else:
            if 10 <= len(_DIGIT.findall(hit[0])) <= 15:
                yield hit.span()
            at = hit.end()


_FINDERS = dict(zip(KINDS, (emails, ips, cards, phones)))


def plain(text: str) -> list[tuple[str, int, int]]:
    return [(kind, *span) for kind in KINDS for span in _FINDERS[kind](text)]


# --- transducers -------------------------------------------------------------------------

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "ԝ": "w", "х": "x", "у": "y", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H",
    "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "Α": "A", "Β": "B", "Ε": "E",
    "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y",
    "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "−": "-", " ": " ", " ": " ", " ": " ",
}

# Digits as words.
_SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3",
    "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9", "zéro": "0",
    "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8",
    "neuf": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
}


@cache
def lookalikes() -> dict[str, str]:
    """What each look-alike stands for: the list, compatibility forms, digits of all scripts."""
    table = dict(_LOOKALIKES)
    for code in (*range(0x80, 0x3400), *range(0xFE00, 0x10000), *range(0x10400, 0x1FC00)):
        char = chr(code)
        plain_form = unicodedata.normalize("NFKC", char)
        digit = unicodedata.decimal(char, None)
        if digit is not None:
            table[char] = str(digit)
        elif len(plain_form) == 1 and "!" <= plain_form <= "~":
            table.setdefault(char, plain_form)
        elif unicodedata.category(char) == "Cf":
            table.setdefault(char, "")
    table["­"] = ""
    return table


class Rewritten:
    """A text after rewriting, and the way back."""

    def __init__(self, text: str):
        self.text, self.source = text, None
        self.edits: list[tuple[int, int, int, int]] = []

    def rewrite(self, edits) -> "Rewritten":
        """``edits``: ``(start, end, replacement)`` in order, not overlapping."""
        made = Rewritten("")
        made.source, parts, done, size = self, [], 0, 0
        for start, end, new in edits:
            parts += [self.text[done:start], new]
            size += start - done + len(new)
            made.edits.append((size - len(new), size, start, end))
            done = end
        if not made.edits:
            return self
        parts.append(self.text[done:])
        made.text = "".join(parts)
        made.starts = [edit[0] for edit in made.edits]
        return made

    def back(self, start: int, end: int) -> tuple[int, int]:
        """Where a span came from; a stretch that was rewritten counts whole."""
        if self.source is None:
            return start, end
        first, last = self._origin(start)[0], self._origin(end - 1)[1]
        return self.source.back(first, last)

    def _origin(self, at: int) -> tuple[int, int]:
        k = bisect_right(self.starts, at) - 1
        # Dropped stretches have no width here: pass over those that start where this does.
        while k >= 0 and self.edits[k][0] == self.edits[k][1]:
            k -= 1
        if k >= 0 and at < self.edits[k][1]:
            return self.edits[k][2], self.edits[k][3]
        k = bisect_right(self.starts, at) - 1
        shift = self.edits[k][3] - self.edits[k][1] if k >= 0 else 0
        return at + shift, at + shift + 1


_NUMERAL = "|".join(sorted(_SPELLED, key=len, reverse=True))
_ITEM = rf"(?:(?:{_NUMERAL})(?![^\W_])|[0-9]++(?![^\W_]))"
_JOIN = r"(?:[ \t]{1,3}|[ ]?[-,][ ]?)"
_NUMERALS = re.compile(rf"(?<![^\W_]){_ITEM}(?:{_JOIN}{_ITEM})+", re.I)
_WORD = re.compile(_NUMERAL, re.I)
_ITEMS = re.compile(rf"{_ITEM}(?:{_JOIN}{_ITEM})*", re.I)
_PLUS = re.compile(r"(?<![^\W_])plus[ ]{1,3}(?=[0-9])", re.I)
_BRACKETS = ("()", "[]", "{}", "<>")
_IN_BRACKETS = lambda word: "|".join(rf"[ ]{{0,2}}\{a}[ ]?{word}[ ]?\{b}[ ]{{0,2}}" for a, b in _BRACKETS)
_DOT_SIGN = rf"(?:{_IN_BRACKETS('(?:dot|[.])')}|[ ]{{1,2}}dot[ ]{{1,2}})"
_AT_SIGN = rf"(?:{_IN_BRACKETS('(?:at|@)')}|[ ]{{1,2}}at[ ]{{1,2}}|[ ]{{0,2}}@[ ]{{0,2}})"
_AT = re.compile(_AT_SIGN, re.I)
#: What follows a sign for "at", and, read backwards from it, what stands before it: names of any
#: length joined by any number of dots and signs for "dot".
_AFTER_AT = re.compile(rf"[A-Z0-9-]++(?:(?:{_DOT_SIGN}|[.])[A-Z0-9-]++)++", re.I)
_BEFORE_AT = regex.compile(rf"(?r)[A-Z0-9_%+-]+(?:(?:{_DOT_SIGN}|[.])[A-Z0-9_%+-]+)*", regex.I)
#: Every address that is not a plain one holds one of these: of "at" alone, a sign for "dot" follows.
_SIGNED = re.compile(r"[ (\[{<](?:(?<= )(?:dot |@)|(?<=[(\[{<])[ ]?(?:at|@|dot|[.])[ ]?[)\]}>])|@ ", re.I)
_DOTS = re.compile(rf"(?<![0-9])[0-9]++(?:(?:{_DOT_SIGN}|[.])[0-9]++){{3}}", re.I)
_DOT = re.compile(_DOT_SIGN, re.I)
_PART = rf"{_ITEM}(?:{_JOIN}{_ITEM}){{0,2}}"
_SPELLED_DOTS = re.compile(rf"(?<![^\W_]){_PART}(?:(?:{_DOT_SIGN}|[.]){_PART}){{3}}", re.I)
#: What these hold where none of their dots is a sign.
_DOTTED_PARTS = re.compile(rf"[.]{_PART}[.]{_PART}[.]", re.I)


def _spelled_together(text: str) -> bool:
    """Whether two digits stand side by side, one of them as a word."""
    words = text.lower().replace("-", " ").replace(",", " ").split()
    if _SPELLED.keys().isdisjoint(words):
        return False
    spelled = [i for i, word in enumerate(words) if word in _SPELLED or word[:-1] in _SPELLED]
    if any(b - a == 1 for a, b in zip(spelled, spelled[1:])):
        return True
    beside = {words[i - 1] for i in spelled if i} | {words[i + 1] for i in spelled if i + 1 < len(words)}
    return any(word[0].isdigit() or word[-1].isdigit() for word in beside)


def _numerals(text: str):
    if not _spelled_together(text):
        return
    for run in _NUMERALS.finditer(text):
        if _WORD.search(run[0]):
            kept = run[0].lower()
            digits = re.sub(_JOIN, "", re.sub(_NUMERAL, lambda m: _SPELLED[m[0]], kept))
            yield run.start(), run.end(), digits


def _dotted_numerals(text: str):
    """Digits as words with a sign for "dot" beside them, as in addresses."""
    for run in _SPELLED_DOTS.finditer(text):
        for word in _ITEMS.finditer(run[0]):
            if not word[0].isdigit():
                digits = re.sub(_JOIN, "", re.sub(_NUMERAL, lambda m: _SPELLED[m[0]], word[0].lower()))
                yield run.start() + word.start(), run.start() + word.end(), digits


def _plus(text: str):
    if "plus" in text or "Plus" in text or "PLUS" in text:
        for hit in _PLUS.finditer(text):
            yield hit.start(), hit.end(), "+"


def _signs(text: str):
    """Signs for "at" and "dot" in addresses; every address is read once, outwards from its "at"."""
    if not _SIGNED.search(text):
        return
    edits = {}
    for hit in _DOTS.finditer(text):
        for sign in _DOT.finditer(text, hit.start(), hit.end()):
            edits[sign.start()] = (sign.end(), ".")
    done = 0
    for at in _AT.finditer(text):
        domain = at.start() >= done and _AFTER_AT.match(text, at.end())
        if not domain:
            continue
        dots = list(_DOT.finditer(text, domain.start(), domain.end()))
        # A bare "at" is a word like others unless a sign for "dot" follows.
        if at[0].strip().lower() == "at" and not dots:
            continue
        local = _BEFORE_AT.match(text, done, at.start())
        if not local:
            continue
        done = domain.end()
        edits[at.start()] = (at.end(), "@")
        for sign in [*_DOT.finditer(text, local.start(), local.end()), *dots]:
            edits[sign.start()] = (sign.end(), ".")
    done = 0
    for start, (end, new) in sorted(edits.items()):
        if start >= done and text[start:end] != new:
            yield start, end, new
            done = end


def disguised(text: str) -> list[tuple[str, int, int]]:
    """Finds in the rewritten text, as spans of the source."""
    rewritten = Rewritten(text)
    if not text.isascii():
        table = lookalikes()
        if odd := table.keys() & set(text):
            found = re.finditer("[" + "".join(map(re.escape, odd)) + "]", text)
            rewritten = rewritten.rewrite((m.start(), m.end(), table[m[0]]) for m in found)
    if _SIGNED.search(rewritten.text) or _DOTTED_PARTS.search(rewritten.text):
        rewritten = rewritten.rewrite(_dotted_numerals(rewritten.text))
    for transducer in (_numerals, _plus, _signs):
        rewritten = rewritten.rewrite(transducer(rewritten.text))
    if rewritten.source is None:
        return []
    found = [(kind, *rewritten.back(start, end)) for kind, start, end in plain(rewritten.text)]
    return found


def find(text: str) -> tuple[list, list]:
    """Plain finds, and all finds; both by start, then kind as listed."""
    order = lambda span: (span[1], KINDS.index(span[0]), span[2])
    base = sorted(plain(text), key=order)
    reach: dict[str, list] = {kind: [s for s in base if s[0] == kind] for kind in KINDS}
    more = []
    for kind, start, end in disguised(text):
        own = reach[kind]
        k = bisect_right(own, start, key=lambda s: s[1]) - 1
        if k < 0 or own[k][2] < end:
            more.append((kind, start, end))
    return base, sorted(base + more, key=order)


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, ``base_sha256`` and all ``spans``. Null: empty."""

    def find_all(texts):
        rows = [find(text.decode()) for text in texts]
        counts = {
            f"n_{kind}": ([sum(span[0] == kind for span in base) for base, _ in rows], pa.int64()) for kind in KINDS
        }
        digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]
        return counts | {
            "base_sha256": (digests, pa.string()),
            "spans": ([joined(spans) for _, spans in rows], pa.string()),
        }

    return map_texts(
        docs,
        lambda: find_all,
        ", ".join(f"n_{kind} bigint" for kind in KINDS) + ", base_sha256 string, spans string",
    )


def masked(text: str) -> str:
    """The text with a mark of its kind in place of each find; overlapping finds are joined."""
    parts, done = [], 0
    for kind, start, end in find(text)[1]:
        if end <= done:
            continue
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*parts, text[done:]])


def mask_texts(docs: DataFrame) -> DataFrame:
    """The same rows and columns; finds in ``text`` are masked and ``n_chars`` says the new length.

    Null texts stay null, and so does their length.
    """
    return rewrite_texts(docs, lambda: masked)
