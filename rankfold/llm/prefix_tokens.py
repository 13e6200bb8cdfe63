"""Exact token counts of every prefix, for byte-level pair merging.

The encoding of a prefix ends in exactly one token, and what comes before that token is the
encoding of a shorter prefix. So one pass over a piece of text keeps, for each of its
prefixes, the last token and the number of tokens: the last token of a prefix is the one
that ends there and that merging keeps apart from the last token of the rest. Whether
merging keeps two tokens apart is asked of the merge list, once for each pair of tokens.

Text is first cut into pieces as the tokenizer does. ``PrefixCounts`` puts the tables of the
pieces together to one of the whole text, and answers any prefix and budget by lookup.
"""

from __future__ import annotations

import json
from array import array
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import map_texts, rewrite_texts

#: Fixed: the pattern that cuts text before merging, as the vocabulary's makers published it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pieces whose counts a task remembers before it starts afresh.
REMEMBERED = 1 << 19


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in shown}
    hidden = (byte for byte in range(256) if byte not in letters)
    return letters | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


class PairMerging:
    """The vocabulary and merge list of a byte-level tokenizer file.

    Tokens are numbered by the merge that makes them, single bytes first; a pair of numbers
    is kept as one integer.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = {letter: byte for byte, letter in byte_letters().items()}
        as_bytes = lambda shown: bytes(letters[c] for c in shown)
        merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        self.special = [t["content"] for t in content["added_tokens"]]
        self.number = {bytes([byte]): byte for byte in range(256)}
        #: The two parts of each token; for a single byte, nothing.
        self.parts: list[tuple[int, int]] = [(-1, -1)] * 256
        #: By pair, the number of the token that merging it makes.
        self.merged: dict[int, int] = {}
        for a, b in merges:
            left, right = self.number.get(as_bytes(a)), self.number.get(as_bytes(b))
            if left is None or right is None:
                continue
            made = len(self.parts)
            self.parts.append((left, right))
            self.merged[left << 20 | right] = made
            # A token that merging its own bytes does not give can end no encoding.
            if self._apart(left, right, made):
                self.number.setdefault(as_bytes(a) + as_bytes(b), made)
        #: Finds all tokens in a piece, its bytes read as characters.
        self.found = ahocorasick.Automaton()
        for token, made in self.number.items():
            self.found.add_word(token.decode("latin-1"), (len(token), made))
        self.found.make_automaton()
        self._known: dict[int, bool] = {}

    def _apart(self, a: int, b: int, before: int) -> bool:
        """Whether no merge crosses the border of two tokens before merge ``before``.

        Undo the merges next to the border, latest first. The pair that then meets at the
        border must not merge before the merge just undone; of equal merges the left one
        goes first.
        """
        merged, parts = self.merged, self.parts
        while True:
            if merged.get(a << 20 | b, before) < before:
                return False
            if a > b:
                if a < 256:
                    return True
                before, a = a, parts[a][1]
            elif b < 256:
                return True
            else:
                before, b = b + 1, parts[b][0]

    def prefix_counts(self, piece: bytes) -> list[int]:
        """The number of tokens of each prefix of one piece, the empty one first."""
        known, count = self._known, [0] * (len(piece) + 1)
        last = [-1] * (len(piece) + 1)
        # Every token that ends at each place, found in one pass.
        for at, (size, token) in self.found.iter(piece.decode("latin-1")):
            end, start = at + 1, at + 1 - size
            if last[end] >= 0:
                continue
            if start:
                pair = last[start] << 20 | token
                fits = known.get(pair)
                if fits is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    fits = known[pair] = self._apart(last[start], token, len(self.parts))
                if not fits:
                    continue
            last[end], count[end] = token, count[start] + 1
        return count


class PrefixCounts:
    """The exact number of tokens of every prefix of one text, in characters.

    A prefix that ends inside a piece is cut like the whole text, so that piece's own table
    says what it adds. White space before the end of a text is one piece, so its runs have
    tables of their own; so have the beginnings of contractions, which are two pieces, and
    those of special strings, which are ordinary text until they are whole.

    With a ``budget`` the table ends where no longer prefix can keep within it.
    """

    def __init__(self, merging: PairMerging, text: str, budget: int | None = None, tables=None):
        self.chars = len(text)
        self.tables = tables or merging.prefix_counts
        self.counts = array("q", [0])
        at = 0
        for hit in _specials(merging).finditer(text):
            if not self._ordinary(text[at : hit.start()] + hit[0][:-1], hit.start() - at, budget):
                break
            self.counts.append(self.counts[hit.start()] + 1)
            at = hit.end()
        else:
            self._ordinary(text[at:], len(text) - at, budget)
        # The least count from each place on never falls, so a budget is found by bisection.
        self._least = np.minimum.accumulate(np.asarray(self.counts)[::-1])[::-1]

    def _ordinary(self, text: str, own: int, budget: int | None) -> bool:
        """Append the counts of a stretch without special strings; whether it was read to its end.

        Past its ``own`` characters begins a special string, which will count less than its beginnings.
        """
        counts, first = self.counts, len(self.counts) - 1
        total = counts[first]
        end = 0
        for hit in _CUT.finditer(text):
            piece = hit[0]
            if budget is not None and total > budget and hit.start() <= own and not _BLANK.match(piece):
                break
            table = self._by_character(piece)
            counts.extend([total + count for count in table[1:]])
            total, end = counts[-1], hit.end()
        for run in _BLANKS.finditer(text, 0, end):
            before = counts[first + run.start()]
            counts[first + run.start() + 1 : first + run.end() + 1] = array(
                "q", [before + count for count in self._by_character(run[0])[1:]]
            )
        return end == len(text)

    def _by_character(self, piece: str):
        data = piece.encode()
        table = self.tables(data)
        if len(data) != len(piece):
            # Bytes that go on with a character end no prefix.
            table = [0, *(table[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80)]
        if len(piece) == 3 and _CONTRACTION.fullmatch(piece):
            table = [0, 1, 2, table[3]]
        return table

    def at(self, chars: int) -> int:
        """The exact number of tokens of the first ``chars`` characters."""
        return self.counts[max(0, min(chars, self.chars))]

    def total(self) -> int:
        return self.at(self.chars)

    def fitting(self, budget: int) -> int:
        """The characters of the longest prefix of at most ``budget`` tokens."""
        return max(0, int(np.searchsorted(self._least, budget, side="right")) - 1)


_CUT = regex.compile(PATTERN)
_CONTRACTION = regex.compile("'re|'ve|'ll")
_BLANK, _BLANKS = regex.compile(r"\s"), regex.compile(r"\s{2,}")


@cache
def _special_pattern(special: tuple[str, ...]):
    return regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or r"(?!)")


def _specials(merging: PairMerging):
    return _special_pattern(tuple(merging.special))


class _Counts(dict):
    """Token counts by piece, made when first asked for; the tables they end are kept too."""

    def __init__(self, merging: PairMerging):
        super().__init__()
        self.merging = merging
        self.kept: dict[bytes, bytes] = {}

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = self.table(piece.encode())[-1]
        if len(piece) <= 64:
            self[piece] = count
        return count

    def table(self, piece: bytes):
        """The number of tokens of each prefix of a piece, the empty one first."""
        table = self.kept.get(piece)
        if table is None:
            table = self.merging.prefix_counts(piece)
            if len(piece) <= 64:
                if len(self.kept) >= REMEMBERED:
                    self.kept.clear()
                # No prefix has more tokens than bytes, so a count is one byte.
                table = self.kept[piece] = bytes(table)
        return table


_LOADED: dict[str, tuple[PairMerging, _Counts]] = {}


def loaded(path: str) -> tuple[PairMerging, _Counts]:
    """The vocabulary and the remembered counts, once in each worker."""
    if path not in _LOADED:
        merging = PairMerging(path)
        _LOADED[path] = (merging, _Counts(merging))
    return _LOADED[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fit_chars`` for each row; a null text is empty.

    ``fit_chars``: the characters of the longest prefix of at most ``limit`` tokens.
    ``path`` names a vocabulary file that is installed on every worker.
    """

    def make():
        merging, counts = loaded(path)
        findall, special = _CUT.findall, merging.special

        def count(texts):
            totals, fits = [], []
            for data in texts:
                text = data.decode()
                parts, total = [text], 0
                for word in special:
                    if word in parts[0] or len(parts) > 1:
                        split = [part.split(word) for part in parts]
                        total += sum(len(s) - 1 for s in split)
                        parts = [p for s in split for p in s]
                total += sum(sum(map(counts.__getitem__, findall(part))) for part in parts)
                totals.append(total)
                fits.append(
                    len(text) if total <= limit else PrefixCounts(merging, text, limit, counts.table).fitting(limit)
                )
            return {
                "n_bytes": (list(map(len, texts)), pa.int64()),
                "n_tokens": (totals, pa.int64()),
                "fit_chars": (fits, pa.int64()),
            }

        return count

    counted = map_texts(docs, make, "n_bytes bigint, n_tokens bigint, fit_chars bigint")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars")


def prefix_tokens_at(docs: DataFrame, path: str, chars: list[int]) -> DataFrame:
    """``doc_id, counts``: the tokens of the prefixes of these lengths, each text read once.

    A length beyond the text counts as the whole text; a null text is empty.
    """

    def make():
        merging, counts = loaded(path)

        def answer(texts):
            tables = (PrefixCounts(merging, data.decode(), None, counts.table) for data in texts)
            return {"counts": ([[table.at(n) for n in chars] for table in tables], pa.list_(pa.int64()))}

        return answer

    return map_texts(docs, make, "counts array<bigint>")


def truncate_texts(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """The same rows and columns; ``text`` is its longest prefix of at most ``budget`` tokens.

    ``n_chars``, if there is one, says the new length. A null text and its length stay null.
    """

    def make():
        merging, counts = loaded(path)
        return lambda text: text[: PrefixCounts(merging, text, budget, counts.table).fitting(budget)]

    return rewrite_texts(docs, make)
