"""Encoding and decoding with merge-type piece vocabularies.

A text's symbols stand in a row. An agenda holds every adjacent pair that forms a piece, best
score first, of equal scores the leftmost; the best pair is merged and its new neighbours
are entered. No merge crosses a place where no piece of the vocabulary joins the characters
on its two sides, so a text is cut at such places, and what a cut-out unit gives is
remembered. Units seen for the first time are checked, batch by batch, against the library.

For vocabularies with identity normalisation, an added leading space and byte fallback, no
user-defined symbols; the check fails for others.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from rankfold.llm.common import map_texts

SPACE = "▁"

#: Units that a worker remembers before it starts afresh, half as many with their ids, and the
#: longest that it remembers.
REMEMBERED, LONGEST = 1 << 19, 64

_LETTER = r"\p{L}\p{M}"
_UNITS = rf"{SPACE}*[{_LETTER}]+|{SPACE}*[^{_LETTER}{SPACE}\n]+|{SPACE}+|\n"


class PieceMerging:
    def __init__(self, path: str):
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        self.pieces = [library.id_to_piece(i) for i in range(size)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        self.byte_of = {i: byte for byte, i in self.bytes.items()}
        self.silent = {i for i in range(size) if library.is_control(i)}
        plain = [i for i in range(size) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.cost = {self.pieces[i]: -library.get_score(i) for i in plain}
        joined = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        letter = regex.compile(f"[{_LETTER}]")
        crossing = any(
            b == SPACE != a or "\n" in (a, b) or (a != SPACE and bool(letter.match(a)) != bool(letter.match(b)))
            for a, b in joined
        )
        #: Cuts a text where no piece joins the two sides; the whole text if that is not so.
        self.cut = regex.compile(r"(?s).+" if crossing else _UNITS).findall

    def encode(self, symbols: str) -> list[int]:
        """Ids of symbols whose spaces are already marked."""
        parts, n = list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        cost = self.cost
        agenda = [(c, i, i + 1, 2) for i in range(n - 1) if (c := cost.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            a, b = parts[i], parts[j]
            if not a or not b or len(a) + len(b) != size:
                continue
            parts[i], parts[j], k = a + b, "", after[j]
            after[i] = k
            h = before[i]
            if h >= 0 and (c := cost.get(parts[h] + parts[i])) is not None:
                heapq.heappush(agenda, (c, h, i, len(parts[h]) + size))
            if k < n:
                before[k] = i
                if (c := cost.get(parts[i] + parts[k])) is not None:
                    heapq.heappush(agenda, (c, i, k, size + len(parts[k])))
        ids, found = [], self.ids
        for part in parts:
            if part:
                known = found.get(part)
                if known is None:
                    ids.extend(self.bytes[byte] for byte in part.encode())
                else:
                    ids.append(known)
        return ids

    def spell(self, ids: list[int]) -> str:
        """The pieces' text, spaces still marked; bytes that are no UTF-8 are replaced."""
        parts, run = [], bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                run.append(byte)
                continue
            if run:
                parts.append(run.decode(errors="replace"))
                run = bytearray()
            if i not in self.silent:
                parts.append(self.pieces[i])
        if run:
            parts.append(run.decode(errors="replace"))
        return "".join(parts)

    def check(self, units: dict[str, list[int]]) -> None:
        """Compare with the library, each unit behind a character that nothing merges with."""
        wanted = self.library.encode(["\n" + unit for unit in units], num_threads=1)
        skipped = len(self.library.encode("\n"))
        for (unit, ids), known in zip(units.items(), wanted):
            if known[skipped:] != ids:
                raise ValueError(f"the library encodes {unit[:40]!r} otherwise: is this a merge-type vocabulary?")


def marked(text: str) -> str:
    """The symbols of a text: a leading space is added to any that is not empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def unmarked(symbols: str) -> str:
    return symbols.removeprefix(SPACE).replace(SPACE, " ")


_LOADED: dict[tuple[str, bool], tuple[PieceMerging, dict]] = {}


def loaded(path: str, ids: bool = True) -> tuple[PieceMerging, dict]:
    """The vocabulary, and what is remembered of units with or without their ids."""
    if (path, ids) not in _LOADED:
        _LOADED[path, ids] = (PieceMerging(path), {})
    return _LOADED[path, ids]


def encode_texts(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """Each row's encoding: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and ``ids``.

    A null text is empty. ``decoded_sha256`` is of the text that the ids decode to, with a
    marked space for a space, as the vocabulary has it. ``path`` names a vocabulary file
    that is installed on every worker.
    """

    def make():
        merging, known = loaded(path, ids)

        def entry(unit: str, made: list[int]):
            return ",".join(map(str, made)), len(made), merging.spell(made), np.array(made, np.int32).tobytes() if ids else None

        def encode(texts):
            cut = [merging.cut(marked(data.decode())) for data in texts]
            new, long = {}, {}
            for units in cut:
                for unit in units:
                    if unit not in known and unit not in new:
                        new[unit] = merging.encode(unit)
            if new:
                merging.check(new)
                if len(known) + len(new) > REMEMBERED >> ids:
                    known.clear()
                    for units in cut:
                        new.update((unit, merging.encode(unit)) for unit in units if unit not in new)
                for unit, made in new.items():
                    (known if len(unit) <= LONGEST else long)[unit] = entry(unit, made)
            if long:
                found = [[known.get(unit) or long[unit] for unit in units] for units in cut]
            else:
                found = [list(map(known.__getitem__, units)) for units in cut]
            out = {
                "n_tokens": ([sum(e[1] for e in row) for row in found], pa.int64()),
                "ids_sha256": ([hashlib.sha256(",".join([e[0] for e in row]).encode()).hexdigest() for row in found], pa.string()),
                "decoded_sha256": (
                    [hashlib.sha256(unmarked("".join([e[2] for e in row])).encode()).hexdigest() for row in found],
                    pa.string(),
                ),
            }
            if ids:
                made = np.frombuffer(b"".join([e[3] for row in found for e in row]), np.int32)
                ends = np.cumsum([0, *out["n_tokens"][0]]).astype(np.int32)
                out["ids"] = (pa.ListArray.from_arrays(pa.array(ends), pa.array(made)),)
            return out

        return encode

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return map_texts(docs, make, schema)
