"""Licence scans with a generalised suffix automaton.

The automaton holds every run of words of every template. Fed a text word by word, it knows
the longest run that ends at each word (the matching statistics); the states it links to
know the shorter runs of other templates that end there, and all places they end at. Long
runs are chained, in the order of text and template, by a dynamic program that keeps the
chain covering most. A template of which a chain covers enough is found; where templates
share wording, the one that covers most of the text gives the label. Words that no template
has end every run, so only stretches of template words that are long enough to matter are
fed to the automaton. The templates are a short fixed list, and so is the automaton that
each task builds from them.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankfold.llm.common import map_texts
from rankfold.llm.licence_texts import TEMPLATES

#: Phrases that count wherever their words stand together, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Lower case for A-Z, and a blank for each ASCII character that is in no word.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class State:
    length: int
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)
    #: Every template and place in it where the state's runs end.
    ends: set[tuple[int, int]] = field(default_factory=set)


class SuffixAutomaton:
    """All runs of several sequences of numbers."""

    def __init__(self, sequences):
        self.states = [State(0)]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, symbol in enumerate(sequence):
                last = self._extend(last, symbol)
                self.states[last].ends.add((number, at + 1))
        for i in sorted(range(1, len(self.states)), key=lambda i: -self.states[i].length):
            if link := self.states[i].link:
                self.states[link].ends |= self.states[i].ends

    def _extend(self, last: int, symbol: int) -> int:
        states = self.states
        if symbol in states[last].next:
            return self._exact(last, symbol)
        made = len(states)
        states.append(State(states[last].length + 1))
        at = last
        while at >= 0 and symbol not in states[at].next:
            states[at].next[symbol] = made
            at = states[at].link
        states[made].link = 0 if at < 0 else self._exact(at, symbol)
        return made

    def _exact(self, at: int, symbol: int) -> int:
        """The state after ``symbol`` whose longest run is one word longer; split off if need be."""
        states = self.states
        to = states[at].next[symbol]
        if states[to].length == states[at].length + 1:
            return to
        made = len(states)
        states.append(State(states[at].length + 1, states[to].link, dict(states[to].next)))
        states[to].link = made
        while at >= 0 and states[at].next.get(symbol) == to:
            states[at].next[symbol] = made
            at = states[at].link
        return made

    def matches(self, symbols):
        """For each symbol: the length of the longest known run that ends there, and its state."""
        states, at, length = self.states, 0, 0
        for symbol in symbols:
            while at and symbol not in states[at].next:
                at = states[at].link
                length = states[at].length
            if symbol in states[at].next:
                at, length = states[at].next[symbol], length + 1
            yield length, at


    def runs(self, symbols, least: int):
        """``(template, end in it, end among the symbols, length)`` of each run that cannot go on.

        A run is the longest that ends at its two places; it counts from ``least`` symbols.
        """
        before: dict[tuple[int, int], int] = {}
        end = 0
        for end, (length, state) in enumerate(self.matches(symbols), 1):
            here: dict[tuple[int, int], int] = {}
            while length >= least:
                for place in self.states[state].ends:
                    here.setdefault(place, length)
                state = self.states[state].link
                length = self.states[state].length
            for (template, stop), size in before.items():
                if (template, stop + 1) not in here:
                    yield template, stop, end - 1, size
            before = here
        for (template, stop), size in before.items():
            yield template, stop, end, size


def chains(runs: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """``(words covered, -first word, -end word)`` of the best chain that ends with each run.

    A run is ``(end in the text, end in the template, length)``; runs are in ascending order.
    A chain goes on with a run that ends later in both and starts at most ``gap`` words after
    the last one's end in the text. What two runs share, in the text or in the template,
    counts once. Of chains that cover as much, the one that starts last is kept.
    """
    best: list[tuple[int, int, int]] = []
    for j, (b, y, length) in enumerate(runs):
        a, x = b - length, y - length
        most, start = length, a
        for i in range(j - 1, -1, -1):
            p, q, _ = runs[i]
            if a - p > gap:
                break
            if p < b and q < y:
                gained = best[i][0] + min(b - max(a, p), y - max(x, q))
                if (gained, best[i][2]) > (most, start):
                    most, start = gained, best[i][2]
        best.append((most, b, start))
    return [(most, -start, -b) for most, b, start in best]


class LicenceScanner:
    def __init__(self, templates, least: int, gap: int, enough: float):
        self.least, self.gap, self.enough = least, gap, enough
        self.labels = [label for label, _ in templates]
        split = [words_of(text.encode()) for _, text in templates]
        phrases = {phrase.encode(): label for phrase, label in PHRASES.items()}
        self.numbers: dict[bytes, int] = {}
        for words in [*split, *(phrase.split() for phrase in phrases)]:
            for word in words:
                self.numbers.setdefault(word, len(self.numbers) + 1)
        self.sizes = list(map(len, split))
        self.automaton = SuffixAutomaton([[self.numbers[w] for w in words] for words in split])
        self.phrases = [([self.numbers[w] for w in phrase.split()], label) for phrase, label in phrases.items()]

    def spans(self, ids: np.ndarray):
        """``(template, first word, end word, words covered)`` of the chains that are found.

        Of one template's chains that meet in the text, that which covers most stays (of equals
        the one that starts first). A chain whose words lie by half or more in better ones is
        dropped: those that cover more words, then a greater share of their template.
        """
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0])).astype(np.int8)))
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start >= self.least:
                for template, stop, at, length in self.automaton.runs(ids[start:end].tolist(), self.least):
                    runs.setdefault(template, []).append((start + at, stop, length))
        found = []
        for template, own in runs.items():
            size = self.sizes[template]
            enough = [c for c in chains(sorted(own), self.gap) if c[0] >= self.enough * size]
            taken: list[tuple[int, int]] = []
            for covered, first, end in sorted(enough, key=lambda c: (-c[0], -c[1], -c[2])):
                span = (-first, -end)
                k = bisect_left(taken, span)
                if (k == 0 or taken[k - 1][1] <= span[0]) and (k == len(taken) or span[1] <= taken[k][0]):
                    taken.insert(k, span)
                    found.append((template, *span, covered))
        better = np.zeros(len(ids), bool)
        kept = []
        for span in sorted(found, key=lambda s: (-s[3], -s[3] / self.sizes[s[0]], s[1], s[0])):
            _, first, end, _ = span
            if 2 * np.count_nonzero(better[first:end]) < end - first:
                better[first:end] = True
                kept.append(span)
        return kept

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        get = self.numbers.get
        ids = np.fromiter((get(word, 0) for word in words), np.int64, len(words))
        starts, base = [], set()
        for phrase, label in self.phrases:
            ends = np.flatnonzero(ids == phrase[-1])
            ends = ends[ends >= len(phrase) - 1]
            for back, number in enumerate(reversed(phrase[:-1]), 1):
                ends = ends[ids[ends - back] == number]
            if len(ends):
                base.add(label)
                starts += (ends - len(phrase) + 1).tolist()
        spans = self.spans(ids)
        score = max((s[3] / self.sizes[s[0]] for s in spans), default=0.0)
        return {
            "n_words": len(words),
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {self.labels[s[0]] for s in spans})),
            "score": score,
            "spans": [
                {"label": self.labels[t], "first": a, "end": b, "covered": c / self.sizes[t]}
                for t, a, b, c in sorted(spans, key=lambda s: (s[1], s[2], s[0]))
            ],
        }


_SPAN = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())])
_KINDS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(_SPAN),
}


def scan_licences(docs: DataFrame, templates=tuple(TEMPLATES), least: int = 4, gap: int = 20, enough: float = 0.7) -> DataFrame:
    """One row per document: counts, labels, score and the spans that templates cover.

    ``least``: words in a run that counts; ``gap``: words between two runs of a chain;
    ``enough``: the share of a template that gives its label. A null text has no words.
    """

    def make():
        scanner = LicenceScanner(templates, least, gap, enough)

        def scan(texts):
            rows = list(map(scanner.scan, texts))
            return {name: ([row[name] for row in rows], kind) for name, kind in _KINDS.items()}

        return scan

    return map_texts(
        docs,
        make,
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, spans array<struct<label:string,first:bigint,end:bigint,covered:double>>",
    )
