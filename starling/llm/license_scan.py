"""Licence scan: matching statistics over a generalised suffix automaton, chained into template spans.

The automaton (:class:`Automaton`) recognises every run of words of every licence
template.  A document's words are streamed through it; after each word the state
and length tell the longest run of words ending there that some template holds
(its matching statistics).  A run that cannot be prolonged and has ``MIN_MATCH``
words or more is a match, at every place where templates hold it.  Matches of one
template that follow each other in the document and in the template, with at most
``MAX_GAP`` words between them on either side, are chained (:func:`chains`); a
chain covers a span of the document and a number of template words.  Of spans
over the same words the one that covers most stays (:func:`best_spans`).  A span
gives its template's label when it covers ``MIN_COVER`` of the template or
``LONG_COVER`` of its words.

Base phrases ("mit license") are counted at all their places, beside the spans.

At scale: one map over the documents without a shuffle.  Templates are fixed
values of a few thousand words; each Python worker builds the automaton once.  A
text is read in segments, its words kept as 4 bytes each.  Words that are not in a
template, and pairs of words that no template holds, cannot be part of a match,
so only the runs between them are streamed; that skips work and no match.

Defined cases: a null or empty text has no words, no labels, null places and score
0; repeated rows are documents of their own; equal spans go to the first label;
an empty table gives an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starling.llm.common import arrow_map, text_or_empty
from starling.llm.license_templates import PHRASES, TEMPLATES

MIN_MATCH, MAX_GAP = 4, 12
MIN_COVER, LONG_COVER = 0.7, 40
SEGMENT = 1 << 20

# Fixed value: a word is a run of digits, small letters and code points outside ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NO_WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def words(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())  # bytes.lower() changes A-Z only


class Automaton:
    """The suffix automaton of several sequences; ``ends[s]`` lists (sequence, end) of the runs of state ``s``."""

    def __init__(self, sequences: list[list[int]], min_match: int):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        for t, sequence in enumerate(sequences):
            state = 0
            for at, word in enumerate(sequence):
                state = self._extend(state, word, own)
                own[state].append((t, at + 1))
        # an end of a state is an end of the states its links lead to; short runs are never asked for
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up = self.link[s]
            if up > 0 and self.size[up] >= min_match:
                own[up] += own[s]
        self.ends = [sorted(set(e)) if n >= min_match else [] for e, n in zip(own, self.size)]

    def _new(self, size: int, step: dict, link: int, own: list) -> int:
        self.size.append(size)
        self.step.append(step)
        self.link.append(link)
        own.append([])
        return len(self.size) - 1

    def _split(self, state: int, word: int, own: list) -> int:
        """The state for the run of ``state`` and ``word`` alone, where its target stands for longer runs too."""
        target = self.step[state][word]
        if self.size[target] == self.size[state] + 1:
            return target
        copy = self._new(self.size[state] + 1, dict(self.step[target]), self.link[target], own)
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int, own: list) -> int:
        if word in self.step[last]:
            return self._split(last, word, own)
        state = self._new(self.size[last] + 1, {}, 0, own)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = state
            at = self.link[at]
        self.link[state] = self._split(at, word, own) if at >= 0 else 0
        return state

    def matches(self, sequence: list[int], min_match: int) -> list[tuple[int, int, int]]:
        """(end, length, state) of the runs of ``min_match`` words or more that the next word does not prolong."""
        step, link, size = self.step, self.link, self.size
        state = length = 0
        out = []
        for at, word in enumerate(sequence):
            before = (at, length, state)
            while state and word not in step[state]:
                state = link[state]
                length = size[state]
            if word in step[state]:
                state = step[state][word]
                length += 1
            if length <= before[1] and before[1] >= min_match:
                out.append(before)
        if length >= min_match:
            out.append((len(sequence), length, state))
        return out


class Scanner:
    """Everything derived from templates and phrases; built once per worker."""

    def __init__(self, templates, phrases, min_match: int):
        texts = [words(t) for _, t in templates]
        named = [words(p) for p, _ in phrases]
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts + named for w in t))}
        sequences = [[self.vocabulary[w] for w in t] for t in texts]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(s) for s in sequences]
        self.phrases = [([self.vocabulary[w] for w in p], label) for p, (_, label) in zip(named, phrases)]
        self.automaton = Automaton(sequences, min_match)
        self.min_match = min_match
        n = len(self.vocabulary)
        self.pairs = np.zeros((n + 1, n + 1), dtype=bool)  # the last row and column are for other words
        for s in sequences:
            self.pairs[s[:-1], s[1:]] = True

    def ids(self, text: bytes) -> np.ndarray:
        """Word numbers, -1 for words that no template has; the text is read segment by segment."""
        text = text.lower()
        out = array("i")
        at = 0
        while at < len(text):
            cut = NO_WORD.search(text, at + SEGMENT)
            to = cut.start() if cut else len(text)
            out.extend(map(self.vocabulary.get, WORD.findall(text, at, to), repeat(-1)))
            at = to
        return np.frombuffer(out, dtype=np.int32) if out else np.zeros(0, dtype=np.int32)

    def base(self, ids: np.ndarray) -> dict[str, np.ndarray]:
        """Starts of each label's phrases."""
        found: dict[str, np.ndarray] = {}
        for phrase, label in self.phrases:
            at = np.flatnonzero(ids == phrase[0])
            at = at[at <= len(ids) - len(phrase)]
            for k in range(1, len(phrase)):
                at = at[ids[at + k] == phrase[k]]
            if len(at):
                found[label] = np.union1d(found[label], at) if label in found else at
        return found

    def template_matches(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(template, start, template start, length) of every match, by start."""
        ok = np.zeros(len(ids) + 1, dtype=bool)
        if len(ids) > 1:
            ok[1:-1] = self.pairs[ids[:-1], ids[1:]]
        edge = np.diff(ok.astype(np.int8))
        out = []
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if b - a + 1 < self.min_match:  # the words a to b
                continue
            for end, length, state in self.automaton.matches(ids[a:b + 1].tolist(), self.min_match):
                for t, stop in self.automaton.ends[state]:
                    out.append((t, a + end - length, stop - length, length))
        return out


@lru_cache(maxsize=8)
def scanner(templates: tuple, phrases: tuple, min_match: int) -> Scanner:
    return Scanner(templates, phrases, min_match)


def chains(matches: list[tuple[int, int, int, int]], max_gap: int = MAX_GAP) -> list[tuple[int, int, int, int, int, int]]:
    """Chains of the matches: (template, start, stop, template start, template stop, covered words).

    Matches come in order of their starts.  One that overlaps the chain before it
    counts its new words only.  Of the chains a match can prolong, it takes the one
    that covers most; every match ends one chain, and chains that a later match
    prolonged are left out.
    """
    found: dict[int, list] = {}  # template: chains [start, stop, template start, template stop, covered, prolonged]
    done = []
    for t, at, place, length in sorted(matches, key=lambda m: (m[1], m[0], m[2])):
        open_chains = [c for c in found.get(t, ()) if at - c[1] <= max_gap]
        done += [(t, c) for c in found.get(t, ()) if at - c[1] > max_gap]
        best = None
        for c in open_chains:
            skip = max(0, c[1] - at, c[3] - place)  # words of the match that the chain has already
            if skip < length and at >= c[0] and place >= c[2] and place - c[3] <= max_gap:
                covered = c[4] + length - skip
                if best is None or covered > best[0]:
                    best = (covered, c)
        if best is None:
            chain = [at, at + length, place, place + length, length, False]
        else:
            covered, c = best
            c[5] = True
            chain = [c[0], at + length, c[2], place + length, covered, False]
        found[t] = [*open_chains, chain]
    done += [(t, c) for t, cs in found.items() for c in cs]
    return sorted((t, *c[:5]) for t, c in done if not c[5])


def best_spans(spans: list[tuple[int, int, int, int, int, int]], sizes: list[int]) -> list[tuple[int, int, int, int, int, int]]:
    """Of spans that share half of the words of the shorter one, that which covers most words, then most of its template."""
    chosen: list = []
    group: list = []
    stop = 0
    for s in [*sorted(spans, key=lambda s: s[1]), None]:
        if s is not None and group and s[1] < stop:
            group.append(s)
            stop = max(stop, s[2])
            continue
        kept: list = []  # spans of different groups share no word
        for g in sorted(group, key=lambda g: (-g[5], -g[5] / sizes[g[0]], g[0], g[1])):
            if all(2 * (min(g[2], k[2]) - max(g[1], k[1])) < min(g[2] - g[1], k[2] - k[1]) for k in kept):
                kept.append(g)
        chosen += kept
        if s is not None:
            group, stop = [s], s[2]
    return sorted(chosen, key=lambda s: s[1])


SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("template", pa.int32()),
                  ("template_start", pa.int64()), ("template_stop", pa.int64()), ("covered", pa.int64()),
                  ("share", pa.float64())])
_SPAN_SQL = ("array<struct<label: string, start: bigint, stop: bigint, template: int, template_start: bigint, "
             "template_stop: bigint, covered: bigint, share: double>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple = TEMPLATES,
         phrases: tuple = PHRASES, min_match: int = MIN_MATCH, max_gap: int = MAX_GAP) -> DataFrame:
    """One row per document: doc_id, n_words, places (map of label to the starts of its phrases), spans."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(b):
        s = scanner(templates, phrases, min_match)
        n, places, spans = [], [], []
        for text in b.column("text").cast(pa.binary()):
            ids = s.ids(text.as_py())
            n.append(len(ids))
            places.append([(k, v.tolist()) for k, v in sorted(s.base(ids).items())])
            spans.append([(s.labels[t], a, e, t, ta, te, covered, covered / s.sizes[t]) for t, a, e, ta, te, covered in
                          best_spans(chains(s.template_matches(ids), max_gap), s.sizes)])
        names = SPAN.names
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(places, pa.map_(pa.string(), pa.list_(pa.int64()))),
             pa.array([[dict(zip(names, x)) for x in row] for row in spans], pa.list_(SPAN))],
            names=["doc_id", "n_words", "places", "spans"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, run, f"doc_id {id_type}, n_words long, places map<string, array<bigint>>, spans {_SPAN_SQL}")


def labelled(scanned: DataFrame, min_cover: float = MIN_COVER, long_cover: int = LONG_COVER) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: the digest of :func:`scan`."""
    starts = F.flatten(F.map_values("places"))
    found = F.transform(F.filter("spans", lambda s: (s.share >= min_cover) | (s.covered >= long_cover)), lambda s: s.label)
    base = F.map_keys("places")
    return scanned.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, found)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s.share)), F.lit(0.0)).alias("score"))
