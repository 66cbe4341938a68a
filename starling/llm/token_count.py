"""Word-piece counts with a linear longest-match automaton.

A word is cut greedily: the longest vocabulary entry that starts it, then the
longest that starts the rest, and so on.  The vocabulary marks entries that end
a word; here the last character of a word is a symbol of its own, so one trie
holds both kinds.  The trie has a failure link and a popped-token count for
every node: on a mismatch the automaton adds the count, moves to the link and
goes on with the same character.  It never steps back in the word and never
builds a piece, so a word costs time linear in its length.

Words and characters are those of the vocabulary file: lower-cased NFC text,
split by its pattern, UTF-8 bytes written as its byte characters.  A word that
cannot be cut counts as one unknown piece (``n_unknown``).

Defined cases: null and empty texts have 0 tokens and 0 words; a very long word
is counted whole; repeated rows are counted alike; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from starling.llm.common import text_or_empty

CACHE_PIECES, LONGEST_CACHED, STEP = 200_000, 64, 512
_END = 0x10000  # added to the last character of a word


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b) if b in keep else chr(spare))
        spare += b not in keep
    return out


class Automaton:
    """The trie with failure links and popped-token counts."""

    ROOT = 0

    def __init__(self, entries: list[str]):
        """``entries``: pieces whose last character is marked when they end a word."""
        self.next: list[dict[str, int]] = [{}]
        final = [False]
        for entry in entries:
            node = 0
            for c in entry:
                child = self.next[node].get(c)
                if child is None:
                    child = self.next[node][c] = len(self.next)
                    self.next.append({})
                    final.append(False)
                node = child
            final[node] = True
        # breadth first: a node's link needs those of shorter strings only
        self.link: list[int | None] = [None] * len(self.next)
        self.pops = [0] * len(self.next)
        order = [(0, c, v) for c, v in self.next[0].items()]
        for parent, c, node in order:
            if final[node]:
                self.link[node], self.pops[node] = 0, 1
            else:
                pops, at = self.pops[parent], self.link[parent]
                while at is not None and c not in self.next[at]:
                    pops += self.pops[at]
                    at = self.link[at]
                if at is not None:
                    self.link[node], self.pops[node] = self.next[at][c], pops
            order += [(node, d, v) for d, v in self.next[node].items()]

    def count(self, word: str) -> int | None:
        """Number of greedy longest-match pieces of a marked word; None when it cannot be cut."""
        node, n = 0, 0
        for c in word:
            while c not in self.next[node]:
                if node == 0 or self.link[node] is None:
                    return None
                n += self.pops[node]
                node = self.link[node]
            node = self.next[node][c]
        while node != 0:
            if self.link[node] is None:
                return None
            n += self.pops[node]
            node = self.link[node]
        return n


def mark(word: str) -> str:
    return word[:-1] + chr(ord(word[-1]) + _END)


class PieceCounter:
    """Token, word and unknown counts of texts, with the vocabulary of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"]["end_of_word_suffix"]
        special = {t["content"] for t in spec["added_tokens"]}
        entries = [mark(t[:-len(suffix)]) if t.endswith(suffix) and t != suffix else t
                   for t in spec["model"]["vocab"] if t not in special]
        self.automaton = Automaton(entries)
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.characters = byte_characters()
        self.cache: dict[str, int] = {}

    def words(self, text: str) -> list[str]:
        found = self.split.findall(unicodedata.normalize("NFC", text).lower())
        return ["".join([self.characters[b] for b in w.encode()]) for w in found]

    def piece(self, text: str) -> int:
        """Counts of a text without spaces, packed: tokens + words * 2**40 + unknown * 2**80."""
        total = 0
        for word in self.words(text):
            n = self.automaton.count(mark(word))
            total += (1 if n is None else n) + (1 << 40) + ((1 << 80) if n is None else 0)
        return total

    def counts(self, text: str) -> tuple[int, int, int]:
        pieces = text.replace("\n", " ").split(" ")
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        known, total = self.cache, 0
        for p in set(pieces).difference(known):
            if len(p) <= LONGEST_CACHED:
                known[p] = self.piece(p)
        for p in pieces:
            n = known.get(p)
            total += self.piece(p) if n is None else n
        mask = (1 << 40) - 1
        return total & mask, total >> 40 & mask, total >> 80


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, n_words, n_unknown.  ``tokenizer`` is a path every task can read."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        counter = PieceCounter(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                found = [counter.counts(t) for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), *[pa.array([x[i] for x in found], pa.int64()) for i in range(3)]],
                    names=[id_col, "n_tokens", "n_words", "n_unknown"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_tokens long, n_words long, n_unknown long")
