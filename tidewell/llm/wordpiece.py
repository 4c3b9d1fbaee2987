"""Token counts: greedy word-piece lengths from a vocabulary trie with failure links, in time linear in the text."""

import json
import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _byte_letters
from .words import frugal

_WORD = re.compile(r"\w+|[^\w\s]")
#: Words kept by a worker; beyond that the memory is emptied and filled anew.
KEPT_WORDS = 300_000


def pieces_of_byte_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """First and later word pieces from a byte-level vocabulary: tokens after a space begin a word, others go on."""
    letters = {v: k for k, v in _byte_letters().items()}
    first, later = [], []
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    for token in vocabulary:
        if all(c in letters for c in token):
            try:
                text = bytes(letters[c] for c in token).decode()
            except UnicodeDecodeError:
                continue
            if text[:1] == " " and _WORD.fullmatch(text[1:]):
                first.append(text[1:])
            elif _WORD.fullmatch(text):
                later.append(text)
    return first, later


class Automaton:
    """Trie of first pieces (root 0) and later pieces (root 1).

    A node's failure link leads to where matching goes on after the longest pieces are popped off what the node spells;
    ``popped`` is how many. Counting a word follows each character once and adds popped counts; no piece is built.
    """

    def __init__(self, first: Iterable[str], later: Iterable[str]) -> None:
        self.children: list[dict[str, int]] = [{}, {}]
        whole = {v for root, pieces in ((0, first), (1, later)) for p in pieces if p for v in [self._add(root, p)]}
        self.link: list[int] = [-1] * len(self.children)
        self.popped = [0] * len(self.children)
        queue = deque([0, 1])
        while queue:
            u = queue.popleft()
            for c, v in self.children[u].items():
                queue.append(v)
                if v in whole:
                    self.link[v], self.popped[v] = 1, 1
                    continue
                z, count = self.link[u], self.popped[u]
                while z >= 0 and c not in self.children[z]:
                    z, count = self.link[z], count + self.popped[z]
                if z >= 0:
                    self.link[v], self.popped[v] = self.children[z][c], count

    def _add(self, node: int, piece: str) -> int:
        for c in piece:
            after = self.children[node].get(c)
            if after is None:
                after = self.children[node][c] = len(self.children)
                self.children.append({})
            node = after
        return node

    def count(self, word: str) -> int:
        """Pieces of the greedy longest match; 1, the unknown piece, if the word has no match."""
        node, count, children, link, popped = 0, 0, self.children, self.link, self.popped
        for c in word:
            while c not in children[node]:
                if link[node] < 0:
                    return 1
                node, count = link[node], count + popped[node]
            node = children[node][c]
        while node != 1:
            if link[node] < 0:
                return 1
            node, count = link[node], count + popped[node]
        return count


class _Counts(dict):
    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(word)
        if len(word) <= 64:
            self[word] = n
        return n


@cache
def _counts(path: str) -> _Counts:
    return _Counts(Automaton(*pieces_of_byte_vocabulary(path)))


def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens`` of each whole text.

    A word is a run of letters, digits and underscores, or one other mark; white space is dropped. Null and empty texts
    have no words. Rows keep their columns (those named like the results are replaced) and repeated rows stay.
    """

    @frugal
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary)
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column("__text"):
                if len(counts) > KEPT_WORDS:
                    counts.clear()
                found = _WORD.findall(text.as_py() or "")
                n_words.append(len(found))
                n_tokens.append(sum(map(counts.__getitem__, found)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], [*batch.schema.names[:-1], "n_words", "n_tokens"])

    kept = [c for c in docs.columns if c not in ("n_words", "n_tokens")]
    fields = docs.select(kept).withColumns({"n_words": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}).schema
    return docs.select(*kept, F.col(text_col).alias("__text")).mapInArrow(count, fields)
