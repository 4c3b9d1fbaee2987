"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

A byte-level BPE tokenizer first cuts a text with a fixed pattern and merges within the cuts only. A single white-space
character between two other characters is always such a cut, so the ids of a text are the ids of its words in order.
"""

import os
import re
from array import array
from functools import cache

import numpy as np

END_ID = 0
#: Words kept by a worker. Beyond that they become the older half of its memory, of which only what is met again stays.
KEPT_WORDS = 400_000
#: White space but for the space and the line feed, and what Python alone counts as white space.
_OTHER_SPACE = "\t\r\x0b\x0c\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_ONLY_PYTHON_SPACE = "\x1c\x1d\x1e\x1f"
_RUNS = ("  ", "\n\n", " \n", "\n ")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: printable bytes stand for themselves, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Equal to ``Tokenizer.encode(text, add_special_tokens=False)`` of a byte-level BPE file; ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.size = self.whole.get_vocab_size()
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.after_space, self.plain = _Words(self, " "), _Words(self, "")

    def _cut(self, text: str) -> bytes:
        """Ids of a text that the pattern doesn't cut."""
        ids = [t.id for t in self.model.tokenize(text.encode("utf-8", "replace").decode("latin-1").translate(self.letters))]
        return array("I", ids).tobytes()

    def word(self, prefix: str, word: str) -> bytes:
        """Ids of a word without white space, with the space before it if it has one."""
        core = word.rstrip("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
        if core.isalpha():
            if len(core) < len(word):
                return (self.after_space if prefix else self.plain)[core] + self.plain[word[len(core) :]]
            return self._cut(prefix + core)
        if not core and word and not prefix:
            return self._cut(word) if "'" not in word else self.slow(word)
        return self.slow(prefix + word)

    def slow(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        has = text.__contains__
        if any(map(has, self.specials)) or any(map(has, _ONLY_PYTHON_SPACE)):
            return self.slow(text)
        if len(self.after_space) + len(self.plain) > KEPT_WORDS:
            self.after_space.grow_old()
            self.plain.grow_old()
        out: list[bytes] = []
        if text[0].isspace() or text[-1].isspace() or any(map(has, _RUNS)) or any(map(has, _OTHER_SPACE)):
            self._any_space(text, out)
        else:
            spaced, line_end = self.after_space.__getitem__, self.plain["\n"]
            for line in text.split("\n"):
                first, *rest = line.split(" ")
                out.append(self.plain[first])
                out.extend(map(spaced, rest))
                out.append(line_end)
            out.pop()
        return b"".join(out)

    def _any_space(self, text: str, out: list[bytes]) -> None:
        """Of a run of white space all but the last character are one cut; a last space goes with the next word."""
        parts = re.split(r"(\s+)", text)
        spaced = False
        for i, part in enumerate(parts):
            if i % 2 == 0:
                if part:
                    out.append((self.after_space if spaced else self.plain)[part])
                spaced = False
            elif i == len(parts) - 2 and not parts[-1]:
                out.append(self.plain[part])
            else:
                if len(part) > 1:
                    out.append(self.plain[part[:-1]])
                spaced = part[-1] == " "
                if not spaced:
                    out.append(self.plain[part[-1]])


class _Words(dict):
    def __init__(self, encoder: Encoder, prefix: str) -> None:
        self.encoder, self.prefix = encoder, prefix
        self.older: dict[str, bytes] = {}

    def grow_old(self) -> None:
        self.older = dict(self)
        self.clear()

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.encoder._cut(word) if word.isspace() and not self.prefix else self.encoder.word(self.prefix, word)
        if len(word) <= 64:
            self[word] = found
        return found


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def document_ids(encode: Encoder, text: str | None) -> np.ndarray:
    """Ids of a document and its end id."""
    return np.frombuffer(encode(text) + END_ID.to_bytes(4, "little"), dtype="<u4")
