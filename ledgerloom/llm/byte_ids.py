"""Token ids by the ``tokenizers`` library, each distinct word encoded once.

A byte-level BPE with the usual word pattern never joins a character that is
not white space with a space or line break that follows it, and its pattern
looks only ahead. So a text may be cut before every such one and its parts
encoded on their own. Parts repeat a lot; a bounded cache keeps their ids.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from ledgerloom.llm.common import KEPT, one_thread, tokenizer_path
from ledgerloom.llm.unit_cache import UnitCache

#: A space or line break after other white space: plain splitting would cut a run of it.
_RUN = re.compile(r"\s[ \n]")
#: After letters and before a space these are words of the pattern by themselves.
_MARKS = ",."
#: How a byte-level vocabulary shows each byte: printable ones as they are, the rest from 256 on, in order.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _PLAIN]
_SHOWN = {b: chr(b) if b in _PLAIN else chr(256 + _HIDDEN.index(b)) for b in range(256)}
_SPACE = _SHOWN[32]
_CUT = re.compile(r"(?<=\S)(?= )")


class IdEncoder:
    """Encodes batches of texts; ``limit`` bounds the words that are kept."""

    def __init__(self, name: str, limit: int = 600_000) -> None:
        one_thread()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.n_ids = self.tokenizer.get_vocab_size()
        self.marks = {m: self.tokenizer.token_to_id(m) for m in _MARKS}
        self.line = self.tokenizer.token_to_id(_SHOWN[10])
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        """Drop the words that are kept."""
        self.words = UnitCache(self._fresh_ids, self.limit)

    def _fresh_ids(self, fresh: list) -> list[list[int]]:
        """Ids of unseen parts.

        Letters, with or without a space before them, are one word of the
        pattern, so the model takes them as they are; a comma or full stop
        after them, and a line break before them, are words by themselves.
        """
        simple: list[tuple] = []
        other: list[int] = []
        stems: dict[str, list[int]] = {}
        for i, part in enumerate(fresh):
            if part.__class__ is str and part:
                last = part[-1]
                stem = part[:-1] if last in _MARKS else part
                line = stem[:1] == "\n"
                letters = stem[1:] if line else stem
                if letters.isalpha():
                    if not letters.isascii():
                        letters = "".join(map(_SHOWN.__getitem__, letters.encode()))
                    key = letters if line else _SPACE + letters
                    stems[key] = []
                    simple.append((i, line, key, last))
                    continue
            other.append(i)
        model = self.tokenizer.model.tokenize
        for key in stems:
            stems[key] = [t.id for t in model(key)]
        found: list = [None] * len(fresh)
        marks, line_id = self.marks, self.line
        for i, line, key, last in simple:
            ids = stems[key]
            if line:
                ids = [line_id, *ids]
            found[i] = [*ids, marks[last]] if last in marks else ids
        texts = [p[0] if (p := fresh[i]).__class__ is tuple else p if p[:1] == "\n" else " " + p for i in other]
        for i, e in zip(other, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            found[i] = e.ids
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the n + 1 places where texts start."""
        parts: list = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if not text:
                continue
            if _RUN.search(text):
                own = [(unit,) for unit in _CUT.split(text)]
            else:
                own = text.replace("\n", " \n").split(" ")
                own[0] = (own[0],)
            counts[i] = len(own)
            parts += own
        ids, lengths = self.words.numbers(parts)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        return ids.view(np.uint32), ends[np.concatenate(([0], np.cumsum(counts)))]


@lru_cache(maxsize=1)
def encoder(name: str, limit: int) -> IdEncoder:
    """The encoder of this worker process; tasks that follow find its words."""
    own = IdEncoder(name, limit)
    KEPT.append(own.forget)
    return own
