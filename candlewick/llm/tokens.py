"""Tokenizing whole texts with the ``tokenizers`` library, each word once.

The vocabulary file used here drops white space and matches runs of letters,
single digits and runs of other signs, so a text's ids are those of its words
laid end to end. Words repeat, so each worker keeps the ids of words it has
seen in a bounded table and gives the library only new ones.
"""

from __future__ import annotations

import functools
import os

import numpy as np

from candlewick.llm.common import KEPT_TABLES

#: Signs that may follow a run of letters without joining it (no apostrophe).
TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"
#: Control signs that str.split() takes as white space and the vocabulary does not.
ODD = "\x1c\x1d\x1e\x1f"


class TextEncoder:
    """Texts -> little-endian unsigned 32-bit ids as bytes (no special tokens).

    ``max_words``: the tables are emptied when that of words grows past this, which
    bounds a worker's memory and changes no result.
    """

    def __init__(self, path: str, max_words: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.max_words = max_words
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)
        for piece, i in self.tok.get_vocab().items():
            self.ends[i] = piece.endswith("</w>")
        #: words are independent only where the vocabulary splits on white space
        self.by_word = self._drops_space()

    def _drops_space(self) -> bool:
        a, b, both = (self.direct([x])[0] for x in ("ab", "cd", "ab \n cd"))
        return a + b == both

    def direct(self, texts: list[str]) -> list[bytes]:
        """Ids by the library alone."""
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; a null text has none."""
        if not self.by_word:
            return self.direct([t or "" for t in texts])
        split = [[] if not t else [t] if any(c in t for c in ODD) else t.split() for t in texts]
        every = set().union(*split)
        new = every.difference(self.words)
        if new and len(self.words) > self.max_words:
            self.words.clear()
            self.parts.clear()
            new = every
        self._learn(list(new))
        get = self.words.__getitem__
        return [b"".join(map(get, ws)) for ws in split]

    def _learn(self, new: list[str]) -> None:
        parts, words, whole = self.parts, self.words, []
        cores, tails, cut = [], [], []
        for w in new:
            core = w.rstrip(TAIL)
            if core.isalpha():  # one run of letters, if still one after lower-casing
                low = core.lower()
                if core.isascii():
                    core = low
                elif not low.isalpha():
                    whole.append(w)
                    continue
                cut.append(w)
                cores.append(core)
                tails.append(w[len(core):])
            else:
                whole.append(w)
        self._runs(list(set(cores).difference(parts)))
        some = list(set(tails).difference(parts, ("",)))
        if some:
            parts.update(zip(some, self.direct(some)))
        parts[""] = b""
        get = parts.__getitem__
        words.update(zip(cut, map(bytes.__add__, map(get, cores), map(get, tails))))
        if whole:
            words.update(zip(whole, self.direct(whole)))

    def _runs(self, runs: list[str]) -> None:
        """Encode runs of letters many to a text, cut after each word end."""
        runs.sort()
        for i in range(0, len(runs), 20_000):
            some = runs[i : i + 20_000]
            lines = [" ".join(some[k : k + 200]) for k in range(0, len(some), 200)]
            found = self.tok.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.asarray(e.ids, "<u4") for e in found])
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some) and (not len(ids) or stops[-1] == len(ids)):
                raw, at = ids.tobytes(), 0
                for run, stop in zip(some, (stops * 4).tolist()):
                    self.parts[run] = raw[at:stop]
                    at = stop
            else:
                self.parts.update(zip(some, self.direct(some)))


@functools.cache
def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and vocabulary file, until another operator's
    task needs the room. Taking the room from the others is up to the task, by
    ``release(encoder.cache_clear)``."""
    return TextEncoder(path)


KEPT_TABLES.append(encoder.cache_clear)
