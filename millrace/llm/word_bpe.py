"""Exact ids of a word-end BPE vocabulary, many times faster than one call per text.

Such a tokenizer (lower case, white space dropped, a suffix at each word's end) gives a chunk
between blanks the same ids wherever it stands.  So chunks are hashed for 256 KB of text at
once, looked up in an open-addressing table of ids kept by chunk, and the ids gathered.  New
chunks are split into pieces as the tokenizer splits them and merged by a rank-based BPE over
the same vocabulary, in which a blank stands for the suffix.  Chunks with characters whose
normal form or case could need care, or with controls, go to the tokenizer itself, and so do
whole texts that may hold special tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

from millrace.llm import worker
from millrace.llm.text_arrays import WHITE, U, string_buffers, words

#: Characters that need no normal form, and whose lower case is one character.
_PLAIN = re.compile("[!-~¡-į]+")


def _byte_of_char() -> dict[str, int]:
    """The usual map of byte-level BPE: printable Latin-1 stands for itself, other bytes from U+0100 on."""
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class WordBpe:
    """slots: size of the table of chunks, a power of two; it is emptied when half full."""

    def __init__(self, path: str, slots: int = 1 << 20):
        import regex
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"]["end_of_word_suffix"]
        special = {t["content"] for t in spec["added_tokens"]}
        self.special = tuple(t.encode() for t in special)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        byte = _byte_of_char()
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in special:
                end = token.endswith(suffix)
                ranks[bytes(byte[c] for c in (token[: -len(suffix)] if end else token)) + b" " * end] = i
        self.line = ranks[b"\n"]  # never an id of a chunk: it stands between chunks here
        self.bpe = tiktoken.Encoding("word_bpe", pat_str="[^ \n]+ |\n", mergeable_ranks=ranks, special_tokens={})
        self.slots = slots
        self._clear()
        del spec, ranks
        worker.trim()  # the file's text and tables are several times what is kept

    @cached_property
    def own(self):
        """The tokenizer itself, loaded when a chunk needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _clear(self) -> None:
        self.keys = np.zeros(self.slots, dtype=np.uint64)
        self.at = np.zeros(self.slots, dtype=np.int32)
        self.size = np.zeros(self.slots, dtype=np.int32)
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.used, self.held = 0, 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash: where it is, or the free one where it would go."""
        mask = U(self.slots - 1)
        slot = (h & mask).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            there = self.keys[slot[left]]
            left = left[(there != h[left]) & (there != 0)]
            slot[left] = (slot[left] + 1) & (self.slots - 1)
        return slot

    def tokens(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of chunks without blanks."""
        out: list = [None] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if _PLAIN.fullmatch(c)]
        odd = [i for i, c in enumerate(chunks) if not _PLAIN.fullmatch(c)]
        if plain:
            spaced = self.pieces.sub(r"\g<0> ", "\n".join([chunks[i].lower() for i in plain]))
            ids = np.array(self.bpe.encode_ordinary(spaced + "\n"), dtype=np.uint32)
            ends = np.flatnonzero(ids == self.line).tolist()
            at = 0
            for i, to in zip(plain, ends, strict=True):
                out[i] = ids[at:to]
                at = to + 1
        for i, e in zip(odd, self.own.encode_batch([chunks[i] for i in odd], add_special_tokens=False) if odd else [], strict=True):
            out[i] = np.array(e.ids, dtype=np.uint32)
        return out

    def _learn(self, h: np.ndarray, chunks: list[str]) -> None:
        found = self.tokens(chunks)
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        flat = np.concatenate(found)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        left = np.arange(len(h))
        while len(left):  # of hashes that want one slot, one gets it at a time
            slot = self._find(h[left])
            _, one = np.unique(slot, return_index=True)
            put, slot = left[one], slot[one]
            self.keys[slot], self.at[slot], self.size[slot] = h[put], at[put], sizes[put]
            left = np.delete(left, one)
        self.held += len(h)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, row offsets into them) for groups of consecutive rows; a null text has none."""
        data, offsets = string_buffers(column)
        for row, h, at, starts, ends in words(column, WHITE, places=True):
            n = len(at) - 1
            part = data[offsets[row] : offsets[row + n]].tobytes()
            if any(s in part for s in self.special):
                for i in range(n):
                    text = data[offsets[row + i] : offsets[row + i + 1]].tobytes().decode()
                    ids = np.array(self.own.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
                    yield row + i, ids, np.array([0, len(ids)])
                continue
            h = h | U(1)  # 0 marks a free slot
            slot = self._find(h)
            new = np.flatnonzero(self.keys[slot] != h)
            if len(new):
                fresh, first = np.unique(h[new], return_index=True)
                if self.held + len(fresh) > self.slots // 2:
                    self._clear()
                    fresh, first = np.unique(h, return_index=True)
                    new = np.arange(len(h))
                at_byte = np.repeat(offsets[row : row + n] - offsets[row], np.diff(at))
                pick = new[first]
                lo, hi = (starts[pick] + at_byte[pick]).tolist(), (ends[pick] + at_byte[pick]).tolist()
                self._learn(fresh, [part[a:b].decode() for a, b in zip(lo, hi, strict=True)])
                slot = self._find(h)
            size = self.size[slot].astype(np.int64)
            after = np.cumsum(size)
            begin = after - size
            total = int(after[-1]) if len(after) else 0
            ids = self.ids[np.repeat(self.at[slot] - begin, size) + np.arange(total)]
            yield row, ids, np.concatenate([[0], after])[at]


_LOADED: dict[str, WordBpe] = {}
worker.KEPT.append(_LOADED)


def load(path: str) -> WordBpe:
    """One copy for each task."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
