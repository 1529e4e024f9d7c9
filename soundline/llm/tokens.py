"""Encoding whole texts with the tokenizers library, remembering the ids of chunks that keep coming back.

A text is cut only where the tokenizer's own pre-tokenizer always cuts, so the ids equal those of the whole text.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np

from .common import release

#: Separators that Python takes for white space and the tokenizers don't: texts with them are encoded whole.
_ODD = re.compile("[\x1c-\x1f]")
#: What new chunks are joined with, and the text of the one token that this makes: it tells where a chunk's ids end.
_BETWEEN = {"words": (" \x01 ", "\x01"), "spaces": ("\n", "\n")}


class Chunked:
    """Encodes texts as Tokenizer.encode(text, add_special_tokens=False) does.

    kind "words": the tokenizer drops white space, so texts are cut at it. kind "spaces": byte-level with one leading
    space kept, so texts are cut before single spaces. Chunks are remembered in two generations of `most` each, which
    bounds the memory whatever the texts hold; forget() drops them.
    """

    def __init__(self, path: str, kind: str, most: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind, self.most, self.known, self.before = kind, most, {}, {}
        self.gap, self.mark = _BETWEEN[kind]
        end = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.end = end[0] if len(end) == 1 else None

    def forget(self) -> None:
        self.known, self.before = {}, {}

    def _cut(self, text: str) -> list:
        """Chunks: str for a word, with the space before it where kind is "spaces"; a tuple for what stands alone."""
        if self.kind == "words":
            return [(text,)] if _ODD.search(text) else text.split()
        chunks = text.split(" ")
        chunks[0] = (chunks[0],)
        return chunks

    def _unsafe(self, chunk) -> bool:
        """Whether texts that hold the chunk must stay whole: its space touches other white space, or ends the text."""
        if self.kind == "words":
            return False
        if isinstance(chunk, tuple):
            return chunk[0][-1:].isspace() or not chunk[0]
        return not chunk or chunk[0].isspace() or chunk[-1].isspace()

    def _joins(self, chunk) -> bool:
        """Whether the chunk's ids stay the same among other chunks, and the mark between them isn't among its own."""
        if isinstance(chunk, tuple) or len(chunk) > 200 or self.mark in chunk:
            return False
        return self.kind == "spaces" or not _ODD.search(chunk) and not chunk.isspace() and (chunk.isascii() or unicodedata.is_normalized("NFC", chunk))

    def _alone(self, chunks: list) -> None:
        lead = " " if self.kind == "spaces" else ""
        for i in range(0, len(chunks), 1000):
            part = chunks[i : i + 1000]
            found = self.tokenizer.encode_batch_fast([c[0] if isinstance(c, tuple) else lead + c for c in part], add_special_tokens=False)
            for c, e in zip(part, found, strict=True):
                self.known[c] = np.array(e.ids, "<u4").tobytes()

    def _learn(self, chunks: list) -> None:
        """Encodes new chunks, many in one call: the library's cost for a call exceeds that for a word."""
        easy = [c for c in chunks if self._joins(c)] if self.end is not None else []
        self._alone(list(set(chunks).difference(easy)))
        lead = " " if self.kind == "spaces" else ""
        for i in range(0, len(easy), 20_000):
            part = easy[i : i + 20_000]
            (e,) = self.tokenizer.encode_batch_fast([lead + (self.gap + lead).join(part)], add_special_tokens=False)
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(ids == self.end)
            if len(ends) != len(part) - 1:
                self._alone(part)
                continue
            raw = ids.tobytes()
            for c, a, b in zip(part, [0, *(4 * ends + 4).tolist()], [*(4 * ends).tolist(), len(raw)], strict=True):
                self.known[c] = raw[a:b]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers; none for null."""
        cut = [self._cut(t) if t else [] for t in texts]
        every = set(chain.from_iterable(cut))
        need = every.difference(self.known)
        if bad := {c for c in need if self._unsafe(c)}:
            cut = [c if bad.isdisjoint(c) else [(t,)] for c, t in zip(cut, texts, strict=True)]
            every = set(chain.from_iterable(cut))
            need = every.difference(self.known)
        if len(self.known) + len(need) > self.most:
            self.known, self.before = {}, self.known
            need = every
        new = []
        for c in need:
            if (got := self.before.get(c)) is None:
                new.append(c)
            else:
                self.known[c] = got
        self._learn(new)
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, chunks)), "<u4") for chunks in cut]


@lru_cache(1)
def _loaded(path: str, kind: str) -> Chunked:
    return Chunked(path, kind)


@contextmanager
def shared(path: str, kind: str, most: int = 200_000) -> Iterator[Chunked]:
    """The one Chunked of a Python worker, for the length of a partition; what it remembers goes with the partition."""
    chunked = _loaded(path, kind)
    chunked.most = most
    try:
        yield chunked
    finally:
        chunked.forget()
        release()


def portions(texts, most_chars: int = 1_000_000):
    """Slices (from, to) of texts that hold about most_chars characters each, one text at least."""
    start = chars = 0
    for i, t in enumerate(texts):
        chars += len(t) if isinstance(t, str) else 0
        if chars >= most_chars:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
