"""Whole texts to token ids through the tokenizers library, every distinct chunk of a worker once.

A chunk is a run of spaces and line feeds together with the characters up to the next such run. Where a
tokenizer's own pre-tokenizer always starts a new piece at a space that follows a visible character, the
ids of a text are those of its chunks, one after the other; that holds for both word and byte level
tokenizers of the kind used here. Texts with other white space go to the library whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_CHUNKS = 250_000  # chunks remembered by a worker; beyond it the memory starts anew
CHARS_PER_CHUNK = 24  # and beyond so much text of them

_OTHER_SPACE = "\0" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")  # U+3000 is the last one
_OTHER_ASCII = "".join(filter(str.isascii, _OTHER_SPACE))
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_ADJACENT = ("  ", "\n\n", " \n", "\n ")


def _has_other_space(text: str) -> bool:
    return any(c in text for c in (_OTHER_ASCII if text.isascii() else _OTHER_SPACE))


def spaced_chunks(text: str) -> str | list[str]:
    """Chunks with their leading white space, which join to the text; with a NUL between them, if the text has none."""
    if _has_other_space(text):
        return [text]
    if any(pair in text for pair in _ADJACENT):
        return "\0".join(_CHUNK.findall(text))
    return text.replace("\n", "\0\n").replace(" ", "\0 ")


def visible_chunks(text: str) -> str | list[str]:
    """Chunks without white space, for tokenizers that drop it; empty ones may be among them."""
    return [text] if _has_other_space(text) else text.replace("\n", "\0").replace(" ", "\0")


def _byte_characters() -> dict[int, str]:
    """The characters by which byte-level models write bytes: visible ones stand for themselves."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(hidden)}


_BYTES = _byte_characters()
# A Latin word; letters below U+0250 are the same in every version of Unicode.
_PLAIN = re.compile("([ \\n]?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]*)")
_PROBES = ["Word", " word", "\nWord,", " w\u00f6rd.", " \u00c9t\u00c9!?", "word;", " a", "\nb.", " straightforwardness", "\u00f1"]


class _Numbers(dict):
    """Numbers of chunks; a new chunk gets the next one and waits to be encoded."""

    def __init__(self) -> None:
        self.waiting: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.waiting.append(chunk)
        return number


class ChunkMemory:
    """Ids of texts, put together from those of their chunks; the ids of a chunk are worked out once and remembered."""

    def __init__(self, max_chunks: int = MAX_CHUNKS):
        self.max_chunks = max_chunks
        self.forget()

    def chunks_of(self, text: str) -> str | list[str]:
        """The chunks of a text, in order: a list of them, or one string with a NUL between them."""
        return spaced_chunks(text)

    def ids_of(self, chunks: list[str]) -> Iterable[list[int]]:
        """The ids of each chunk."""
        raise NotImplementedError

    def forget(self) -> None:
        self.index = _Numbers()
        self.starts, self.ids, self.chars = array("q", [0]), array("I"), 0

    def _learn(self) -> None:
        """Encode the chunks that wait."""
        waiting, self.index.waiting = self.index.waiting, []
        for first in range(0, len(waiting), 20_000):
            chunks = waiting[first : first + 20_000]
            for chunk, ids in zip(chunks, self.ids_of(chunks), strict=True):
                self.ids.extend(ids)
                self.starts.append(len(self.ids))
                self.chars += len(chunk)

    def _chunk_numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the numbers of all chunks, how many each text has). Arrow takes texts apart and finds the distinct chunks."""
        if len(self.index) > self.max_chunks or self.chars > CHARS_PER_CHUNK * self.max_chunks:
            self.forget()
        parts = [self.chunks_of(text) for text in texts]
        joined = pa.array([part if isinstance(part, str) else "" for part in parts], pa.string())
        lists = pc.split_pattern(joined, "\0")
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist takes many times as long
        numbers = self._numbers(distinct)[coded.indices.to_numpy()]
        counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        if listed := {i: self._numbers(part) for i, part in enumerate(parts) if not isinstance(part, str)}:
            by_text = np.split(numbers, np.cumsum(counts)[:-1])
            numbers = np.concatenate([listed.get(i, own) for i, own in enumerate(by_text)])
            counts[list(listed)] = [len(own) for own in listed.values()]
        self._learn()
        return numbers, counts

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))

    def _per_text(self, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(np.concatenate(([0], counts)))]
        return np.diff(ends)

    def lengths(self, texts: list[str]) -> np.ndarray:
        """How many ids each text has."""
        numbers, counts = self._chunk_numbers(texts)
        return self._per_text(np.diff(np.frombuffer(self.starts, np.int64))[numbers], counts)

    def encode(self, texts: list[str], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end_id`` unless that is None; the bounds of the texts among them)."""
        numbers, counts = self._chunk_numbers(texts)
        known = np.frombuffer(self.starts, np.int64)
        lengths = np.diff(known)[numbers]
        totals = self._per_text(lengths, counts)
        first = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        source = np.repeat(known[:-1][numbers] - first, lengths) + np.arange(int(lengths.sum()))
        found = np.frombuffer(self.ids, np.uint32)[source] if len(source) else np.empty(0, np.uint32)
        if end_id is None:
            return found, np.concatenate(([0], np.cumsum(totals)))
        bounds = np.concatenate(([0], np.cumsum(totals + 1)))
        out = np.full(int(bounds[-1]), end_id, np.uint32)
        kept = np.ones(len(out), bool)
        kept[bounds[1:] - 1] = False
        out[kept] = found
        return out, bounds


class ChunkEncoder(ChunkMemory):
    """``keeps_space`` tells whether white space is part of the tokens.

    Plain words, a Latin word with at most a blank before and marks after it, go straight to the library's model: the
    pre-tokenizer would pass them on as they are. Whether that holds is tried out on a few words; if it
    does not, and for all other chunks, the library's whole pipeline is used. A text in which a special token may stand
    is one chunk: the library cuts such texts at the token before it does anything else.
    """

    def __init__(self, path: str, keeps_space: bool, max_chunks: int = MAX_CHUNKS):
        from tokenizers import Tokenizer

        super().__init__(max_chunks)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.keeps_space = keeps_space
        self.divide = spaced_chunks if keeps_space else visible_chunks
        # Special tokens may be looked for in lower-cased text too: two characters of punctuation stand for them.
        self.marks = sorted({t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values() if t.content})
        self.parts: dict[str, list[int]] = {}
        probes = _PROBES if keeps_space else [p.strip() for p in _PROBES]
        expected = [e.ids for e in self.tokenizer.encode_batch(probes, add_special_tokens=False)]
        self.plain_words = [self._plain(p) for p in probes] == expected
        if any(mark.lower() != mark.upper() for mark in self.marks):
            raise ValueError(f"special tokens of {path} do not begin with punctuation: {self.marks}")

    def chunks_of(self, text: str) -> str | list[str]:
        if any(mark in text for mark in self.marks):
            return [text]
        return self.divide(text)

    def _part(self, part: str) -> list[int]:
        """Ids of a blank, a line feed or marks, of which there are few."""
        if part not in self.parts:
            self.parts[part] = [t.id for t in self.tokenize(part.translate(_BYTES))] if part else []
        return self.parts[part]

    def _plain(self, chunk: str) -> list[int] | None:
        """Ids of a plain word, None for other chunks."""
        match = _PLAIN.fullmatch(chunk)
        if not match:
            return None
        lead, word, marks = match.groups()
        if not self.keeps_space:
            lower = word.lower()
            if lower is not word and lower.upper() != word.upper():
                return None
            lead, word = "", lower
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTES)
        if lead == " ":
            ids = [t.id for t in self.tokenize(_BYTES[32] + word)]
        else:
            ids = [t.id for t in self.tokenize(word)]
            if lead:
                ids = self._part(lead) + ids
        return ids + self._part(marks) if marks else ids

    def ids_of(self, chunks: list[str]) -> Iterator[list[int]]:
        known = [self._plain(c) if c and self.plain_words else None for c in chunks]
        other = [c for c, ids in zip(chunks, known, strict=True) if ids is None]
        whole = iter(self.tokenizer.encode_batch_fast(other, add_special_tokens=False))
        return (next(whole).ids if ids is None else ids for ids in known)


@lru_cache(maxsize=1)
def worker_encoder(path: str, keeps_space: bool, max_chunks: int = MAX_CHUNKS) -> ChunkEncoder:
    """The encoder of this worker process, kept from task to task."""
    return ChunkEncoder(path, keeps_space, max_chunks)
