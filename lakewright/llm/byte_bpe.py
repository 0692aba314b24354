"""Byte-level BPE by backtracking over longest matches: the exact result of the merges, in linear time.

A sequence of tokens is the result of the merges exactly if that holds for every two neighbours: as long as no
merge crosses a boundary, the tokens on either side come about as they would alone. So an encoder may take the longest
token at each place that goes with the one before, and go back where none does. A prefix of a text has one
encoding only; a place from which there was no way on is closed for good, so each is tried once.

The tokens are found by one Aho-Corasick automaton over the vocabulary, whose bytes are written as Latin-1 characters.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.llm.encoder import ChunkMemory
from lakewright.llm.texts import add_columns, strings_of

MAX_PIECES = 700_000  # pieces that a worker keeps the ids of
MAX_PAIRS = 1_000_000  # pairs of neighbours that a worker remembers
BLOCK_BYTES = 1 << 18  # text of the pieces that are looked through together


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file, a token in base 64 and its number a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The tokens of one vocabulary, and which of them may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.widths = [len(token) for token in self.tokens]
        self.shorter = [self._prefix(token) for token in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) > 1:
                self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.automaton.make_automaton()
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs: dict[int, bool] = {}
        self.timelines: dict[int, tuple[list[int], list[bytes], list[bytes]] | None] = {}

    def _prefix(self, token: bytes) -> int:
        """The longest other token that this one begins with, or -1."""
        return next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), -1)

    def _timeline(self, rank: int) -> tuple[list[int], list[bytes], list[bytes]] | None:
        """How a token comes about: the ranks of its merges in their order, its first part and its last part before each of them
        and after all. None for a token that its own merges do not give.
        """
        if rank not in self.timelines:
            text, rank_of, none = self.tokens[rank], self.ranks.get, len(self.tokens)
            parts = [text[i : i + 1] for i in range(len(text))]
            ranked = [rank_of(text[i : i + 2], none) for i in range(len(text) - 1)]
            steps, heads, tails = [], [parts[0]], [parts[-1]]
            while ranked and (least := min(ranked)) < none:
                at = ranked.index(least)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                del ranked[at]
                if at:
                    ranked[at - 1] = rank_of(parts[at - 1] + parts[at], none)
                if at < len(ranked):
                    ranked[at] = rank_of(parts[at] + parts[at + 1], none)
                steps.append(least)
                heads.append(parts[0])
                tails.append(parts[-1])
            self.timelines[rank] = ([*steps, none], heads, tails) if len(parts) == 1 else None
        return self.timelines[rank]

    def fits(self, before: int, token: int) -> bool:
        """Whether the merges leave these two neighbours as they are; ``before`` is -1 at the beginning.

        Merges go by rank and then from the left. So the two come about side by side, each by its own timeline, until
        the parts that meet would merge sooner than anything on the left and no later than anything on the right.
        """
        right = self._timeline(token)
        if before < 0 or right is None:
            return right is not None
        left = self._timeline(before)
        if left is None:
            return False
        (steps, _, tails), (others, heads, _) = left, right
        rank_of, none = self.ranks.get, len(self.tokens)
        i = j = 0
        while True:
            one, two = steps[i], others[j]
            across = rank_of(tails[i] + heads[j], none)
            if across < one and across <= two:
                return False
            if one == two == none:
                return True
            if one <= two:
                i += 1
            else:
                j += 1

    def _learn(self, before: int, token: int, key: int) -> bool:
        if len(self.pairs) > MAX_PAIRS:
            self.pairs.clear()
        self.pairs[key] = known = self.fits(before, token)
        return known

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of every piece of text."""
        out: list[list[int]] = []
        block: list[bytes] = []
        held = 0
        for piece in pieces:
            block.append(piece)
            held += len(piece)
            if held > BLOCK_BYTES:
                out += self._encode_block(block)
                block, held = [], 0
        return out + self._encode_block(block)

    def _encode_block(self, pieces: list[bytes]) -> list[list[int]]:
        rank_of = self.ranks.get
        whole = [rank_of(piece) for piece in pieces]
        parted = [piece for piece, rank in zip(pieces, whole, strict=True) if rank is None]
        # No token has the character between pieces, so none is found across it.
        joined = "\u0100".join([piece.decode("latin-1") for piece in parted])
        longest = array("i", self.single[np.frombuffer(b"\0".join(parted), np.uint8)].tobytes())
        for end, (back, rank) in self.automaton.iter(joined):
            longest[end - back] = rank  # ends come in order, so the longest token at a place is the last one
        closed = bytearray(len(joined) + 1)
        out, first = [], 0
        for piece, rank in zip(pieces, whole, strict=True):
            if rank is None:
                out.append(self._path(longest, closed, first, first + len(piece)))
                first += len(piece) + 1
            else:
                out.append([rank])
        return out

    def _path(self, longest: array, closed: bytearray, place: int, last: int) -> list[int]:
        """The tokens from ``place`` to ``last``: the longest that go with the one before, and back where none does."""
        widths, shorter, known, size = self.widths, self.shorter, self.pairs.get, len(self.tokens)
        ids: list[int] = []
        key = 0  # of the pair of the token before, or none, and the next one
        while place < last:
            token = longest[place]
            while True:
                after = place + widths[token]
                if not closed[after]:
                    fits = known(key + token)
                    if fits or fits is None and self._learn(ids[-1] if ids else -1, token, key + token):
                        break
                token = shorter[token]
                while token < 0:
                    closed[place] = 1
                    token = ids.pop()
                    place -= widths[token]
                    key = (ids[-1] + 1) * size if ids else 0
                    token = shorter[token]
            ids.append(token)
            place = after
            key = (token + 1) * size
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Pieces:
    """Cuts texts by ``public_tokenizers.PATTERN`` as the tiktoken library does.

    The regex library may know later code points than tiktoken does. For those that Python's tables, the oldest of
    the three, do not have, tiktoken itself is asked whether it takes them for letters, numbers or neither.
    """

    def __init__(self, pattern: str):
        import regex
        import tiktoken

        self.pattern = regex.compile(pattern)
        # Tokens that only come about where the second character goes into one piece with the first.
        pairs = [bytes([first, lead]) for first in b"a1-" for lead in range(128, 256)]
        ranks = {token: rank for rank, token in enumerate([bytes([b]) for b in range(256)] + pairs)}
        self.probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.stand_ins: dict[str, str] = {}

    def _stand_in(self, character: str) -> str:
        if character not in self.stand_ins:
            joined = [c for c in "a1-" if self.probe.encode_ordinary(c + character)[0] >= 256]
            self.stand_ins[character] = joined[0] if joined else "\u2003"
        return self.stand_ins[character]

    def of(self, text: str) -> list[str]:
        late = () if text.isascii() else [c for c in set(text) if unicodedata.category(c) == "Cn"]
        if not late:
            return self.pattern.findall(text)
        shown = text.translate({ord(c): self._stand_in(c) for c in late})
        return [text[slice(*match.span())] for match in self.pattern.finditer(shown)]


class ByteBpeEncoder(ChunkMemory):
    """Whole texts to ids; the ids of a piece are remembered."""

    def __init__(self, path: str, pattern: str, max_pieces: int = MAX_PIECES):
        super().__init__(max_pieces)
        self.merges, self.pieces = Merges(read_ranks(path)), Pieces(pattern)

    def chunks_of(self, text: str) -> str | list[str]:
        pieces = self.pieces.of(text)
        return pieces if "\0" in text or not pieces else "\0".join(pieces)

    def ids_of(self, chunks: list[str]) -> list[list[int]]:
        return self.merges.encode([chunk.encode() for chunk in chunks])


@lru_cache(maxsize=1)
def worker_encoder(path: str, pattern: str) -> ByteBpeEncoder:
    """The encoder of this worker process, kept from task to task."""
    return ByteBpeEncoder(path, pattern)


@lru_cache(maxsize=1)
def worker_tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


def encode_documents(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``docs`` (text, ...) with the column ``ids``, an array of ints: the tokens of each whole text.

    ``ranks`` is the path of a rank file, which every worker reads; ``pattern`` cuts a text into pieces that are encoded one by
    one. No special tokens are looked for or added. A null or empty text has no ids. Rows are taken as they come: repeated ones, and
    ones without an id, are encoded like any other; an empty table stays empty. Other columns stay as they are, but for one called
    ``ids``, which gives way.
    """

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        ids, bounds = worker_encoder(ranks, pattern).encode(strings_of(batch.column("text")), None)
        return {"ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))}

    return add_columns(docs, "ids array<int>", convert)


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` (ids, ...) with the column ``decoded``: the bytes that the ids stand for.

    An id that is not in the vocabulary is an error. A null array counts as empty. Other columns stay, but for one called ``decoded``.
    """

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        token = worker_tokens(ranks).__getitem__
        return {"decoded": [b"".join(map(token, ids or ())) for ids in batch.column("ids").to_pylist()]}

    return add_columns(encoded, "decoded binary", convert, "ids")


def digest(decoded: DataFrame) -> DataFrame:
    """Per document: doc_id, n_tokens, and the SHA-256 of its ids, as decimals joined by commas, and of its decoded bytes."""
    ids = F.coalesce("ids", F.array().cast(T.ArrayType(T.IntegerType())))
    return decoded.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
