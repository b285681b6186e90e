"""Byte-level BPE over a corpus: every merge is replayed over all distinct words at once.

Each task holds the distinct words of its share of the corpus in flat arrays. An inverted index leads from the token that
a pair would form to the positions of such pairs. The merges are taken in the order of their ranks; a merge visits only the
positions that the index lists for it and renews only the pairs to the left and right of these. Words met earlier keep their
ids (bounded memory), so a word is merged about once a task, however often the corpus holds it.

A pair may be cut from the same bytes in several ways, and a merge can bring up a pair whose token has a lower rank than the
merge itself. The next lowest rank is therefore always taken from a heap. Only where such a pair comes up in a word that the
same merge touches at several places could the order inside the word differ; those few words are merged one by one.

Input: any text column. Null and empty texts have no ids. Texts are never cut; a text is one item whatever its length.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Memo, with_struct

FIELDS = T.StructType([
    T.StructField("ids", T.BinaryType()),
    T.StructField("n_tokens", T.LongType()),
])

# Distinct words, and pieces of text, whose ids a task remembers; more may be in use for one list of texts.
REMEMBERED = 250_000

# Bytes of text whose words are merged together.
TOGETHER = 12 << 20


class Ranks:
    """A vocabulary of byte strings by rank, and which neighbouring tokens form which."""

    def __init__(self, lines: list[bytes]) -> None:
        """`lines` as in a rank file: base64 of the token's bytes, a blank, its rank."""
        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.none = max(self.rank.values()) + 1
        self.size = self.none
        self.bytes: list[bytes] = [b""] * self.none
        for token, rank in self.rank.items():
            self.bytes[rank] = token
        formed = [
            (self.rank[token[:i]], self.rank[token[i:]], rank)
            for token, rank in self.rank.items()
            for i in range(1, len(token))
            if token[:i] in self.rank and token[i:] in self.rank
        ]
        left, right, into = np.array(formed, dtype=np.int64).reshape(-1, 3).T
        code = left * self.size + right
        order = np.argsort(code)
        self._code = np.append(code[order], np.iinfo(np.int64).max)
        self._into = np.append(into[order], self.none)
        self.single = np.array([self.rank.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        if (self.single < 0).any():
            raise ValueError("the vocabulary lacks single bytes")

    def forms(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair forms; `none` where there is none."""
        code = left * self.size + right
        at = np.searchsorted(self._code, code)
        return np.where(self._code[at] == code, self._into[at], self.none)

    def merge_word(self, word: bytes) -> list[int]:
        """Ids of one word, lowest rank first and leftmost first among equals."""
        n = len(word)
        ids = [int(self.single[b]) for b in word]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        length = [1] * n

        def formed(i: int) -> int | None:
            j = after[i]
            return self.rank.get(word[i:j + length[j]]) if j < n else None

        heap = [(r, i) for i in range(n) if (r := formed(i)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if not length[i] or formed(i) != rank:
                continue
            j = after[i]
            length[i], length[j], ids[i] = length[i] + length[j], 0, rank
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := formed(k)) is not None:
                    heapq.heappush(heap, (r, k))
        return [x for x, size in zip(ids, length) if size]


def replay(words: list[bytes], ranks: Ranks) -> list[bytes]:
    """Ids of every word as unsigned 32-bit integers, by replaying the merges over all of them together."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ids = ranks.single[np.frombuffer(b"".join(words), np.uint8)]
    n = len(ids)
    if not n:
        return [b"" for _ in words]
    word = np.repeat(np.arange(len(words)), lengths)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    last, first = np.cumsum(lengths[lengths > 0]) - 1, np.cumsum(lengths[lengths > 0]) - lengths[lengths > 0]
    after[last], before[first] = n, -1  # no neighbours across words
    pair = np.full(n + 1, ranks.none, dtype=np.int64)  # the token that a position and its right neighbour form
    inner = np.flatnonzero(after < n)
    pair[inner] = ranks.forms(ids[inner], ids[after[inner]])
    alive = np.ones(n, dtype=bool)

    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(positions: np.ndarray) -> None:
        """Put positions into the index under the token their pairs form."""
        formed = pair[positions]
        positions, formed = positions[formed < ranks.none], formed[formed < ranks.none]
        if not len(positions):
            return
        order = np.argsort(formed, kind="stable")
        positions, formed = positions[order], formed[order]
        cuts = np.flatnonzero(formed[1:] != formed[:-1]) + 1
        for rank, part in zip(formed[np.append(0, cuts)].tolist(), np.split(positions, cuts)):
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(heap, rank)

    enter(inner)
    alone: list[np.ndarray] = []
    while heap:
        rank = heapq.heappop(heap)
        at = np.sort(np.concatenate(index.pop(rank)))
        at = at[alive[at] & (pair[at] == rank) & np.append(True, at[1:] != at[:-1])]
        if not len(at):
            continue
        # A run of overlapping pairs: every second one merges, from the left.
        chained = after[at[:-1]] == at[1:]
        if chained.any():
            starts = np.append(0, np.flatnonzero(~chained) + 1)
            place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
            at = at[place % 2 == 0]
        eaten = after[at]
        ids[at] = rank
        alive[eaten] = False
        pair[eaten] = ranks.none
        follows = after[at] = after[eaten]
        inside = follows < n
        before[follows[inside]] = at[inside]
        pair[at] = ranks.none
        left = before[at]
        has_left = left >= 0
        left = left[has_left]
        renewed = np.concatenate([at[inside], left])
        formed = ranks.forms(ids[renewed], ids[np.concatenate([follows[inside], at[has_left]])])
        pair[renewed] = formed
        if len(at) > 1 and (formed < rank).any():
            touched, times = np.unique(word[at], return_counts=True)
            alone.append(np.intersect1d(word[renewed[formed < rank]], touched[times > 1]))
        enter(renewed)

    kept = np.flatnonzero(alive)
    flat = ids[kept].astype("<u4").tobytes()
    ends = 4 * np.searchsorted(word[kept], np.arange(len(words)), side="right")
    out = [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
    for w in np.unique(np.concatenate(alone)).tolist() if alone else ():
        out[w] = np.array(ranks.merge_word(words[w]), dtype="<u4").tobytes()
    return out


class Encoder:
    """Turns texts into ids; remembers the ids of what it has met.

    Texts are cut at single blanks between two characters that are not white space. No match of a pattern that lets a
    word begin with one blank, and with no more than that, spans such a place; so the pieces can be matched alone, and
    each distinct piece needs it once.
    """

    def __init__(self, ranks: Ranks, pattern: str, remembered: int = REMEMBERED) -> None:
        self.ranks, self._split = ranks, regex.compile(pattern).findall
        self._odd = regex.compile(r"\s\s|^\s|\s$").search  # blanks at which a text may not be cut
        self._words, self._pieces = Memo(remembered), Memo(remembered)

    def _pieces_of(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self._odd(text):
            return self._split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self._pieces_of(t) for t in texts]
        new = self._pieces.unknown(set().union(*map(set, cut)))
        # A blank and letters are one match.
        matches = [[x] if x[0] == " " and x[1:].isalpha() else self._split(x) for x in new]
        words = self._words.unknown(set().union(*matches))
        self._words.add(words, replay([w.encode() for w in words], self.ranks))
        of_word = self._words.of
        self._pieces.add(new, [of_word(x[0]) if len(x) == 1 else b"".join(map(of_word, x)) for x in matches])
        of_piece = self._pieces.of
        return [b"".join(map(of_piece, x)) for x in cut]


class Decoder:
    def __init__(self, ranks: Ranks) -> None:
        self._bytes = ranks.bytes

    def decode(self, ids: bytes) -> bytes:
        token = self._bytes
        return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(1)
def read_ranks(path: str) -> Ranks:
    """The rank file of a public tokenizer; every executor has it at this path."""
    with open(path, "rb") as file:
        return Ranks(file.readlines())


@lru_cache(1)
def encoder_of(path: str, pattern: str) -> Encoder:
    """One encoder for all tasks of a Python worker, which go on with the words it remembers."""
    return Encoder(read_ranks(path), pattern)


def encode(df: DataFrame, path: str, pattern: str, column: str = "text", into: str = "bpe") -> DataFrame:
    """Add a struct of `ids` (little-endian unsigned 32-bit) and `n_tokens` for every whole text."""

    def start():
        encoder = encoder_of(path, pattern)

        def compute(texts):
            ids = encoder.encode(texts)
            return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]

        return compute

    return with_struct(df, column, into, FIELDS, start, TOGETHER, gather=True)


def round_trip(df: DataFrame, path: str, pattern: str, column: str = "text", into: str = "bpe") -> DataFrame:
    """Add a struct of `n_tokens`, `ids_sha256` of the encoded ids and `decoded_sha256` of the bytes they decode to."""
    fields = T.StructType([
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])

    def start():
        ranks = read_ranks(path)
        encoder, decoder = encoder_of(path, pattern), Decoder(ranks)

        def compute(texts):
            ids = encoder.encode(texts)
            return [
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(decoder.decode(x)).hexdigest() for x in ids]),
            ]

        return compute

    return with_struct(df, column, into, fields, start, TOGETHER, gather=True)


def decode(df: DataFrame, path: str, column: str = "ids", into: str = "decoded") -> DataFrame:
    """Add a struct with the `bytes` that a binary column of ids decodes to; null ids decode to nothing."""

    def start():
        decoder = Decoder(read_ranks(path))
        return lambda ids: [pa.array([decoder.decode(x or b"") for x in ids], pa.binary())]

    return with_struct(df, column, into, T.StructType([T.StructField("bytes", T.BinaryType())]), start)
