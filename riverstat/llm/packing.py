"""Tokenised documents packed into sequences by the sum-of-squares rule.

A document's ids are those of its whole text and one closing id. Only documents longer than a sequence are cut, into whole
sequences and a rest. Where a piece goes is decided by the open sequences alone: with N(g) sequences that have a gap of g
left, the piece goes to the gap, or to a new sequence, that makes the sum of N(g)^2 over all gaps smallest afterwards. So
no gap is left behind that many others share and few pieces fit. Full sequences count for nothing.

A word's ids do not depend on its neighbours. The distinct words of 16 MB of texts are found by sorting their hashes, and only
these are looked up among those a task remembers, or given to the tokenizer; ids of texts are then gathered by position.

Pieces are dealt by a hash into blocks of about `BLOCK` pieces, and each block is packed in one task, longest pieces first
(ties by document and piece). A block ends with a few open sequences, so their share falls with its size; it is the same
at every input size, and no task holds more than a block. Only lengths and numbers move; texts and ids do not.

Defined cases: null text is empty (one piece with the closing id alone); equal rows are packed one by one; an empty table
gives no rows; a null doc_id is kept as null.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, cut, with_struct

# Pieces that one task packs.
BLOCK = 8192

# Words whose ids a Python worker remembers.
REMEMBERED = 300_000

# Bytes of text whose words are looked up together.
TOGETHER = 16 << 20

_SIGNS = (b".", b",")

# Words given to the tokenizer in one string.
_TOGETHER = 256


class Words:
    """Ids of texts by a tokenizer that drops white space, word by word; remembers the words it has met.

    Texts are cut at blanks and line feeds only; words may hold other white space, which the tokenizer then treats. A-Z
    become lower case here as the tokenizer would do it, and a full stop or comma behind an ASCII letter ends a match, so a
    word with it at its end has the ids of the word without it and those of the sign.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known, self._stems = Memo(remembered), Memo(remembered)
        vocabulary = self._tokenizer.get_vocab()
        self._is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._is_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # The strings of special tokens are matched before lower case is made.
        self._special = [x.content.encode() for x in self._tokenizer.get_added_tokens_decoder().values()]

    def _lower(self, text: str) -> bytes:
        raw = text.encode()
        lower = raw.lower()
        return raw if any(x in lower for x in self._special) else lower

    def _found(self, words: list[bytes]) -> list[bytes]:
        """Ids of unknown words. Each match ends with an id that is marked as a word's end, so words of letters are given
        in one string and parted there; where a string has more ends than words, its words are given one by one."""
        texts = [w.decode() for w in words]
        letters = [i for i, t in enumerate(texts) if t.isalpha()]
        single = [i for i, t in enumerate(texts) if not t.isalpha()]
        groups = [letters[i:i + _TOGETHER] for i in range(0, len(letters), _TOGETHER)]
        out = [b""] * len(words)
        joined = [" ".join([texts[i] for i in group]) for group in groups]
        for group, made in zip(groups, self._tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(made.ids, dtype="<u4")
            ends = (4 * np.flatnonzero(self._is_end[ids]) + 4).tolist()
            if len(ends) != len(group):
                single += group
                continue
            raw = ids.tobytes()
            for i, a, b in zip(group, [0, *ends], ends):
                out[i] = raw[a:b]
        rest = self._tokenizer.encode_batch_fast([texts[i] for i in single], add_special_tokens=False)
        for i, made in zip(single, rest):
            out[i] = np.array(made.ids, dtype="<u4").tobytes()
        return out

    def ids(self, texts: list[str | None], closing: int) -> list[np.ndarray]:
        """Ids of each text and the closing one. Only distinct words are looked up, once for all texts of the list."""
        words, of_word, ends = distinct_words([self._lower(t or "") for t in texts])
        new = self._known.unknown(set(words))
        parts = [(w[:-1], w[-1:]) if w[-1:] in _SIGNS and w[-2:-1].islower() else (w,) for w in new]
        stems = self._stems.unknown({x for part in parts for x in part})
        self._stems.add(stems, self._found(stems))
        of_stem = self._stems.of
        self._known.add(new, [b"".join(map(of_stem, part)) for part in parts])
        each = list(map(self._known.of, words))
        length = np.fromiter(map(len, each), np.int64, len(each)) // 4
        flat, begin = np.frombuffer(b"".join(each), dtype="<u4"), np.cumsum(length) - length
        n = length[of_word]
        total = np.append(0, np.cumsum(n))
        made = flat[np.repeat(begin[of_word] - total[:-1], n) + np.arange(total[-1])]
        cuts, end = total[ends].tolist(), np.array([closing], dtype="<u4")
        return [np.append(made[i:j], end) for i, j in zip([0, *cuts[:-1]], cuts)]


# Fixed random numbers per byte and powers of odd numbers per place, for two independent hashes of words.
_BYTE = np.random.default_rng(5).integers(1, 1 << 63, size=(2, 256), dtype=np.uint64)
_PLACES = 1 << 12
_POWER = np.stack([
    np.cumprod(np.full(_PLACES, odd, dtype=np.uint64), dtype=np.uint64) for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
])

# Bytes that are hashed at once.
_HASHED = 1 << 20


def _hashes(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Two hashes of each word, none empty, by its bytes, their places and its length."""
    out = np.empty((2, len(starts)), dtype=np.uint64)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(starts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + _HASHED, side="right")))
        n = lengths[at:to]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        letters = raw[place + np.repeat(starts[at:to], n)]
        place %= _PLACES
        for k in (0, 1):
            out[k, at:to] = np.add.reduceat(_BYTE[k][letters] * _POWER[k][place], first) + n.astype(np.uint64)
        at = to
    return out


def distinct_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of texts that are cut at blanks and line feeds, the number of each word, and of words up to each
    text's end. Words are told apart by 128 bits."""
    joined = b" ".join([*texts, b""])
    raw = np.frombuffer(joined, np.uint8)
    blanks = np.flatnonzero((raw == 32) | (raw == 10))
    starts = np.append(0, blanks[:-1] + 1) if len(blanks) else blanks
    lengths = blanks - starts
    starts, lengths = starts[lengths > 0], lengths[lengths > 0]
    ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    one, two = _hashes(raw, starts, lengths)
    order = np.argsort(one, kind="stable")
    if (differ := np.append(False, (one[order][1:] == one[order][:-1]) & (two[order][1:] != two[order][:-1]))).any():
        order = np.lexsort((two, one))
        differ = np.append(False, two[order][1:] != two[order][:-1])
    new = np.append(True, one[order][1:] != one[order][:-1])[:len(order)] | differ[:len(order)]
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    first = order[new]
    words = [joined[a:b] for a, b in zip(starts[first].tolist(), (starts[first] + lengths[first]).tolist())]
    return words, number, ends


@lru_cache(1)
def words_of(path: str, remembered: int) -> Words:
    """One for all tasks of a Python worker, which go on with the words it remembers."""
    return Words(path, remembered)


def pieces(
    docs: DataFrame, path: str, size: int = 4096, closing: int = 1, column: str = "text", together: int = TOGETHER,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    `together` and `remembered` only trade a task's memory for time; 16 MB of texts take about 300 MB.
    """
    part = T.StructType([
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    fields = T.StructType([T.StructField("pieces", T.ArrayType(part))])

    def start():
        words = words_of(path, remembered)

        def compute(texts):
            ids = words.ids(texts, closing)
            counts = [-(-len(x) // size) for x in ids]
            starts = [s for x in ids for s in range(0, len(x), size)]
            parts = [x[s:s + size] for x in ids for s in range(0, len(x), size)]
            struct = pa.StructArray.from_arrays([
                pa.array([i for n in counts for i in range(n)], pa.int32()), pa.array(starts, pa.int64()),
                pa.array([len(x) for x in parts], pa.int64()),
                pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64()),
            ], names=part.names)
            return [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), struct)]

        return compute

    rows = with_struct(
        docs.select("doc_id", F.col(column).alias("text")), "text", "made", fields, start, together, gather=True
    )
    return rows.select("doc_id", F.explode("made.pieces").alias("p")).select("doc_id", "p.*")


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, placed one after the other where the sum of squares becomes smallest.

    Moving a sequence from gap g to gap h changes the sum by 2 (N(h) - N(g)) + 2, where gaps 0 and `size` (full and new
    sequences) have no count of their own. Ties go to the smallest gap.
    """
    count = np.zeros(size + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    filled: list[int] = []
    number, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    for i, length in enumerate(lengths.tolist()):
        gaps = count[length:size]  # of the gaps length, ..., size - 1
        change = 2 * count[0:size - length] - 2 * gaps + 2
        if length < size:
            change[0] = 1 - 2 * gaps[0]  # the sequence becomes full
            change[gaps == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            opened = 2 * int(count[size - length]) + 1
            gap = length + best if change[best] <= opened else size
        else:
            gap = size
        if gap == size:
            sequence = len(filled)
            filled.append(0)
        else:
            sequence = open_at[gap].pop()
            count[gap] -= 1
        number[i], offset[i] = sequence, filled[sequence]
        filled[sequence] += length
        left = size - filled[sequence]
        if left:
            count[left] += 1
            open_at[left].append(sequence)
    return number, offset


def pack(rows: DataFrame, size: int = 4096, block: int = BLOCK) -> DataFrame:
    """Add sequence_id and offset to rows of doc_id, piece, start, length, ids_crc32 whose lengths are 1 to `size`."""
    rows = cut(rows)
    blocks = max(1, -(-rows.count() // block))

    def place(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable"
        )
        number, offset = sum_of_squares(pdf["length"].to_numpy(), size)
        pdf["sequence_id"] = key[0] * (1 << 32) + number
        pdf["offset"] = offset
        return pdf.drop(columns="block")

    schema = T.StructType([
        *rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())
    ])
    # The hash covers all columns, so rows without a doc_id spread too.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(*rows.columns), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(place, schema)


def pack_documents(
    docs: DataFrame, path: str, size: int = 4096, closing: int = 1, column: str = "text", together: int = TOGETHER,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The pieces of all documents with their places; sequence ids are unique, offsets gapless."""
    return pack(pieces(docs, path, size, closing, column, together, remembered), size)
