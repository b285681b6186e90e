"""Token counts of whole texts, with most of the text never merged.

The tokenizer cuts a text into pre-tokens and merges each alone. Before any text is read, every string of the vocabulary is
merged once by itself: those that come out as one token are proven to be whole tokens, whatever stands around them. In a
text, a pre-token among them counts as one without any merge; only the rest is merged, each distinct one once as long as a
task remembers it (bounded memory).

Pre-tokens are cut by the tokenizer's pattern. Which characters are letters or numbers depends on the Unicode version of a
library; characters on which the tokenizer and the pattern matcher here differ are found when they are first met, and the
tokenizer itself cuts the texts that hold them. Strings of special tokens inside a text are one token each, as the
tokenizer has it by default.

Input: any text column; texts are never cut or shortened. Defined cases: null and empty texts have no bytes and no tokens;
a text of one endless word is merged in n log n steps; repeated rows are counted alike, each; an empty table gives no rows;
a column with the name of the result is replaced, all others are kept.
"""

from __future__ import annotations

import heapq
import json
import os
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Memo, with_struct

FIELDS = T.StructType([
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("over_limit", T.BooleanType()),
])

# Pre-tokens that are no whole tokens whose counts a Python worker remembers.
REMEMBERED = 200_000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or one from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Merges:
    """The merges of a byte-level vocabulary, by the pair they join."""

    def __init__(self, merges: list[list[str]]) -> None:
        self._letters = byte_letters()
        self._rank = {(left, right): rank for rank, (left, right) in enumerate(merges)}

    def count(self, token: str) -> int:
        """Tokens that a pre-token is merged into: lowest rank first, leftmost first among equals."""
        parts: list[str | None] = [self._letters[b] for b in token.encode()]
        n = left = len(parts)
        rank = self._rank
        if n < 2:
            return n
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or rank.get((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            k = before[i]
            if k >= 0 and (r := rank.get((parts[k], parts[i]))) is not None:
                heapq.heappush(heap, (r, k))
        return left


def whole_tokens(vocabulary: list[str], merges: Merges, split) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and are merged into one token when they stand alone."""
    byte = {letter: b for b, letter in enumerate(byte_letters())}
    proven = []
    for letters in vocabulary:
        try:
            text = bytes([byte[x] for x in letters]).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # no text of its own: a special token, or a part of a character
        if split(text) == [text] and merges.count(text) == 1:
            proven.append(text)
    return frozenset(proven)


class Counter:
    """Counts tokens as the tokenizer of a file does, for byte-level BPE with its usual pattern."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, cutter, added = described["model"], described["pre_tokenizer"] or {}, described["added_tokens"]
        plain = (
            model["type"] == "BPE" and cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space")
            and cutter.get("use_regex", True) and not described["normalizer"] and not model.get("ignore_merges")
            and not any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip"))
        )
        if not plain:
            raise ValueError("only byte-level BPE without normalizer, prefix or stripping tokens is counted")
        self._library_cuts = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._find = regex.compile(pattern)
        self._split = self._find.findall
        self._merges = Merges([m if isinstance(m, list) else m.split(" ") for m in model["merges"]])
        self.whole = whole_tokens(list(model["vocab"]), self._merges, self._split)
        special = sorted((x["content"] for x in added), key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self._agreed, self._differ = set(map(chr, range(128))), set()
        self._rest = Memo(remembered)

    def _differs(self, letter: str) -> bool:
        """Whether the library takes a character for another kind than the pattern here does."""
        probe = f"a{letter}1{letter}!{letter}a"
        return [at for _, at in self._library_cuts(probe)] != [m.span() for m in self._find.finditer(probe)]

    def _pre_tokens(self, text: str) -> list[str]:
        if not text.isascii():
            letters = set(text)
            for letter in letters - self._agreed - self._differ:
                (self._differ if self._differs(letter) else self._agreed).add(letter)
            if self._differ & letters:
                return [text[a:b] for _, (a, b) in self._library_cuts(text)]
        return self._split(text)

    def counts(self, texts: list[str | None]) -> list[int]:
        found, rest = [], []
        for text in texts:
            text, marks, parts = text or "", 0, None
            if self._special is not None:
                parts = self._special.split(text)
                marks = len(parts) - 1
            tokens = self._pre_tokens(text) if not marks else [t for part in parts for t in self._pre_tokens(part)]
            found.append(marks + len(tokens))
            rest.append([t for t in tokens if t not in self.whole])
        new = self._rest.unknown(set().union(*rest))
        self._rest.add(new, [self._merges.count(t) - 1 for t in new])
        more = self._rest.of
        return [n + sum(map(more, others)) for n, others in zip(found, rest)]


@lru_cache(1)
def counter_of(path: str, pattern: str) -> Counter:
    """One for all tasks of a Python worker."""
    return Counter(path, pattern)


def count(
    df: DataFrame, path: str, pattern: str, limit: int = 1024, column: str = "text", into: str = "tokens"
) -> DataFrame:
    """Add a struct of `n_bytes`, `n_tokens` and `over_limit` (more than `limit` tokens) for every whole text."""

    def start():
        counter = counter_of(path, pattern)

        def compute(texts):
            n = counter.counts(texts)
            return [
                pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                pa.array([x > limit for x in n], pa.bool_()),
            ]

        return compute

    return with_struct(df, column, into, FIELDS, start)
