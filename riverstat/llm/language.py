"""Language of texts by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (from its code point and a seed, so all tasks agree). An n-gram's vector binds
the vectors of its letters by multiplication, each permuted (rotated) once for every place before the last. A text's vector
bundles, that is adds, those of all its n-grams; a language's prototype bundles the vectors of texts in that language, each
scaled to length one. Texts are compared with the prototypes by cosine, after the mean of the prototypes, which holds what
the languages share, is taken off the prototypes.

Letters are taken in lower case; runs of other characters are one blank. Whole texts count, in pieces of bounded memory.

Prototypes are learned from at most about `SAMPLE` labelled rows, chosen by a hash of doc_id; their sums per task are added by
Spark. Prediction uses the text only.

Defined cases: null texts and texts without letters are `und` with score 0; with no labelled row every text is `und`; ties go
to the language that sorts first; rows without doc_id are never learned from; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, pieces, ship, with_struct

UNKNOWN = "und"
DIMENSIONS = 1024
SAMPLE = 8000  # labelled rows that prototypes are learned from
N = 3
SEED = 7
FOREIGN = 0.12  # texts of LETTERS or more below this cosine with all whole prototypes are in no learned language
LETTERS = 200

_BLANK = 32
_ROWS = 192  # texts whose counts are multiplied together


@lru_cache(1)
def _folded() -> np.ndarray:
    """Each code point's letter in lower case, or a blank."""
    fold = np.full(0x110000, _BLANK, dtype=np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            lower = letter.lower()
            fold[point] = ord(lower) if len(lower) == 1 else point
    return fold


class Space:
    """Vectors of letters and n-grams; remembers those it has made (bounded)."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = N, seed: int = SEED, remembered: int = 10_000) -> None:
        self.dimensions, self.n, self._seed, self._remembered = dimensions, n, seed, remembered
        self._letters: dict[int, np.ndarray] = {}
        self._codes = np.empty(0, dtype=np.int64)
        self._vectors = np.empty((0, dimensions), dtype=np.float32)
        self._fold = _folded()

    def _letter(self, point: int) -> np.ndarray:
        if point not in self._letters:
            bits = np.random.default_rng([self._seed, point]).integers(0, 2, self.dimensions)
            self._letters[point] = (2 * bits - 1).astype(np.int8)
        return self._letters[point]

    def _ngram(self, code: int) -> np.ndarray:
        bound = np.ones(self.dimensions, dtype=np.int8)
        for place in range(self.n):
            bound = bound * np.roll(self._letter(code & 0x1FFFFF), place)
            code >>= 21
        return bound

    def ngrams(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of n-grams (sorted codes of 21 bits a letter)."""
        known = np.isin(codes, self._codes, assume_unique=True)
        if not known.all():
            new = codes[~known]
            made = np.array([self._ngram(c) for c in new.tolist()], dtype=np.float32)
            if len(self._codes) + len(new) > self._remembered:
                self._codes, self._vectors = codes[:0], self._vectors[:0]
                new = codes
                made = np.array([self._ngram(c) for c in new.tolist()], dtype=np.float32)
            order = np.argsort(both := np.append(self._codes, new))
            self._codes, self._vectors = both[order], np.concatenate([self._vectors, made])[order]
        return self._vectors[np.searchsorted(self._codes, codes)]

    def _counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts (texts by n-grams) and the n-grams' codes."""
        padded = [f" {t} " for t in texts]
        points = self._fold[np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        row = np.repeat(np.arange(len(texts)), [len(t) for t in padded])
        blank = points == _BLANK
        stay = ~(blank & np.append(False, blank[:-1] & (row[1:] == row[:-1])))
        points, row = points[stay].astype(np.int64), row[stay]
        size = len(points) - self.n + 1
        if size <= 0:
            return np.zeros((len(texts), 0), dtype=np.float32), np.empty(0, dtype=np.int64)
        code = np.zeros(size, dtype=np.int64)
        for place in range(self.n):
            code = code << 21 | points[place:place + size]
        whole = row[:size] == row[self.n - 1:]
        codes, index = np.unique(code[whole], return_inverse=True)
        flat = np.bincount(row[:size][whole] * len(codes) + index, minlength=len(texts) * len(codes))
        return flat.reshape(len(texts), len(codes)).astype(np.float32), codes

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """One vector a text; zero if it has no letter. Texts longer than a group's share are taken in parts."""
        out = np.zeros((len(texts), self.dimensions), dtype=np.float64)
        part, rows, held = [], [], 0

        def add() -> None:
            nonlocal part, rows, held
            counts, codes = self._counts(part)
            if len(codes):
                np.add.at(out, rows, counts @ self.ngrams(codes))
            part, rows, held = [], [], 0

        for i, text in enumerate(texts):
            if text is None or not any(map(str.isalpha, text)):
                continue
            for at in range(0, len(text), 1 << 20):  # parts overlap so that no n-gram is lost
                chunk = text[max(0, at - self.n + 1):at + (1 << 20)]
                part.append(chunk)
                rows.append(i)
                held += len(chunk)
                if len(part) == _ROWS or held > 1 << 20:
                    add()
        if part:
            add()
        return out


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # (languages, dimensions), of length one, without what the languages share
    whole: np.ndarray  # the same with it
    dimensions: int
    n: int
    seed: int


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def learn(
    docs: DataFrame, learnable: Column, dimensions: int = DIMENSIONS, n: int = N, seed: int = SEED, sample: int = SAMPLE
) -> Profiles:
    """Prototypes from the rows for which `learnable` holds and lang is not null."""
    ship(docs.sparkSession)
    rows = docs.filter(learnable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    share = min(1.0, sample / max(1, rows.count()))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < F.lit(round(share * (1 << 30)))

    def run(batches):
        space, sums = Space(dimensions, n, seed), {}
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                vectors = _unit(space.bundle(piece.column("text").to_pylist()))
                langs = np.array(piece.column("lang").to_pylist(), dtype=object)
                for lang in set(langs.tolist()):
                    sums[lang] = sums.get(lang, 0) + vectors[langs == lang].sum(0)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(list(sums), pa.string()),
            "sums": pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64())),
        })

    sums = rows.filter(chosen).select("lang", "text").mapInArrow(run, "lang string, sums array<double>")
    parts = sums.select("lang", F.posexplode("sums").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    found = parts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"))  # one vector a language
    bundles = {r["lang"]: np.array([p["x"] for p in r["v"]]) for r in found.collect()}
    languages = sorted(k for k, v in bundles.items() if v.any())
    prototypes = _unit(np.array([bundles[k] for k in languages]).reshape(len(languages), dimensions))
    whole = prototypes
    if len(languages) > 1:
        prototypes = _unit(prototypes - prototypes.mean(0))
    return Profiles(languages, prototypes, whole, dimensions, n, seed)


_FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_NEAR = T.StructType([*_FIELDS.fields, T.StructField("near", T.DoubleType())])


def predict(
    docs: DataFrame, profiles: Profiles, column: str = "text", into: str = "language", near: bool = False
) -> DataFrame:
    """Add a struct of `lang_pred` and `score`, the cosine with that language's prototype (0 where it is negative).

    With `near` it also has the largest cosine with the whole prototypes, which texts of mixed languages keep.
    """
    names = [*profiles.languages, UNKNOWN]
    prototypes, whole = profiles.prototypes.T.astype(np.float64), profiles.whole.T.astype(np.float64)

    def start():
        space = Space(profiles.dimensions, profiles.n, profiles.seed)

        def compute(texts):
            vectors = space.bundle(texts)
            some = vectors.any(1) & bool(len(names) > 1)
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            nearest = np.zeros(len(texts))
            if some.any():
                unit = _unit(vectors[some])
                cosine = unit @ prototypes
                best[some], score[some] = cosine.argmax(1), np.clip(cosine.max(1), 0, 1)
                if near:
                    nearest[some] = (unit @ whole).max(1)
            made = [pa.array([names[i] for i in best], pa.string()), pa.array(score)]
            return [*made, pa.array(nearest)] if near else made

        return compute

    return with_struct(docs, column, into, _NEAR if near else _FIELDS, start)


def held_out() -> Column:
    """Rows that nothing is learned from: crc32 of doc_id as text leaves 2 when divided by 4, or there is no doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def known_language(docs: DataFrame) -> DataFrame:
    """The documents that may be in a learned language.

    Those without letters go, and those of `LETTERS` or more whose cosines with the whole prototypes are all below `FOREIGN`.
    If no language could be learned, all documents with letters stay.
    """
    profiles = learn(docs, ~held_out())
    if not profiles.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    letters = F.length(F.regexp_replace("text", r"\P{L}+", ""))
    into = free(docs, "_language")
    foreign = F.when(F.col(f"{into}.near") < FOREIGN, letters >= LETTERS).otherwise(False)
    found = predict(docs, profiles, into=into, near=True)
    return found.filter((F.col(f"{into}.lang_pred") != UNKNOWN) & ~foreign).select(docs.columns)
