"""Toxicity of texts by a factorization machine over hashed terms.

Terms of a text are its distinct words in lower case and their first 3, 4 and 5 letters (languages that build words share the
beginnings), each held as a 64-bit hash. The score is the logistic function of

    bias + sum of w[i] + sum over pairs i < j of <v[i], v[j]>

over the terms i of the text that the model holds, so two terms can count together for more (or less) than each alone. The
pair sum takes one pass over the terms: half of (sum of v)^2 - sum of v^2.

Learning uses at most about `SAMPLE` labelled rows, chosen by a hash of doc_id. Spark counts in how many toxic and other
rows of these each term occurs; the model holds the `TERMS` terms that tell most (likelihood ratio, `LEAST` rows or more);
weights are then fitted to the sample's rows, reduced to these terms, by AdaGrad on the logistic loss. The sample and the
model are the same size at any input size. Scoring reads whole texts.

Defined cases: null and empty texts have the score of the bias alone; without labelled rows of both kinds all scores are the
share of toxic rows (0 without any); rows without doc_id are not learned from; other columns are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, free, Memo, pieces, ship, with_struct

SAMPLE = 20_000  # labelled rows that the model is learned from
TERMS = 4096
LEAST = 5
FACTORS = 4
EPOCHS = 40

_WORDS = re.compile(r"[^\W\d_]+").findall
_PREFIXES = (3, 4, 5)


def _hash(kind: str, term: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}{term}") - (1 << 63)


def terms_of(word: str) -> list[int]:
    """Hashed terms of a word in lower case."""
    return [_hash("=", word), *[_hash("^", word[:n]) for n in _PREFIXES if len(word) >= n]]


class Terms:
    """Distinct terms of texts; remembers those of words it has met."""

    def __init__(self, of_word, remembered: int = 200_000) -> None:
        self._of_word, self._memo = of_word, Memo(remembered)

    def of(self, texts: list[str | None]) -> list[set[int]]:
        words = [set(_WORDS(t.lower())) if t else set() for t in texts]
        new = self._memo.unknown(set().union(*words))
        self._memo.add(new, map(self._of_word, new))
        of = self._memo.of
        return [set().union(*map(of, w)) for w in words]


@dataclass(frozen=True)
class Machine:
    terms: np.ndarray  # sorted hashes
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # (terms, FACTORS)

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Scores of rows of term numbers."""
        return 1 / (1 + np.exp(-np.clip(self.bias + _sums(rows, self.linear, self.factors)[0], -40, 40)))


def _starts(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat term numbers, the rows they are of, and the numbers of rows that have any."""
    n = np.array([len(x) for x in rows], dtype=np.int64)
    flat = np.concatenate(rows).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    return flat, np.repeat(np.arange(len(rows)), n), n


def _sums(rows, linear, factors):
    flat, row, _ = _starts(rows)
    total = np.bincount(row, linear[flat], len(rows))
    sums = np.stack([np.bincount(row, factors[flat, f], len(rows)) for f in range(factors.shape[1])], 1)
    squares = np.bincount(row, (factors[flat] ** 2).sum(1), len(rows))
    return total + 0.5 * ((sums ** 2).sum(1) - squares), sums


def fit(terms: np.ndarray, rows: list[np.ndarray], toxic: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS,
        rate: float = 0.1, decay: float = 1e-5, seed: int = 3) -> Machine:
    """Weights by AdaGrad over rows of term numbers, in an order that is fixed by the seed."""
    rng = np.random.default_rng(seed)
    share = min(max(toxic.mean(), 1e-6), 1 - 1e-6) if len(toxic) else 1e-6
    bias, w = float(np.log(share / (1 - share))), np.zeros(len(terms))
    v = rng.normal(0, 0.01, (len(terms), factors))
    seen_b, seen_w, seen_v = 1.0, np.ones(len(terms)), np.ones((len(terms), factors))
    for _ in range(epochs if 0 < toxic.sum() < len(toxic) else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 256):
            chosen = order[at:at + 256]
            part = [rows[i] for i in chosen]
            flat, row, _ = _starts(part)
            score, sums = _sums(part, w, v)
            error = 1 / (1 + np.exp(-np.clip(bias + score, -40, 40))) - toxic[chosen]
            gw = np.bincount(flat, error[row], len(w)) + decay * w
            pull = error[row, None] * (sums[row] - v[flat])
            gv = np.stack([np.bincount(flat, pull[:, f], len(w)) for f in range(factors)], 1) + decay * v
            gb = error.sum()
            seen_b += gb * gb
            seen_w += gw * gw
            seen_v += gv * gv
            bias -= rate * gb / seen_b ** 0.5
            w -= rate * gw / np.sqrt(seen_w)
            v -= rate * gv / np.sqrt(seen_v)
    return Machine(terms, bias, w, v)


def _ratio(a: Column, n: Column, b: Column, m: Column) -> Column:
    """Likelihood ratio of `a` of n against `b` of m."""

    def part(x, size):
        p = (a + b) / (n + m)
        return F.when(x > 0, x * F.log(x / (size * p))).otherwise(0.0)

    def rest(x, size):
        p = (a + b) / (n + m)
        return F.when(x < size, (size - x) * F.log((size - x) / (size * (1 - p)))).otherwise(0.0)

    return 2 * (part(a, n) + part(b, m) + rest(a, n) + rest(b, m))


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE, most: int = TERMS,
          least: int = LEAST, seed: int = 11) -> Machine:
    """Learn from docs (doc_id, text) and labels (doc_id, toxic) in the rows for which `learnable` (of doc_id) holds."""
    ship(docs.sparkSession)
    known = labels.select("doc_id", "toxic").filter(learnable & F.col("toxic").isin(0, 1))
    share = min(1.0, sample / max(1, known.count()))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < F.lit(round(share * (1 << 30)))
    picked = known.filter(chosen).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))  # at most about `sample` rows
    rows = cut(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()

    def count(batches):
        terms = Terms(terms_of)
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                met = {0: Counter(), 1: Counter()}
                for toxic, found in zip(piece.column("toxic").to_pylist(), terms.of(piece.column("text").to_pylist())):
                    met[toxic].update(found)
                for toxic, counts in met.items():
                    n = pa.array(counts.values(), pa.int64())
                    zero = pa.array(np.zeros(len(counts), np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(counts.keys(), pa.int64()), n if toxic else zero, zero if toxic else n], ["term", "a", "b"]
                    )

    counted = rows.select("toxic", "text").mapInArrow(count, "term long, a long, b long")
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    n, m = F.lit(float(size["toxic"])), F.lit(float(size["n"] - size["toxic"]))
    telling = (
        counted.groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .filter((a + b >= least) & (n > 0) & (m > 0))
        .withColumn("ratio", _ratio(a, n, b, m)).filter("ratio > 10.8")
        .orderBy(F.desc("ratio"), "term").limit(most)  # the size of the model
    )
    terms = np.sort(np.array([r["term"] for r in telling.select("term").collect()], dtype=np.int64))

    def reduce(batches):
        found_of = Terms(_numbered(terms))
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                found = [sorted(x) for x in found_of.of(piece.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("toxic"), pa.array(found, pa.list_(pa.int64()))],
                    ["doc_id", "toxic", "found"],
                )

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("found", T.ArrayType(T.LongType()))])
    # Rows of the bounded sample, reduced to the model's terms.
    drawn = sorted(rows.mapInArrow(reduce, schema).collect(), key=lambda r: (r["doc_id"], r["toxic"], r["found"]))
    return fit(terms, [np.array(r["found"], np.int64) for r in drawn], np.array([r["toxic"] for r in drawn], dtype=float))


def _numbered(terms: np.ndarray):
    """Numbers of a word's terms in the model."""
    number = {t: i for i, t in enumerate(terms.tolist())}
    return lambda word: [number[t] for t in terms_of(word) if t in number]


_FIELDS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score(docs: DataFrame, machine: Machine, column: str = "text", into: str = "toxicity") -> DataFrame:
    """Add a struct of `score` (0 to 1) and `predicted` (1 from 0.5)."""

    def start():
        terms = Terms(_numbered(machine.terms))

        def compute(texts):
            found = machine.scores([np.fromiter(x, np.int64, len(x)) for x in terms.of(texts)])
            return [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]

        return compute

    return with_struct(docs, column, into, _FIELDS, start)


def held_out() -> Column:
    """Rows that nothing is learned from: crc32 of doc_id as text is divisible by 5, or there is no doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic."""
    machine = learn(docs, labels, ~held_out())
    into = free(docs, "_toxicity")
    return score(docs, machine, into=into).filter(F.col(f"{into}.predicted") == 0).select(docs.columns)
