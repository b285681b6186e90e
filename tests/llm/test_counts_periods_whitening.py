"""Token counts against the library, runs against a plain search, whitening against numpy; and the registered queries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riverstat.llm import periods, queries, tokencount, whitening

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def counter():
    return tokencount.counter_of(JSON, public_tokenizers.PATTERN)


def library_counts(library, texts):
    return [len(x.ids) for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    letters = "ab  \n\t'sllé漢՘\U0001f600.,19  ߀͸"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    return [
        None, "", " ", "\n\n  x", "a" * 5000, " " * 3000 + "x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext",
        "it's we'll 'S I'M", "\x00\x7f﻿", "\U0002fa1d\U000e0101", *made,
    ]


def test_counts_equal_the_library(library, counter):
    texts = odd_texts()
    assert counter.counts(texts) == library_counts(library, texts)


def test_whole_tokens_are_proven(library, counter):
    some = sorted(counter.whole)
    ids = library.encode_batch(some, add_special_tokens=False)
    assert all(len(x.ids) == 1 for x in ids) and len(some) > 40_000
    assert "<|endoftext|>" not in counter.whole


def test_counts_forget_without_harm(library):
    small = tokencount.Counter(JSON, public_tokenizers.PATTERN, remembered=3)
    texts = odd_texts()
    for _ in range(2):
        assert [small.counts([t])[0] for t in texts] == library_counts(library, texts)


def test_counts_of_rows(spark, library):
    texts = odd_texts()[:40] * 2
    rows = [(i % 40, t, "x") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, tokens string")
    found = tokencount.count(table, JSON, public_tokenizers.PATTERN, limit=3).select("doc_id", "text", "tokens.*").collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == sorted(
        (i, len((t or "").encode()), n, n > 3) for (i, t, _), n in zip(rows, library_counts(library, texts))
    )
    assert tokencount.count(table.limit(0), JSON, public_tokenizers.PATTERN).count() == 0


def test_registered_token_counts(spark, library):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    found = queries.QUERIES["op12_tokens"](spark, folder).collect()
    counts = dict(zip(docs, library_counts(library, docs.values())))
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found} == {
        i: (len((t or "").encode()), counts[i], counts[i] > 1024) for i, t in docs.items()
    }
    assert len(found) == len(docs)


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by comparing all words with those of every period later."""
    n, out = len(words), []
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(24, 3 * p):
                smaller = any(all(words[k] == words[k + q] for k in range(i, j + p - q)) for q in range(1, p))
                if not smaller:
                    out.append((i, length, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text, rewrite=True):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if rewrite and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + length for s, length, p in found)]
    best = (None,) * 4
    if found:
        from fractions import Fraction

        s, length, p = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, length, p, 1000 * length // p)
    return (doc_id, len(found), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def repeating(seed: int, longest: int = 300) -> str:
    rng = random.Random(seed)
    n, kinds = rng.randrange(longest), rng.choice([1, 2, 3, 60])
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 30:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 3))
            for i in range(a + p, min(n, a + p * rng.randrange(2, 9))):
                words[i] = words[i - p]
    return rng.choice([" ", "\n", "\t "]).join(words)


def as_rows(found):
    return sorted(
        [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in found],
        key=repr,
    )


@pytest.mark.parametrize("long", [periods.LONG, 40])
def test_runs_equal_a_plain_search(spark, long):
    """Also with documents of more than 40 words dealt to other tasks in rows of few tiles."""
    rows = [(i, repeating(i), 1) for i in range(150)]
    rows += [(None, "x " * 40, 1), (7, None, 1), (7, "", 1), (7, " \n", 1), (3, repeating(3), 1), (3, "a b " * 30, 1)]
    rows += [(900, "a " * 23, 1), (901, "a " * 24, 1), (902, "a b " * 30, 1), (903, " ".join("abcdefgh" * 3), 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    found = periods.report(table, periods.planted, long).collect()
    assert as_rows(found) == sorted([plain_report(i, t) for i, t, _ in rows], key=repr)
    assert sum(r.n_runs for r in found) > 50


def test_runs_of_long_texts(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(9000)}" for _ in range(40_000)]
    text = " ".join(base + base + base + base[:50] + ["z"] * 70_000)
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = periods.report(table).first()
    # Whether the words behind the third copy go on with the period is up to them; z's are the longest by their period.
    assert (row.n_runs, row.start, row.length, row.period) == (2, 120_050, 70_000, 1)
    kept = b" ".join([w.encode() for w in base] + [b"z"])
    assert row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
    assert periods.report(table.limit(0)).count() == 0


def test_registered_periods(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in docs if len((r.text or "").split()) <= 1500}
    found = queries.QUERIES["op13_periods"](spark, folder).collect()
    assert len(found) == len(docs)
    assert as_rows([r for r in found if r.doc_id in short]) == sorted([plain_report(i, t) for i, t in short.items()], key=repr)


def whitened_plainly(vectors: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors], dtype=np.float64)
    n = len(x)
    y = x - x.mean(0)
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(0))) for row in x]
    return y @ axes / np.sqrt(np.maximum(values, 1e-300)), values, axes, exact


def check_whitened(found, vectors: dict[int, list], k: int):
    ids = list(vectors)
    plain, values, _, exact = whitened_plainly([vectors[i] for i in ids])
    by = {(r.vec_id, r.component): r for r in found}
    assert len(found) == len(by) == len(ids) * k
    for c in range(k):
        got = np.array([by[i, c + 1].whitened for i in ids])
        sign = np.sign((got * plain[:, c]).sum())
        assert np.abs(got - sign * plain[:, c]).max() < 1e-6
        assert abs(by[ids[0], c + 1].explained / (values[c] / values.sum()) - 1) < 1e-9
    assert [by[i, 1].deviation for i in ids] == exact
    assert {r.n for r in found} == {len(ids)} and max(r.identity_error for r in found) < 1e-6


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    for d, rank in ((1, 1), (2, 2), (7, 7), (16, 5), (33, 33)):
        a = rng.normal(size=(d, rank)) * 10.0 ** rng.uniform(-3, 3, rank)
        matrix = a @ a.T
        factor = whitening.pivoted_cholesky(matrix)
        assert factor.shape[1] >= rank and np.allclose(factor @ factor.T, matrix, rtol=1e-12, atol=1e-12 * matrix.max())
        values, axes = whitening.one_sided_jacobi(factor)
        assert np.allclose(values[:rank], np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-6)
        assert np.abs(axes[:, :rank].T @ axes[:, :rank] - np.eye(rank)).max() < 1e-12
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_whitening_of_rows(spark):
    rng = np.random.default_rng(5)
    vectors = {i: (rng.normal(size=6) * [5, 3, 2, 1, 0.5, 0.25]).tolist() for i in range(200)}
    odd = [(300, None), (301, []), (302, [1.0, None, 1, 1, 1, 1]), (303, [float("nan")] * 6), (304, [float("inf")] * 6),
           (305, [1.0, 2.0]), (306, [1e20] * 6)]
    rows = [(i, [*map(float, v)], 1) for i, v in vectors.items()]
    rows += [(i, None if v is None else [None if c is None else float(c) for c in v], 1) for i, v in odd]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int").repartition(5)
    check_whitened(whitening.whiten(table).collect(), vectors, 6)
    check_whitened(whitening.whiten(table, components=2).collect(), vectors, 2)


def test_whitening_of_repeats_and_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(5)], schema)
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.limit(0)).count() == 0
    assert whitening.whiten(same.limit(0)).columns == whitening.whiten(same).columns
    line = spark.createDataFrame([(None, [0.0, 0.0]), (1, [1.0, 2.0]), (1, [2.0, 4.0]), (2, [2.0, 4.0])], schema)
    found = whitening.whiten(line).collect()
    assert sorted((r.vec_id or -1, round(abs(r.whitened), 9)) for r in found) == sorted(
        zip((-1, 1, 1, 2), np.round(np.abs(np.array([0, 1, 2, 2]) - 1.25) / np.std([0, 1, 2, 2]), 9).tolist())
    )
    assert abs(found[0].explained - 1) < 1e-12


def test_deviation_beyond_a_long_is_an_error():
    x = np.array([[2 ** 40], [0]], dtype=np.int64)
    assert whitening.deviations(x[1:], 2, [2]) == [4]
    with pytest.raises(OverflowError):
        whitening.deviations(x, 2, [2 ** 40])


def test_registered_whitening(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").filter(F.col("embedding").isNotNull())
    vectors = {r.vec_id: r.embedding for r in table.collect()}
    vectors = {i: v for i, v in vectors.items() if v and all(c is not None and np.isfinite(c) for c in v)}
    check_whitened(queries.QUERIES["op11_whitening"](spark, folder).collect(), vectors, 8)
