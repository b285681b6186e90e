"""Runs of words that repeat with a period, and texts with all but one period of each run.

A run is a longest stretch of words whose smallest period q is met by all words q apart, of at least max(24, 3 q) words.
Periods are taken by octaves: 1 to 7, 8 to 15, 16 to 31, and so on, an octave from S on (8 for the first) with boundaries every
S words. Around each boundary lies a tile, S words before it and 4 S behind it. Within a tile, the Z-function of the words
behind the boundary says how far these agree with those p later, and that of the reversed words how far the words before
the boundary do; both are linear in the tile. The words of a run agree with those p later on 2 S places or more, so some
boundary in it has S of them behind it, and every such boundary gives a fragment that reaches the next one or the run's end.
Fragments of a document and period are shuffled together and stitched; a stretch found under several periods has the smallest.

Tiles overlap and are solved alone, so those of a document need not be in one task: documents of more than `LONG` words are
exploded into rows of neighbouring tiles that are dealt to all tasks; the tiles of shorter ones are solved where the document
is read. A tile whose first eight words come back nowhere in its octave has no such boundary; windows' hashes tell that for all
tiles of a list of documents at once. Words are compared as whole words, by their number in the document, never by a hash.

Words are what bytes 0x20 and 0x09 to 0x0D leave. Defined cases: a null, empty or blank text has no words, no runs and the
digest of nothing; documents are told apart by doc_id and text, so equal rows, and rows that repeat a doc_id with another
text, each get their own result; a null doc_id is kept as null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, pieces, ship

SHORTEST, TIMES = 24, 3

# Boundaries of the shortest periods are as far apart; windows of as many words are hashed.
LEAST = 8

# Words of a document whose tiles are solved where it is read, and words between the first and last boundary of a row of tiles.
LONG = 1 << 16

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]
_SCHEMA = "doc_id long, a long, b long, text string, period long, start long, stop long"


def z_function(x: list[int]) -> list[int]:
    """For each place, how many items from there on equal those from the beginning on."""
    n = len(x)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def octaves(n: int) -> list[tuple[int, int, int]]:
    """(distance of boundaries, first period, last period) of all octaves that a document of n words has room for."""
    found, first = [], 1
    while n >= max(SHORTEST, TIMES * first):
        step = max(LEAST, first)
        last = 2 * step - 1 if first > 1 else LEAST - 1
        found.append((step, first, min(last, n // TIMES)))
        first = last + 1
    return found


def tile(words: list[int], boundary: int, step: int, first: int, last: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, stop): words start to stop - 1 equal those a period later, from a tile's boundary on for `step` or more."""
    right = words[boundary:boundary + 4 * step]
    z = z_function(right)
    before = words[max(0, boundary - step):boundary]
    around = words[max(0, boundary - step):boundary + 2 * step]
    m = len(before)
    backward = None
    for p in range(first, min(last, len(right) - 1) + 1):
        ahead = min(z[p], 2 * step)
        if ahead < step:
            continue
        if backward is None:
            backward = z_function([*before[::-1], -1, *around[::-1]])
        # The words before boundary + p, backwards.
        at = m + 1 + len(around) - (m + p)
        yield p, boundary - (backward[at] if m else 0), boundary + ahead


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Hash of the `LEAST` words from each place on; beyond the end there are zeros."""
    x = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    padded = np.append(x, np.zeros(LEAST, dtype=np.uint64))
    out = np.zeros(len(x), dtype=np.uint64)
    for i in range(LEAST):
        out = out * np.uint64(0xBF58476D1CE4E5B9) + padded[i:i + len(x)]
    return out


def live_boundaries(
    mixed: np.ndarray, at: np.ndarray, lengths: np.ndarray, step: int, first: int, last: int, chunk: int = 1 << 20
) -> np.ndarray:
    """Places of boundaries whose first words may come back `first` to `last` later; documents begin at `at`."""
    room = lengths - step - first
    fits = np.flatnonzero(room >= 0)
    counts = room[fits] // step + 1
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    boundaries = np.repeat(at[fits], counts) + inner * step
    periods, found = np.arange(first, last + 1), []
    for i in range(0, len(boundaries), max(1, chunk // len(periods))):
        some = boundaries[i:i + max(1, chunk // len(periods))]
        later = np.minimum(some[:, None] + periods, len(mixed) - 1)
        found.append(some[(mixed[later] == mixed[some][:, None]).any(1)])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def stitched(fragments: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Overlapping or touching fragments of a period as one."""
    out: list[tuple[int, int, int]] = []
    for p, a, b in sorted(fragments):
        if out and out[-1][0] == p and out[-1][2] >= a:
            out[-1] = (p, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((p, a, b))
    return out


def fragments(documents: list[np.ndarray], spans: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Stitched fragments of lists of word numbers, none empty, in the octaves asked for each."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not documents:
        return found
    lengths = np.array([len(x) for x in documents])
    at = np.cumsum(lengths) - lengths
    mixed = _mixed(np.concatenate(documents)) if lengths.sum() else np.zeros(0, dtype=np.uint64)
    by_step: dict[tuple[int, int], list[int]] = {}
    for d, asked in enumerate(spans):
        for step, first, _ in asked:
            by_step.setdefault((step, first), []).append(d)
    lists: dict[int, list[int]] = {}
    for (step, first), some in by_step.items():
        last = LEAST - 1 if first == 1 else 2 * step - 1
        chosen = np.array(some)
        live = live_boundaries(mixed, at[chosen], lengths[chosen], step, first, last)
        owner = np.searchsorted(at, live, side="right") - 1
        for place, d in zip(live.tolist(), owner.tolist()):
            if d not in lists:
                lists[d] = documents[d].tolist()
            found[d] += tile(lists[d], place - int(at[d]), step, first, last)
    return [stitched(x) if x else x for x in found]


def long_enough(period: int, start: int, stop: int) -> bool:
    return stop - start + period >= max(SHORTEST, TIMES * period)


def _numbers(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)


def _width(step: int, long: int) -> int:
    return max(long // step, 1) * step


def _rows_of_tiles(numbers: np.ndarray, long: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(step, first period, first boundary, words) of rows of neighbouring tiles; the words begin a step before that boundary."""
    n = len(numbers)
    for step, first, _ in octaves(n):
        width = _width(step, long)
        for begin in range(0, max(1, n - step - first + 1), width):
            yield step, first, begin, numbers[max(0, begin - step):begin + width + 3 * step]


def _found(docs: DataFrame, rewrite: Rewrite | None, long: int) -> tuple[DataFrame, DataFrame]:
    """Documents that have runs, or are long, with their text; and all fragments, as one written table read in two ways."""

    def read(batches):
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                ids, a, b, texts = (piece.column(c).to_pylist() for c in ("doc_id", "a", "b", "text"))
                words = [(t or "").encode().split() for t in texts]
                if rewrite is not None:
                    words = [rewrite(i, w) for i, w in zip(ids, words)]
                here = [i for i, w in enumerate(words) if SHORTEST <= len(w) <= long]
                numbers = [_numbers(words[i]) for i in here]
                found = fragments(numbers, [octaves(len(x)) for x in numbers])
                rows = []
                for i, some in zip(here, found):
                    some = [f for f in some if long_enough(*f)]
                    if some:
                        rows.append((ids[i], a[i], b[i], texts[i], None, None, None, None, None, None, None))
                        rows += [(ids[i], a[i], b[i], None, *f, None, None, None, None) for f in some]
                yield from _batches(rows)
                for i, w in enumerate(words):
                    if len(w) > long:
                        yield from _batches([(ids[i], a[i], b[i], texts[i], None, None, None, None, None, None, None)])
                        for step, first, begin, part in _rows_of_tiles(_numbers(w), long):
                            yield from _batches([(ids[i], a[i], b[i], None, None, None, None, step, first, begin, part)])

    keys = ["doc_id", "a", "b"]
    tiles = "step long, first long, begin long, words array<int>"
    types = [*[pa.int64()] * 3, pa.string(), *[pa.int64()] * 6, pa.list_(pa.int32())]
    names = ["doc_id", "a", "b", "text", "period", "start", "stop", "step", "first", "begin", "words"]

    def _batches(rows):
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

    def solve(batches):
        for batch in batches:
            for i in range(len(batch)):
                ids, a, b, step, first, begin = (batch.column(c)[i].as_py() for c in (*keys, "step", "first", "begin"))
                part = batch.column("words")[i].values.to_numpy().astype(np.int64)
                offset = step if begin else 0
                at = begin - offset
                last = LEAST - 1 if first == 1 else 2 * step - 1
                inner = part[offset:]
                mixed = _mixed(inner)
                live = live_boundaries(mixed, np.array([0]), np.array([len(inner)]), step, first, last)
                live = live[live < _width(step, long)]  # those behind are the next row's
                words = part.tolist() if len(live) else []
                some = [f for x in live.tolist() for f in tile(words, x + offset, step, first, last)]
                if some:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([v] * len(some), pa.int64()) for v in (ids, a, b)
                    ] + [pa.array([f[0] for f in some], pa.int64()), pa.array([f[1] + at for f in some], pa.int64()),
                         pa.array([f[2] + at for f in some], pa.int64())], ["doc_id", "a", "b", "period", "start", "stop"])

    keyed = docs.select("doc_id", F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b"), "text")
    table = cut(keyed.mapInArrow(read, f"{_SCHEMA}, {tiles}"))
    long_tiles = table.filter("words IS NOT NULL").select(*keys, "step", "first", "begin", "words").repartition(
        *keys, "step", "first", "begin"
    )
    solved = long_tiles.mapInArrow(solve, "doc_id long, a long, b long, period long, start long, stop long")
    short = table.filter("period IS NOT NULL").select(*keys, "period", "start", "stop")
    return table.filter("text IS NOT NULL").select(*keys, "text"), short.unionByName(solved)


def runs(found: DataFrame) -> DataFrame:
    """doc_id, a, b, runs (start, length, period by start and period) from fragments, stitched by document and period."""
    keys = ["doc_id", "a", "b"]
    by_period = Window.partitionBy(*keys, "period").orderBy("start", "stop")
    reached = F.max("stop").over(by_period.rowsBetween(Window.unboundedPreceding, -1))
    opened = found.distinct().withColumn("opens", F.coalesce(reached < F.col("start"), F.lit(True)).cast("int"))
    whole = (
        opened.withColumn("number", F.sum("opens").over(by_period.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "period", "number").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .withColumn("length", F.col("stop") - F.col("start") + F.col("period"))
        .filter(F.col("length") >= F.greatest(F.lit(SHORTEST), TIMES * F.col("period")))
    )
    smallest = whole.groupBy(*keys, "start", "length").agg(F.min("period").alias("period"))
    return smallest.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of every tenth document, by the hash of its id, repeated from some place on; others, and those without id, as they are."""
    n = len(words)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """Words outside of runs (start, length, period) and those of each run's first period, joined by blanks."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()] if len(kept) < len(words) else words)


def _longest(found: list[tuple[int, int, int]]) -> tuple[int | None, int | None, int | None, int | None]:
    """start, length, period and exponent in thousandths of the run with the greatest length by period."""
    best = None
    for start, length, period in found:  # by start and period, so the first of equals stays
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return (*best, 1000 * best[1] // best[2]) if best else (None, None, None, None)


_REPORT = [
    ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
]


def report(docs: DataFrame, rewrite: Rewrite | None = None, long: int = LONG) -> DataFrame:
    """One row per document: doc_id, number of runs, the run of greatest exponent, digests of all runs and of the kept words.

    `rewrite` may change a document's words before anything else is done.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with_text, found = _found(docs, rewrite, long)
    all_runs = runs(found)
    keys = ["doc_id", "a", "b"]
    texts = with_text.dropDuplicates(keys)
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    joined = texts.alias("l").join(all_runs.alias("r"), same).select(*[F.col(f"l.{k}") for k in keys], "text", "runs")

    def digest(batches):
        for batch in batches:
            ids, a, b, texts_, lists = (batch.column(c).to_pylist() for c in (*keys, "text", "runs"))
            rows = []
            for i, text, some in zip(ids, texts_, lists):
                words = text.encode().split()
                words = rewrite(i, words) if rewrite is not None else words
                some = [(r["start"], r["length"], r["period"]) for r in some]
                lines = "".join([f"{x},{y},{z}\n" for x, y, z in some])
                rows.append((
                    len(some), *_longest(some), hashlib.sha256(lines.encode()).hexdigest(),
                    hashlib.sha256(collapsed(words, some)).hexdigest(),
                ))
            made = [pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(_REPORT)]
            head = [pa.array(x, pa.int64()) for x in (ids, a, b)]
            yield pa.RecordBatch.from_arrays(head + made, [*keys, *[n for n, _ in _REPORT]])

    fields = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in _REPORT)
    of_text = joined.mapInArrow(digest, f"doc_id long, a long, b long, {fields}")

    def plain(batches):
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                ids = piece.column("doc_id").to_pylist()
                words = [(t or "").encode().split() for t in piece.column("text").to_pylist()]
                if rewrite is not None:
                    words = [rewrite(i, w) for i, w in zip(ids, words)]
                digests = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("a"), piece.column("b"), pa.array(digests)], [*keys, "plain"]
                )

    keyed = docs.select("doc_id", F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b"), "text")
    every = keyed.mapInArrow(plain, "doc_id long, a long, b long, plain string")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    out = every.alias("l").join(of_text.alias("r"), same, "left")
    nothing = F.sha2(F.lit(""), 256)
    return out.select(
        F.col("l.doc_id").alias("doc_id"), F.coalesce("n_runs", F.lit(0)).alias("n_runs"), "start", "length", "period",
        "exponent_milli", F.coalesce("runs_sha256", nothing).alias("runs_sha256"),
        F.coalesce("collapsed_sha256", "plain").alias("collapsed_sha256"),
    )
