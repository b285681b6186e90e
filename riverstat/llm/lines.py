"""Lines that many documents share are dropped; documents can be added to and taken out of the index again.

The index has two tables of one shard number. `counts` holds, for every line key of the documents in the index, how many of
them hold it: it is exact, and adding or removing documents adds to or subtracts from it. `filters` holds for each
shard a cuckoo filter of its shared keys (those held by at least `least` documents) and the exceptions: other keys of
the shard that the filter would take for shared. Every line of an indexed document is in `counts`, so filter and exceptions
answer exactly, in a few bytes per shared key, and keys can leave the filter again. When documents come or go, only keys
that pass the limit are inserted or deleted, and only in the shards that hold such keys.

A line's key is the line without ASCII white space at both ends and with A-Z in lower case, held as a 128-bit hash. Keys of
fewer than `shortest` code points are never shared. Lines end at line feeds; null or empty text is one empty line.

Dropping asks the filters at any size. Those of at most `SEND` bytes in all go to every task, and texts are read once. Larger
ones stay where they are: the distinct hashes of all lines go to the tasks that hold their shards' filters, and texts get
their keys to drop by a join on their hash.

Defined cases: a document is a row, so equal rows count as often as they occur; doc_id plays no part; empty tables give empty
tables; a document that loses all lines keeps an empty text; other columns are kept.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, free, pieces, ship, with_struct

LEAST = 10
SHORTEST = 1
SHARD_KEYS = 100_000  # keys of `counts` in a shard
SEND = 32 << 20  # bytes of filters that tasks may get

_SPACE = b" \t\n\v\f\r"
_HASHES = np.dtype([("a", "<i8"), ("b", "<i8")])


class CuckooFilter:
    """Holds 16-bit fingerprints of keys (pairs of 64-bit hashes), four to a bucket; a key has two buckets.

    A key's second bucket follows from the first and the fingerprint, so entries can move between their two buckets
    and be deleted without their keys. A key that is inserted n times must be deleted n times.
    """

    SLOTS = 4

    def __init__(self, table: np.ndarray) -> None:
        self.table = table  # (a power of two, SLOTS); 0 is free

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> CuckooFilter:
        """A filter of these keys, as large as they need."""
        buckets = 1
        while buckets * cls.SLOTS * 0.9 < len(a):
            buckets *= 2
        while True:
            made = cls(np.zeros((buckets, cls.SLOTS), dtype=np.uint16))
            if made.insert(a, b):
                return made
            buckets *= 2

    def _spots(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = ((b.astype(np.uint64) >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.int64)
        first = a.astype(np.int64) & (len(self.table) - 1)
        return mark, first, first ^ self._step(mark)

    def _step(self, mark):
        return (mark * 0x5BD1E995 >> 7) & (len(self.table) - 1)

    def insert(self, a: np.ndarray, b: np.ndarray) -> bool:
        """False if the table has become too full; it is then of no use."""
        table = self.table
        for mark, first, second in zip(*(x.tolist() for x in self._spots(a, b))):
            at = first
            for bucket in (first, second):
                free = np.flatnonzero(table[bucket] == 0)
                if len(free):
                    table[bucket, free[0]] = mark
                    break
            else:
                for kick in range(500):
                    slot = (mark + kick) % self.SLOTS
                    mark, table[at, slot] = int(table[at, slot]), mark
                    at ^= int(self._step(mark))
                    free = np.flatnonzero(table[at] == 0)
                    if len(free):
                        table[at, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, a: np.ndarray, b: np.ndarray) -> None:
        for mark, first, second in zip(*(x.tolist() for x in self._spots(a, b))):
            for bucket in (first, second):
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break
            else:
                raise KeyError("a key that was never inserted cannot be deleted")

    def contains(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mark, first, second = self._spots(a, b)
        mark = mark[:, None].astype(np.uint16)
        return (self.table[first] == mark).any(1) | (self.table[second] == mark).any(1)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, dtype=np.uint16).reshape(-1, cls.SLOTS).copy())


def _key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()  # of bytes, lower() and strip() change ASCII only


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _long_enough(key: bytes, shortest: int) -> bool:
    return len(key) >= shortest and (shortest <= 1 or len(key.decode()) >= shortest)


@dataclass(frozen=True)
class LineIndex:
    """counts: shard, a, b, n. filters: shard, filter, exceptions. Both stay in the shared folder."""

    counts: DataFrame
    filters: DataFrame
    shards: int
    least: int
    shortest: int


def line_counts(docs: DataFrame, column: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """In how many rows each line key occurs: a, b (the halves of its hash), n. Counted in each task before the shuffle."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", 8 << 20):
                met: Counter[bytes] = Counter()
                for text in piece.column("text").to_pylist():
                    met.update({_key(x) for x in (text or "").encode().split(b"\n")})
                keys = [(_hash(k), n) for k, n in met.items() if _long_enough(k, shortest)]
                hashes = np.frombuffer(b"".join([h for h, _ in keys]), _HASHES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes["a"].copy()), pa.array(hashes["b"].copy()), pa.array([n for _, n in keys], pa.int64())],
                    ["a", "b", "n"],
                )

    found = docs.select(F.col(column).alias("text")).mapInArrow(run, "a long, b long, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _exceptions(table: CuckooFilter, pdf: pd.DataFrame, shared: np.ndarray) -> bytes:
    """Keys that the filter takes for shared but that are not."""
    others = pdf[~shared]
    wrong = others[table.contains(others["a"].to_numpy(), others["b"].to_numpy())]
    return np.rec.fromarrays([wrong["a"].to_numpy(), wrong["b"].to_numpy()], dtype=_HASHES).tobytes()


def _filters(counts: DataFrame, least: int) -> DataFrame:
    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shared = (pdf["n"] >= least).to_numpy()
        table = CuckooFilter.of(pdf["a"].to_numpy()[shared], pdf["b"].to_numpy()[shared])
        return pd.DataFrame({"shard": [key[0]], "filter": [table.to_bytes()], "exceptions": [_exceptions(table, pdf, shared)]})

    return counts.groupBy("shard").applyInPandas(build, "shard long, filter binary, exceptions binary")


def build(docs: DataFrame, column: str = "text", least: int = LEAST, shortest: int = SHORTEST,
          shard_keys: int = SHARD_KEYS) -> LineIndex:
    """Index of all documents."""
    counts = cut(line_counts(docs, column, shortest))
    shards = max(1, -(-counts.count() // shard_keys))
    counts = counts.select(F.pmod(F.shiftright("a", 20), F.lit(shards)).alias("shard"), "a", "b", "n")
    return LineIndex(counts, cut(_filters(counts, least)), shards, least, shortest)


def _changed(index: LineIndex, docs: DataFrame, column: str, sign: int) -> LineIndex:
    change = line_counts(docs, column, index.shortest).select(
        F.pmod(F.shiftright("a", 20), F.lit(index.shards)).alias("shard"), "a", "b", F.lit(0).cast("long").alias("n"),
        (sign * F.col("n")).alias("by"),
    )
    old = index.counts.withColumn("by", F.lit(0).cast("long"))
    both = cut(old.unionByName(change).groupBy("shard", "a", "b").agg(F.sum("n").alias("n"), F.sum("by").alias("by")))
    now = F.col("n") + F.col("by")
    if both.filter(now < 0).limit(1).count():
        raise ValueError("documents were removed that the index does not hold")
    passing = (F.col("n") >= index.least) != (now >= index.least)
    touched = both.filter(F.col("by") != 0).select("shard").distinct()
    least = index.least

    def renew(key: tuple, keys: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        shared = (keys["now"] >= least).to_numpy()
        a, b = keys["a"].to_numpy(), keys["b"].to_numpy()
        up, down = (keys["passing"] & shared).to_numpy(), (keys["passing"] & ~shared).to_numpy()
        table = CuckooFilter.from_bytes(held["filter"].iloc[0]) if len(held) else None
        if table is not None:
            table.delete(a[down], b[down])
        if table is None or not table.insert(a[up], b[up]):
            table = CuckooFilter.of(a[shared], b[shared])
        return pd.DataFrame({"shard": [key[0]], "filter": [table.to_bytes()], "exceptions": [_exceptions(table, keys, shared)]})

    keys = both.join(touched, "shard", "left_semi").select("shard", "a", "b", now.alias("now"), passing.alias("passing"))
    renewed = keys.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInPandas(
        lambda key, left, right: renew(key, left, right) if len(left) else right, index.filters.schema
    )
    counts = both.select("shard", "a", "b", now.alias("n")).filter("n > 0")
    return LineIndex(counts, cut(renewed), index.shards, index.least, index.shortest)


def insert(index: LineIndex, docs: DataFrame, column: str = "text") -> LineIndex:
    """The index with these documents too."""
    return _changed(index, docs, column, 1)


def delete(index: LineIndex, docs: DataFrame, column: str = "text") -> LineIndex:
    """The index without these documents, which it must hold."""
    return _changed(index, docs, column, -1)


_FIELDS = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
])


def _kept(texts: list[str | None], shared) -> list[pa.Array]:
    """Texts without the lines whose keys are shared, and the numbers of lines."""
    out, lines, dropped = [], [], []
    for text in texts:
        all_lines = (text or "").encode().split(b"\n")
        keys = [_key(x) for x in all_lines]
        gone = shared(set(keys))
        stay = [x for x, k in zip(all_lines, keys) if k not in gone] if gone else all_lines
        out.append(b"\n".join(stay).decode())
        lines.append(len(all_lines))
        dropped.append(len(all_lines) - len(stay))
    return [pa.array(out, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]


def drop_shared(index: LineIndex, docs: DataFrame, column: str = "text", into: str = "lines", send: int = SEND) -> DataFrame:
    """Add a struct of `text` (the lines that stay), `n_lines` and `n_dropped`. Documents must be in the index."""
    size = index.filters.agg(F.sum(F.octet_length("filter") + F.octet_length("exceptions"))).first()[0] or 0
    return _by_filters(index, docs, column, into) if size <= send else _by_join(index, docs, column, into)


def _by_filters(index: LineIndex, docs: DataFrame, column: str, into: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(
        {r["shard"]: (r["filter"], r["exceptions"]) for r in index.filters.collect()}  # at most `send` bytes
    )
    shards, shortest = index.shards, index.shortest

    def start():
        tables = {s: CuckooFilter.from_bytes(raw) for s, (raw, _) in sent.value.items()}
        wrong = {w[i:i + 16] for _, w in sent.value.values() for i in range(0, len(w), 16)}

        def compute(texts):
            keys = list({k for t in texts for k in map(_key, (t or "").encode().split(b"\n")) if _long_enough(k, shortest)})
            raw = [_hash(k) for k in keys]
            hashes = np.frombuffer(b"".join(raw), _HASHES)
            shard = (hashes["a"] >> 20) % shards
            hit = np.zeros(len(keys), dtype=bool)
            order = np.argsort(shard, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                if len(part) and int(shard[part[0]]) in tables:
                    hit[part] = tables[int(shard[part[0]])].contains(hashes["a"][part], hashes["b"][part])
            shared = {keys[i] for i in np.flatnonzero(hit).tolist() if raw[i] not in wrong}
            return _kept(texts, shared.intersection)

        return compute

    return with_struct(docs, column, into, _FIELDS, start, 8 << 20)


def _by_join(index: LineIndex, docs: DataFrame, column: str, into: str) -> DataFrame:
    """For filters too large to send: equal texts have equal lines to drop, so these are found once a text's hash."""
    ship(docs.sparkSession)
    shortest = index.shortest
    names = [c for c in docs.columns if c != into]
    text = F.coalesce(F.col(column), F.lit(""))
    t_name, u_name, work_name = (free(docs, name) for name in ("_t", "_u", "_work"))
    keyed = docs.select(*names, F.xxhash64(text).alias(t_name), F.xxhash64(text, F.lit(1)).alias(u_name))

    def lines(batches):
        for batch in batches:
            for piece in pieces(batch, "text", 8 << 20):
                t, u = piece.column("t").to_numpy(), piece.column("u").to_numpy()
                hashes = [
                    [_hash(k) for k in {_key(x) for x in (s or "").encode().split(b"\n")} if _long_enough(k, shortest)]
                    for s in piece.column("text").to_pylist()
                ]
                n = [len(x) for x in hashes]
                flat = np.frombuffer(b"".join([h for x in hashes for h in x]), _HASHES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(t, n)), pa.array(np.repeat(u, n)), pa.array(flat["a"].copy()), pa.array(flat["b"].copy())],
                    ["t", "u", "a", "b"],
                )

    def ask(keys: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """The shard's keys that its filter holds and its exceptions do not name."""
        if not len(held) or not len(keys):
            return keys[["a", "b"]].iloc[:0]
        hit = CuckooFilter.from_bytes(held["filter"].iloc[0]).contains(keys["a"].to_numpy(), keys["b"].to_numpy())
        raw = held["exceptions"].iloc[0]
        wrong = pd.MultiIndex.from_arrays([np.frombuffer(raw, _HASHES)["a"], np.frombuffer(raw, _HASHES)["b"]])
        return keys.loc[hit & ~pd.MultiIndex.from_frame(keys[["a", "b"]]).isin(wrong), ["a", "b"]]

    texts = keyed.select(F.col(t_name).alias("t"), F.col(u_name).alias("u"), F.col(column).alias("text"))
    found = texts.mapInArrow(lines, "t long, u long, a long, b long")
    shard = F.pmod(F.shiftright("a", 20), F.lit(index.shards)).alias("shard")
    asked = found.select("a", "b").distinct().select(shard, "a", "b")  # at most the shard's keys of `counts`
    shared = asked.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInPandas(ask, "a long, b long")
    hits = found.join(shared, ["a", "b"], "left_semi").distinct()
    packed = F.concat(F.hex("a"), F.lit("/"), F.hex("b"))
    drops = cut(hits.groupBy("t", "u").agg(F.collect_set(packed).alias("_drop")))  # one text's lines
    same = (F.col(t_name) == F.col("r.t")) & (F.col(u_name) == F.col("r.u"))
    joined = keyed.join(drops.alias("r"), same, "left").select(
        *(keyed[n] for n in names), F.to_json(F.struct(F.col("r._drop").alias("drop"), keyed[column].alias("text"))).alias(work_name)
    )

    def start():
        import json

        def compute(works):
            made = []
            for work in map(json.loads, works):
                drop = set(work.get("drop", ()))

                def shared_of(keys, drop=drop):
                    if not drop:
                        return set()
                    h = {k: np.frombuffer(_hash(k), "<u8") for k in keys if _long_enough(k, shortest)}
                    return {k for k, (a, b) in h.items() if f"{a:X}/{b:X}" in drop}

                made.append(_kept([work.get("text")], shared_of))
            if not made:
                return [pa.array([], f) for f in (pa.string(), pa.int64(), pa.int64())]
            return [pa.concat_arrays(x) for x in zip(*made)]

        return compute

    return with_struct(joined, work_name, into, _FIELDS, start, 8 << 20).select(*names, into)
