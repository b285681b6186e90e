"""Near-duplicate documents by min-max hashing.

A document's set holds its distinct word shingles as 64-bit hashes. Under each of 120 random orders of all hashes both the
smallest and the largest member of the set are kept: two values for one evaluation, each equal in two documents with a
probability that is their similarity. Six minima, or six maxima, of different orders make a band; documents that agree in one
of the 40 bands are candidates. Two documents of similarity 0.8 miss all bands with probability 5e-6; unrelated documents
hardly ever agree in one.

Equal sets are one class with the smallest doc_id as its representative, so copies never meet in pairs. Candidates are
confirmed on the full sets, and components of the links need not know all pairs. First each bucket's members are compared
with one of them. Buckets of three or more members that still hold several components go on: what hangs together by them is a
cluster, and the sets of a cluster's members are compared in tasks, by blocks of at most `BLOCK` members against each other.
A task compares all members of different components and returns one row for each member that it could link, not pairs. So
every candidate pair is compared unless it is known to be in one component already, and no bucket is capped.

Words are the runs of other characters than ASCII white space, with A-Z in lower case; fewer words than a shingle has are one
shingle. Defined cases: documents without words (null and empty text too) link with nothing and are kept; so do rows
without doc_id, whose component_id is null; an empty table gives no rows; other columns are ignored. `near_duplicates` takes
doc_ids as unique, but for rows that repeat a doc_id with the same text: other texts of one doc_id may be linked through it.
`one_of_each` needs no unique doc_ids: it numbers the rows and links and drops by that number.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, cut, free, pieces, shared_folder, ship
from .components import components

ORDERS, ROWS = 120, 6
SEND = 1_000_000  # ids that tasks may get
BLOCK = 512  # members of a cluster in a block

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of hashed shingles of texts; remembers the hashes of words."""

    def __init__(self, words: int, remembered: int = 200_000) -> None:
        self._words, self._memo = words, Memo(remembered)

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct hashes of each text's shingles."""
        cut = [(t or "").encode().lower().split() for t in texts]  # of bytes: ASCII letters and white space only
        new = self._memo.unknown(set().union(*map(set, cut)))
        self._memo.add(new, map(xxhash.xxh3_64_intdigest, new))
        of = self._memo.of
        out = []
        for words in cut:
            h = np.fromiter(map(of, words), np.uint64, len(words))
            size = min(self._words, len(h)) or 1
            made = np.full(max(0, len(h) - size + 1), np.uint64(size))
            for place in range(size if len(h) else 0):
                made = _mixed(made * _ODD + h[place:place + len(made)])
            out.append(np.unique(made))
        return out


class MinMax:
    """Bands of minima and maxima of sets."""

    def __init__(self, orders: int = ORDERS, rows: int = ROWS, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self._flip = rng.integers(0, 1 << 64, (orders, 1), dtype=np.uint64)
        self._times = rng.integers(0, 1 << 64, (orders, 1), dtype=np.uint64) | np.uint64(1)
        self._rows = rows

    def bands(self, members: np.ndarray) -> np.ndarray:
        """Hashes of the bands of minima, then those of maxima."""
        low = high = None
        for at in range(0, len(members), 2048):
            ranks = (members[None, at:at + 2048] ^ self._flip) * self._times
            ranks ^= ranks >> np.uint64(32)
            least, most = ranks.min(1), ranks.max(1)
            low = least if low is None else np.minimum(low, least)
            high = most if high is None else np.maximum(high, most)
        values = np.concatenate([low, high]).reshape(-1, self._rows)
        key = np.arange(len(values), dtype=np.uint64) + np.uint64(1)
        for row in range(self._rows):
            key = _mixed(key * _ODD + values[:, row])
        return key.astype(np.int64)


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, a and b (128-bit hash of the set), bands (null for empty sets)."""

    def run(batches):
        shingles, minmax = Shingles(words), MinMax()
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                sets = shingles.of(piece.column("text").to_pylist())
                keys = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x.tobytes()) for x in sets]), "<i8").reshape(-1, 2)
                bands = [minmax.bands(x) if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys[:, 0].copy()),
                    pa.array(keys[:, 1].copy()), pa.array(bands, pa.list_(pa.int64())),
                ], ["doc_id", "n", "a", "b", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, a long, b long, bands array<long>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches):
        shingles = Shingles(words)
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                sets = [x.astype(np.int64) for x in shingles.of(piece.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["id", "members"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "id long, members array<long>")


def _of_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of docs by ids in `ids` (one column, doc_id), which are sent to all tasks if they are few."""
    few = ids.count() <= SEND
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", how)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs x, y (with set sizes nx, ny) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("x"), F.col("members").alias("mx"))
    right = sets.select(F.col("id").alias("y"), F.col("members").alias("my"))
    common = F.size(F.array_intersect("mx", "my"))
    joined = pairs.join(left, "x").join(right, "y").withColumn("common", common)
    return joined.filter(100 * F.col("common") >= percent * (F.col("nx") + F.col("ny") - F.col("common"))).select("x", "y")


def _members(entries: DataFrame) -> DataFrame:
    """Entries (bucket, rep, n) of buckets that have more, each with its bucket's smallest member and number of members.

    The entries, the most rows of all, are dealt by their bucket once; what is asked of a bucket is answered in place.
    """
    bucket = Window.partitionBy("bucket")
    least = F.min(F.struct("rep", "n")).over(bucket)
    return entries.withColumns({"least": least, "held": F.count(F.lit(1)).over(bucket)}).filter("held > 1").select(
        "bucket", "rep", "n", F.col("least.rep").alias("pivot"), F.col("least.n").alias("pn"), "held"
    )


def _pairs(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs x, y of a bucket's smallest member and another (with set sizes nx, ny) that may be similar by size."""
    sized = members.filter((F.col("rep") != F.col("pivot")) & (100 * F.least("n", "pn") >= percent * F.greatest("n", "pn")))
    return sized.select(
        F.col("pivot").alias("x"), F.col("rep").alias("y"), F.col("pn").alias("nx"), F.col("n").alias("ny")
    ).dropDuplicates(["x", "y"])


def _candidates(entries: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs to confirm, and the members (bucket, rep) of buckets of three or more."""
    members = _members(entries).persist(StorageLevel.MEMORY_AND_DISK)
    found = cut(_pairs(members, percent)), cut(members.filter("held > 2").select("bucket", "rep"))
    members.unpersist()
    return found


def _similar(sets: list[np.ndarray], rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of `rows` and of all sets) that are similar enough, by products of 0/1 matrices."""
    size = np.array([len(x) for x in sets])
    row, flat = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1  # others are in no intersection
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(rows), len(sets)))
    for at in range(0, int((count > 1).sum()), 8192):
        part = slice(*np.searchsorted(column, [at, at + 8192]))
        held = np.zeros((len(sets), 8192), dtype=np.float32)
        held[row[part], column[part] - at] = 1
        common += held[rows] @ held.T
    i, j = np.nonzero(100 * common >= percent * (size[rows][:, None] + size[None, :] - common))
    return rows[i], j


def _in_clusters(members: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links x, y between different components that share a bucket, as far as components need them.

    `members` are those of buckets of three or more: two members have been compared.
    """
    now = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component")
    )
    several = now.groupBy("bucket").agg(
        F.min("component").alias("c"), F.max("component").alias("d"), F.min("rep").alias("first")
    ).filter("c < d").select("bucket", "first")
    now = cut(now.join(cut(several), "bucket"))
    if now.isEmpty():
        return None
    clusters = components(now, "first", "rep").withColumnsRenamed({"node": "rep", "component": "cluster"})
    labelled = cut(now.select("rep", "component").distinct().join(clusters, "rep"))
    blocks = labelled.groupBy("cluster").agg(F.expr(f"CAST(ceil(count(1) / {BLOCK}) AS INT)").alias("blocks"))
    parted = labelled.join(blocks, "cluster").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    wanted = _of_ids(sets.withColumnRenamed("id", "doc_id"), labelled.select(F.col("rep").alias("doc_id")), "left_semi")
    work = parted.withColumn("other", other).select(
        "cluster", "rep", "component", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")
    ).join(wanted.withColumnRenamed("doc_id", "rep"), "rep")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        rep, label = pdf["rep"].to_numpy(), pdf["component"].to_numpy()
        labels, count = np.unique(label, return_counts=True)
        rows = np.flatnonzero(label != labels[count.argmax()])  # one of any two that differ is here
        if not len(rows):
            return pd.DataFrame({"x": [], "y": []}, dtype="int64")
        i, j = _similar(list(pdf["members"]), rows, percent)
        # Components in the block, from those that are known: one link a member suffices.
        root = label.copy()
        while True:
            least = np.minimum(root[i], root[j])
            top = dict(zip(labels.tolist(), labels.tolist()))
            for name, to in zip(np.append(label[i], label[j]).tolist(), np.append(least, least).tolist()):
                top[name] = min(top[name], to)
            new = np.minimum(root, np.array([top[x] for x in label.tolist()]))
            if (new == root).all():
                break
            root = new
        moved = root != label
        return pd.DataFrame({"x": root[moved], "y": rep[moved]}).astype("int64")

    more = cut(work.groupBy("cluster", "lo", "hi").applyInPandas(compare, "x long, y long"))
    return None if more.isEmpty() else more


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents whose sets have a similarity of `percent` or more are linked."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    signed = cut(_signatures(docs, words))
    classes = signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("a", "b")
    rep = F.min("doc_id").alias("rep")
    entries = classes.agg(rep, F.any_value("n").alias("n"), F.any_value("bands").alias("bands")).select(
        "rep", "n", F.explode("bands").alias("bucket")
    )
    pairs, crowded = _candidates(entries, percent)
    ids = pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).unionByName(crowded.select(F.col("rep").alias("doc_id")))
    sets = cut(_sets(_of_ids(docs, ids.distinct(), "left_semi"), words))

    links = cut(_confirmed(pairs, sets, percent))
    found = components(links, "x", "y")
    more = _in_clusters(crowded, found, sets, percent)
    if more is not None:
        found = components(links.unionByName(more), "x", "y")

    of_class = cut(
        classes.agg(rep).join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select("a", "b", F.coalesce("component", "rep").alias("component_id"))
    )
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    return signed.drop("bands").join(of_class, ["a", "b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that are near duplicates of a kept one; one row of each group stays, of its smallest doc_id.

    Rows get a number in a written table, so reading them again cannot change it.
    """
    path = f"{shared_folder(docs.sparkSession)}/numbered-{uuid.uuid4().hex}"
    row, component = free(docs, "_row"), free(docs, "_component")
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    known = rows.filter("doc_id IS NOT NULL").select(F.col(row).alias("doc_id"), "text")
    found = near_duplicates(known, words, percent).select(
        F.col("doc_id").alias(row), F.col("component_id").alias(component), "kept"
    )
    groups = found.filter(~F.col("kept")).select(component).distinct()
    members = cut(found.select(row, component).join(groups, component, "left_semi"))
    few = members.count() <= SEND
    members = rows.select(row, "doc_id").join(F.broadcast(members) if few else members, row)
    first = members.groupBy(component).agg(F.min(F.struct("doc_id", row)).alias("first"))
    dropped = members.join(first, component).filter(F.col(row) != F.col("first")[row]).select(row)
    dropped = cut(dropped)
    return rows.join(F.broadcast(dropped) if few else dropped, row, "left_anti").select(docs.columns)
