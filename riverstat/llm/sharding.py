"""A uniform shuffle into shards of exact sizes, by drawing first how many rows go from where to where.

Rows are dealt by a random 64-bit number into `PARTS` parts. How many rows of each part every shard gets is drawn on its
own: the matrix of parts by shards, whose sums are the parts' and the shards' sizes, follows the multivariate
hypergeometric law that a uniform shuffle of all rows would give it. Each part is then permuted by itself and cut as its row
of the matrix says, and each shard permutes what it has received. All permutations are orders by random numbers.

Parts and shards are never ordered as a whole: their rows are dealt into buckets by the leading bits of the same random
numbers, buckets are ordered in tasks of about `BUCKET` rows, and a bucket's first place is the sum of the counts before it.
The matrix has PARTS * shards numbers whatever the input; the driver sees it and the sizes of the parts, and never a row.

The random numbers are hashes of a row number that is written to the shared folder with the slim rows (no texts), so jobs and
retried tasks see the same. The law is `rows`: shard sizes differ by one at most, the first shards being the larger ones.

Defined cases: equal rows and rows without doc_id are rows like others; null text has no bytes; an empty table gives no rows;
other columns are ignored. Main path: DataFrame functions only.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

PARTS = 64
BUCKET = 50_000
OVERHEAD = 16  # bytes that a row counts besides its text


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of `drawn` are good. Inverts the distribution function over 14 deviations around the mode."""
    total = good + bad
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    deviation = (drawn * (good / total) * (bad / total) * (total - drawn) / max(1, total - 1)) ** 0.5
    reach = int(14 * deviation) + 40
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    rise = np.log(good - k[:-1]) + np.log(drawn - k[:-1]) - np.log(k[:-1] + 1) - np.log(bad - drawn + k[:-1] + 1)
    log = np.append(0.0, np.cumsum(rise))
    share = np.cumsum(np.exp(log - log.max()))
    return int(k[min(len(k) - 1, np.searchsorted(share, rng.random() * share[-1], side="right"))])


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows from each part to each shard, as a uniform shuffle of all rows would deal them."""
    rng = np.random.default_rng(seed)
    left = list(shards)
    matrix = []
    for size in parts:
        row, open_slots = [], sum(left)
        for s, slots in enumerate(left):
            n = hypergeometric(rng, slots, open_slots - slots, size) if size else 0
            row.append(n)
            size -= n
            open_slots -= slots
            left[s] -= n
        matrix.append(row)
    return matrix


def _placed(rows: DataFrame, group: str, number: str, into: str, buckets: int) -> DataFrame:
    """Place of each row (from 0) in its group, in the order of a random number; no task orders more than a bucket."""
    rows = rows.withColumn("_bucket", F.shiftrightunsigned(number, 1) % F.lit(buckets))
    sizes = rows.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(group, "_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_bucket").orderBy(number, "_row")
    return (
        rows.withColumn("_at", F.row_number().over(inside) - 1)
        .join(before, [group, "_bucket"])
        .withColumn(into, F.col("_before") + F.col("_at"))
        .drop("_bucket", "_before", "_at")
    )


def shuffle_into_shards(
    df: DataFrame, shards: int, seed: int = 0, parts: int = PARTS, bucket: int = BUCKET
) -> DataFrame:
    """Add `shard` (int, 0 to shards - 1) and `slot` (long, gapless from 0) to slim rows; two columns of those names are replaced."""
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    rows = df.select(*kept, F.monotonically_increasing_id().alias("_row"))
    rows = cut(rows.withColumns({"_to": F.xxhash64("_row", F.lit(seed)), "_in": F.xxhash64("_row", F.lit(seed + 1))}))
    rows = rows.withColumn("_part", F.pmod(F.shiftright("_to", 40), F.lit(parts)).cast("int"))
    sizes = {r["_part"]: r["n"] for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [sizes.get(p, 0) for p in range(parts)]
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix(counts, room, seed)
    ends = json.dumps([np.cumsum(row).tolist() for row in matrix])

    placed = _placed(rows, "_part", "_to", "_place", max(1, -(-total // (parts * bucket))))
    cuts = F.from_json(F.lit(ends), "array<array<bigint>>")  # parts * shards numbers, whatever the input
    # The part's row of the matrix: the first shard whose end lies behind the place.
    shard = F.size(F.filter(F.element_at(cuts, F.col("_part") + 1), lambda end: end <= F.col("_place")))
    sent = placed.withColumn("shard", shard.cast("int")).drop("_part", "_to", "_place")
    settled = _placed(sent, "shard", "_in", "slot", max(1, -(-total // (shards * bucket))))
    return settled.select(*kept, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law `rows` says nothing of more shards)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shuffle_into_shards(slim, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
