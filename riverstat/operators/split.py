"""Number output files so that none cuts a group."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .ordering import place_in_slices, running_total

# The task code below travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of input that one block of groups covers (a block holds at most this many groups), and blocks merged at once.
BLOCK_ROWS = 1_000_000
FAN = 32

_EXITS = "block long, entry long, need long, files long"
_ENTERED = "block long, need long, files long"


def _one_per_exit(exits: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring entries with the same exit become one: the last, since the walk takes the first it reaches."""
    same = (exits["need"] == exits["need"].shift(-1)) & (exits["files"] == exits["files"].shift(-1))
    return exits[~same]


def _follow(need: np.ndarray, files: np.ndarray, block: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Walk through a block: from `need`, the first position where the next file may begin, to the one behind it."""
    at = np.searchsorted(block["entry"].to_numpy(), need)
    inside = at < len(block)
    at = np.minimum(at, len(block) - 1)
    return (
        np.where(inside, block["need"].to_numpy()[at], need),
        files + np.where(inside, block["files"].to_numpy()[at], 0),
    )


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Exits of several consecutive blocks taken as one."""
    blocks = [b for _, b in pdf.sort_values(["block", "entry"]).groupby("block")]
    entry, need, files = (blocks[0][c].to_numpy() for c in ("entry", "need", "files"))
    for block in blocks[1:]:
        need, files = _follow(need, files, block)
    if len(blocks) > 1:  # the walk may also come in behind the last group of the first block
        first = blocks[1].iloc[:1]
        late_need, late_files = first["need"].to_numpy(), first["files"].to_numpy()
        for block in blocks[2:]:
            late_need, late_files = _follow(late_need, late_files, block)
        entry = np.append(entry, first["entry"])
        need, files = np.append(need, late_need), np.append(files, late_files)
    return _one_per_exit(
        pd.DataFrame({"block": pdf["parent"].iloc[0], "entry": entry, "need": need, "files": files})
    )


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """State of the walk in front of each of the blocks, from the state in front of the first."""
    need, files = pdf["need_before"].to_numpy()[:1], pdf["files_before"].to_numpy()[:1]
    states = []
    for number, block in pdf.sort_values(["block", "entry"]).groupby("block"):
        states.append((number, need[0], files[0]))
        need, files = _follow(need, files, block)
    return pd.DataFrame(states, columns=["block", "need", "files"])


def _enter(exits: DataFrame, blocks: int, fan: int) -> DataFrame:
    """State of the walk in front of every block: merge upwards until few blocks are left, then walk back down."""
    if blocks <= fan:
        start = {"parent": F.lit(0), "need_before": F.lit(0), "files_before": F.lit(0)}
        grouped = exits.withColumns({name: zero.cast("long") for name, zero in start.items()})
    else:
        exits = exits.withColumn("parent", F.expr(f"block div {fan}L")).checkpoint()
        above = _enter(exits.groupBy("parent").applyInPandas(_merge, _EXITS), blocks // fan + 1, fan)
        grouped = exits.join(
            above.withColumnsRenamed({"block": "parent", "need": "need_before", "files": "files_before"}), "parent"
        )
    return grouped.groupBy("parent").applyInPandas(_walk, _ENTERED)


def file_numbers(
    df: DataFrame, key: str, size: int, block_rows: int = BLOCK_ROWS, fan: int = FAN
) -> DataFrame:
    """File number of every key: groups in key order fill a file until it has more than `size` rows.

    A file that begins `b` rows into the order is followed by the one at the first group that begins at or after
    `b + size + 1`. That walk is sequential, but only through one number. So the groups are cut into blocks of the
    order, and each block works out, in its own task, where the walk leaves it for every place it may enter it: these
    lie in its first `size + 1` rows, and places with the same exit are merged. Blocks are merged in the same way, `fan` at a time,
    until `fan` are left; from there the walk's state is handed back down and the blocks number their groups. A task
    holds one block of groups or the exits of `fan` blocks. Only counts per key are handled here, never the rows.
    """
    span = size + 1
    width = span * max(1, block_rows // span)
    keys = df.select(F.col(key).alias("group_key")).filter(F.col("group_key").isNotNull())
    counts = keys.groupBy("group_key").agg(F.count(F.lit(1)).alias("n"))
    placed = place_in_slices(counts, ["group_key"])
    rows = keys.count()
    groups = (
        running_total(placed, ["group_key"], "n")
        .select("group_key", (F.col("running") - F.col("n")).alias("begin"))
        .withColumn("block", F.expr(f"begin div {width}L"))
        .filter(F.col("block").isNotNull())  # as the join below asks for, so that both uses share one exchange
    )

    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        begin = np.sort(pdf["begin"].to_numpy())
        block = int(pdf["block"].iloc[0])
        following = np.searchsorted(begin, begin + span)
        entries = np.arange(min(np.searchsorted(begin, block * width + span) + 1, len(begin)))
        at, files = entries.copy(), np.ones(len(entries), dtype="int64")
        while True:
            then = following[at]
            inside = then < len(begin)
            if not inside.any():
                break
            at = np.where(inside, then, at)
            files += inside
        return _one_per_exit(
            pd.DataFrame({"block": block, "entry": begin[entries], "need": begin[at] + span, "files": files})
        )

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("begin", ignore_index=True)
        begin = pdf["begin"].to_numpy()
        starts = []
        at = int(np.searchsorted(begin, pdf["need"].iloc[0]))
        while at < len(begin):
            starts.append(at)
            at = int(np.searchsorted(begin, begin[at] + span))
        pdf["file_no"] = pdf["files"].iloc[0] + np.searchsorted(starts, np.arange(len(begin)), side="right")
        return pdf[["group_key", "file_no"]]

    entered = _enter(
        groups.groupBy("block").applyInPandas(exits, _EXITS), rows // width + 1, fan
    )
    key_type = counts.schema["group_key"].dataType.simpleString()
    numbered = groups.join(entered, "block").groupBy("block").applyInPandas(
        number, f"group_key {key_type}, file_no long"
    )
    return numbered.withColumnRenamed("group_key", key)


def bounded_split(df: DataFrame, key: str, size: int = K.SPLIT_SIZE) -> DataFrame:
    """Add `file_no` (1, 2, ...) to the rows; rows without a key belong to no file."""
    return df.join(file_numbers(df, key, size), key)
