"""Greedy next-fit bundling of an ordered list under two budgets, cut into blocks that are worked on in parallel.

A bundle takes messages in order and closes when the next one would exceed the limit of bytes or of files, so a
bundle depends on everything before it.  What a run of messages does to the open bundle is,
however, a function of two numbers: the bytes and the files the open bundle holds on entry.  They only decide before
which message it closes first, the earlier of two places that each fall as its number grows; from there on a fresh
bundle goes on by itself.  So the function is a monotone table with few pieces.  Each block works out its own, tables are composed
block by block (a fan-in at a time, so no task sees more than ``FAN_IN`` of them), and with its
entry value known every block assigns its messages on its own.  A group of any size is split.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast.session import scratch_path, send_with_tasks

send_with_tasks(__name__)

FAN_IN = 1_000
#: stands for "no limit of files"
NO_LIMIT = 1 << 62

# One piece: the first one applies whose ``above`` is below the entry's bytes or whose ``above_files`` is below its files.
# Then the block closes ``breaks`` bundles and leaves ``carry`` bytes in ``files`` files; a relative piece, the last one,
# closes none and adds them to the entry.  ``start`` is the one piece that applies when no bundle is open yet.
_COLUMNS = ["start", "above", "above_files", "breaks", "carry", "files", "relative"]
_PIECES = "start boolean, above bigint, above_files bigint, breaks bigint, carry bigint, files bigint, relative boolean"
Piece = tuple[int, int, int, int, int, bool]
#: below the bytes and files of every entry
ANY = -1


class Table:
    """What a run of messages does to the bundle that is open before it."""

    def __init__(self, start: tuple[int, int, int], pieces: list[Piece]) -> None:
        self.start, self.pieces = start, pieces
        # places fall along the pieces, so their negatives rise
        self.above = -np.array([p[0] for p in pieces])
        self.above_files = -np.array([p[1] for p in pieces])

    def apply(self, entry: tuple[int, int] | None) -> tuple[int, int, int]:
        """(bundles closed, bytes and files left open) for an entry, None being no open bundle."""
        if entry is None:
            return self.start
        size, files = entry
        at = min(
            int(np.searchsorted(self.above, -size, side="right")), int(np.searchsorted(self.above_files, -files, side="right"))
        )
        _, _, breaks, carry, more, relative = self.pieces[min(at, len(self.pieces) - 1)]
        return (breaks, carry + size, more + files) if relative else (breaks, carry, more)

    def then(self, second: "Table") -> "Table":
        """The table of this run followed by ``second``."""

        def after(breaks: int, carry: int, files: int) -> tuple[int, int, int]:
            more, left, left_files = second.apply((carry, files))
            return breaks + more, left, left_files

        pieces = [(above, above_files, *after(breaks, carry, files), False) for above, above_files, breaks, carry, files, relative in self.pieces if not relative]
        if self.pieces[-1][-1]:
            _, _, _, carry, files, _ = self.pieces[-1]
            for above, above_files, breaks, carry2, files2, relative in second.pieces:
                total = (carry + carry2, files + files2) if relative else (carry2, files2)
                pieces.append((max(above - carry, ANY), max(above_files - files, ANY), breaks, *total, relative))
        return Table(after(*self.start), _short(pieces))


def _short(pieces: list[Piece]) -> list[Piece]:
    """Neighbours with equal results as one piece, and nothing behind a piece that every entry meets."""
    out: list[Piece] = []
    for piece in pieces:
        if out and out[-1][2:] == piece[2:]:
            out[-1] = piece
        else:
            out.append(piece)
        if piece[0] <= ANY or piece[1] <= ANY:
            break
    return out


def _following(sizes: np.ndarray, limit: int, max_files: int) -> np.ndarray:
    """Where the bundle closes that is opened at each position."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    places = np.arange(len(sizes))
    by_bytes = np.maximum(np.searchsorted(total, total[:-1] + limit, side="right") - 1, places + 1)
    return np.minimum(by_bytes, places + min(max_files, len(sizes)))


def _fresh_starts(sizes: np.ndarray, limit: int, max_files: int) -> tuple[np.ndarray, np.ndarray]:
    """For a bundle opened at each position: bundles closed up to the end, and where the last one is opened.

    Pointers are doubled, so a run of n messages takes log n passes over arrays.
    """
    n = len(sizes)
    following = _following(sizes, limit, max_files)
    # a bundle that reaches the end points at itself; a step is one closed bundle
    goal = np.where(following < n, following, np.arange(n))
    steps = (following < n).astype(np.int64)
    while True:
        further = goal[goal]
        if (further == goal).all():
            return steps, goal
        steps += steps[goal]
        goal = further


def block_table(sizes: np.ndarray, limit: int, max_files: int) -> Table:
    n = len(sizes)
    total = np.concatenate(([0], np.cumsum(sizes)))
    breaks, last = _fresh_starts(sizes, limit, max_files)
    carry, files = total[n] - total[last], n - last
    start = (int(breaks[0]), int(carry[0]), int(files[0]))
    # the open bundle closes before message i when its bytes exceed limit - total[i + 1], or its files max_files - i - 1
    above = np.maximum(limit - total[1:], ANY)
    above_files = np.maximum(max_files - np.arange(1, n + 1), ANY)
    ends = np.flatnonzero(np.append((np.diff(breaks) != 0) | (np.diff(last) != 0), True))
    pieces = [
        (int(above[i]), int(above_files[i]), int(breaks[i]) + 1, int(carry[i]), int(files[i]), False) for i in ends.tolist()
    ]
    pieces.append((ANY, ANY, 0, int(total[n]), n, True))
    return Table(start, _short(pieces))


def _read_table(frame: pd.DataFrame) -> Table:
    rows = frame.sort_values("place")
    first = rows[rows["start"]].iloc[0]
    rest = rows[~rows["start"]]
    pieces = list(zip(*(rest[c].tolist() for c in _COLUMNS[1:]), strict=True))
    return Table((int(first["breaks"]), int(first["carry"]), int(first["files"])), pieces)


def _as_frame(table: Table, **columns) -> pd.DataFrame:
    rows = [(True, 0, 0, *table.start, False), *((False, *p) for p in table.pieces)]
    frame = pd.DataFrame(rows, columns=_COLUMNS)
    return frame.assign(place=range(len(rows)), **columns)[[*columns, "place", *_COLUMNS]]


def next_fit(
    messages: DataFrame,
    group: list[str],
    order: str,
    size: str,
    limit: int,
    rows_per_block: int | None = None,
    fan_in: int = FAN_IN,
    max_files: int | None = None,
) -> DataFrame:
    """``group``, ``order`` and ``bundle_index`` (from 0 within the group) of every message.

    ``order`` must be unique within a group and ``size`` not negative; a NULL size counts as 0.  Bundles stay
    within ``limit`` bytes unless a single message is larger, and within ``max_files`` messages if that is given.

    Blocks are ranges of (group, order), as many as the session has shuffle partitions, joined where they are small, or of
    ``rows_per_block`` rows.  They are written once, so that all passes see the same cut.
    """
    spark = messages.sparkSession
    path = scratch_path(spark, "bundle-blocks")
    sized = F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("size")
    narrow = messages.select(*group, order, sized).withColumn("gid", F.to_json(F.struct(*group)))
    most = NO_LIMIT if max_files is None else max_files
    if most < 1:
        raise ValueError("a bundle holds one file at least")
    if rows_per_block is None:
        ranged = narrow.repartitionByRange("gid", order)
    else:
        ranged = narrow.repartitionByRange(max(1, -(-messages.count() // rows_per_block)), "gid", order)
    ranged.withColumn("block", F.spark_partition_id().cast("bigint")).write.parquet(f"{path}/rows")
    schema = {f.name: f.dataType.simpleString() for f in narrow.schema}
    rows = spark.read.schema(", ".join(f"`{c}` {t}" for c, t in schema.items()) + ", block bigint").parquet(f"{path}/rows")
    assigned_schema = ", ".join(f"`{c}` {schema[c]}" for c in [*group, order]) + ", bundle_index bigint"
    block_count = max(1, len(rows.inputFiles()))
    node = "gid string, node bigint, place bigint, "

    def assign(rows: pd.DataFrame, bytes_open: int, files_open: int, offset: int) -> pd.DataFrame:
        rows = rows.sort_values(order)
        sizes = rows["size"].to_numpy()
        following = _following(sizes, limit, most)
        if files_open:
            at = min(int(np.searchsorted(np.cumsum(sizes), limit - bytes_open, side="right")), most - files_open)
        else:
            at = int(following[0])
        opened = np.zeros(len(sizes), dtype=np.int64)
        while at < len(sizes):  # once a bundle
            opened[at] = 1
            at = int(following[at])
        return rows[[*group, order]].assign(bundle_index=offset + np.cumsum(opened))

    def summarise(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows.sort_values(order)["size"].to_numpy()
        return _as_frame(block_table(sizes, limit, most), gid=rows["gid"].iloc[0], node=rows["block"].iloc[0])

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        whole: Table | None = None
        for _, part in frame.groupby("node", sort=True):
            table = _read_table(part)
            whole = table if whole is None else whole.then(table)
        return _as_frame(whole, gid=frame["gid"].iloc[0], node=frame["parent"].iloc[0])

    def chain(frame: pd.DataFrame, entry: tuple[int, int] | None, offset: int) -> pd.DataFrame:
        out = []
        for number, part in frame.groupby("node", sort=True):
            out.append((frame["gid"].iloc[0], number, *(entry or (0, 0)), offset))
            more, *entry = _read_table(part).apply(entry)
            offset += more
        return pd.DataFrame(out, columns=["gid", "node", "bytes_open", "files_open", "offset"])

    def entry_of(frame: pd.DataFrame) -> tuple[int, int] | None:
        # an open bundle holds a file at least
        first = frame.iloc[0]
        return (int(first["bytes_open"]), int(first["files_open"])) if first["files_open"] else None

    levels = [rows.groupBy("gid", "block").applyInPandas(summarise, node + _PIECES)]
    while block_count > fan_in:
        levels[-1].write.parquet(f"{path}/level{len(levels)}")
        kept = spark.read.parquet(f"{path}/level{len(levels)}")
        levels[-1] = kept.withColumn("parent", F.floor(F.col("node") / F.lit(fan_in)))
        levels.append(levels[-1].groupBy("gid", "parent").applyInPandas(compose, node + _PIECES))
        block_count = -(-block_count // fan_in)

    entry_schema = "gid string, node bigint, bytes_open bigint, files_open bigint, offset bigint"
    entries = levels[-1].groupBy("gid").applyInPandas(lambda frame: chain(frame, None, 0), entry_schema)
    for lower in reversed(levels[:-1]):
        entries = (
            lower.join(entries.withColumnRenamed("node", "parent"), ["gid", "parent"])
            .groupBy("gid", "parent")
            .applyInPandas(lambda frame: chain(frame, entry_of(frame), int(frame["offset"].iloc[0])), entry_schema)
        )
    return (
        rows.join(entries.withColumnRenamed("node", "block"), ["gid", "block"])
        .groupBy("gid", "block")
        .applyInPandas(
            lambda part: assign(part, *(int(part[c].iloc[0]) for c in ("bytes_open", "files_open", "offset"))), assigned_schema
        )
    )
