"""Packing of files into batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize, shuffle_partitions

#: Rows of a part that one task packs.
PART = 1_000_000


class Chain:
    """Batches of some sizes in order: where the batch that begins at each place ends, and what follows from there."""

    def __init__(self, sizes: np.ndarray, limit: int) -> None:
        self.limit, self.sums = limit, np.r_[0, np.cumsum(sizes)]
        n = len(sizes)
        #: The place behind a batch that begins at each place: as many as fit, but one at least.
        self.next = np.maximum(np.arange(n) + 1, np.searchsorted(self.sums, self.sums[:-1] + limit, "right") - 1)
        #: From each place on, the number of batches that begin, and where the last of them does.
        self.count, self.last = np.ones(n + 1, np.int64), np.arange(n + 1)
        self.count[n] = 0
        for i in range(n - 1, -1, -1):
            j = self.next[i]
            if j < n:
                self.count[i], self.last[i] = self.count[j] + 1, self.last[j]

    def joined(self, filled: int | None) -> int:
        """How many of the first files join a batch that is filled so far; None is no batch at all."""
        if filled is None:
            return 0
        return max(0, int(np.searchsorted(self.sums, self.limit - filled, "right")) - 1)

    def starts(self, place: int) -> np.ndarray:
        """The places at which batches begin, from one on."""
        out = []
        while place < len(self.next):
            out.append(place)
            place = int(self.next[place])
        return np.array(out, np.int64)

    def outcomes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What a part does to the batch that runs into it: least room it has left, batches that begin, and what the last holds.

        The last that holds is -1 where the whole part joins. Of outcomes that are the same for more and more room the first stays.
        """
        n = len(self.next)
        most = max(0, int(np.searchsorted(self.sums, self.limit, "right")) - 1)
        place = np.arange(most + 1)
        count, held = self.count[place], np.where(place < n, self.sums[n] - self.sums[self.last[place]], -1)
        new = np.r_[True, (count[1:] != count[:-1]) | (held[1:] != held[:-1])]
        return self.sums[place][new], count[new], held[new]


def packed(files: DataFrame, limit: int, path: str = "path", size: str = "size", strict: bool = False) -> DataFrame:
    """Batches of files in the order of their paths: `path, size, batch`, counted from 0.

    A file joins the current batch as long as the batch stays within `limit`, else it opens the next; a file
    above the limit has a batch of its own, or fails with strict=True. Null sizes count as 0, negative ones are an error, null
    paths are left out, a path listed twice counts twice.

    Where a batch begins depends on all before it, but what a part of the files does depends only on how much
    the batch that runs into it holds. So parts of about PART rows in path order are summed up at once, each by
    what it does for any such amount, a table of no more rows than one batch; one pass over these tables
    gives what runs into each part; and then all parts are packed at once.
    """
    if limit < 1:
        raise ValueError(f"the limit must be positive, not {limit}")
    rows = files.where(F.col(path).isNotNull()).select(F.col(path).alias("path"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"))
    n = rows.count()
    parts = max(1, min(shuffle_partitions(rows.sparkSession), -(-n // 1000)), -(-n // PART))
    # Equal rows may be in any order, so a number keeps very many of them from one part.
    spread = rows.repartitionByRange(parts, "path", "size", F.xxhash64(F.monotonically_increasing_id()))
    spread = materialize(spread.withColumn("part", F.spark_partition_id()), "packing-parts")

    def in_order(table: pa.Table) -> pa.Table:
        return table.sort_by([("path", "ascending"), ("size", "ascending")])

    def sum_up(table: pa.Table) -> pa.Table:
        sizes = in_order(table)["size"].to_numpy()
        if sizes.min(initial=0) < 0:
            raise ValueError("a size is negative")
        if strict and sizes.max(initial=0) > limit:
            raise ValueError(f"a file of {sizes.max()} bytes exceeds the limit of {limit}")
        chain = Chain(sizes, limit)
        room, count, held = chain.outcomes()
        part = np.full(len(room), table["part"][0].as_py())
        return pa.table({"part": pa.array(part, pa.int32()), "room": room, "count": count, "held": held, "whole": np.full(len(room), chain.sums[-1])})

    outcomes = materialize(spread.groupBy("part").applyInArrow(sum_up, "part int, room long, count long, held long, whole long"), "packing-outcomes")

    def run_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, batch, filled = None, 0, None  # batch: the number of the one that runs into the part
        chosen: tuple[int, int, int] | None = None
        out: list[tuple[int, int, int | None]] = []

        def leave() -> tuple[int, int | None]:
            count, held, whole = chosen
            begun = count - (filled is None and count > 0)
            return batch + begun, held if held >= 0 else (filled or 0) + whole

        for rows_ in batches:
            for p, room, count, held, whole in zip(*(c.to_pylist() for c in rows_.columns), strict=True):
                if p != part:
                    if part is not None:
                        batch, filled = leave()
                    part, chosen = p, (count, held, whole)  # the outcome for no room at all, and for no batch
                    out.append((p, batch, filled))
                elif filled is not None and room <= limit - filled:
                    chosen = (count, held, whole)
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["part", "batch", "filled"])

    entering = outcomes.coalesce(1).sortWithinPartitions("part", "room").mapInArrow(run_through, "part int, batch long, filled long")
    enters = {r.part: (r.batch, r.filled) for r in entering.collect()}  # one row for each part

    def pack(table: pa.Table) -> pa.Table:
        batch, filled = enters[table["part"][0].as_py()]
        table = in_order(table)
        chain = Chain(table["size"].to_numpy(), limit)
        begins = np.zeros(len(table), np.int64)
        begins[chain.starts(chain.joined(filled))] = 1
        numbers = batch + np.cumsum(begins) - (1 if filled is None else 0)
        return pa.table({"path": table["path"], "size": table["size"], "batch": numbers})

    return spread.groupBy("part").applyInArrow(pack, "path string, size long, batch long")
