"""Duplicates hidden by formatting differences (problem 3).

Two fields of a record are compared as the bytes that count, folded by a lookup table of 256 entries: 0 means
skip, anything else is the folded byte. Hashes and comparisons run over the raw bytes through the table, so
canonical strings are never built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize

#: Characters of the line notation that count in a structure.
NOTATION = "()[]=#+-@/\\.:%*$~"

#: Multipliers of the two rolling hashes (odd, 64 bits).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def fold_table(extra: str = "") -> np.ndarray:
    """Digits and letters count, letters without case; of the other ASCII characters those in `extra`."""
    table = np.zeros(256, np.uint8)
    for c in map(chr, range(128)):
        if c.isalnum() or c in extra:
            table[ord(c)] = ord(c.lower())
    return table


PLAIN, STRUCTURE = fold_table(), fold_table(NOTATION)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its n + 1 offsets; a null has no bytes."""
    column = column.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = int(offsets[0]) if len(offsets) else 0
    return data[start : int(offsets[-1]) if len(offsets) else 0], offsets - start


def rolling_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each string: two polynomial hashes modulo 2^64 of the bytes that count, and their number."""
    codes = table[data]
    at = np.flatnonzero(codes)
    edges = np.searchsorted(at, offsets)
    starts, ends = edges[:-1], edges[1:]
    counts = ends - starts
    place = np.arange(len(at)) - np.repeat(starts, counts)
    longest = int(counts.max(initial=0))
    hashes = []
    for base in BASES:
        powers = np.full(longest + 1, base, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        sums = np.zeros(len(at) + 1, np.uint64)
        np.cumsum(codes[at].astype(np.uint64) * powers[place], dtype=np.uint64, out=sums[1:])
        hashes.append(sums[ends] - sums[starts])
    return hashes[0], hashes[1], counts


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _next_counting(codes: np.ndarray) -> np.ndarray:
    """At each place, the nearest place from there on that counts; one past the end if there is none."""
    n = len(codes)
    places = np.where(codes > 0, np.arange(n), n)
    return np.append(np.minimum.accumulate(places[::-1])[::-1], n)


#: Steps that all pairs of a batch take together; longer strings are finished one by one in chunks.
LOCKSTEPS, CHUNK = 2048, 65536


def _same_in_chunks(a: np.ndarray, b: np.ndarray) -> bool:
    left, right, i, j = a[:0], b[:0], 0, 0
    while True:
        while not len(left) and i < len(a):
            left, i = a[i : i + CHUNK][a[i : i + CHUNK] > 0], i + CHUNK
        while not len(right) and j < len(b):
            right, j = b[j : j + CHUNK][b[j : j + CHUNK] > 0], j + CHUNK
        n = min(len(left), len(right))
        if not n:
            return len(left) == len(right)
        if not np.array_equal(left[:n], right[:n]):
            return False
        left, right = left[n:], right[n:]


def same_folded(first: pa.Array, second: pa.Array, table: np.ndarray) -> np.ndarray:
    """Whether the strings of a pair agree in the bytes that count, by two pointers that skip the others.

    The pointers of all pairs advance together, one counting byte a step, and a pair drops out at its first
    difference or at an end.
    """
    (da, oa), (db, ob) = raw_bytes(first), raw_bytes(second)
    ca, cb = table[da], table[db]
    na, nb = _next_counting(ca), _next_counting(cb)
    same = np.ones(len(oa) - 1, bool)
    active = np.arange(len(same))
    p, q = oa[:-1].copy(), ob[:-1].copy()
    for _ in range(LOCKSTEPS):
        if not len(active):
            return same
        pa_, qa = na[p], nb[q]
        over_a, over_b = pa_ >= oa[active + 1], qa >= ob[active + 1]
        over = over_a | over_b
        bad = over_a != over_b
        on = ~over
        bad[on] = ca[pa_[on]] != cb[qa[on]]
        same[active[bad]] = False
        go = on & ~bad
        active, p, q = active[go], pa_[go] + 1, qa[go] + 1
    for row, i, j in zip(active, p, q, strict=True):
        same[row] = _same_in_chunks(ca[i : oa[row + 1]], cb[j : ob[row + 1]])
    return same


def _looks_like_id(data: np.ndarray, offsets: np.ndarray, prefix: bytes, length: int) -> np.ndarray:
    codes = PLAIN[data]
    at = np.flatnonzero(codes)
    edges = np.searchsorted(at, offsets)
    fits = np.diff(edges) == length
    for k, byte in enumerate(prefix.lower()):
        place = np.minimum(edges[:-1] + k, max(len(at) - 1, 0))
        fits &= (codes[at[place]] == byte) if len(at) else False
    return fits


def _keyed(prefix: bytes, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, one, two = batch.columns
            ids = [_looks_like_id(*raw_bytes(c), prefix, length) for c in (one, two)]
            turned = pa.array(ids[0] & ~ids[1])
            structure, name = pc.if_else(turned, two, one), pc.if_else(turned, one, two)
            s1, s2, sn = rolling_hashes(*raw_bytes(structure), STRUCTURE)
            i1, i2, n = rolling_hashes(*raw_bytes(name), PLAIN)
            keep = pa.array((sn > 0) & (n > 0))
            k1 = _mixed(s1 + np.uint64(3) * _mixed(i1)).view(np.int64)
            k2 = _mixed(s2 + np.uint64(5) * _mixed(i2)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(k1), pa.array(k2), structure, name], names=["row_no", "k1", "k2", "structure", "name"]
            ).filter(keep)

    return run


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, k1, k2, structure, name, first, first_structure, first_name = batch.columns
        same = same_folded(structure, first_structure, STRUCTURE) & same_folded(name, first_name, PLAIN)
        other, same = pa.array(~same), pa.array(same)
        yield pa.RecordBatch.from_arrays(
            [row, k1, k2, first, same, pc.if_else(other, structure, None), pc.if_else(other, name, None)],
            names=["row_no", "k1", "k2", "first_row_no", "same", "structure", "name"],
        )


def _canonical(column: str, extra: str) -> F.Column:
    escaped = "".join("\\" + c for c in extra)
    return F.lower(F.regexp_replace(column, f"[^0-9A-Za-z{escaped}]", ""))


def folded_copies(
    rows: DataFrame, row: str = "row_no", structure: str = "smiles", name: str = "id", prefix: str = "LYQ", length: int = 19
) -> DataFrame:
    """Every record that has copies, each row with the first row of its class: `first_row_no, row_no`.

    Rows are copies if they agree in both fields by the bytes that count: ASCII letters (without case) and
    digits, in the structure the NOTATION characters too; other characters, also letters beyond ASCII, are
    skipped. The two columns may hold the fields either way round: they are turned if the structure column
    alone reads as an id, `length` counting characters that start with `prefix`. The first row is that with
    the smallest number, and comes with itself. Rows whose fields are null, empty or without a character
    that counts have no copies and don't come out, nor do rows without copies. Repeated row numbers come out
    as often as they occur. Extra columns are ignored.

    Rows are grouped by 128 bits of rolling hashes, counted map-side, and each is then compared with the
    first row of its group byte by byte. Rows that differ from it in spite of equal hashes are grouped
    again by their canonical text, so that classes are exact.
    """
    keyed = rows.select(F.col(row).cast("long").alias("row_no"), F.col(structure).alias("structure"), F.col(name).alias("name")).where(
        F.col("structure").isNotNull() & F.col("name").isNotNull()
    ).mapInArrow(_keyed(prefix.encode(), length), "row_no long, k1 long, k2 long, structure string, name string")
    groups = (
        keyed.groupBy("k1", "k2")
        .agg(F.min(F.struct("row_no", "structure", "name")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("k1", "k2", F.col("first.row_no").alias("first_row_no"), F.col("first.structure").alias("fs"), F.col("first.name").alias("fn"))
    )
    pairs = keyed.join(groups, ["k1", "k2"]).select("row_no", "k1", "k2", "structure", "name", "first_row_no", "fs", "fn")
    verified = materialize(
        pairs.mapInArrow(_verified, "row_no long, k1 long, k2 long, first_row_no long, same boolean, structure string, name string"),
        "folded",
    )
    other = verified.where("not same").select(
        "row_no", "k1", "k2", _canonical("structure", NOTATION).alias("s"), _canonical("name", "").alias("i")
    )
    again = other.groupBy("k1", "k2", "s", "i").agg(F.min("row_no").alias("first_row_no"), F.count(F.lit(1)).alias("n"))
    rest = other.join(again.where("n > 1"), ["k1", "k2", "s", "i"]).select("first_row_no", "row_no")
    return verified.where("same").select("first_row_no", "row_no").unionByName(rest)


def folded_records(copies: DataFrame) -> DataFrame:
    """The classes of folded_copies with their number of rows: `first_row_no, copies`."""
    return copies.groupBy("first_row_no").agg(F.count(F.lit(1)).alias("copies"))
