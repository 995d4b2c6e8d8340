"""Most similar vectors for every vector (problem 1).

A block matrix join. Vectors are assigned to cells around centroids, and cells that lie together form blocks of
some thousand rows. A block is first joined with itself, which gives each of its vectors k candidates and a
bound; then a vector visits only those blocks of which bounds can't exclude that they hold something nearer.
Tiles are products of int8 codes, kept in floats that hold them exactly, and the error of a code gives bounds of the true distance; pairs that these
can't rule out are computed from the floats and merged into the query's k best, a bounded heap. As blocks are
skipped by proof alone, the result is exact whatever the centroids are; they decide only how much work it takes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize

#: The least number of vectors that centroids and code scales are fitted on; of a sample, four for each centroid at least.
SAMPLE = 16_384
#: Cells for the square root of the number of vectors, centroids that are spread out farthest first, and rounds of refinement.
CELLS, SPREAD, ROUNDS = 4, 1_024, 2
#: Rows of a block, queries that visit it at once, queries and data rows of a matrix tile.
BLOCK, CHUNK, TILE, WIDE = 2_048, 16_384, 512, 4_096
#: Blocks that a query visits before its bound is taken again.
FIRST_BLOCKS = 4
#: Entries of a matrix of queries by cells that are held at once.
HELD = 1_000_000


class Grid:
    """Centroids, radii and sizes of the cells, and the blocks they form."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        sample = sample.astype(np.float64)
        self.centroids = _centroids(sample, cells)
        self.radius = np.zeros(len(self.centroids))
        self.count = np.zeros(len(self.centroids), np.int64)

    def fill(self, cell: np.ndarray, radius: np.ndarray, count: np.ndarray) -> None:
        """Takes the cells' radii and sizes and forms blocks: `base` is the first block of a cell, `parts` how many it has.

        Cells are halved across the direction in which they spread most until they hold BLOCK rows together; a cell
        with more is cut into several blocks.
        """
        self.radius[cell], self.count[cell] = radius, count
        self.base, self.parts = np.full(len(self.count), -1), np.zeros(len(self.count), np.int64)
        self.blocks, open_ = 0, [np.flatnonzero(self.count)] if self.count.any() else []
        while open_:
            cells = open_.pop()
            total = int(self.count[cells].sum())
            if total <= BLOCK or len(cells) == 1:
                self.base[cells], self.parts[cells] = self.blocks, -(-total // BLOCK)
                self.blocks += -(-total // BLOCK)
                continue
            at = self.centroids[cells] - self.centroids[cells].mean(0)
            axis = at[np.argmax((at**2).sum(1))]
            for _ in range(4):
                axis = at.T @ (at @ axis)
                axis = axis / max(np.linalg.norm(axis), 1e-300)
            order = np.argsort(at @ axis, kind="stable")
            cut = int(np.clip(np.searchsorted(np.cumsum(self.count[cells][order]), total / 2), 1, len(cells) - 1))
            open_ += [cells[order[:cut]], cells[order[cut:]]]
        filled = np.flatnonzero(self.count)
        self.sorted = filled[np.argsort(self.base[filled], kind="stable")]
        self.first, self.starts = np.unique(self.base[self.sorted], return_index=True)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Of some vectors to all centroids."""
        return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + (self.centroids**2).sum(1) - 2 * (x @ self.centroids.T)))

    def least(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """What any member of each cell is away from each vector at least; infinite for empty cells.

        Members of cell b are within its radius of its centroid, and nearer to it than to the vector's own
        centroid, hence beyond the half-way plane between the two.
        """
        far = self.distances(x)
        cells, place = np.unique(own, return_inverse=True)
        apart = self.distances(self.centroids[cells])[place]
        near = far[np.arange(len(x)), own][:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(apart > 1e-6, (far**2 - near**2) / (2 * apart), 0)
        least = np.maximum(far - self.radius, plane) - 1e-6 * (1 + far)
        least[:, self.count == 0] = np.inf
        return least

    def open_blocks(self, x: np.ndarray, own: np.ndarray, block: np.ndarray, bound: np.ndarray) -> list[np.ndarray]:
        """Of every query: the blocks but its own that its bound leaves open, most promising first."""
        found: list[np.ndarray] = []
        step = max(16, HELD // len(self.centroids))
        for i in range(0, len(x), step):
            part = slice(i, i + step)
            least = np.minimum.reduceat(self.least(x[part], own[part])[:, self.sorted], self.starts, axis=1)
            many = self.parts[self.sorted[self.starts]]
            mine = np.searchsorted(self.first, self.base[own[part]])
            least[np.arange(len(least)), mine] = np.where(many[mine] > 1, -1.0, np.inf)  # other blocks of its own cell are open
            row, at = np.nonzero((least <= bound[part, None]) & np.isfinite(least))
            order = np.lexsort((at, least[row, at], row))
            row, at = row[order], at[order]
            blocks = np.repeat(self.first[at], many[at]) + _counting(many[at])
            row = np.repeat(row, many[at])
            other = blocks != block[part][row]
            found += np.split(blocks[other], np.searchsorted(row[other], np.arange(1, len(least))))
        return found


def _counting(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each length, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _centroids(sample: np.ndarray, cells: int) -> np.ndarray:
    """Some centroids spread out farthest first, the others drawn as the vectors lie, then moved to their means."""
    cells = min(cells, len(sample))
    squares = (sample**2).sum(1)
    least, chosen = np.full(len(sample), np.inf), [0]
    for _ in range(min(SPREAD, max(1, cells // 2)) - 1):
        c = sample[chosen[-1]]
        np.minimum(least, squares + c @ c - 2 * (sample @ c), out=least)
        chosen.append(int(least.argmax()))
    others = np.setdiff1d(np.arange(len(sample)), chosen)[: cells - len(set(chosen))]
    centroids = sample[np.unique(np.r_[chosen, others])]
    for _ in range(ROUNDS):
        cell = _nearest(sample, centroids)
        counts = np.bincount(cell, minlength=len(centroids))
        order = np.argsort(cell, kind="stable")
        sums = np.add.reduceat(sample[order], np.r_[0, np.cumsum(counts)[:-1]].clip(max=len(sample) - 1), axis=0)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    norms, step = (centroids**2).sum(1), max(16, HELD // len(centroids))
    return np.concatenate([(norms - 2 * (x[i : i + step] @ centroids.T)).argmin(1) for i in range(0, len(x), step)] or [np.zeros(0, np.int64)])


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors that are kept as float32 bytes, as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = len(column[0].as_py()) if len(column) else 4
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), width // 4).astype(np.float64)


class Codes:
    """Int8 codes of vectors around the middle of some data, whose largest deviation is 127."""

    def __init__(self, data: np.ndarray) -> None:
        self.middle = data.mean(0)
        self.scale = max(float(np.abs(data - self.middle).max()), 1e-12) / 127
        # Sums of squares of codes are exact in float32 below 2^24, so up to 256 dimensions, and in float64 in any case.
        self.exact = np.float32 if data.shape[1] <= 256 else np.float64

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, whole numbers that floats hold exactly, and the length of what they miss; values beyond the range are cut off."""
        codes = np.clip(np.rint((x - self.middle) / self.scale), -127, 127)
        return codes.astype(self.exact), np.sqrt(((x - self.middle - self.scale * codes) ** 2).sum(1))


class Best:
    """The k nearest rows found so far of many queries: a bounded heap each, kept as rows of two sorted matrices."""

    def __init__(self, n: int, k: int, bound: np.ndarray) -> None:
        self.k, self.bound = k, bound.copy()
        self.square, self.row = np.full((n, k), np.inf), np.full((n, k), -1)

    def push(self, query: np.ndarray, square: np.ndarray, row: np.ndarray, number: np.ndarray) -> None:
        """Merges pairs into the k best of their queries, by distance and then by number."""
        order = np.lexsort((number[row], square, query))
        query, square, row = query[order], square[order], row[order]
        touched, starts, counts = np.unique(query, return_index=True, return_counts=True)
        place = _counting(counts)
        kept = place < self.k
        line = np.repeat(np.arange(len(touched)), counts)[kept]
        squares, rows = np.full((len(touched), 2 * self.k), np.inf), np.full((len(touched), 2 * self.k), -1)
        squares[:, : self.k], rows[:, : self.k] = self.square[touched], self.row[touched]
        squares[line, self.k + place[kept]], rows[line, self.k + place[kept]] = square[kept], row[kept]
        numbers = np.where(rows >= 0, number[rows], np.iinfo(np.int64).max)
        best = np.lexsort((numbers, squares), axis=1)[:, : self.k]
        self.square[touched], self.row[touched] = np.take_along_axis(squares, best, 1), np.take_along_axis(rows, best, 1)
        self.bound[touched] = np.minimum(self.bound[touched], np.sqrt(self.square[touched, -1]))


def block_search(
    queries: np.ndarray, query_numbers: np.ndarray, data: np.ndarray, numbers: np.ndarray, k: int, bound: np.ndarray
) -> Best:
    """The k nearest data rows within `bound` of every query, tile by tile; a row never finds its own number.

    Codes are taken around the middle of the data, as those of a block lie close together.
    """
    best = Best(len(queries), k, bound)
    codes = Codes(data)
    (qc, qe), (dc, de) = codes.of(queries), codes.of(data)
    qn, dn = (qc**2).sum(1), (dc**2).sum(1)
    for j in range(0, len(data), WIDE):
        right = slice(j, j + WIDE)
        worst = float(de[right].max(initial=0))
        for i in range(0, len(queries), TILE):
            left = slice(i, i + TILE)
            squares = qc[left] @ dc[right].T
            squares *= -2
            squares += dn[right]
            squares += qn[left, None]
            limit = best.bound[left]
            if squares.shape[1] > k and not np.isfinite(limit).all():
                # The k + 1 nearest by codes, of which one may be the query itself, give a first bound that has no error.
                some = np.argpartition(squares, k, axis=1)[:, : k + 1] + j
                first = ((queries[left, None] - data[some]) ** 2).sum(2)
                first[numbers[some] == query_numbers[left, None]] = np.inf
                limit = np.minimum(limit, np.sqrt(np.partition(first, k - 1, axis=1)[:, k - 1]) * (1 + 1e-9))
            reach = (limit + qe[left] + worst) / codes.scale
            at = np.flatnonzero(squares <= (reach**2 * (1 + 1e-6) + 1e-3)[:, None])
            if not len(at):
                continue
            a, b = np.divmod(at, squares.shape[1])
            a, b = a + i, b + j
            other = query_numbers[a] != numbers[b]
            a, b = a[other], b[other]
            exact = np.concatenate([((queries[a[s : s + 16384]] - data[b[s : s + 16384]]) ** 2).sum(1) for s in range(0, len(a), 16384)] or [np.zeros(0)])
            near = exact <= best.bound[a] ** 2 * (1 + 1e-12)
            if near.any():
                best.push(a[near], exact[near], b[near], numbers)
    return best


_FOUND = pa.list_(pa.struct([("square", pa.float64()), ("copies", pa.list_(pa.int64()))]))


def _found_lists(best: Best, copies: pa.Array) -> pa.Array:
    there = best.row >= 0
    values = pa.StructArray.from_arrays([pa.array(best.square[there]), copies.take(pa.array(best.row[there]))], names=["square", "copies"])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, there.sum(1).cumsum()].astype(np.int32)), values)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    edges = np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)))


_STATE = "number long, copies array<long>, v binary, cell int, block int, bound double, found array<struct<square: double, copies: array<long>>>, blocks array<int>, more boolean"
_STATE_NAMES = ["number", "copies", "v", "cell", "block", "bound", "found", "blocks", "more"]


def _own_block(shared, k: int) -> Callable[[pa.Table], pa.Table]:
    """Joins a block with itself and plans which others its rows have to visit."""

    def run(table: pa.Table) -> pa.Table:
        grid = shared.value
        numbers, x = table["number"].to_numpy(), _vectors(table["v"])
        best = block_search(x, numbers, x, numbers, k, np.full(len(x), np.inf))
        own, block = table["cell"].to_numpy(), table["block"].to_numpy()
        blocks = grid.open_blocks(x, own, block, best.bound)
        counts = np.array([len(b) for b in blocks])
        copies = table["copies"].combine_chunks()
        # Only rows that go on visiting need their vector again.
        v = pc.if_else(pa.array(counts > 0), table["v"].combine_chunks(), None)
        columns = [table["number"], copies, v, table["cell"], table["block"], pa.array(best.bound), _found_lists(best, copies), _lists([b[:FIRST_BLOCKS] for b in blocks]), pa.array(counts > FIRST_BLOCKS)]
        return pa.table(columns, names=_STATE_NAMES)

    return run


def _other_block(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Searches a block for the queries that visit it."""

    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["number", "found"]
        if not len(data) or not len(queries):
            return pa.table([pa.array([], pa.int64()), pa.array([], _FOUND)], names=names)
        best = block_search(
            _vectors(queries["v"]), queries["number"].to_numpy(), _vectors(data["v"]), data["number"].to_numpy(), k, queries["bound"].to_numpy()
        )
        found = pa.table([queries["number"], _found_lists(best, data["copies"].combine_chunks())], names=names)
        return found.filter(pa.array((best.row >= 0).any(1)))

    return run


def _rest(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Plans the blocks that are still open under the bound of the first visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared.value
        for batch in batches:
            x, own, block = _vectors(batch["v"]), batch["cell"].to_numpy(), batch["block"].to_numpy()
            visited = grid.open_blocks(x, own, block, batch["bound"].to_numpy())
            now = grid.open_blocks(x, own, block, batch["new"].to_numpy())
            left = [np.setdiff1d(b, w[:FIRST_BLOCKS]) for b, w in zip(now, visited, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["number"], batch["v"], batch["new"], _lists(left)], names=["number", "v", "bound", "blocks"])

    return run


def _search(visits: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """What queries (`number, v, bound, blocks`) find in the blocks they visit: `number, found`.

    A vector is sent once for each block it visits. Blocks that very many queries visit are searched in several tasks.
    """
    chunks = visits.select(F.explode("blocks").alias("block")).groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    chunks = materialize(chunks, "visited-blocks")
    asked = visits.select("number", "v", "bound", F.explode("blocks").alias("block")).join(chunks, "block")
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("number"), F.col("chunks")).cast("int"))
    there = data.join(chunks, "block").withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    return (
        there.select("block", "chunk", "number", "copies", "v").groupBy("block", "chunk")
        .cogroup(asked.select("block", "chunk", "number", "v", "bound").groupBy("block", "chunk"))
        .applyInArrow(_other_block(k), "number long, found array<struct<square: double, copies: array<long>>>")
    )


def usable(rows: DataFrame, vector: str, valid: str, size: int) -> DataFrame:
    """The rows whose flag is true and whose vector has `size` finite values; a negative zero becomes zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col(valid) & (F.size(vector) == size) & fine).withColumn(vector, F.transform(vector, lambda x: x + F.lit(0.0).cast("float")))


def nearest_pairs(
    rows: DataFrame, k: int = 5, number: str = "vec_no", vector: str = "usrcat", valid: str = "usrcat_valid", size: int = 60
) -> DataFrame:
    """Pairs of rows of which one is among the k nearest of the other: `vec_no_a, vec_no_b`, the smaller first.

    Distance is Euclidean, at equal distance the smaller number is nearer; rows with equal vectors are
    neighbours at distance 0. Rows with a false or null flag, a null vector, another length, or a null, NaN
    or infinite value take no part. With n rows there are at most k n pairs; fewer than k other rows are all
    neighbours; an empty table gives no pairs. Extra columns are ignored. Numbers must be unique.

    Equal vectors are searched once, with their k + 1 smallest numbers, so any number of copies costs one
    search. There are CELLS times the square root of n cells, whatever n is. Centroids are fitted on at most
    SAMPLE distinct vectors, or four for each cell if that is more; every vector is in a cell, and the result
    doesn't depend on the sample. Sent to all executors: the centroids (for a billion vectors of 60 values 126
    thousand, 61 MB).
    """
    spark = rows.sparkSession
    fine = usable(rows.select(number, vector, valid), vector, valid, size).select(F.col(number).cast("long").alias("number"), F.col(vector).alias("x")).withColumn("h", F.xxhash64("x"))
    alike = Window.partitionBy("h", "x").orderBy("number")  # sorted by the hash first, which is cheap to compare
    distinct = materialize(
        fine.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= k + 1)
        .groupBy("h", "x").agg(F.sort_array(F.collect_list("number")).alias("copies"))
        .select(F.col("copies")[0].alias("number"), "copies", "h", "x"),
        "distinct-vectors",
    )
    n = distinct.count()
    if not n:
        return spark.createDataFrame([], "vec_no_a long, vec_no_b long")
    cells = max(1, int(CELLS * n**0.5))
    lot = F.xxhash64("number")
    # About twice the sample by hash, of which the smallest are kept, so no sort sees more.
    share = F.lit(min(2**63 - 1, int(2**64 * 2 * max(SAMPLE, 4 * cells) / n) - 2**63))
    sample = distinct.select("x", lot.alias("lot")).where(F.col("lot") <= share).orderBy("lot").limit(max(SAMPLE, 4 * cells)).select("x").toArrow()["x"].combine_chunks()
    grid = Grid(sample.flatten().to_numpy(zero_copy_only=False).reshape(len(sample), -1), cells)
    centroids = spark.sparkContext.broadcast(grid.centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["x"].flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(batch), -1)
            x = values.astype(np.float64)
            cell = _nearest(x, centroids.value)
            away = np.sqrt(((x - centroids.value[cell]) ** 2).sum(1))
            v = pa.array([r.tobytes() for r in values], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["number"], batch["copies"], v, pa.array(cell.astype(np.int32)), pa.array(away)], names=["number", "copies", "v", "cell", "away"])

    placed = materialize(distinct.select("number", "copies", "x").mapInArrow(assign, "number long, copies array<long>, v binary, cell int, away double"), "placed-vectors")
    found = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).toPandas()  # one row for each cell
    grid.fill(found["cell"].to_numpy(), found["radius"].to_numpy(), found["n"].to_numpy())
    shared = spark.sparkContext.broadcast(grid)
    used = found["cell"].to_numpy()
    places = spark.createDataFrame(pa.table({"cell": pa.array(used, pa.int32()), "base": pa.array(grid.base[used], pa.int32()), "parts": pa.array(grid.parts[used], pa.int32())}))
    data = placed.join(F.broadcast(places), "cell").withColumn("block", (F.col("base") + F.pmod(F.xxhash64("number"), F.col("parts"))).cast("int"))
    data = data.select("number", "copies", "v", "cell", "block")
    state = materialize(data.groupBy("block").applyInArrow(_own_block(shared, k), _STATE), "own-blocks")

    going = state.where(F.size("blocks") > 0)
    first = materialize(_search(going.select("number", "v", "bound", "blocks"), data, k), "first-visits")
    open_ = state.where("more").select("number", "v", "cell", "block", "bound", "found")
    second = first.limit(0)
    if not open_.isEmpty():
        merged = (
            open_.select("number", "found").unionByName(first.join(open_.select("number"), "number", "left_semi").select("number", "found"))
            .groupBy("number").agg(F.sort_array(F.flatten(F.collect_list("found.square"))).alias("squares"))
            .select("number", F.when(F.size("squares") >= k, F.sqrt(F.element_at("squares", F.lit(k)))).otherwise(F.lit(float("inf"))).alias("new"))
        )
        again = open_.join(merged, "number").select("number", "v", "cell", "block", "bound", "new")
        planned = materialize(again.mapInArrow(_rest(shared), "number long, v binary, bound double, blocks array<int>"), "open-queries")
        second = _search(planned, data, k)

    # Rows that visited no block are done; of the others what all blocks gave is merged.
    nothing = F.lit(None).cast("array<bigint>").alias("copies")
    parts = going.select("number", "copies", "found").unionByName(first.select("number", nothing, "found")).unionByName(second.select("number", nothing, "found"))
    nearer = F.array_sort(F.flatten(F.collect_list("found")))  # by distance, then by the smallest number
    visited = parts.groupBy("number").agg(F.max("copies").alias("copies"), F.slice(nearer, 1, k).alias("found"))
    whole = state.where(F.size("blocks") == 0).select("copies", "found").unionByName(visited.select("copies", "found"))
    near = (
        whole.select("copies", F.array_sort(F.concat(
            F.transform("copies", lambda c: F.struct(F.lit(-1.0).alias("square"), c.alias("no"))),
            F.flatten(F.transform(F.coalesce("found", F.array()), lambda f: F.transform(f["copies"], lambda c: F.struct(f["square"].alias("square"), c.alias("no"))))),
        )).alias("near"))
        .select(F.explode("copies").alias("a"), "near")
        .select("a", F.explode(F.slice(F.filter("near", lambda e: e["no"] != F.col("a")), 1, k)).alias("e"))
        .select("a", F.col("e.no").alias("b"))
    )
    # Further copies of a vector have its k smallest numbers as neighbours; their join is on the hash, the vectors are compared.
    many = distinct.where(F.size("copies") > k).select(F.col("h").alias("mh"), F.col("x").alias("mx"), "copies")
    more = (
        fine.join(many, (F.col("h") == F.col("mh")) & (F.col("x") == F.col("mx"))).where(F.col("number") > F.col("copies")[k])
        .select(F.col("number").alias("a"), F.explode(F.slice("copies", 1, k)).alias("b"))
    )
    return near.unionByName(more).select(F.least("a", "b").alias("vec_no_a"), F.greatest("a", "b").alias("vec_no_b")).distinct()
