"""Deduplicating new batches against all history (problem 4).

History is kept in runs that are sorted under several keys for each distinct id: the first and the last half of
the id, for its own length and the next smaller one. One edit leaves one of the two halves as it is, so ids that
are one edit apart stand together under some key. Runs are cut into ranges of the keys' hashes and merged tier
by tier; a new batch opens the ranges of its own keys alone and is compared inside the windows of equal keys
around its ids. Which rows are accepted then follows from a graph of matches between distinct ids of batches,
not between rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.runs import MB, Change, Journal, State, Table
from ..runtime import materialize, shuffle_partitions, work_path

#: Ids under one key from which the window is split by what is left of an id after one deletion.
WINDOW = 200
#: Links between undecided ids that one task decides in one pass; more are cut into connected parts first.
AT_ONCE = 2_000_000
#: Files named by batches up to which their list is broadcast.
MOST_NAMED = 500_000


def plain(name: Column | str) -> Column:
    """An id's ASCII letters and digits in lower case; null for null, and maybe empty."""
    return F.lower(F.regexp_replace(name, "[^0-9A-Za-z]", ""))


def one_apart(a: Column, b: Column) -> Column:
    """Whether one replaced, missing or added character, or two swapped neighbours, turn a into b."""
    n = F.length(a)
    swapped = F.exists(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, n)) == b,
    )
    return (a != b) & (F.abs(n - F.length(b)) <= 1) & ((F.levenshtein(a, b, 1) >= 0) | ((n == F.length(b)) & (n > 1) & (F.levenshtein(a, b, 2) == 2) & swapped))


def _keys(ids: DataFrame) -> DataFrame:
    """`id, key`: four keys for each id, of the lengths n and n - 1."""
    n = F.length("id")
    tagged = ids.select("id", F.explode(F.when(n > 0, F.array(n, n - 1)).otherwise(F.array(n))).alias("n"))
    half = F.greatest(F.lit(0), F.floor((F.col("n") - 1) / 2).cast("int"))
    first = F.concat_ws("", F.col("n"), F.lit("<"), F.substring("id", F.lit(1), half))
    last = F.concat_ws("", F.col("n"), F.lit(">"), F.substring("id", F.length("id") - half + 1, half))
    return tagged.select("id", F.explode(F.array(first, last)).alias("key"))


def _split(keyed: DataFrame) -> DataFrame:
    """Of entries under a large key: one under each string that one deletion leaves, and under the shorter id itself.

    Any two ids that are one edit apart meet under one of them, and no more than some hundred ids of letters
    and digits do.
    """
    size, tag = F.length("id"), F.regexp_extract("key", r"^(\d+)", 1).cast("int")
    left = F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(F.substring("id", F.lit(1), i - 1), F.substring("id", i + 1, size)))
    left = F.when(size > 0, left).otherwise(F.array().cast("array<string>"))
    strings = F.array_distinct(F.when(size == tag, F.concat(F.array("id"), left)).otherwise(left))
    return keyed.withColumn("rest", F.explode(strings)).withColumn("key", F.concat_ws("|", "key", "rest")).drop("rest")


KEYS = T.StructType([T.StructField("key", T.StringType()), T.StructField("id", T.StringType())])
PLACES = T.StructType([T.StructField("id", T.StringType()), T.StructField("path", T.StringType()), T.StructField("row", T.LongType())])


class History:
    """Accepted rows, kept between calls: `key, id` for distinct ids, and the smallest row of each id in each file.

    Batches are known by a mark of their rows, so a batch that is given again changes nothing, and one to which
    late rows came is taken in again. Rows are never taken out.
    """

    def __init__(self, spark: SparkSession, root: str, unit: int = 8 * MB, fanout: int = 4, top: int = 2) -> None:
        self.spark, self.journal = spark, Journal(spark, root)
        self.keys = Table(self.journal, "keys", KEYS, ["key"], ["key", "id"], unit, fanout, top)
        self.places = Table(self.journal, "places", PLACES, ["id"], ["id", "path"], unit, fanout, top)

    def accept(self, rows: DataFrame, parts: int = 1) -> None:
        """Takes in the rows of accepted batches (`batch_no, row_no, path, id`), in `parts` sorted runs by groups of batches."""
        mark = F.concat_ws(":", F.count(F.lit(1)), F.sum(F.xxhash64("row_no", "path", "id").cast("decimal(38,0)")))
        marks = {str(r.batch_no): r.mark for r in rows.groupBy("batch_no").agg(mark.alias("mark")).collect()}  # one row for each batch
        known = self.journal.state().notes
        late = sorted((b for b, m in marks.items() if known.get(b) != m), key=int)
        for i in range(parts):
            group = late[i * len(late) // parts : (i + 1) * len(late) // parts]
            if group:
                self._accept(rows.where(F.col("batch_no").isin([int(b) for b in group])), {b: marks[b] for b in group})
                with ThreadPoolExecutor(1) as beside:  # both are tables of one journal, where one merge waits for the other's commit
                    keyed = beside.submit(self.keys.compact)
                    self.places.compact()
                    keyed.result()
        self.journal.vacuum()

    def _accept(self, rows: DataFrame, marks: dict[str, str]) -> None:
        places = materialize(rows.groupBy("id", "path").agg(F.min("row_no").alias("row")), "accepted")
        ids = places.select("id").distinct()

        def take(state: State) -> Change:
            new = ids.join(self.places.around(state, ids).select("id"), "id", "left_anti") if state.of("places") else ids
            n, size = places.agg(F.count(F.lit(1)), F.coalesce(F.sum(self.places.weight), F.lit(0))).first()
            with ThreadPoolExecutor(1) as beside:
                keyed = beside.submit(self.keys.write, _keys(new).select("key", "id"), 4 * size)
                made = self.places.write(places, size)
            return Change("accept", [made, keyed.result()], notes=marks, inputs={"batches": sorted(marks, key=int), "rows": n})

        self.journal.transact(take)

    def places_of(self, ids: DataFrame, expected: int) -> DataFrame:
        """`id, path, row` of some distinct ids."""
        state = self.journal.state()
        return self.places.around(state, ids, expected).join(ids, "id", "left_semi")

    def matches(self, ids: DataFrame, expected: int) -> DataFrame:
        """`id, other`: of distinct new ids, those of history or of the new ones that are one edit apart, each pair once."""
        new = _keys(ids).select("key", "id")
        near = self.keys.around(self.journal.state(), new, 4 * expected).join(new.select("key").distinct(), "key", "left_semi")
        both = new.withColumn("new", F.lit(True)).unionByName(near.withColumn("new", F.lit(False)))
        both = materialize(both.groupBy("key", "id").agg(F.max("new").alias("new")), "window-entries")
        sizes = both.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("new").alias("new")).where("n > 1 and new")
        small = both.join(sizes.where(F.col("n") <= WINDOW).select("key"), "key", "left_semi")
        large = _split(both.join(sizes.where(F.col("n") > WINDOW).select("key"), "key", "left_semi"))
        windows = small.unionByName(large)
        here, there = windows.where("new").select("key", "id"), windows.select("key", F.col("id").alias("other"))
        return here.join(there, (here["key"] == there["key"]) & one_apart(here["id"], there["other"])).select("id", "other").distinct()


def named_files(specs: DataFrame, files: DataFrame) -> DataFrame:
    """`batch_no, path`: the files that each batch's `exclude_inputs` name, out of `files` (`path`).

    Entries are stripped of white space; empty ones and nulls name nothing. An entry names the file of that
    path, the files directly in the directory of that path (with or without slashes at its end), or, with *
    (any run of characters) or ? (one), neither a slash, all files that it matches. Patterns meet files by
    number of slashes and the directory before the first wildcard, so that no cross join is needed.
    """
    paths = files.select("path").where(F.col("path").isNotNull()).distinct()
    entries = (
        specs.select("batch_no", F.explode("exclude_inputs").alias("entry"))
        .select("batch_no", F.regexp_replace("entry", r"^[\s\x{A0}\x{200B}\x{3000}]+|[\s\x{A0}\x{200B}\x{3000}]+$", "").alias("entry"))
        .where("entry <> ''").distinct()
    )
    exact, pattern = entries.where(~F.col("entry").rlike("[*?]")), entries.where(F.col("entry").rlike("[*?]"))
    as_file = exact.select("batch_no", F.col("entry").alias("path")).join(paths, "path", "left_semi")
    folder = paths.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("entry")).where(F.col("path").contains("/"))
    as_folder = exact.select("batch_no", F.regexp_replace("entry", "/+$", "").alias("entry")).join(folder, "entry")
    slashes = lambda c: F.size(F.split(c, "/")) - 1
    parts = F.split("path", "/")
    known = paths.select(
        "path", slashes("path").alias("slashes"), F.explode(F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.concat_ws("/", F.slice(parts, F.lit(1), i)))).alias("start")
    )
    quoted = F.regexp_replace("entry", r"([\\.^$|()\[\]{}+])", r"\\$1")
    rule = F.concat(F.lit("(?s)^"), F.replace(F.replace(quoted, F.lit("*"), F.lit("[^/]*")), F.lit("?"), F.lit("[^/]")), F.lit("\\z"))
    ruled = pattern.select("batch_no", rule.alias("rule"), slashes("entry").alias("slashes"), F.regexp_replace(F.regexp_extract("entry", r"^([^*?]*)/[^/]*[*?]", 1), "/+$", "").alias("start"))
    matched = ruled.join(known, ["slashes", "start"]).where(F.expr("path rlike rule"))
    return as_file.select("batch_no", "path").unionByName(as_folder.select("batch_no", "path")).unionByName(matched.select("batch_no", "path")).distinct()


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decides ids in order: links (`row, there, known`) are sorted by batch and row, and lead to earlier ids.

    An id is accepted unless one that it links to is. `known` says so of ids that were decided before.
    """
    taken: set[int] = set()
    node, hit = None, False
    rows: list[int] = []
    verdicts: list[bool] = []
    for batch in batches:
        for row, there, known in zip(*(batch[c].to_pylist() for c in ("row", "there", "known")), strict=True):
            if row != node:
                if node is not None:
                    rows.append(node)
                    verdicts.append(not hit)
                    if not hit:
                        taken.add(node)
                node, hit = row, False
            hit = hit or bool(known) or (known is None and there in taken)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(verdicts, pa.bool_())], names=["row", "accepted"])
        rows, verdicts = [], []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([not hit], pa.bool_())], names=["row", "accepted"])


def _parts(links: DataFrame) -> DataFrame:
    """`node, part`: connected parts of links (`row, there`), named by their smallest node.

    Each node takes the smallest part among its neighbours, and then the part of its part, so that the ways
    double from round to round, until nothing changes.
    """
    edges = materialize(links.select(F.col("row").alias("node"), "there").unionByName(links.select(F.col("there").alias("node"), F.col("row").alias("there"))).distinct(), "edges")
    parts = materialize(edges.groupBy("node").agg(F.min("there").alias("near")).select("node", F.least("node", "near").alias("part")), "parts")
    while True:
        near = edges.join(parts.select(F.col("node").alias("there"), "part"), "there").groupBy("node").agg(F.min("part").alias("near"))
        lower = parts.join(near, "node").select("node", F.least("part", "near").alias("part"), F.col("part").alias("was"))
        lower = materialize(lower, "lower-parts")
        heads = lower.select(F.col("node").alias("part"), F.col("part").alias("head"))
        after = materialize(lower.join(heads, "part", "left").select("node", F.least("part", "head").alias("part"), "was"), "parts")
        parts = after.select("node", "part")
        if after.where("part <> was").isEmpty():
            return parts


def _resolved(links: DataFrame, state: DataFrame) -> DataFrame:
    """`row, accepted` of all open ids, from deciding links (`batch_no, row, there`) and `state` (`row, accepted`, null while open)."""
    known = state.select(F.col("row").alias("there"), F.col("accepted").alias("known"))
    open_ = links.join(state.where("accepted is null").select("row"), "row", "left_semi").join(known, "there").select("batch_no", "row", "there", "known")
    open_ = materialize(open_, "open-links")
    found: list[DataFrame] = []
    while True:
        n = open_.count()
        if n <= AT_ONCE:
            if n or not found:
                found.append(open_.coalesce(1).sortWithinPartitions("batch_no", "row").mapInArrow(_decide, "row long, accepted boolean"))
            break
        # Parts that don't exceed what one task decides are decided now, several to a task.
        undecided = open_.where("known is null")
        parts = _parts(undecided.select("row", "there"))
        placed = materialize(open_.join(parts.select(F.col("node").alias("row"), "part"), "row", "left").withColumn("part", F.coalesce("part", "row")), "placed-links")
        giant = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > AT_ONCE).select("part")
        tasks = max(shuffle_partitions(open_.sparkSession), -(-n // AT_ONCE))
        small = placed.join(giant, "part", "left_anti").repartition(tasks, "part").sortWithinPartitions("batch_no", "row")
        found.append(materialize(small.mapInArrow(_decide, "row long, accepted boolean"), "decided"))
        # Of the rest, those whose earlier ids are all decided, or one of them accepted.
        rest = placed.join(giant, "part", "left_semi")
        votes = rest.groupBy("row").agg(F.coalesce(F.max("known"), F.lit(False)).alias("any"), F.count_if(F.col("known").isNull()).alias("waiting"))
        ready = materialize(votes.where("any or waiting = 0").select("row", (~F.col("any")).alias("accepted")), "decided")
        found.append(ready)
        left = rest.join(ready.select("row"), "row", "left_anti").join(ready.select(F.col("row").alias("there"), F.col("accepted").alias("now")), "there", "left")
        open_ = materialize(left.select("batch_no", "row", "there", F.coalesce("known", "now").alias("known")), "open-links")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def repeated_rows(
    selections: DataFrame, specs: DataFrame, root: str | None = None, parts: int = 1, sizes: Sequence[int] = (8 * MB, 4, 2)
) -> DataFrame:
    """Rows of new batches that repeat an accepted row: `accepted_row_no, row_no`.

    Rows of batches with status `accepted` are accepted. Rows of `new` batches are taken in order of
    `batch_no, row_no`: a row whose id equals, or is one edit apart from, that of an accepted row that lies in
    a file named by the batch's `exclude_inputs` or comes earlier in the same batch is a repeat and not
    accepted, and comes out with the smallest such row; any other is accepted. Ids are compared by their ASCII
    letters and digits without case; null ids match none, ids without letters and digits match one another.
    Batches with another or no status, and rows of batches that aren't listed, take no part. Row numbers must
    be unique. Empty tables give no rows; extra columns are ignored.

    `root` keeps the history between calls: accepted batches that it holds already needn't be given again, and
    are skipped if they are, so a later call takes in what is new and reads of the history only the ranges of
    its own keys and matches. Rows of a new batch enter the history once the batch is given as accepted.
    Without root the history is built from the batches given. It is taken in as `parts` runs; `sizes` are unit,
    fanout and top of the runs.

    Only the first row of an id in a batch can be accepted, so all matching happens between distinct ids, and
    an id with any number of rows is one node.
    """
    spark = selections.sparkSession
    status = specs.select("batch_no", "status").where(F.col("status").isin("accepted", "new")).distinct()
    rows = (
        selections.where(F.col("id").isNotNull()).select("row_no", "batch_no", "path", plain("id").alias("id"))
        .join(status, "batch_no").select("row_no", "batch_no", F.coalesce("path", F.lit("")).alias("path"), "id", "status")
    )
    history = History(spark, root or work_path(spark, "history"), *sizes)
    new = rows.where("status = 'new'")
    firsts = new.groupBy("batch_no", "id").agg(F.min(F.struct("row_no", "path")).alias("f")).select("batch_no", "id", F.col("f.row_no").alias("row"), F.col("f.path").alias("path"))
    with ThreadPoolExecutor(1) as beside:
        first = beside.submit(materialize, firsts, "new-ids")
        history.accept(rows.where("status = 'accepted'"), parts)
        nodes = first.result()
    n = nodes.count()
    ids = nodes.select("id").distinct()
    alike = materialize(history.matches(ids, n).unionByName(ids.select("id", F.col("id").alias("other"))), "matches")
    met = materialize(history.places_of(alike.select(F.col("other").alias("id")).distinct(), n), "matched-places")
    named = materialize(named_files(specs.where("status = 'new'"), met.select("path").unionByName(nodes.select("path"))), "named-files")
    names = F.broadcast(named) if named.count() <= MOST_NAMED else named

    # Of what history and new batches hold, what each batch may look at, one row for each id and batch.
    near = nodes.select("batch_no", "id", "row").join(alike, "id")
    seen = met.join(names, "path").groupBy("batch_no", F.col("id").alias("other")).agg(F.min("row").alias("there"))
    past = near.join(seen, ["batch_no", "other"]).groupBy("row").agg(F.min("there").alias("past"))
    other = nodes.select(F.col("id").alias("other"), F.col("batch_no").alias("other_batch"), F.col("row").alias("there"), "path")
    earlier = other.join(names, "path").where("other_batch < batch_no").select("batch_no", "other", "there", F.lit(False).alias("beside"))
    beside = other.select(F.col("other_batch").alias("batch_no"), "other", "there", F.lit(True).alias("beside"))
    links = materialize(
        near.join(earlier.unionByName(beside), ["batch_no", "other"]).where("id <> other or not beside").select("batch_no", "row", "there", "beside"), "links"
    )
    # A link decides if the other comes first. Ids met in history are rejected, ids without deciding links accepted.
    deciding = links.where("not beside or there < row").select("batch_no", "row", "there")
    state = nodes.select("batch_no", "id", "row").join(past, "row", "left").join(deciding.select("row", F.lit(True).alias("linked")).distinct(), "row", "left")
    state = materialize(state.withColumn("accepted", F.when(F.col("past").isNotNull(), False).when(F.col("linked").isNull(), True)), "state")
    decided = state.where("accepted is not null").select("row", "accepted").unionByName(_resolved(deciding, state.select("row", "accepted")))
    taken = decided.where("accepted").select("row")
    hits = links.join(taken.select(F.col("row").alias("there")), "there", "left_semi").unionByName(
        taken.select(F.lit(None).cast("int").alias("batch_no"), "row", F.col("row").alias("there"), F.lit(True).alias("beside"))
    )
    firsts = hits.groupBy("row").agg(F.min(F.when(~F.col("beside"), F.col("there"))).alias("before"), F.min(F.when(F.col("beside"), F.col("there"))).alias("beside"))
    verdict = state.select("batch_no", "id", "row", "past").join(firsts, "row", "left").select("batch_no", "id", F.least("past", "before").alias("first"), "beside")
    return (
        new.select("row_no", "batch_no", "id").join(verdict, ["batch_no", "id"])
        .select(F.least("first", F.when(F.col("beside") < F.col("row_no"), F.col("beside"))).alias("accepted_row_no"), "row_no")
        .where("accepted_row_no is not null")
    )
