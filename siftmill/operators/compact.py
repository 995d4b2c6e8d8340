"""Far too many small files (problem 2): size-tiered incremental compaction with a transaction journal.

New small files are taken in as a run of the tier of its real size; runs of one tier are merged into the next,
level by level, so that each record is rewritten once a tier and files end well-sized (see runs.py). The journal
records inputs and outputs of every step; which files were taken in is a table of the same store, so that a step
done again, at once by two writers, or after a crash adds nothing twice and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runs import MB, RETENTION, Change, Journal, Run, State, Table

INPUTS = T.StructType([T.StructField("path", T.StringType()), T.StructField("fingerprint", T.LongType())])


class RecordStore:
    """Records kept once each in few well-sized files.

    `identity` names the columns in which records must agree to be one, nulls included. `unit` is the least size
    of a file in bytes of text, `fanout` how many runs of a tier make one of the next, `top` the last tier
    whose files grow, so that files reach about unit * fanout ** top bytes.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, identity: list[str], unit: int = 8 * MB, fanout: int = 4, top: int = 2, retention: float = RETENTION
    ) -> None:
        self.spark, self.schema, self.identity = spark, schema, identity
        self.journal = Journal(spark, root, retention)
        self.records = Table(self.journal, "records", schema, identity, identity, unit, fanout, top)
        self.inputs = Table(self.journal, "inputs", INPUTS, ["path", "fingerprint"], ["path", "fingerprint"], unit, max(fanout, 4), top, small=8)

    def read(self) -> DataFrame:
        """All records; an empty table if nothing was added. Files of a frame stay readable for the retention time."""
        return self.records.read(self.journal.state())

    def unseen(self, files: DataFrame, state: State | None = None) -> DataFrame:
        """Those of `files` (with `path, fingerprint`) that no committed transaction took in."""
        state = state or self.journal.state()
        if not state.of("inputs"):
            return files
        return files.join(self.inputs.around(state, files), ["path", "fingerprint"], "left_anti")

    def add(self, files: DataFrame, parse: Callable[[DataFrame], DataFrame]) -> Run | None:
        """Adds the records of small files as a run; nothing if all of the files were taken in before.

        `files` has one row or more for each file (`path, size, fingerprint` and what parsing needs), and `parse`
        makes the records of those that weren't taken in yet. Records that the store holds already are left
        out, by a join on the identity columns alone with those slots that the hashes of the new records lie
        in. If another writer commits meanwhile, both are done again with what is there then.
        """

        def take(state: State) -> Change | None:
            fresh = self.unseen(files, state)
            listed = fresh.select(F.col("path").cast("string"), F.col("size").cast("long"), F.col("fingerprint").cast("long")).distinct()
            n, mark, size = listed.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "size", "fingerprint").cast("decimal(38,0)")), F.sum("size")).first()
            if not n:
                return None
            new = parse(fresh).select(*self.schema.fieldNames()).dropDuplicates(self.identity)
            if state.of("records"):
                old = self.records.around(state, new, n).select(*(F.col(c).alias(f"__{c}") for c in self.identity))
                new = new.join(old, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in self.identity)), "left_anti")
            with ThreadPoolExecutor(1) as beside:  # the list of files is written while the records are
                taken = beside.submit(self.inputs.write, listed, 64 * n)
                made = self.records.write(new, int(size or 0))
            return Change("add", [made, taken.result()], inputs={"files": n, "mark": str(mark), "bytes": size})

        change = self.journal.transact(take)
        return change.adds[0] if change else None

    def compact(self) -> list[Run]:
        """Merges, of the records and of the list of files, what is due; the runs that were made."""
        return self.records.compact() + self.inputs.compact()

    def vacuum(self) -> None:
        """Deletes what has been out of use for the retention time."""
        self.journal.vacuum()


POSE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("member_id", T.StringType()),
        T.StructField("site_id", T.StringType()),
        T.StructField("mode", T.IntegerType()),
        T.StructField("affinity_kcal_mol", T.DoubleType()),
        T.StructField("rmsd_lb", T.DoubleType()),
        T.StructField("rmsd_ub", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("text_hash", T.BinaryType()),
    ]
)
#: Two pose records are one if they agree in these: blocks of other text are other records.
POSE_IDENTITY = ["id", "member_id", "site_id", "mode", "affinity_kcal_mol", "rmsd_lb", "rmsd_ub", "text_hash"]


def pose_store(spark: SparkSession, root: str, **sizes: float) -> RecordStore:
    """A store of pose records; a text is compared by its SHA-256, so that merges and joins don't carry it as a key."""
    return RecordStore(spark, root, POSE_SCHEMA, POSE_IDENTITY, **sizes)


def pack_pose_files(store: RecordStore, files: DataFrame, parts: int = 1) -> list[Run]:
    """Takes new pose files (`path, id, member_id, site_id, content`) into a store and compacts it; the runs that were made.

    Sizes are taken from the contents, as listed sizes may be missing or stale. Null, empty and broken files
    add what they hold, maybe nothing; files listed twice or with equal records add each record once. An
    empty table does nothing. Calling it again with the same files, also after a crash, changes nothing.

    The files are taken in `parts` transactions, by the hash of their path, so a crash costs at most one of
    them. Files that were merged are deleted once the retention time is over.
    """
    from ..sources.pose_text import pose_records

    if parts < 1:
        raise ValueError(f"there must be a part, not {parts}")
    named = files.select(
        F.coalesce("path", F.lit("")).alias("path"), "id", "member_id", "site_id", "content", F.coalesce(F.octet_length("content"), F.lit(0)).alias("size"),
        F.xxhash64("id", "member_id", "site_id", "content").alias("fingerprint"),
    )


    def parse(fresh: DataFrame) -> DataFrame:
        return pose_records(fresh.select("id", "member_id", "site_id", "content")).withColumn("text_hash", F.unhex(F.sha2("text", 256)))

    made = [store.add(named.where(F.pmod(F.xxhash64("path"), F.lit(parts)) == part) if parts > 1 else named, parse) for part in range(parts)]
    made = [r for r in made if r] + store.compact()
    store.vacuum()
    return made
