"""Tables kept as size-tiered runs under a journal of numbered versions.

A run is what one transaction wrote: files that together cover the hash space of a table, cut into a power of
two of ranges, its slots, so that a reader who knows the hashes it looks for opens only the slots that may hold
them. Runs of about one size, a tier, are merged into one of the next as soon as there are `fanout` of them.

Every version of the journal is one small file that names all live runs and what the transaction took in and
gave out. Whoever creates the next number has committed; whoever comes second looks at the new version and
tries again. Each attempt writes into a folder of its own, so a step that died, or lost, leaves only a folder
that no version names.
"""

from __future__ import annotations

import json
import math
import os
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import remove_path

MB = 1 << 20
#: Seconds for which files that no longer belong to a table are kept for those who still read them.
RETENTION = 86_400.0
#: Leading bits of hashes by which slots are chosen: at most 2 ** PREFIX numbers go to the driver.
PREFIX = 12
#: Attempts of a transaction while others commit.
ATTEMPTS = 50


@dataclass(frozen=True)
class Run:
    """A committed run of one table: its folder, slots, those of them without rows, files, rows and bytes."""

    name: str
    kind: str
    slots: int
    empty: tuple[int, ...]
    files: int
    rows: int
    size: int


@dataclass(frozen=True)
class State:
    """A version: the live runs, folders that are no longer live and since when, notes, and the step that made it."""

    version: int = 0
    runs: tuple[Run, ...] = ()
    gone: dict[str, float] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)
    step: dict[str, object] = field(default_factory=dict)

    def of(self, kind: str) -> list[Run]:
        return [r for r in self.runs if r.kind == kind]


@dataclass
class Change:
    """What a transaction does: runs it adds, names of those it consumes, notes it sets."""

    step: str
    adds: list[Run] = field(default_factory=list)
    consumes: list[str] = field(default_factory=list)
    notes: dict[str, object] = field(default_factory=dict)
    inputs: object = None


class Journal:
    """The versions of a store. On object stores without an atomic rename there must be one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, retention: float = RETENTION) -> None:
        self.spark, self.root, self.retention = spark, root.rstrip("/"), retention
        jvm = spark.sparkContext._jvm
        self._path, self._jvm = jvm.org.apache.hadoop.fs.Path, jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(f"{self.root}/journal"))

    def data(self, name: str) -> str:
        return f"{self.root}/data/{name}"

    def _versions(self) -> list[int]:
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/journal")))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _file(self, version: int) -> str:
        return f"{self.root}/journal/{version:012d}.json"

    def state(self) -> State:
        """The newest version; an empty one if there is none."""
        versions = self._versions()
        if not versions:
            return State()
        stream = self._fs.open(self._path(self._file(versions[-1])))
        try:
            found = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        runs = tuple(Run(**{**r, "empty": tuple(r["empty"])}) for r in found.pop("runs"))
        return State(**found, runs=runs)

    def commit(self, state: State) -> bool:
        """Writes a version; False, and nothing is changed, if the one before it isn't the newest.

        Between that look and the new name another writer may commit, which the name shows; that its version
        would also be deleted again in between is kept out by the retention time.
        """
        draft = f"{self.root}/journal/.{uuid.uuid4().hex}.draft"
        body = asdict(state)
        stream = self._fs.create(self._path(draft), True)
        try:
            stream.write(json.dumps(body, sort_keys=True).encode())
        finally:
            stream.close()
        try:
            versions = self._versions()
            return (versions[-1] if versions else 0) == state.version - 1 and self._put(draft, self._file(state.version))
        finally:
            self._fs.delete(self._path(draft), False)

    def _put(self, draft: str, entry: str) -> bool:
        """Gives the draft its name unless there is such a file."""
        if self._fs.getUri().getScheme() == "file":  # its rename would replace what is there
            try:
                os.link(self._path(draft).toUri().getPath(), self._path(entry).toUri().getPath())
            except FileExistsError:
                return False
            return True
        return not self._fs.exists(self._path(entry)) and bool(self._fs.rename(self._path(draft), self._path(entry)))

    def transact(self, make: Callable[[State], Change | None]) -> Change | None:
        """Makes a change of the newest version and commits it.

        If another writer was first, a change that only consumes runs which are still live is kept, as a merge
        is right whatever was added; any other is made again from the new version.
        """
        change = None
        for _ in range(ATTEMPTS):
            state = self.state()
            live = {r.name for r in state.runs}
            if change is None or not change.consumes or not live.issuperset(change.consumes):
                self.drop(change)
                change = make(state)
                if change is None:
                    return None
            gone = state.gone | dict.fromkeys(change.consumes, time.time())
            runs = tuple(r for r in state.runs if r.name not in change.consumes) + tuple(r for r in change.adds if r.rows)
            step = {"kind": change.step, "inputs": change.inputs or change.consumes, "outputs": [r.name for r in change.adds]}
            if self.commit(replace(state, version=state.version + 1, runs=runs, gone=gone, notes=state.notes | change.notes, step=step)):
                return change
        raise OSError(f"others wrote to {self.root} all the time")

    def drop(self, change: Change | None) -> None:
        for run in change.adds if change else ():
            remove_path(self.spark, self.data(run.name))

    def vacuum(self) -> None:
        """Deletes files and versions that have been out of use for the retention time, which must be longer than any step takes."""
        state, limit = self.state(), time.time() - self.retention
        old = [name for name, since in state.gone.items() if since <= limit]
        if old:
            kept = {k: v for k, v in state.gone.items() if k not in old}
            if not self.commit(replace(state, version=state.version + 1, gone=kept, step={"kind": "vacuum", "inputs": old, "outputs": []})):
                return
            state = self.state()
        named = {r.name for r in state.runs} | set(state.gone)
        folder = self._path(f"{self.root}/data")
        if self._fs.exists(folder):
            for status in self._fs.listStatus(folder):
                name = status.getPath().getName()
                if name in old or (name not in named and status.getModificationTime() / 1000 <= limit):
                    self._fs.delete(status.getPath(), True)
        for status in self._fs.listStatus(self._path(f"{self.root}/journal")):
            stem = status.getPath().getName().removesuffix(".json")
            if status.getModificationTime() / 1000 <= limit and not (stem.isdigit() and int(stem) >= state.version):
                self._fs.delete(status.getPath(), False)


def slot_of(hash_: Column, slots: int) -> Column:
    """The slot of a 64-bit hash among a power of two: its leading bits."""
    bits = slots.bit_length() - 1
    return F.shiftrightunsigned(hash_, 64 - bits).cast("int") if bits else F.lit(0)


class Table:
    """One table of a store: `kind` in the journal, cut by the hash of `keys`, sorted by `order` inside of a slot.

    `unit` is the least size of a file in bytes, `fanout` how many runs of a tier make one of the next, `top` the
    last tier whose files grow: they reach unit * fanout ** top. Runs of `largest` bytes are merged no more, and runs below a unit as soon
    as there are `small` of them.
    """

    def __init__(
        self, journal: Journal, kind: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str], unit: int = 8 * MB, fanout: int = 4, top: int = 2, largest: int = 1 << 40, small: int = 2
    ) -> None:
        if fanout < 2 or unit < 1 or top < 0:
            raise ValueError("fanout must be at least 2, unit at least 1 and top at least 0")
        self.journal, self.kind, self.schema, self.keys, self.order = journal, kind, schema, list(keys), list(order)
        self.unit, self.fanout, self.top, self.largest, self.small = unit, fanout, top, largest, small
        fixed = 8 * sum(not isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in schema)
        self.weight = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) for f in schema if isinstance(f.dataType, (T.StringType, T.BinaryType))), F.lit(fixed))

    @property
    def hash(self) -> Column:
        return F.xxhash64(*self.keys)

    def tier(self, size: int) -> int:
        """The tier of a run of some bytes: 0 below the size of a unit times fanout."""
        return int(math.log(max(size / self.unit, 1), self.fanout) + 1e-9)

    def slots(self, size: int) -> int:
        """As many slots as files of this tier's size fit in, rounded down to a power of two, so none gets smaller than that."""
        whole = size // (self.unit * self.fanout ** min(self.tier(size), self.top))
        return 1 << max(0, int(whole).bit_length() - 1)

    def read(self, state: State, prefixes: Iterable[int] | None = None, bits: int = 0) -> DataFrame:
        """All rows of a version, or those of slots that hold hashes with one of some prefixes of so many bits."""
        spark, paths = self.journal.spark, []
        wanted = None if prefixes is None else set(prefixes)
        for run in state.of(self.kind):
            width = run.slots.bit_length() - 1
            if wanted is None:
                paths.append(self.journal.data(run.name))
                continue
            if width <= bits:
                here = {p >> (bits - width) for p in wanted}
            else:
                here = {(p << (width - bits)) + i for p in wanted for i in range(1 << (width - bits))}
            paths += [f"{self.journal.data(run.name)}/run_slot={s}" for s in sorted(here.difference(run.empty))]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*paths)

    def most_slots(self, state: State) -> int:
        return max((r.slots for r in state.of(self.kind)), default=1)

    def around(self, state: State, rows: DataFrame, expected: int | None = None) -> DataFrame:
        """Rows of the slots that the hashes of some `rows` with the key columns lie in; all, if `expected` rows meet every slot anyway."""
        most = self.most_slots(state)
        if most == 1 or (expected or 0) > 4 * most:
            return self.read(state)
        bits = min(PREFIX, most.bit_length() - 1)
        found = rows.select(F.shiftrightunsigned(self.hash, 64 - bits).cast("int").alias("p")).distinct().collect()  # at most 2 ** PREFIX rows
        return self.read(state, [r.p for r in found], bits)

    def write(self, rows: DataFrame, size: int, spread: int = 1) -> Run:
        """Writes rows as a run of about `size` bytes; with `spread`, each slot as so many files by the hash of whole rows."""
        slots, name, seen = self.slots(size), f"{self.kind}-{uuid.uuid4().hex}", Observation()
        out = rows.select(*self.schema.fieldNames()).withColumn("run_slot", slot_of(self.hash, slots))
        place = F.col("run_slot") * spread + (F.pmod(F.xxhash64(*self.order), F.lit(spread)).cast("int") if spread > 1 else 0)
        out = out.repartitionById(slots * spread, place).sortWithinPartitions("run_slot", *self.order)
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(self.weight).alias("size"))
        out.write.partitionBy("run_slot").option("compression", "zstd").parquet(self.journal.data(name))
        fs, path = self.journal._fs, self.journal._path
        filled, files = set(), 0
        for status in fs.listStatus(path(self.journal.data(name))):
            if status.isDirectory() and status.getPath().getName().startswith("run_slot="):
                filled.add(int(status.getPath().getName()[9:]))
                files += sum(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(status.getPath())) if spread > 1 else 1
        return Run(name, self.kind, slots, tuple(s for s in range(slots) if s not in filled), files, seen.get["rows"], seen.get["size"] or 0)

    def due(self, state: State) -> list[Run]:
        """Runs to be merged next: all that are below a unit, if they are enough, or a tier that holds fanout runs."""
        runs = [r for r in state.of(self.kind) if r.size < self.largest]
        small = [r for r in runs if r.size < self.unit]
        if len(small) >= max(2, self.small):
            return small
        for tier in sorted({self.tier(r.size) for r in runs}):
            same = [r for r in runs if self.tier(r.size) == tier]
            if len(same) >= self.fanout:
                return same
        return []

    def compact(self) -> list[Run]:
        """Merges until nothing is due; the runs it made."""
        made = []

        def merge(state: State) -> Change | None:
            runs = self.due(state)
            if not runs:
                return None
            size = sum(r.size for r in runs)
            spread = max(-(-r.files // max(1, r.slots - len(r.empty))) for r in runs)
            return Change(f"merge {self.kind}", [self.write(self.read(replace(state, runs=tuple(runs))), size, spread)], [r.name for r in runs])

        while change := self.journal.transact(merge):
            made += change.adds
        return made
