"""Intake of new candidate files as they arrive, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import source_stem
from ..operators.runs import Change, Journal, State, Table
from ..operators.sharding import assigned
from ..sources.smi import parse_lines


def candidate_stream(spark: SparkSession, folder: str, shards: int = 512, files_per_batch: int = 1000) -> DataFrame:
    """`smiles, id, source, shard_id` of the line files of a folder, as a stream; lines without id are left out."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).schema("value string").load(folder)
    parsed = parse_lines(lines.withColumn("source", source_stem(F.col("_metadata.file_name"))), missing="drop")
    return assigned(parsed.select("smiles", "id", "source"), shards=shards)


CANDIDATES = T.StructType([T.StructField(c, T.StringType()) for c in ("smiles", "id", "source")] + [T.StructField("shard_id", T.IntegerType())])


def candidate_runs(spark: SparkSession, root: str, **sizes: int) -> Table:
    """The candidates taken in so far, as size-tiered runs by shard."""
    return Table(Journal(spark, root), "candidates", CANDIDATES, ["shard_id"], ["shard_id", "id"], **sizes)


def take_into_runs(spark: SparkSession, folder: str, root: str, checkpoint: str, shards: int = 512, files_per_batch: int = 1000, **sizes: int) -> StreamingQuery:
    """Takes in all files that are there and weren't taken in before, as runs that are merged tier by tier, then stops.

    However many small batches come, few well-sized files are left. The number of the last batch is committed
    with its run, so a batch that is repeated after a crash adds nothing; one folder of checkpoints belongs to one root.
    """
    runs = candidate_runs(spark, root, **sizes)

    def add(batch: DataFrame, number: int) -> None:
        def take(state: State) -> Change | None:
            if state.notes.get("batch", -1) >= number:
                return None
            rows = batch.select(*CANDIDATES.fieldNames())
            size = rows.agg(F.coalesce(F.sum(runs.weight), F.lit(0))).first()[0]
            return Change("take in", [runs.write(rows, size)], notes={"batch": number}, inputs={"batch": number})

        runs.journal.transact(take)
        runs.compact()
        runs.journal.vacuum()

    return candidate_stream(spark, folder, shards, files_per_batch).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def take_in(spark: SparkSession, folder: str, target: str, checkpoint: str, shards: int = 512) -> StreamingQuery:
    """Takes in all files that are there and weren't taken in before, then stops.

    The checkpoint keeps which files are done, and the file sink commits a batch as a whole, so a run that
    dies is repeated without loss or doubling.
    """
    stream = candidate_stream(spark, folder, shards).repartition("shard_id")
    return (
        stream.writeStream.format("parquet").partitionBy("shard_id").option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
