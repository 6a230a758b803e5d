"""Continuous forecasting, monitoring and storing of messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import documents as docs
from ..operators import messages as msg
from ..operators.forecast import Predictor, forecast
from ..schemas import HORIZON
from ..session import scratch
from ..sinks.topics import publish
from ..sources.topics import POSITION, positioned

BatchWriter = Callable[[DataFrame, int], None]


def _start(writer, available_now: bool, every: str | None) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def run_id(spark: SparkSession) -> str:
    """The id that a query keeps over restarts, as long as its checkpoint lives."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def per_batch_folder(path: str, format: str = "parquet", partition_by: tuple[str, ...] = ()) -> BatchWriter:
    """A writer that puts a batch into ``path/run=…/batch_id=…``, replacing it on a retry.

    A batch that is run again after a failure overwrites its own folder, so
    restarts neither lose nor repeat rows. A new checkpoint is a run of its own
    and overwrites nothing, but stores again what it reads again;
    ``committed_folder`` does not.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        out = rows.write.mode("overwrite").format(format)
        if partition_by:
            out = out.partitionBy(*partition_by)
        out.save(f"{path}/run={run_id(rows.sparkSession)}/batch_id={batch_id}")

    return write


DOCUMENTS, LEDGER = "documents", "ledger"
_LEDGER_SCHEMA = "source string, first long, last long, run string, batch_id long"


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """What was committed below ``path``: a range of positions per batch and source.

    Each committed batch has one further row without a source.
    """
    if not _exists(spark, f"{path}/{LEDGER}"):
        return spark.createDataFrame([], _LEDGER_SCHEMA)
    return spark.read.schema(_LEDGER_SCHEMA).parquet(f"{path}/{LEDGER}")


def committed_folder(path: str, partition_by: tuple[str, ...] = ()) -> BatchWriter:
    """A writer that stores each message once, whichever checkpoint it is read with.

    Rows need ``position``. A batch is written to its own folder, then its commit
    record to the ledger: the first and last position it has seen of each source.
    A batch whose record exists is not written again; one that failed before is
    replaced. A new run leaves out the positions that other runs have committed.
    ``committed`` reads only batches with a record, so what an abandoned run left
    half done does not count. Batches of one query follow each other, and a path
    takes one running query at a time.
    """
    earlier: dict[str, DataFrame] = {}

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        run = run_id(spark)
        record = f"{path}/{LEDGER}/run={run}/batch_id={batch_id}"
        if _exists(spark, f"{record}/_SUCCESS"):
            return
        if run not in earlier:
            # Other runs are over, so their ledger is read once.
            ranges = ledger(spark, path).filter((F.col("run") != run) & F.col("source").isNotNull())
            earlier[run] = ranges.select("source", "first", "last")
        known = earlier[run]
        nth = F.col("position.nth")
        seen = (F.col("position.source") == known["source"]) & nth.between(known["first"], known["last"])
        out = rows.join(known, seen, "left_anti").write.mode("overwrite")
        if partition_by:
            out = out.partitionBy(*partition_by)
        out.parquet(f"{path}/{DOCUMENTS}/run={run}/batch_id={batch_id}")
        ranges = rows.groupBy("position.source").agg(
            F.min("position.nth").alias("first"), F.max("position.nth").alias("last")
        )
        mark = spark.createDataFrame([(None, None, None)], "source string, first long, last long")
        ranges.union(mark).coalesce(1).write.mode("overwrite").parquet(record)

    return write


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``committed_folder`` has stored, of committed batches alone."""
    stored = spark.read.parquet(f"{path}/{DOCUMENTS}").withColumns({
        "run": F.col("run").cast("string"), "batch_id": F.col("batch_id").cast("long"),
    })
    done = ledger(spark, path).filter("source is null").select("run", "batch_id")
    return stored.join(done, ["run", "batch_id"], "left_semi").drop("run", "batch_id")


def to_topic(format: str = "kafka", **options: str) -> BatchWriter:
    """A writer that publishes each batch. A retried batch is published again;
    readers make rows unique by key, as ``reconcile`` does."""

    def write(rows: DataFrame, batch_id: int) -> None:
        publish(rows, format, **options)

    return write


def to_collections(format: str = "mongodb", **options: str) -> BatchWriter:
    """A writer for document stores: one append per collection.

    ``{collection}`` in an option stands for the collection's name. Documents
    carry ``_id``, a digest of the message's position, so a store that replaces
    by ``_id`` holds each message once however often a batch is retried, equal
    messages are all kept, and batch sizes change nothing.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        digest = F.sha2(F.concat_ws("/", f"{POSITION}.source", f"{POSITION}.nth"), 256)
        identified = rows.withColumn("_id", digest).drop(POSITION).persist()
        try:
            for collection in (*docs.COLLECTIONS.values(), docs.FORECASTS, docs.REJECTS):
                chosen = identified.filter(F.col("collection") == collection).drop("collection")
                named = {k: v.format(collection=collection) for k, v in options.items()}
                chosen.write.format(format).mode("append").options(**named).save()
        finally:
            identified.unpersist()

    return write


def start_forecasts(
    messages: DataFrame,
    predict: Predictor | Transformer,
    write: BatchWriter,
    checkpoint: str,
    horizon: int = HORIZON,
    available_now: bool = False,
    every: str | None = None,
    name: str = "recursive_forecast",
) -> StreamingQuery:
    """Forecast every trigger of each micro-batch and hand the messages to ``write``.

    Tables that the steps of a model need are gone when the batch is written.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            with scratch(batch.sparkSession, "forecast-batch"):
                write(msg.forecast_messages(forecast(batch, predict, horizon)), batch_id)

    writer = (
        msg.parse_triggers(messages).writeStream.queryName(name)
        .outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(handle)
    )
    return _start(writer, available_now, every)


def start_monitor(
    messages: DataFrame,
    checkpoint: str | None = None,
    format: str = "console",
    every: str | None = None,
    available_now: bool = False,
    name: str = "monitor",
    **options: str,
) -> StreamingQuery:
    """Pass the keys and values of a topic on to a display as they arrive.

    ``options`` go to the display; a console shows as many rows of a batch as
    its ``numRows`` says, by default Spark's own number.
    """
    display = monitor_view(messages).writeStream.format(format).options(**options)
    if checkpoint:
        display = display.option("checkpointLocation", checkpoint)
    return _start(display.outputMode("append").queryName(name), available_now, every)


def monitor_view(messages: DataFrame) -> DataFrame:
    """A topic read by ``topics`` holds text already, so columns are only renamed."""
    return messages.select(F.col("key").alias("pair"), F.col("value").alias("prediction_json"))


def start_document_sink(
    messages: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    known_only: bool = False,
    available_now: bool = True,
    every: str | None = None,
    name: str = "document_sink",
) -> StreamingQuery:
    """Route every message of each micro-batch into its collection, equal ones too."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write(docs.documents(positioned(batch), known_only), batch_id)

    writer = (
        messages.writeStream.queryName(name)
        .outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(handle)
    )
    return _start(writer, available_now, every)


def start_copy(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    available_now: bool = True,
    every: str | None = None,
    name: str = "drain",
) -> StreamingQuery:
    """Append a stream to files; with ``available_now`` it stops when all input is read."""
    writer = (
        rows.writeStream.queryName(name).outputMode("append").format(format)
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return _start(writer, available_now, every)


def wait_any(spark: SparkSession, seconds: float) -> bool:
    """Wait until one of the running queries ends, or the time is up."""
    return bool(spark.streams.awaitAnyTermination(int(seconds)))
