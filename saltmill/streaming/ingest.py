"""Stream sources and the landing of parsed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.paths import children

CORRUPT = "_corrupt"


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int = 1000) -> DataFrame:
    """A parquet table, one file or a folder of files, as a file stream in bounded batches."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # As a glob the path may name a single file too.
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(f"{sf_dir}/{name}.parque[t]")
    )


def text_pairs(stream: DataFrame) -> DataFrame:
    """Binary (key, value) as text."""
    return stream.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def parse_values(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text to columns; text that is of no use is kept in ``_corrupt``.

    That is text that does not parse, lacks a field declared not nullable, or has
    none of the fields.
    """
    fields = [T.StructField(f.name, f.dataType) for f in schema]
    full = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.withColumn("_p", F.from_json(value, full, opts))
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull()
    empty = F.lit(True)
    for f in schema:
        missing = F.col(f"_p.{f.name}").isNull()
        empty = empty & missing
        if not f.nullable:
            bad = bad | missing
    return parsed.select(
        *[F.col(f"_p.{f}").alias(f) for f in schema.fieldNames()],
        F.when(bad | empty, F.coalesce(F.col(value), F.lit(""))).alias(CORRUPT),
    )


def write_batches(
    parsed: DataFrame, out_dir: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write rows and rejects of each batch in one pass.

    Each batch has its own folder, written with overwrite, so a batch that runs
    again leaves no copies. ``every`` is the poll interval ("5 seconds"); without
    it the query handles what is there and stops.
    """
    marked = parsed.withColumn("rejected", F.col(CORRUPT).isNotNull())

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("rejected")
            .parquet(f"{out_dir}/batch_id={batch_id}")
        )

    writer = marked.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def land_batches(stream: DataFrame, out_dir: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the rows of a stream, a folder per batch; see ``write_batches`` for the replay and ``every``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()


def read_batches(
    spark: SparkSession, out_dir: str, schema: T.StructType, batches: list[int] | None = None
) -> DataFrame:
    """Written batches (all, or those listed) with ``batch_id``, ``rejected`` and ``_corrupt``."""
    extra = [(CORRUPT, T.StringType()), ("batch_id", T.LongType()), ("rejected", T.BooleanType())]
    full = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in extra]])
    if not (children(spark, out_dir) if batches is None else batches):
        return spark.createDataFrame([], full)
    read = spark.read.schema(full).option("basePath", out_dir)
    if batches is None:
        return read.parquet(out_dir)
    return read.parquet(*[f"{out_dir}/batch_id={b}" for b in batches])


def ingest_stream(
    stream: DataFrame, schema: T.StructType, out_dir: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Parse JSON texts and write good rows and rejects, see ``write_batches``."""
    return write_batches(parse_values(stream, schema), out_dir, checkpoint, every)


def ingested(spark: SparkSession, out_dir: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of all batches; a reject is its text as ``value``."""
    rows = read_batches(spark, out_dir, schema)
    good = rows.where(~F.col("rejected")).select(*schema.fieldNames())
    return good, rows.where("rejected").select(F.col(CORRUPT).alias("value"))
