"""File, JDBC and message sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import PADDED, rental_schema


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = False, **options: str
) -> DataFrame:
    """CSV with a header (unless ``header="false"``) and a declared schema.

    Columns bind by position: columns past the schema are dropped and values that
    do not parse become NULL. ``strict`` compares the header with the schema
    instead and fails on a difference.
    """
    given = {"header": "true", "enforceSchema": "false" if strict else "true"} | options
    return spark.read.schema(schema).options(**given).csv(path)


def read_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): rejects are the rows with a value that does not parse, or with more
    or fewer values than columns; ``_record`` holds the line of the latter.

    The file is read as text columns and cast, so a bad value is seen instead of lost.
    """
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*schema.names, "_record"]])
    raw = read_csv(spark, path, text, columnNameOfCorruptRecord="_record", mode="PERMISSIVE", **options)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema}
    bad = F.col("_record").isNotNull()
    for f in schema:
        bad = bad | (F.col(f.name).isNotNull() & typed[f.name].isNull())
    rows = raw.where(~bad).select(*[typed[f.name].alias(f.name) for f in schema])
    return rows, raw.where(bad)


def list_items(c: Column) -> Column:
    """Items of a list written {a,"b, c"}: quoted, or free of commas, quotes and braces."""
    items = F.regexp_extract_all(c, F.lit(r'"(?:[^"\\]|\\.)*"|[^{},"]+'), F.lit(0))

    def bare(x: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(x, '^"|"$', ""), r"\\(.)", "$1")

    return F.transform(items, bare)


def read_rental_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV dump of a rental table in its declared types.

    Blank-padded names are trimmed; bytes are written as 0x...; lists as {a,"b c"};
    search tokens as 'token':position pairs.
    """
    schema = rental_schema(table)
    as_text = (T.ArrayType, T.BinaryType)
    read_as = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, as_text) else f.dataType)
            for f in schema
        ]
    )

    def typed(f: T.StructField) -> Column:
        c = F.col(f.name)
        if f.name == "fulltext":
            c = F.regexp_extract_all(c, F.lit("'([^']+)'"), F.lit(1))
        elif isinstance(f.dataType, T.ArrayType):
            c = list_items(c)
        elif isinstance(f.dataType, T.BinaryType):
            c = F.unhex(F.substring(c, 3, 2147483647))
        elif f.name in PADDED.get(table, []):
            c = F.rtrim(c)
        return c.alias(f.name)

    # Lists and search tokens hold doubled quotes.
    return read_csv(spark, path, read_as, escape='"').select(*[typed(f) for f in schema])


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Multi-line JSON; a top-level array gives one row per element."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path, multiLine=True)


RECORD = "_record"


def _read_records(
    spark: SparkSession, raw_dir: str, schema: T.StructType | str, indented: bool, pattern: str
) -> DataFrame:
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # Required fields are checked later: read as such, a missing one would fail the job.
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    read = (
        spark.read.schema(loose.add(RECORD, T.StringType()))
        .option("columnNameOfCorruptRecord", RECORD)
        .option("mode", "PERMISSIVE")
        .json(raw_dir, multiLine=indented, pathGlobFilter=pattern, recursiveFileLookup=False)
    )
    # Spark refuses a query of the record text alone, so a condition that always holds reads a
    # declared column as well. Maps have no hash.
    plain = [f.name for f in fields if "map<" not in f.dataType.simpleString()]
    if not plain:
        return read.where(F.length(F.to_json(F.struct(fields.names[0]))) > 0)
    return read.where(F.xxhash64(F.col(f"`{plain[0]}`")) >= F.lit(-(2**63)))


def read_raw_checked(
    spark: SparkSession, raw_dir: str, schema: T.StructType | str, indented: bool = False, pattern: str = "*.json"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of all files of a name pattern directly in a raw folder.

    A line holds one record or an array of records; lines that hold neither, or a value
    of another type, are rejects, with their text in ``_record``. ``indented`` is for
    arrays over several lines; such a file cannot be split and is read by one task, and is
    rejected as a whole.
    """
    read = _read_records(spark, raw_dir, schema, indented, pattern)
    return read.where(F.col(RECORD).isNull()).drop(RECORD), read.where(F.col(RECORD).isNotNull())


def read_raw(
    spark: SparkSession, raw_dir: str, schema: T.StructType | str, indented: bool = False, pattern: str = "*.json"
) -> DataFrame:
    """The rows of ``read_raw_checked``; the read fails at the first reject.

    An empty folder gives no rows.
    """
    told = F.concat(
        F.lit("not a JSON record (indented arrays need indented=True): "), F.substring(RECORD, 1, 200)
    )
    good = F.when(F.col(RECORD).isNull(), F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))
    return _read_records(spark, raw_dir, schema, indented, pattern).where(good).drop(RECORD)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """JDBC scan in strides of a numeric column; the bounds set strides, not a filter."""
    return spark.read.jdbc(
        url=url,
        table=table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Kafka stream of binary (key, value); needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
