"""File sources: typed CSV with optional quarantine, glob resolution,
document (JSON) reads (S1-S4, S8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_COLUMN


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             check_header: bool = True, multiline: bool = False) -> DataFrame:
    """CSV with a header row under an explicit all-text schema.

    ``check_header=True`` compares the header with the schema names
    (``enforceSchema=false``), so a swapped or renamed column fails loudly
    instead of binding silently by position.
    """
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .option("enforceSchema", not check_header).option("multiLine", multiline)
            .schema(schema).csv(path))


def read_csv_quarantine(spark: SparkSession, path: str | list[str], schema: T.StructType,
                        check_header: bool = True,
                        multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """S3: split a CSV read into (good rows, quarantined raw lines).

    Rows whose field count differs from the schema keep their text in the
    corrupt-record column and go to quarantine with that text; good rows
    lose the column.
    """
    fields = list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
    df = (spark.read.option("header", True).option("mode", "PERMISSIVE")
          .option("enforceSchema", not check_header).option("multiLine", multiline)
          .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
          .schema(T.StructType(fields)).csv(path))
    # Keep every column in both branches: Spark refuses a CSV query that only
    # references the corrupt-record column.
    good = df.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    bad = df.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(
        F.col(CORRUPT_COLUMN).alias("raw"), F.lit("field_count").alias("reason"),
        *[F.col(f.name) for f in schema.fields])
    return good, bad


def stage_csv_quarantine(spark: SparkSession, path: str | list[str], schema: T.StructType, out: str,
                         header: bool = True, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """S3 in one parse, with provenance: (good rows, quarantined lines).

    The files are parsed once into a table below ``out``, partitioned by outcome,
    and both results read their own partition. A quarantined line has its text
    (``raw``), ``reason``, and where it stands: ``file`` and the first byte of the
    block that a task read it from (``block_start``). good + bad = lines.
    """
    fields = list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
    rows = (spark.read.option("header", header).option("mode", "PERMISSIVE").option("multiLine", multiline)
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).schema(T.StructType(fields)).csv(path))
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    rows.select("*", F.when(bad, F.col("_metadata.file_path")).alias("_file"),
                F.when(bad, F.col("_metadata.file_block_start")).alias("_block_start"), bad.alias("_quarantined")) \
        .write.partitionBy("_quarantined").parquet(out)
    stored = T.StructType([*fields, T.StructField("_file", T.StringType()), T.StructField("_block_start", T.LongType()),
                           T.StructField("_quarantined", T.BooleanType())])
    back = spark.read.schema(stored).parquet(out)
    names = [f"`{f.name}`" for f in schema.fields]
    return back.where("not _quarantined").select(*names), back.where("_quarantined").select(
        F.col(CORRUPT_COLUMN).alias("raw"), F.lit("field_count").alias("reason"), F.col("_file").alias("file"), F.col("_block_start").alias("block_start"))


# Columns of ``with_place``.
PLACE = ("_file", "_block")


def with_place(df: DataFrame) -> DataFrame:
    """Rows of a file scan with the file and block that they come from."""
    return df.select("*", F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.file_block_start").alias(PLACE[1]))


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of ``df`` in file order (path, block, line).

    ``df`` comes from ``with_place`` and may be filtered since. A first pass
    counts the rows of each block (one small row a block), which gives each
    block's offset; a second one keeps the rows below ``n``. Blocks that begin
    beyond ``n`` are dropped where they are read; no task gets more rows than its
    own blocks hold. A block's rows stand together and in order within a task.
    """
    at = df.withColumn("_row", F.monotonically_increasing_id())
    w = Window.orderBy(*PLACE)  # one row a block of the files
    blocks = at.groupBy(*PLACE).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows")) \
        .withColumn("_before", F.sum("_rows").over(w) - F.col("_rows")).where(F.col("_before") < n)
    # a block in the result holds a row of the first n: at most n blocks
    near = at.join(F.broadcast(blocks.drop("_rows")), list(PLACE))
    return near.where(F.col("_before") + F.col("_row") - F.col("_first") < n).select(*[c for c in df.columns if c not in PLACE])


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching ``pattern`` (Hadoop glob), sorted; metadata only."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath)
    return sorted(str(s.getPath().toString()) for s in (found or []))


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths`` (of one file system) that exist; metadata only, one look-up each."""
    if not paths:
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(paths[0]).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [p for p in paths if fs.exists(path(p))]


def publish(spark: SparkSession, path: str, target: str) -> None:
    """Move a finished folder to ``target``, so that a stream's source sees it whole or not at all."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    to = hpath(target)
    fs = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(to.getParent())
    if not fs.rename(hpath(path), to):
        raise OSError(f"{path} cannot become {target}")


def resolve_first(spark: SparkSession, pattern: str) -> str:
    """S4, reference form: the first sorted match; an error when none."""
    paths = glob_paths(spark, pattern)
    if not paths:
        raise FileNotFoundError(f"no files matched {pattern}")
    return paths[0]


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON document collection under an explicit schema."""
    return spark.read.schema(schema).json(path)
