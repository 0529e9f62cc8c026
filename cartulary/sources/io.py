"""Reading and writing: JSON lines, files whole, PDFs and images as bytes, single files put in place at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartulary.tables import materialize

MAX_PDF_BYTES = 50 << 20


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Blank lines are skipped, a bad line raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_or_nothing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the files without a single bad line."""
    full = StructType([*StructType.fromDDL(schema).fields, StructField("_bad", StringType())])
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path).withColumn("_file", F.input_file_name())
    rows = materialize(rows, "jsonl")  # the reader tells bad lines only along with the others'
    bad = rows.where("_bad is not null").select("_file").distinct()
    return rows.join(bad, "_file", "left_anti").drop("_bad", "_file")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): each file of plain text or markdown whole."""
    return spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, length, content) of files that fit a pattern, anywhere below the path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length", "content")


def with_base64(files: DataFrame) -> DataFrame:
    """S8."""
    return files.withColumn("base64", F.base64("content"))


def pdf_threats(files: DataFrame, *, max_bytes: int = MAX_PDF_BYTES) -> DataFrame:
    """Files with the first reason to refuse one: empty, too_large, bad_magic, encrypted, active_content or attachments."""
    text = F.decode("content", "ISO-8859-1")
    reason = (
        F.when(F.col("length") == 0, "empty")
        .when(F.col("length") > max_bytes, "too_large")
        .when(F.substring(text, 1, 4) != "%PDF", "bad_magic")
        .when(F.regexp_like(text, F.lit(r"/Encrypt\b")), "encrypted")
        .when(F.regexp_like(text, F.lit(r"/(JavaScript|JS|OpenAction)\b")), "active_content")
        .when(F.regexp_like(text, F.lit(r"/EmbeddedFiles?\b")), "attachments")
    )
    return files.withColumn("reason", reason)


def write_jsonl(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """K1, K6: UTF-8, nulls left out; append mode for logs."""
    df.write.mode(mode).json(path)


def write_split(marked: DataFrame, path: str, column: str) -> None:
    """K3, K4: one folder for each value of a column."""
    marked.write.partitionBy(column).mode("errorifexists").json(path)


def write_text_atomically(spark: SparkSession, path: str, text: str) -> None:
    """K2: a small file written beside its place and renamed into it, by the path's own file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    temp = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(temp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(temp, target, over)
