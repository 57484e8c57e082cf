"""Readers and writers."""

from __future__ import annotations

import hashlib
import json
import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import prose

MESSAGES = "messages ARRAY<STRUCT<role: STRING, content: STRING>>, meta STRUCT<kind: STRING, source: STRING, section: STRING, level: INT, format: STRING, unit: STRING, group: STRING, template: STRING, verified: STRING, has_contract: BOOLEAN, standard: STRING>, _corrupt_record STRING"
#: Folders that a scan leaves out.
PRUNED = (".git", ".cache", "__pycache__", ".pytest_cache", ".github")
#: Rows of a range of keys that is numbered in one task, as long as there are under 2 ** RANGE_BITS ranges.
RANGE_ROWS, RANGE_BITS = 10_000, 10


def files(spark: SparkSession, roots: list[str], extensions: tuple[str, ...], content: bool = True) -> DataFrame:
    """(root_rank, root, path, length, content) of files below the roots with these extensions, in any case; pruned folders are left out.

    Without content no file is opened: binaryFile prunes the column. A root that isn't there gives a warning and no rows.
    """
    fields = "root_rank int, root string, path string, length long" + ", content binary" * content
    out = spark.createDataFrame([], fields)
    for rank, root in enumerate(roots):
        at = spark._jvm.org.apache.hadoop.fs.Path(root)
        if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            warnings.warn(f"no such root: {root}", stacklevel=2)
            continue
        df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        relative = F.substring_index("path", root.rstrip("/") + "/", -1)
        df = df.where(F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(*extensions) & ~F.arrays_overlap(F.split(relative, "/"), F.array(*map(F.lit, PRUNED))))
        df = df.select(F.lit(rank).alias("root_rank"), F.lit(root).alias("root"), relative.alias("path"), "length", *(["content"] if content else []))
        out = out.unionByName(df)
    return out


def texts(spark: SparkSession, roots: list[str], extensions: tuple[str, ...]) -> DataFrame:
    """Validated, redacted texts of files; binary, undecodable and empty ones are left out."""
    return files(spark, roots, extensions).withColumn("text", prose.clean_text(F.col("content"))).where("text IS NOT NULL").drop("content")


def records(spark: SparkSession, paths: list[str] | str, schema: str | T.StructType = MESSAGES) -> DataFrame:
    """JSON lines of chat records with their file; malformed lines have _corrupt_record, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(paths).withColumn("path", F.input_file_name())


def sequence(df: DataFrame, *order: str | Column) -> DataFrame:
    """df with `seq`, dense from 0 in the order of real keys, without gathering rows: they are counted and numbered by ranges of their keys.

    A row's range hangs on its key alone, never on the task that holds it: tasks of the plan that counts needn't be those of the plan that numbers.
    Range ends are sampled keys, so that ranges have about as many rows; any ends give the same numbers.
    """
    keyed = df.withColumn("__key", F.struct(*((F.col(k) if isinstance(k, str) else k).alias(f"k{n}") for n, k in enumerate(order))))
    n = keyed.count()
    ranges, ends = min(n // RANGE_ROWS + 1, 1 << RANGE_BITS), []
    if ranges > 1:
        some = [r[0] for r in keyed.select("__key").sample(min(1.0, 100 * ranges / n), 0).orderBy("__key").collect()]  # 100 keys a range
        ends = [some[len(some) * k // ranges] for k in range(1, ranges)] if some else []
    table = df.sparkSession.createDataFrame([(ends,)], T.StructType([T.StructField("__ends", T.ArrayType(keyed.schema["__key"].dataType))]))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(RANGE_BITS))))
    at = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(F.col("__ends"), low + step - 1) <= F.col("__key"), low + step).otherwise(low))
    ranged = keyed.crossJoin(F.broadcast(table)).withColumn("__range", at).drop("__key", "__ends")
    counts = ranged.groupBy("__range").count()
    before = counts.select("__range", F.coalesce(F.sum("count").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    return ranged.withColumn("__n", within).join(F.broadcast(before), "__range").withColumn("seq", F.col("__base") + F.col("__n")).drop("__range", "__n", "__base")


def write_splits(df: DataFrame, path: str, split: str = "split", fmt: str = "json") -> None:
    """One folder per split."""
    df.write.partitionBy(split).format(fmt).mode("overwrite").save(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("overwrite").csv(path)


def write_tokens(df: DataFrame, root: str, fingerprint: str) -> str:
    """Token id arrays as Parquet in a folder named by the fingerprint of what made them; an existing one is reused."""
    path = f"{root.rstrip('/')}/{fingerprint}"
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        df.write.mode("overwrite").parquet(path)
    return path


def fingerprint(inputs: DataFrame, params: dict) -> str:
    """Digest of a stage's inputs(path, digest), in the order of path, and its parameters. Digests are combined by path on executors."""
    rolled = inputs.select(F.sha2(F.concat_ws("\0", "path", "digest"), 256).alias("h")).agg(F.bit_xor(F.conv(F.substring("h", 1, 15), 16, 10).cast("long")), F.bit_xor(F.conv(F.substring("h", 16, 15), 16, 10).cast("long")), F.count("*")).collect()[0]
    return hashlib.sha256(json.dumps([list(rolled), params], sort_keys=True, default=str).encode()).hexdigest()

