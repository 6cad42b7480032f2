"""Records as JSON lines and JSON documents, in and out."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Strict: a line that does not parse is an error; blank lines are skipped."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_controls(spark: SparkSession, path: str) -> DataFrame:
    """Planted controls: control_id, mimicked_family, text, and what they refer to or null."""
    fields = "control_id string, mimicked_family string, text string, ref_candidate_id string, ref_source_id string, expected_verdict string"
    return read_jsonl(spark, path, fields)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line and value (raw JSON) of every line that is not blank, for validators."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\n")).alias("line", "value")).where("trim(value) <> ''")


def bad_lines(lines: DataFrame) -> DataFrame:
    """file, line and value of lines that are not JSON."""
    return lines.where(F.expr("try_parse_json(value)").isNull())


def discovered(spark: SparkSession, root: str, name: str = "units.jsonl") -> DataFrame:
    """The sub-folders of a run that hold a file of this name, in order; none is an error."""
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/{name}").select("path")
    found = files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("source_id")).orderBy("source_id")
    if found.isEmpty():
        raise FileNotFoundError(f"no {name} below {root}")
    return found


def write_jsonl(df: DataFrame, path: str, execute: bool = True) -> DataFrame:
    """Overwrites JSON lines, a folder for each source_id; absent fields are left out. A dry run writes nothing."""
    if execute:
        writer = df.write.mode("overwrite").option("ignoreNullFields", "true")
        (writer.partitionBy("source_id") if "source_id" in df.columns else writer).json(path)
    return df


def append_records(df: DataFrame, path: str) -> None:
    """Adds records to a table of votes or of a token ledger; a batch is kept whole or not at all."""
    df.write.mode("append").parquet(path)


def document(df: DataFrame) -> str:
    """A small report as an indented JSON document."""
    rows = [json.loads(r[0]) for r in df.select(F.to_json(F.struct(*df.columns))).collect()]
    return json.dumps(rows[0] if len(rows) == 1 else rows, indent=2, ensure_ascii=False)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small document as one file, on whatever file system the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def write_document(df: DataFrame, path: str) -> None:
    write_text(df.sparkSession, document(df), path)


def sorted_json(fields: dict[str, Column]) -> Column:
    """An object as text, keys in order, a space after colons and commas."""
    parts = []
    for key in sorted(fields):
        parts += [F.lit(("" if not parts else ", ") + json.dumps(key) + ": "), fields[key]]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def json_string(value: Column) -> Column:
    """A JSON string; quotes, backslashes and control characters escaped."""
    return F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'^\{"v":(.*)\}$', 1)
