"""CSV scans that keep the lines they refuse."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

LINE = "_refused"


def scan_with_rejects(spark: SparkSession, path: str, schema: StructType, out_dir: str, header: bool = True) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(accepted rows, refused lines, counts) of CSV files.

    A line that doesn't fit the declared schema (a wrong number of fields, a
    value of another type) is refused as a whole. One pass reads the files, counts
    both kinds (``Observation``) and writes them: accepted rows with the schema
    below ``out_dir/refused=false``, refused lines as text, with their file, below
    ``out_dir/refused=true``."""
    wide = StructType([*schema.fields, StructField(LINE, StringType())])
    reader = spark.read.option("header", str(header).lower()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
    seen = Observation()
    refused = F.col(LINE).isNotNull()
    rows = reader.schema(wide).csv(path).select("*", F.when(refused, F.input_file_name()).alias("_file"), refused.alias("refused"))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("refused")).alias("refused"))
    rows.write.mode("overwrite").partitionBy("refused").parquet(out_dir)
    counts = dict(seen.get)
    kept = spark.read.schema(StructType([*wide.fields, StructField("_file", StringType()), StructField("refused", StringType())])).parquet(out_dir)
    accepted = kept.where(F.col("refused") == "false").select(*schema.names)
    side = kept.where(F.col("refused") == "true").select(F.col(LINE).alias("line"), F.col("_file").alias("file"))
    return accepted, side, {"read": counts["read"], "refused": counts["refused"], "accepted": counts["read"] - counts["refused"]}
