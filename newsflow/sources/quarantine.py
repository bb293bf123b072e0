"""JSON records of files whose columns drift: what fits goes on, the rest is kept with its file and the reason.

Records are parsed once, as variants, so a file's surprise never fails a read.  The schema of what has landed is merged
over all records by a widening rule (whole numbers below decimals below doubles, everything else that differs stays a
variant): ``landed_schema``.  ``split_records`` casts every wanted column by itself: missing columns and JSON nulls are null;
a value that can't take the wanted type sends the whole record to quarantine, as does a line that isn't a JSON object.
Columns that nobody asked for stay readable in ``extra``.  Every line is in exactly one of the two results; blank lines
are no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(file, value): the lines of all files of a folder."""
    return spark.read.option("recursiveFileLookup", "true").text(folder).select(F.col("_metadata.file_path").alias("file"), "value").where(F.trim("value") != "")


def _variant(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_v", F.try_parse_json("value"))


def landed_schema(lines: DataFrame) -> DataFrame:
    """One row: the merged schema of all records that are JSON, as DDL of an object (null without any)."""
    return _variant(lines).agg(F.schema_of_variant_agg("_v").alias("schema"))


def split_records(lines: DataFrame, wanted: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine): file, the wanted columns and ``extra``; file, value and reason."""
    parsed = _variant(lines).withColumn("_fields", F.expr("try_variant_get(_v, '$', 'map<string, variant>')"))

    def raw(f: T.StructField) -> Column:
        return F.element_at("_fields", f.name)

    def cast(f: T.StructField) -> Column:
        return F.try_variant_get(raw(f), "$", f.dataType.simpleString())

    bad = [F.when(raw(f).isNotNull() & ~F.is_variant_null(raw(f)) & cast(f).isNull(), F.lit(f"{f.name} is not {f.dataType.simpleString()}")) for f in wanted]
    reason = F.when(F.col("_v").isNull(), "not JSON").when(F.col("_fields").isNull(), "not an object").otherwise(F.nullif(F.concat_ws("; ", *bad), F.lit("")))
    judged = parsed.withColumn("reason", reason)
    names = F.array(*[F.lit(f.name) for f in wanted])
    rest = F.map_filter("_fields", lambda k, _: ~F.array_contains(names, k))
    extra = F.when(F.size(F.map_keys(rest)) > 0, F.to_json(rest))
    good = judged.where("reason IS NULL").select("file", *[cast(f).alias(f.name) for f in wanted], extra.alias("extra"))
    return good, judged.where("reason IS NOT NULL").select("file", "value", "reason")
