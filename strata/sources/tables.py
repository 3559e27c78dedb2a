"""Scans and sinks.

Every scan returns a lazy DataFrame; column selection and filters applied
later reach the parquet reader through Catalyst (``PushedFilters`` /
``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens the pandas CSV reader treats as missing by default.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Turn floating NaN into SQL NULL so aggregates skip it as pandas does."""
    targets = cols or [f.name for f in df.schema.fields
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not targets:
        return df
    return df.withColumns({c: F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c))
                           for c in targets})


def read_csv(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str = "_corrupt_record",
             raw_col: str = "_raw_record", multi_line: bool = False, header: bool = True) -> DataFrame:
    """CSV scan with (unless told otherwise) header and an explicit schema; no record is lost or changed unseen.

    Every field is read as text first, the pandas missing tokens become NULL (a token
    with blanks around it is text, as in pandas), then each field is cast with ``try_cast``. ``corrupt_col``
    lists what is wrong with a record: ``<fields>`` if it has too few fields (the rest is NULL) or too
    many (the surplus is in the raw record only), and the name of each field that could not be cast.
    ``raw_col`` is the record itself where the list is not empty (written anew from its fields if
    only casts failed), else NULL. ``multi_line``: quoted fields may hold line
    ends; a file is then read by one task, so large tables should come in many files.
    """
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = (spark.read
           .option("header", header)
           .option("mode", "PERMISSIVE")
           .option("quote", '"')
           .option("escape", '"')
           .option("multiLine", multi_line)
           .option("columnPruning", False)  # else only the selected fields would be counted
           .option("columnNameOfCorruptRecord", raw_col)
           .schema(T.StructType([*text.fields, T.StructField(raw_col, T.StringType(), True)]))
           .csv(path))
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}  # kept as they are
    fields = [F.col(f"`{f.name}`") for f in schema.fields]
    cleaned = {}
    bad = [F.when(F.col(raw_col).isNotNull(), F.lit("<fields>"))]  # evaluated against the raw text columns, in the same projection
    for f, c in zip(schema.fields, fields, strict=True):
        v = F.when(~c.isin(PANDAS_NA_TOKENS), c)
        if isinstance(f.dataType, T.StringType):
            cleaned[f.name] = v
        else:
            typed = v.try_cast(f.dataType)
            cleaned[f.name] = typed
            bad.append(F.when(v.isNotNull() & typed.isNull(), F.lit(f.name)))
    wrong = F.array_compact(F.array(*bad))
    cleaned[corrupt_col] = wrong
    cleaned[raw_col] = F.when(F.size(wrong) > 0, F.coalesce(F.col(raw_col), F.to_csv(F.struct(*fields), blanks)))
    return nan_to_null(raw.withColumns(cleaned))


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> None:
    """S3: write a result table (metrics, audit rows) per run."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def cached_view(df: DataFrame, name: str | None = None) -> DataFrame:
    """Keep a transformed table in memory (spilling to disk) for reuse."""
    from pyspark import StorageLevel

    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    if name:
        out.createOrReplaceTempView(name)
    return out
