"""CSV extracts in, CSV results out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.scale import materialize
from tradewind.sources.schemas import NA_TOKENS, ORDERED_EXTRACTS, RAW_SCHEMAS


def _cell(name: str, kind: T.DataType, strict: bool) -> Column:
    """A text cell as its declared type: missing-value tokens are null, anything else must convert."""
    text = F.col(f"`{name}`")
    text = F.when(~text.isin(*NA_TOKENS), text)
    if isinstance(kind, T.StringType):
        return text.alias(name)
    value = text.try_cast(kind)
    if strict:
        said = F.concat(F.lit(f"column {name} takes {kind.simpleString()}, not "), text)
        value = F.when(text.isNotNull() & value.isNull(), F.raise_error(said).cast(kind)).otherwise(value)
    return value.alias(name)


def read_text(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False) -> DataFrame:
    """All columns of a header CSV as text, found by their names in the header.

    Files whose header differs from the first file's fail, as does a header that lacks one of ``columns``;
    the order of the columns is free. Quoted line breaks need ``multi_line``.
    """
    df = spark.read.csv(path, header=True, mode="FAILFAST", escape='"', multiLine=multi_line, enforceSchema=False)
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"{path} has no column {', '.join(lacking)}")
    return df


def read_csv(spark: SparkSession, path: str, schema: str, with_order: bool = False,
             multi_line: bool = False, strict: bool = True) -> DataFrame:
    """Read header CSV into the columns and types of ``schema``; missing-value tokens become null.

    A cell that does not fit its type fails the job, or with ``strict`` off becomes null and is counted by
    ``count_rejects``. ``with_order`` adds ``ingest_seq``, the record's place in the extract as (file, block start, row
    within the split). It is computed per task: no shuffle, no counting pass.
    """
    fields = T.StructType.fromDDL(schema).fields
    df = read_text(spark, path, [f.name for f in fields], multi_line)
    cols = [_cell(f.name, f.dataType, strict) for f in fields]
    if with_order:
        cols.append(F.struct(F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.file_block_start").alias("block"),
                             F.monotonically_increasing_id().alias("row")).alias("ingest_seq"))
    return df.select(*cols)


def count_rejects(spark: SparkSession, path: str, schema: str, table: str, multi_line: bool = False) -> DataFrame:
    """(table_name, column_name, rows_read, rejected): cells of typed columns that do not fit, in one pass."""
    fields = [f for f in T.StructType.fromDDL(schema).fields if not isinstance(f.dataType, T.StringType)]
    df = read_text(spark, path, [f.name for f in fields], multi_line)
    given = {f.name: F.when(~F.col(f"`{f.name}`").isin(*NA_TOKENS), F.col(f"`{f.name}`")) for f in fields}
    counts = df.agg(F.count("*").alias("rows_read"), *[
        F.count_if(given[f.name].isNotNull() & given[f.name].try_cast(f.dataType).isNull()).alias(f.name) for f in fields])
    rows = F.explode(F.array(*[F.struct(F.lit(f.name).alias("c"), F.col(f"`{f.name}`").alias("n")) for f in fields]))
    return counts.select("rows_read", rows.alias("_r")).select(
        F.lit(table).alias("table_name"), F.col("_r.c").alias("column_name"), "rows_read", F.col("_r.n").alias("rejected"))


REASONS = ("does not fit its type", "record does not fit the header")


def read_or_quarantine(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records in the columns and types of ``schema``, what kept the other records out), from one reading of the files.

    The second has a row per fault: file, block, row (the record's place as ``ingest_seq`` gives it), column_name, cell and reason. A
    record with any fault is in the second only, whole records with the wrong number of cells or broken quoting with the
    record itself as the cell. So the records of the files are those kept and the distinct places of those quarantined. Missing-value
    tokens are null, not faults. The records are stored once in the scratch folder.
    """
    fields = T.StructType.fromDDL(schema).fields
    header = read_text(spark, path, [f.name for f in fields], multi_line).columns
    broken = "_broken"
    while broken in header:
        broken += "_"
    texts = T.StructType([T.StructField(c, T.StringType()) for c in [*header, broken]])
    df = spark.read.schema(texts).csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=broken, escape='"',
                                      multiLine=multi_line, enforceSchema=False)

    def fault(column: str, cell: Column, reason: str) -> Column:
        return F.struct(F.lit(column).alias("column_name"), cell.alias("cell"), F.lit(reason).alias("reason"))

    whole = F.col(f"`{broken}`")
    faults = [F.when(whole.isNotNull(), fault("", whole, REASONS[1]))]
    for f in fields:
        if not isinstance(f.dataType, T.StringType):
            text = F.col(f"`{f.name}`")
            misfit = whole.isNull() & text.isNotNull() & ~text.isin(*NA_TOKENS) & text.try_cast(f.dataType).isNull()
            faults.append(F.when(misfit, fault(f.name, text, REASONS[0])))
    cells = [_cell(f.name, f.dataType, False) for f in fields]
    read = df.select(F.struct(*cells).alias("record"), F.array_compact(F.array(*faults)).alias("faults"),
                     F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    read = materialize(read, "records")
    kept = read.where(F.size("faults") == 0).select("record.*")
    return kept, read.where(F.size("faults") > 0).select("file", "block", "row", F.explode("faults").alias("f")).select(
        "file", "block", "row", "f.*")


def read_extract(spark: SparkSession, path: str, name: str, multi_line: bool = False, strict: bool = True) -> DataFrame:
    """One of the eight raw extracts by name."""
    return read_csv(spark, path, RAW_SCHEMAS[name], name in ORDERED_EXTRACTS, multi_line, strict)


def read_extracts(spark: SparkSession, folder: str, suffix: str = "_raw.csv") -> dict[str, DataFrame]:
    """All eight extracts from ``<folder>/<name><suffix>``."""
    return {name: read_extract(spark, f"{folder.rstrip('/')}/{name}{suffix}", name) for name in RAW_SCHEMAS}


def write_csv(df: DataFrame, path: str) -> None:
    """Write header CSV, one file per task, comma separated, quotes doubled."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                   ignoreTrailingWhiteSpace=False)
