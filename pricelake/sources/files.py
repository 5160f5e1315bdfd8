"""File sources and sinks: CSV with rejects, JSON records, parquet layers, clustered layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.session import small_tasks
from pricelake.sources import manifest
from pricelake.streaming.folders import first_lines

# Text values loaded as SQL NULL (CSV convention of the raw loaders).
NULL_TOKENS = ["NULL", "null", ""]

# Column that holds the raw line of a CSV record of the wrong width.
MALFORMED = "_malformed"

# --------------------------------------------------------------------------------------------
# Typed RAW layouts (declared DDL of the raw tables)
# --------------------------------------------------------------------------------------------
RAW_PRICE_TYPES = {
    "date": "date", "open": "double", "high": "double", "low": "double", "close": "double",
    "volume": "bigint", "ticker": "string", "ingested_at": "timestamp_ntz",
}
RAW_COMPANY_TYPES = {
    "ticker": "string", "company_name": "string", "sector": "string", "industry": "string",
    "country": "string", "exchange": "string", "currency": "string", "market_cap": "bigint",
    "full_time_employees": "bigint", "website": "string", "ingested_at": "timestamp_ntz",
}

COMPANY_JSON_SCHEMA = T.StructType([
    T.StructField("TICKER", T.StringType()),
    T.StructField("COMPANY_NAME", T.StringType()),
    T.StructField("SECTOR", T.StringType()),
    T.StructField("INDUSTRY", T.StringType()),
    T.StructField("COUNTRY", T.StringType()),
    T.StructField("EXCHANGE", T.StringType()),
    T.StructField("CURRENCY", T.StringType()),
    T.StructField("MARKET_CAP", T.DoubleType()),
    T.StructField("FULL_TIME_EMPLOYEES", T.DoubleType()),
    T.StructField("WEBSITE", T.StringType()),
    T.StructField("INGESTED_AT", T.StringType()),
])


# --------------------------------------------------------------------------------------------
# Scans
# --------------------------------------------------------------------------------------------
def csv_headers(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of every header layout under ``path``; empty files are left out.  Reads the
    first line of each file and no more, without a job."""
    layouts: dict[str, list[str]] = {}
    for file, head in first_lines(spark, path):
        if head is not None:
            layouts.setdefault(head.lstrip("\ufeff").rstrip("\r"), []).append(file)
    return [([c.strip().strip('"').strip().lower() for c in head.split(",")], sorted(fs))
            for head, fs in sorted(layouts.items())]


def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV scan by *header name*: every field is read as text, names are lower-cased, and the
    null tokens become SQL NULL.  Files are read by their own header, so a file whose columns come
    in another order keeps its values, and a file that lacks a column has nulls there.

    ``MALFORMED`` is the raw line of a record that has not as many fields as its header (null
    otherwise), and names the columns that its file lacks if ``columns`` asks for them."""
    layouts = csv_headers(spark, path)
    if not layouts:
        raise ValueError(f"no CSV file with a header under {path}")
    parts = []
    for names, paths in layouts:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, MALFORMED]])
        df = (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
              .option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
              .option("mode", "PERMISSIVE").csv(paths))
        lacking = [c for c in columns or [] if c not in names]
        bad = F.lit(f"file without {', '.join(lacking)}") if lacking else F.col(MALFORMED)
        wanted = columns if columns is not None else names
        parts.append(df.select(*[F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)).alias(c) if c in names
                                 else F.lit(None).cast("string").alias(c) for c in wanted],
                               bad.alias(MALFORMED)))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _typed(c: str, t: str) -> F.Column:
    if t in ("bigint", "int"):
        # Integers written with decimals ('164000.0') are accepted, with all their digits; text
        # that is not a number is not.
        return F.round(F.col(c).try_cast("decimal(38,6)")).try_cast(t)
    return F.col(c).try_cast(t)


def split_rejects(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Continue-on-error load: malformed records, and rows where a non-null text does not cast to
    its declared type, go to ``rejects`` (with the offending column names, ``record`` for a
    malformed one); all other rows are returned typed."""
    bad = {c: F.col(c).isNotNull() & _typed(c, t).isNull() for c, t in types.items() if t != "string"}
    if MALFORMED in df.columns:
        bad = {"record": F.col(MALFORMED).isNotNull(), **bad}
    # Both sides are told apart by the conditions alone; only rejects get the names as text.  Over a CSV scan
    # the conditions are one array: in one generated method with the null tokens and the casts they are more
    # than 8,000 bytes, which the JVM never compiles.
    any_bad = (F.exists(F.array(*bad.values()), lambda x: x) if MALFORMED in df.columns
               else reduce(lambda x, y: x | y, bad.values(), F.lit(False)))
    good = df.filter(~any_bad).select(*[_typed(c, t).alias(c) for c, t in types.items()])
    names = F.concat_ws(",", *[F.when(x, F.lit(c)) for c, x in bad.items()])
    rejects = df.filter(any_bad).select(*types.keys(), names.alias("reject_columns"))
    return good, rejects


def read_company_records(spark: SparkSession, path: str) -> DataFrame:
    """Company records as JSON lines; a missing field becomes null.  Output has the RAW layout."""
    j = spark.read.schema(COMPANY_JSON_SCHEMA).json(path)
    return j.select(
        *[F.col(f.name).alias(f.name.lower()) for f in COMPANY_JSON_SCHEMA.fields
          if f.name not in ("MARKET_CAP", "FULL_TIME_EMPLOYEES", "INGESTED_AT")],
        F.round("MARKET_CAP").cast("bigint").alias("market_cap"),
        F.round("FULL_TIME_EMPLOYEES").cast("bigint").alias("full_time_employees"),
        F.col("INGESTED_AT").cast("timestamp_ntz").alias("ingested_at"),
    ).select(*RAW_COMPANY_TYPES.keys())


def layer_path(root: str, layer: str | None, name: str, default_layer: str = "PUBLIC") -> str:
    """Where a model lives: a custom layer name is used verbatim (trimmed), else the default."""
    schema = default_layer if layer is None else layer.strip()
    return f"{root.rstrip('/')}/{schema}/{name}"


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


# --------------------------------------------------------------------------------------------
# Sinks
# --------------------------------------------------------------------------------------------
def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row; values are written as they are (Spark trims by default)."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def full_refresh(df: DataFrame, path: str) -> str:
    """Truncate-and-reload: the whole table is replaced by ``df``.  The rows are written beside the old
    ones and then committed, so a load that dies leaves the table as it was.  Returns the folder."""
    n = manifest.write_version(df, path)
    return manifest.commit_version(df, path, n).folders()[0]


def table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that is loaded by full refresh."""
    found = manifest.current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    return manifest.read(spark, found)


def stored(df: DataFrame, path: str, derived: dict[str, F.Column] | None = None) -> DataFrame:
    """``df`` written to ``path`` and read back: computed once, and its lineage cut.  Columns that are
    ``derived`` from others are not written but computed by the reader."""
    rows = df.drop(*(derived or {}))
    with small_tasks(df.sparkSession):
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(rows.schema).parquet(path)
    return back.withColumns(derived).select(*df.columns) if derived else back


def clustered(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition by the clustering keys and sort inside each partition, so every output
    file covers a narrow key range and parquet min/max statistics prune row groups."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def write_clustered(df: DataFrame, path: str, keys: list[str], partitions: int | None = None,
                    mode: str = "overwrite") -> None:
    """Write ``df`` range-partitioned and sorted by ``keys``.  Range partitioning samples its input
    to find the boundaries, which runs the input plan once more: for small tables."""
    clustered(df, keys, partitions).write.mode(mode).parquet(path)
