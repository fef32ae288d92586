"""Raw and processed inputs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrec.functions.columns import flatten_category, flatten_description
from tallyrec.session import exists
from tallyrec.sources.csv_records import records, split_starts
from tallyrec.sources.versions import load_version

# File suffixes in the order they are tried.
SUFFIXES = ("parquet", "json.gz", "jsonl.gz", "json", "jsonl", "csv.gz", "csv")

# Words a CSV cell may hold instead of a value.
CSV_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Public review and metadata column names and ours. For products the first name
# present wins.
REVIEW_NAMES = {
    "reviewerID": "user_id",
    "asin": "product_id",
    "overall": "rating",
    "unixReviewTime": "timestamp",
}
PRODUCT_NAMES = {
    "product_id": ("asin", "parent_asin"),
    "category": ("categories", "main_category"),
}
REQUIRED_REVIEW_COLUMNS = ("user_id", "product_id", "rating")

# The three processed tables.
PROCESSED_TABLES = ("interactions", "products", "users")


def resolve_source(spark: SparkSession, folder: str, stem: str) -> str | None:
    """The first existing ``{stem}.{suffix}`` in ``folder``, a file or a folder of part files."""
    for suffix in SUFFIXES:
        name = f"{folder.rstrip('/')}/{stem}.{suffix}"
        if exists(spark, name):
            return name
    return None


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multiline_csv: bool = True,
) -> DataFrame:
    """Read Parquet, JSON Lines or CSV by suffix; JSON and CSV may be gzipped.

    CSV columns come as strings with the usual null words removed. Quoted cells may hold line breaks,
    and Spark still splits large files: one scan looks for such cells, and only where it finds some
    are lines put together, see :mod:`tallyrec.sources.csv_records`. Lines end with a line feed, with
    or without a carriage return, and the header stands in one line. ``multiline_csv=False`` promises
    that there are no such cells and spares the scan. Gzip files are read in one piece.
    """
    return _read(spark, path, None, schema, multiline_csv)


def _read(
    spark: SparkSession,
    path: str,
    order: str | None,
    schema: T.StructType | None = None,
    multiline_csv: bool = True,
) -> DataFrame:
    """:func:`read_table`, with the input order as column ``order`` if that has a name."""
    name = path.lower().rstrip("/")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if name.endswith(".parquet"):
        df = reader.parquet(path)
    elif name.endswith((".json", ".jsonl", ".json.gz", ".jsonl.gz")):
        df = reader.json(path)
    else:
        starts = split_starts(spark, path) if multiline_csv else None
        df = reader.csv(path, header=True, escape='"', inferSchema=False)
        if starts is not None:
            return _without_null_words(_parsed(records(spark, path, starts), df.schema, order))
        df = df if order is None else with_input_order(df, order)
        return _without_null_words(df)
    return df if order is None else with_input_order(df, order)


def _parsed(found: DataFrame, schema: T.StructType, order: str | None) -> DataFrame:
    """The cells of CSV records."""
    record = F.regexp_replace("record", r"\r$", "")
    rows = found.where(~F.col("first") & (F.trim(record) != ""))
    names = (field.name.replace("`", "``") for field in schema)
    ddl = ", ".join(f"`{n}` {field.dataType.simpleString()}" for n, field in zip(names, schema))
    cells = F.from_csv(record, ddl, {"escape": '"', "multiLine": "true"})
    position = [] if order is None else [F.struct("file", "split", "row").alias(order)]
    return rows.select(cells.alias("cells"), *position).select("cells.*", *(n for n in [order] if n))


def _without_null_words(df: DataFrame) -> DataFrame:
    return df.select(
        *(
            F.when(~F.col(f"`{c}`").isin(*CSV_NULLS), F.col(f"`{c}`")).alias(c)
            if isinstance(df.schema[c].dataType, T.StringType)
            else F.col(f"`{c}`")
            for c in df.columns
        )
    )


# Reserved name of the column that :func:`load_reviews` adds.
INPUT_ORDER = "_input_order"


def with_input_order(df: DataFrame, name: str = INPUT_ORDER) -> DataFrame:
    """Add the position of each row in its input files as a sortable column.

    Call it on a freshly read table. Rows are ordered by file, then by split, then by the
    position inside the split, however Spark packs the splits into tasks.
    """
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def spread_unsplittable(df: DataFrame, path: str) -> DataFrame:
    """Distribute the rows of an input that Spark had to read in one piece."""
    return df.hint("rebalance") if path.lower().endswith(".gz") else df


def load_reviews(spark: SparkSession, path: str, **options) -> DataFrame:
    """Raw reviews under our column names, with their input order in ``INPUT_ORDER``."""
    df = _read(spark, path, INPUT_ORDER, **options)
    return spread_unsplittable(normalize_reviews(df, path), path)


def normalize_reviews(df: DataFrame, source: str = "reviews") -> DataFrame:
    """Rename the public review columns that are present; fail if a required one is missing."""
    df = df.withColumnsRenamed({old: new for old, new in REVIEW_NAMES.items() if old in df.columns})
    missing = sorted(set(REQUIRED_REVIEW_COLUMNS).difference(df.columns))
    if missing:
        raise ValueError(f"{source}: missing required columns {missing}")
    return df


def load_products(spark: SparkSession, path: str | None, **options) -> DataFrame | None:
    """Raw product metadata under our column names, or None when there is no such input."""
    if path is None:
        return None
    return spread_unsplittable(normalize_products(read_table(spark, path, **options)), path)


def normalize_products(df: DataFrame) -> DataFrame:
    """Rename product columns and flatten list-valued categories and descriptions."""
    for target, candidates in PRODUCT_NAMES.items():
        found = next((c for c in candidates if c in df.columns), None)
        if found is not None and target not in df.columns:
            df = df.withColumnRenamed(found, target)
    flat = {}
    if "category" in df.columns:
        flat["category"] = flatten_category(df)
    if "description" in df.columns:
        flat["description"] = flatten_description(df)
    return df.withColumns(flat) if flat else df


class Processed(NamedTuple):
    """The three clean tables."""

    interactions: DataFrame
    products: DataFrame
    users: DataFrame


def load_processed(spark: SparkSession, folder: str) -> Processed:
    """The three tables that :func:`tallyrec.sources.sinks.save_processed` wrote last, or the three
    plain Parquet tables in a folder that it never wrote to."""
    saved = load_version(spark, folder)
    root = folder.rstrip("/") if saved is None else saved.folder
    return Processed(*(spark.read.parquet(f"{root}/{t}.parquet") for t in PROCESSED_TABLES))


def raw_row_count(
    spark: SparkSession, folder: str, stem: str = "reviews", **options
) -> DataFrame:
    """One row: records in the raw input of any supported format, 0 when there is none."""
    path = resolve_source(spark, folder, stem)
    if path is None:
        return spark.range(1).select(F.lit(0).cast("bigint").alias("n_raw"))
    return read_table(spark, path, **options).agg(F.count(F.lit(1)).alias("n_raw"))
