"""Readers.

Explicit schemas by default: inference costs an extra pass over the input and guesses types per
file; it stays available behind ``infer=True`` for the header CSV, as in the reference job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column names and types of the car files (names are matched without case) and the column
# order of the headerless transaction files.
CAR_TYPES = {"car_id": "bigint", "car_name": "string", "year": "bigint", "selling_price": "double", "present_price": "double",
             "kms_driven": "bigint", "fuel_type": "string", "seller_type": "string", "transmission": "string", "owner": "bigint"}
CAR_REQUIRED = [c for c in CAR_TYPES if c != "car_id"]
TX_COLUMNS = ["tranaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount",
              "tx_time_seconds", "tx_time_days", "tx_fraud", "tx_fraud_scenario"]
TEMPERATURE_TYPES = {"dt": "string", "country": "string", "average_temperature": "double"}
CORRUPT = "_corrupt_record"


def _fold(name: str) -> str:
    return name.strip().lower().replace("_", "").replace(" ", "")


def read_csv_header(spark: SparkSession, path: str, types: dict[str, str] | None = None, infer: bool = False,
                    required: list[str] | None = None) -> DataFrame:
    """CSV with a header line, columns by name in whatever order. ``types`` gives the types of known
    columns (default: the car columns), others are strings; ``required`` ones must be there. With
    ``infer``, types are guessed in an extra pass. Names come out in lower case."""
    r = spark.read.option("header", True)
    if infer:
        d = r.option("inferSchema", True).csv(path)
        return d.toDF(*[c.lower() for c in d.columns])
    types = CAR_TYPES if types is None else types
    names = r.csv(path).columns  # reads the header line only
    missing = [c for c in required or [] if c not in {n.strip().lower() for n in names}]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    schema = ", ".join(f"`{n}` {types.get(n.strip().lower(), 'string')}" for n in names)
    d = r.schema(schema).option("enforceSchema", False).csv(path)
    return d.toDF(*[n.strip().lower() for n in names])


def read_csv_positional(spark: SparkSession, path_glob: str, names: list[str] = TX_COLUMNS, sep: str = ",",
                        comment: str = "#", corrupt: bool = False) -> DataFrame:
    """Headerless CSV files (glob), ``#`` comment lines skipped, every value a string named by position
    (P10). Lines with more or fewer fields than names are not cut or padded: with ``corrupt`` every row
    comes with the column ``_corrupt_record`` (the raw line, NULL for a good row; see ``split_corrupt``),
    without it a ragged line is an error when it is read."""
    schema = ", ".join(f"`{n}` string" for n in names)
    r = spark.read.option("header", False).option("sep", sep).option("comment", comment).option("columnPruning", False)
    if corrupt:
        return r.schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT).csv(path_glob)
    return r.schema(schema).option("mode", "FAILFAST").csv(path_glob)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt-record column, raw lines of the others as ``value``)."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    # Spark reads the corrupt-record column of a CSV only together with another one: nothing of it is added
    nothing = F.substring(F.coalesce(F.col(df.columns[0]), F.lit("")), 1, 0)
    return good, df.where(F.col(CORRUPT).isNotNull()).select(F.concat(F.col(CORRUPT), nothing).alias("value"))


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """P10: ``_c{i}`` -> names in one projection."""
    return df.toDF(*names)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return spark.read.parquet(path)


def read_dated_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """Staged CSV of dated readings (the HTTP download is staging, not a data step). Columns are taken
    by header name (case, spaces and underscores aside), others are ignored; a missing one is an error."""
    types = types or TEMPERATURE_TYPES
    raw = spark.read.option("header", True).csv(path)
    by_name = {_fold(c): c for c in raw.columns}
    missing = [c for c in types if _fold(c) not in by_name]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    return raw.select(*[F.expr(f"try_cast(`{by_name[_fold(c)]}` as {t})").alias(c) for c, t in types.items()])


def read_text_dir(spark: SparkSession, path: str) -> DataFrame:
    """Every line of every file under ``path`` with its file and a within-file order key
    (split start offset, then position inside the split)."""
    df = spark.read.text(path)
    return df.select(F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_block_start").alias("block_start"),
                     F.monotonically_increasing_id().alias("pos"), "value")
