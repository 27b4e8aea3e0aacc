"""Record tables at rest: columnar (parquet) or CSV, and conversion between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas as S
from headway.functions.columns import list_to_text, text_to_list

# --- fixed values: file extension per format -------------------------------
EXTENSIONS = {"columnar": ".parquet", "csv": ".csv"}
# ----------------------------------------------------------------------------


def table_path(base: str, format: str) -> str:
    """Logical path + format -> path with extension (an extension given stays)."""
    extension = EXTENSIONS[format.lower()]
    return base if base.endswith(extension) else base + extension


# Blanks, quotes, line breaks and empty strings come back as they were written.
_CSV = {
    "header": True,
    "escape": '"',
    "nullValue": "\u0001",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _as_text(df: DataFrame) -> DataFrame:
    lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: list_to_text(F.col(c)) for c in lists}) if lists else df


def write_table(df: DataFrame, base: str, format: str = "columnar", mode: str = "errorifexists") -> str:
    """Write a table in the given format; an empty one keeps its schema or header."""
    path = table_path(base, format)
    if format.lower() == "csv":
        writer = _as_text(df).write.mode(mode)
        # Quotes inside a cell are doubled, the form other CSV readers expect.
        writer.options(**_CSV).csv(path)
    else:
        df.write.mode(mode).parquet(path)
    return path


def read_table(spark: SparkSession, name: str, base: str, format: str = "columnar") -> DataFrame:
    """Read one of the four record tables with its fixed schema."""
    schema = S.RECORDS[name]
    path = table_path(base, format)
    if format.lower() != "csv":
        return spark.read.schema(schema).parquet(path)
    lists = [f.name for f in schema if isinstance(f.dataType, T.ArrayType)]
    flat = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in lists else f.dataType) for f in schema]
    )
    df = spark.read.schema(flat).options(multiLine=True, **_CSV).csv(path)
    return df.withColumns({c: text_to_list(F.col(c)) for c in lists}) if lists else df


def columnar_to_csv(spark: SparkSession, source: str, target: str | None = None) -> str:
    """Convert one columnar table to CSV, by default next to it with ``.csv``."""
    extension = EXTENSIONS["columnar"]
    stem = source.removesuffix(extension)
    return write_table(spark.read.parquet(source), target or stem, "csv")


def write_score(score: DataFrame, path: str, history: str | None = None) -> None:
    """Score record(s) as JSON; NaN and infinities are kept. Optionally append to a table."""
    score.write.option("ignoreNullFields", False).json(path)
    if history:
        score.write.mode("append").parquet(history)


def read_score(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("allowNonNumericNumbers", True).json(path)
