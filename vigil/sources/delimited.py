"""Delimited text sources and sinks (pipe CSV as the flat-table exchange format).

Options give pandas-like quoting: quote char ``"``, doubled-quote escaping,
fields with the separator, quotes or newlines quoted; empty strings written
as empty; leading/trailing blanks kept (Spark trims them on write by default). Parquet is the primary sink; CSV is for interchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The tokens pandas' CSV reader turns into missing values by
# default (empty fields are already NULL in Spark).
PANDAS_NA_TOKENS = ["#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def na_tokens_to_null(df: DataFrame, cols=None, tokens=PANDAS_NA_TOKENS) -> DataFrame:
    """Read-side NULL rule of the flat-table consumers: string fields whose
    whole value is one of ``tokens`` become NULL (numeric columns are typed
    by the schema and already NULL on a failed parse)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.select(*[F.when(F.col(c).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def read_pipe_csv(spark: SparkSession, path: str, schema: StructType | str,
                  sep: str = "|", na_tokens: bool = True) -> DataFrame:
    """Pipe CSV with a declared schema. By default the consumers' missing-value
    tokens become NULL in string columns; ``na_tokens=False`` keeps them."""
    df = (spark.read.schema(schema).option("header", True).option("sep", sep)
          .option("quote", '"').option("escape", '"').option("multiLine", True)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))
    return na_tokens_to_null(df) if na_tokens else df


def write_pipe_csv(df: DataFrame, path: str, sep: str = "|", mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", True).option("sep", sep)
     .option("quote", '"').option("escape", '"').option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_indexed_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Comma CSV written with a leading unnamed index column, which is dropped.
    ``schema`` describes the columns after the index."""
    r = spark.read.option("header", True)
    if schema is None:
        df = r.option("inferSchema", True).csv(path)
        first = df.columns[0]
        return df.drop(first) if first in ("_c0", "") else df
    named = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    whole = StructType([StructField("_index", StringType()), *named.fields])
    return r.option("enforceSchema", True).schema(whole).csv(path).drop("_index")
