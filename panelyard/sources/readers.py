"""Readers over landed files.  Files stay in place; Spark prunes partitions and columns."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.functions import strip_blank
from panelyard.operators.merge import keep_one
from panelyard.schemas import missing_to_null
from panelyard.session import materialise

# Watch-list categories and the local symbols it must not contain; snapshot columns read as text.
WATCH_CATEGORIES = ("미국", "ETF")
WATCH_SYMBOL_COLUMNS = ("Ticker", "ticker", "Symbol")
LOCAL_SYMBOL = r"(?i)^[0-9]{6}\.(KS|KQ)$"
SNAPSHOT_NUMBERS = ("Open", "High", "Low", "Close", "Volume", "Marcap", "Stocks", "Changes", "ChagesRatio",
                    "ChangesRatio", "Amount")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All partitions of a table; an absent table is an empty frame of the schema.  NaN reads as NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return missing_to_null(reader.parquet(path))
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_partition(spark: SparkSession, path: str, schema: T.StructType, column: str, value) -> DataFrame:
    """One month or year partition (pruned at planning time); empty when it does not exist."""
    if column not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(column, T.StringType() if isinstance(value, str)
                                                              else T.IntegerType())])
    return read_table(spark, path, schema).where(F.col(column) == value)


def foreign_files(df_with_files: DataFrame, pattern: str) -> DataFrame:
    """Names of data files that do not follow the naming rule; must be empty."""
    name = F.col("_metadata.file_name")
    return df_with_files.select(name.alias("file_name")).where(~F.col("file_name").rlike(pattern)).distinct()


def inventory(df: DataFrame) -> DataFrame:
    """Files holding the table, with rows per file."""
    return df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("bytes")
                     ).groupBy("file_path", "bytes").agg(F.count(F.lit(1)).alias("rows"))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Daily snapshot CSVs, one file per date named ``...YYYY-MM-DD.csv``, each with its own header.

    Codes stay text; numbers that do not read are NULL; ``Date`` comes from the file name, ``own_date`` from the
    file when it has one.  A column that a file lacks is NULL in its rows.  Files are read by kind of header (there
    are a few kinds, whatever the number of files), so values always stand under their own name.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("at"))
    # the first line of a file is the first row of its first block
    firsts = lines.where("at = 0").withColumn("row", F.monotonically_increasing_id()).groupBy("file").agg(
        F.min_by("value", "row").alias("header"))
    kinds = [r.header for r in firsts.select("header").distinct().collect() if r.header is not None]
    firsts = materialise(firsts, "headers") if kinds else firsts
    out = None
    for header in sorted(kinds):
        mine = lines.join(firsts.where(F.col("header") == header).select("file"), "file")
        names = next(csv.reader([header.lstrip("\ufeff")]))
        fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        cells = F.from_csv("value", ", ".join(f"{f.name} string" for f in fields))
        rows = mine.where(F.col("value") != header).select(cells.alias("v"), F.to_date(F.regexp_extract(
            "file", r"(\d{4}-\d{2}-\d{2})[^/]*$", 1)).alias("Date"))
        columns = []
        for i, c in enumerate(names):
            cell = F.nullif(F.col(f"v.c{i}"), F.lit(""))
            if c == "Date":
                columns.append(F.try_to_date(cell).alias("own_date"))
            elif c in SNAPSHOT_NUMBERS:
                columns.append(cell.try_cast("double").alias(c))
            elif c:
                columns.append(cell.alias(c))
        part = rows.select(*columns, "Date")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], "Code string, Date date") if out is None else out


QUOTE = "struct<price:double,marketCap:double,percentChange24h:double,percentChange7d:double>"
LISTING_ITEM = f"symbol string, id long, name string, circulatingSupply double, tags array<string>, quotes string"


def parse_listing(df: DataFrame, items: str = "items") -> DataFrame:
    """Nested listing entries -> flat rows.

    ``items`` is a JSON array of entries (text).  ``quotes`` may be a list (its first element counts) or a map
    with key USD; both shapes are read and the one present wins.  Blank symbols and entries without id are dropped; of a
    symbol listed more than once in a response, or in several, the last entry counts (responses in the order of a
    hash of their text, which reruns repeat).  A response is hashed once, before its entries become rows.
    """
    entry = F.posexplode(F.from_json("items", f"array<struct<{_typed(LISTING_ITEM)}>>"))
    hashed = df.select(F.xxhash64(items).alias("response"), F.col(items).alias("items"))
    rows = hashed.select("response", entry.alias("place", "i")).select("response", "place", "i.*")
    listed = flatten_listing(rows).where(F.col("id").isNotNull())
    return keep_one(listed, ["symbol"], [F.col("response").desc(), F.col("place").desc()]).drop("response", "place")


def _typed(ddl: str) -> str:
    return ",".join(f"{name}:{kind}" for name, kind in (part.strip().split(" ", 1) for part in ddl.split(", ")))


def flatten_listing(rows: DataFrame) -> DataFrame:
    """One row per listed symbol from entries whose ``quotes`` is JSON text."""
    listed = F.get(F.from_json("quotes", f"array<{QUOTE}>"), F.lit(0))
    keyed = F.try_element_at(F.from_json("quotes", f"map<string,{QUOTE}>"), F.lit("USD"))
    is_list = F.col("quotes").startswith("[")
    symbol = F.upper(strip_blank(F.coalesce("symbol", F.lit(""))))
    parsed = rows.withColumn("_q", F.when(is_list, listed).otherwise(F.when(~is_list, keyed)))
    return parsed.select(
        *[c for c in ("response", "place") if c in rows.columns], symbol.alias("symbol"), "id", "name", F.col("circulatingSupply").alias("supply"),
        F.get("tags", F.lit(0)).alias("tag"), F.col("_q.price").alias("price"), F.col("_q.marketCap").alias("market_cap"),
        F.col("_q.percentChange24h").alias("change_24h"), F.col("_q.percentChange7d").alias("change_7d"),
    ).where(F.col("symbol") != "")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Listing responses landed as JSON files, entries below ``data.cryptoCurrencyList`` or ``data`` itself."""
    text = spark.read.text(path, wholetext=True)
    nested = F.get_json_object("value", "$.data.cryptoCurrencyList")
    return parse_listing(text.select(F.coalesce(nested, F.get_json_object("value", "$.data")).alias("items")))


def ticker_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Usable lines of a ticker list: stripped, without blanks and '#' comments."""
    clean = strip_blank(F.col(column))
    return lines.withColumn(column, clean).where((F.col(column) != "") & ~F.col(column).startswith("#"))


def read_ticker_list(spark: SparkSession, path: str) -> DataFrame:
    return ticker_lines(spark.read.text(path)).withColumnRenamed("value", "ticker")


def watch_list(
    df: DataFrame, category: str = "category", categories: Sequence[str] = WATCH_CATEGORIES,
    symbols: Sequence[str] = WATCH_SYMBOL_COLUMNS,
) -> DataFrame:
    """Symbols of a watch list: wanted categories when the column exists, no local listings."""
    column = next((c for c in symbols if c in df.columns), None)
    if column is None:
        raise ValueError(f"watch list needs one of {list(symbols)}")
    rows = df.where(F.col(category).isin(*categories)) if category in df.columns else df
    ticker = strip_blank(F.col(column).cast("string"))
    return rows.select(ticker.alias("ticker")).where((F.col("ticker") != "") & ~F.col("ticker").rlike(LOCAL_SYMBOL))


def register_tables(spark: SparkSession, tables: Mapping[str, str]) -> None:
    """Name landed Parquet folders so SQL can use them."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Ad-hoc SQL over registered tables or ``parquet.`path```.  Errors surface to the caller."""
    return spark.sql(sql)
