"""File feeds: delimited text, XML waybills, dated file names.

Readers take explicit schemas (inference turns ``000001`` into a number).
Each text format also has a column parser (``from_csv`` / ``from_xml``) so
the same rules apply to text already in a table or a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions.expr import date_from_digits, parse_decimal_comma
from ebbflow.sources.rejects import PAYMENT_FIELDS, parse_lines

# Fixed formats of the feeds.
TRANSACTIONS_SCHEMA = ("transaction_id STRING, transaction_date STRING, amount STRING, card_num STRING, "
                       "oper_type STRING, oper_result STRING, terminal STRING")
PAYMENT_SCHEMA = "transaction_dt STRING, card_num STRING, transaction_amt STRING"
PAYMENT_TS_FORMAT = "dd.MM.yyyy HH:mm:ss"
WAYBILL_SCHEMA = (
    "_number STRING, number STRING, _issuedt STRING, issuedt STRING, car STRING, "
    "driver STRUCT<license: STRING>, period STRUCT<start: STRING, stop: STRING>"
)
XML_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


# ------------------------------------------------------------------ S4
def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ";", header: bool = True) -> DataFrame:
    """Delimited files with an explicit schema; ``file_name`` kept for S9."""
    return (spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)
            .withColumn("file_name", F.col("_metadata.file_name")))


def parse_delimited(text: Column, schema: str, sep: str) -> Column:
    return F.from_csv(text, schema, {"sep": sep})


def decimal_comma(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    return parse_decimal_comma(c, precision, scale)


# ------------------------------------------------------------------ S5
def payments_from_text(df: DataFrame, text_col: str = "value") -> DataFrame:
    """TAB separated ``dd.MM.yyyy HH:mm:ss<TAB>card<TAB>amount`` lines; lines that
    cannot be read are left out (``rejects.parse_lines`` gives them with the reason)."""
    return parse_lines(df.select(text_col), PAYMENT_FIELDS, "\t", text_col).good


def read_payments(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path).withColumn("file_name", F.col("_metadata.file_name"))
    return payments_from_text(raw)


# ------------------------------------------------------------------ S6
def waybills_from_struct(w: Column) -> list[Column]:
    """Flatten a parsed waybill (number/issuedt as attribute or element)."""
    return [
        F.coalesce(w["_number"], w["number"]).alias("waybill_num"),
        w["driver"]["license"].alias("driver_license"),
        F.trim(w["car"]).alias("car_plate_num"),
        F.to_timestamp(w["period"]["start"], XML_TS_FORMAT).cast("timestamp_ntz").alias("work_start_dt"),
        F.to_timestamp(w["period"]["stop"], XML_TS_FORMAT).cast("timestamp_ntz").alias("work_end_dt"),
        F.to_timestamp(F.coalesce(w["_issuedt"], w["issuedt"]), XML_TS_FORMAT).cast("timestamp_ntz").alias("issue_dt"),
    ]


def parse_waybill_xml(df: DataFrame, text_col: str) -> DataFrame:
    w = F.from_xml(F.col(text_col), WAYBILL_SCHEMA)
    return df.select(w.alias("_w")).select(*waybills_from_struct(F.col("_w")))


def read_waybills(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<waybill>`` element of the XML files."""
    raw = spark.read.format("xml").option("rowTag", "waybill").schema(WAYBILL_SCHEMA).load(path)
    return raw.select(F.struct(*[F.col(c) for c in raw.columns]).alias("_w")).select(*waybills_from_struct(F.col("_w")))


# ------------------------------------------------------------------ S7..S10
def file_date(name: Column | str, fmt: str = "ddMMyyyy") -> Column:
    """Business date from the digits of a file name."""
    return date_from_digits(name, fmt)


def with_file_date(df: DataFrame, name_col: str, fmt: str, out: str = "update_dt") -> DataFrame:
    """A full-slice file; its date (from the name) becomes the change time."""
    return df.withColumn(out, file_date(name_col, fmt).cast("timestamp_ntz"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """File names under ``path`` (metadata only, contents are not read)."""
    return (spark.read.format("binaryFile").load(path).select(
        F.col("path"), F.element_at(F.split("path", "/"), -1).alias("file_name")))


def pending_files(files: DataFrame, prefix: str, wm, fmt: str = "ddMMyyyy", name_col: str = "file_name") -> DataFrame:
    """Files of one feed dated after the watermark, ordered by the parsed
    date (not the text); ``is_next`` marks the oldest one.  The oldest date is
    read first, as one row, like a watermark, so no join is needed."""
    f = files.filter(F.col(name_col).startswith(prefix)).withColumn("file_dt", file_date(name_col, fmt))
    f = f.filter(F.col("file_dt") > F.lit(wm).cast("date"))
    first = f.agg(F.min("file_dt")).first()[0]
    return f.select(name_col, "file_dt", (F.col("file_dt") == F.lit(first).cast("date")).alias("is_next"))


def cumulative_delta(file_rows: DataFrame, fact: DataFrame, date_col: str, wm, key: list[str]) -> DataFrame:
    """S8 + D10: rows of a cumulative file from the watermark day on
    (``>=``, day-granular data), minus rows already loaded."""
    new = file_rows.filter(F.col(date_col) >= F.lit(wm).cast("date"))
    return new.dropDuplicates(key).join(fact.select(*key), key, "left_anti")
