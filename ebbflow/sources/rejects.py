"""Bad records of text feeds.

A line that cannot be read goes, with the reason, to a reject output beside the good rows; the feed goes on.  The two
outputs come from one parse, so every line is in exactly one of them (:class:`Parsed`).

Reasons, the first that holds: ``blank`` (nothing but blanks), ``fields`` (too few or too many), ``key`` (an empty
required field), ``time`` and ``amount`` (cannot be parsed).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions.expr import parse_decimal_comma

#: What a text column is to become; plain text is trimmed.
TEXT, TIME, AMOUNT = "text", "time", "amount"


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = TEXT
    required: bool = False
    fmt: str = "yyyy-MM-dd HH:mm:ss"
    precision: int = 12
    scale: int = 2

    def value(self, text: Column) -> Column:
        text = F.trim(text)
        if self.kind == TIME:
            return F.try_to_timestamp(text, F.lit(self.fmt)).cast("timestamp_ntz")
        return parse_decimal_comma(text, self.precision, self.scale) if self.kind == AMOUNT else text


#: Fixed format of the payment feed.
PAYMENT_FIELDS = [Field("transaction_dt", TIME, True, "dd.MM.yyyy HH:mm:ss"), Field("card_num", TEXT, True), Field("transaction_amt", AMOUNT, True)]
#: Fixed format of the transactions feed.
TRANSACTION_FIELDS = [Field("trans_id", TEXT, True), Field("trans_date", TIME, True, "yyyy-MM-dd HH:mm:ss[.SSSSSS]"), Field("amt", AMOUNT, True, precision=10),
                      Field("card_num", TEXT, True), Field("oper_type"), Field("oper_result"), Field("terminal")]


@dataclass(frozen=True)
class Parsed:
    """A parsed feed: ``rows`` has ``reason`` (null for a good line), the line, and the fields' values."""

    rows: DataFrame
    fields: list[Field]

    @property
    def good(self) -> DataFrame:
        return self.rows.filter(F.col("reason").isNull()).select(*[f.name for f in self.fields])

    @property
    def rejected(self) -> DataFrame:
        keep = [c for c in self.rows.columns if c not in {f.name for f in self.fields}]
        return self.rows.filter(F.col("reason").isNotNull()).select(*keep)

    def observed(self, name: str = "feed") -> tuple[Parsed, Observation]:
        """The same feed with counts of its lines and rejected lines, filled when ``rows`` is first evaluated."""
        seen = Observation(name)
        rows = self.rows.observe(seen, F.count(F.lit(1)).alias("lines"), F.count("reason").alias("rejected"))
        return Parsed(rows, self.fields), seen


def parse_lines(df: DataFrame, fields: list[Field], sep: str, line_col: str = "value") -> Parsed:
    """Split every line at ``sep`` (no quoting) and parse its fields; other columns of ``df`` are kept with the line.

    A null line counts as blank.  A line is cut once and its fields are parsed once, whatever is asked of the rows: both
    steps are generators of one row, so a filter on the reason does not repeat them below.
    """
    others = [c for c in df.columns if c != line_col]
    lines = df.select(*others, F.col(line_col).alias("line"))
    text = F.regexp_replace("line", "[\r\n]+$", "")
    blank = text.isNull() | (F.trim(F.translate(text, "\t", " ")) == "")
    cut = lines.select("*", _one_row(F.split(text, _quoted(sep), -1).alias("_cut"), blank.alias("_blank")))
    part = lambda i: F.get(F.col("_cut"), F.lit(i))
    empty = [F.trim(part(i)) == "" for i in range(len(fields))]
    read = cut.select("*", _one_row(*[f.value(part(i)).alias(f.name) for i, f in enumerate(fields)],
                                    *[e.alias(f"_empty_{i}") for i, e in enumerate(empty)]))
    missing, bad_time, bad_amount = F.lit(False), F.lit(False), F.lit(False)
    for i, f in enumerate(fields):
        is_empty, v = F.col(f"_empty_{i}"), F.col(f.name)
        if f.required:
            missing = missing | is_empty
        if f.kind == TIME:
            bad_time = bad_time | (~is_empty & v.isNull())
        if f.kind == AMOUNT:
            bad_amount = bad_amount | (~is_empty & v.isNull())
    reason = (F.when(F.col("_blank"), "blank").when(F.size("_cut") != len(fields), "fields")
              .when(missing, "key").when(bad_time, "time").when(bad_amount, "amount"))
    return Parsed(read.select(*others, "line", reason.alias("reason"), *[f.name for f in fields]), fields)


def _one_row(*columns: Column) -> Column:
    """The columns as the one row of a generator."""
    return F.inline(F.array(F.struct(*columns)))


def _quoted(sep: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() and ord(c) > 32 else c for c in sep)


def read_feed(spark: SparkSession, path: str, fields: list[Field], sep: str, header: bool = False) -> Parsed:
    """Text files of a feed, each line with the name of its file; a header line is known by the first field's name."""
    raw = spark.read.text(path).withColumn("file_name", F.col("_metadata.file_name"))
    if header:
        raw = raw.filter(~F.coalesce(F.col("value").startswith(fields[0].name + sep), F.lit(False)))
    return parse_lines(raw, fields, sep)
