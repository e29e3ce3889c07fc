"""Control state: high-water marks and JSON workflow settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_watermark(control: DataFrame, source: str, default=None):
    """The mark of one source as a driver literal (so that the
    incremental filter is pushed into the scan).  The control table has one
    row per source."""
    rows = control.filter(F.col("source") == source).select("watermark").limit(1).collect()
    return rows[0]["watermark"] if rows else default


def advance_watermarks(control: DataFrame, batch_marks: DataFrame) -> DataFrame:
    """``greatest(coalesce(max(batch ts), old), old)`` per source.

    ``batch_marks`` holds (source, ts) rows of the loaded batches (any
    number per source); an empty batch keeps the old mark and a mark never
    moves backwards."""
    m = batch_marks.groupBy("source").agg(F.max("ts").alias("_m"))
    old = F.col("watermark")
    return control.join(m, "source", "left").select(
        "source", F.greatest(F.coalesce(F.col("_m"), old), old).alias("watermark"))


def setting(settings: DataFrame, workflows: DataFrame, field: str, default: Column, cast: str) -> DataFrame:
    """Read a field of the JSON settings of each workflow, with a default
    when the workflow or the field is absent."""
    val = F.get_json_object(F.col("workflow_settings"), f"$.{field}").try_cast(cast)
    return workflows.join(settings, "workflow_key", "left").select(
        "workflow_key", F.coalesce(val, default).alias(field))


def read_setting(settings: DataFrame, workflow_key: str, field: str, default, cast: str):
    """W1/W3 for one workflow: the field as a driver literal (one row), so the
    incremental filter that uses it is pushed into the scan."""
    rows = setting(settings, settings.sparkSession.createDataFrame([(workflow_key,)], "workflow_key string"),
                   field, F.lit(default).cast(cast), cast).collect()
    return rows[0][field]


def settings_row(workflow_key: Column, **fields: Column) -> list[Column]:
    """Serialise the new checkpoint of a workflow to JSON."""
    return [workflow_key.alias("workflow_key"),
            F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("workflow_settings")]


def control_table(spark: SparkSession, marks: dict[str, str]) -> DataFrame:
    """A control table (source, watermark) from driver literals."""
    return spark.createDataFrame([(k, v) for k, v in marks.items()], "source string, watermark string").select(
        "source", F.col("watermark").cast("timestamp_ntz").alias("watermark"))
