"""Tool calls inside assistant messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tagged_call(content: Column) -> Column:
    """JSON text between the first ``<tool>`` and ``</tool>``; null when either tag is missing."""
    return F.nullif(F.trim(F.regexp_extract(content, r"(?s)<tool>(.*?)</tool>", 1)), F.lit(""))


def plain_name(name: Column, prefix: str = "weather_tools.") -> Column:
    return F.replace(name, F.lit(prefix), F.lit(""))


def extract_tool_calls(messages: DataFrame, content: str = "content", first_call: str | None = None,
                       prefix: str = "weather_tools.") -> DataFrame:
    """Adds ``tool_name``, ``arguments`` (JSON object text) and ``call_status``.

    ``first_call`` names a column holding the JSON of the first structured call, which wins over the tag.
    ``arguments`` may arrive as an object or as a string holding one. Text that is no JSON is kept with
    status ``malformed`` rather than dropped.
    """
    call = tagged_call(F.col(content))
    if first_call is not None:
        call = F.coalesce(F.col(first_call), call)
    raw_arguments = F.get_json_object("call_json", "$.arguments")
    return (
        messages.withColumn("call_json", call)
        .withColumn("call_variant", F.try_parse_json("call_json"))
        .withColumn("tool_name", plain_name(F.get_json_object("call_json", "$.name"), prefix))
        .withColumn("arguments", F.when(F.col("call_variant").isNotNull(), raw_arguments))
        .withColumn(
            "call_status",
            F.when(F.col("call_json").isNull(), "none")
            .when(F.col("call_variant").isNull() | F.col("tool_name").isNull(), "malformed")
            .otherwise("ok"),
        )
        .withColumn("tool_name", F.when(F.col("call_status") == "ok", F.col("tool_name")))
        .drop("call_json", "call_variant")
    )
