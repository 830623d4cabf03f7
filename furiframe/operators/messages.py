"""Conversation records read back from JSON Lines: damaged ones go to a reject table, with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furiframe.operators.dataset import MESSAGES

_RECORD = f"messages {MESSAGES}, _damaged string"


def _problem(line: Column, record: Column) -> Column:
    """Why a line is no record; null for a sound one."""
    messages = record["messages"]
    return (F.when(line.isNull() | (F.trim(line) == ""), F.lit("empty line"))
            .when(record["_damaged"].isNotNull(), F.lit("damaged record"))
            .when(messages.isNull(), F.lit("no messages"))
            .when(F.size(messages) == 0, F.lit("no turns"))
            .when(F.exists(messages, lambda m: m.isNull() | m["role"].isNull() | m["content"].isNull()),
                  F.lit("turn without role or content")))


def parse_messages(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``lines`` with ``messages`` and ``problem`` added: exactly one of them is null in every row.

    One narrow pass, no shuffle: a record that is no JSON, or whose fields are
    of other types, comes back whole in the corrupt-record column of the
    permissive parser instead of as silent nulls.
    """
    line = F.col(line_col)
    record = F.from_json(line, _RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged"})
    parsed = lines.withColumn("_ff_record", record)
    problem = _problem(line, F.col("_ff_record"))
    sound = F.when(F.col("problem").isNull(), F.col("_ff_record.messages"))
    return parsed.withColumn("problem", problem).withColumn("messages", sound).drop("_ff_record")


def sound_messages(parsed: DataFrame) -> DataFrame:
    """The sound records of ``parse_messages``."""
    return parsed.where(F.col("problem").isNull()).drop("problem")


def rejected_messages(parsed: DataFrame) -> DataFrame:
    """The records that are not sound, whole, with their ``problem``."""
    return parsed.where(F.col("problem").isNotNull()).drop("messages")
