"""Export form of requests, tasks and replies: fields joined by `;`.

Inside Spark these are ordinary columns. The text form cannot hold a `;` in a field.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ";"

# Flags of the text form.
TERMINATE = "_terminate"
ERROR = "_exceptionMessage"
NONE = "---"

# Field order, with the type each field has as a column.
REQUEST = {"local_id": "string", "bucket": "string", "batch_size": "int", "flag": "string"}
TASK = {
    "local_id": "string",
    "num_tasks": "bigint",
    "operation": "string",
    "url": "string",
    "bucket": "string",
}
REPLY = {
    "local_id": "string",
    "num_tasks": "bigint",
    "url": "string",
    "result": "string",
    "operation": "string",
    "flag": "string",
}


def flag_of(is_set: Column, name: str) -> Column:
    return F.when(is_set, name).otherwise(NONE)


def encode(layout: dict[str, str], **columns: Column) -> Column:
    """The text of a message; a field without a given column is read by its name."""
    fields = [columns.get(name, F.col(name)).cast("string") for name in layout]
    # A null would be left out and shift the fields after it.
    return F.concat_ws(SEPARATOR, *[F.coalesce(f, F.lit("")) for f in fields])


def decode(layout: dict[str, str], message: Column) -> Column:
    """The message as a struct of typed fields; null where a field does not parse."""
    parts = F.split(message, SEPARATOR)
    return F.struct(
        *[
            F.get(parts, F.lit(i)).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(layout.items())
        ]
    )
