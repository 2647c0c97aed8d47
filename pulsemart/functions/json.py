"""JSON <-> row.

P1 parses with an all-string schema and casts afterwards: a change record
quotes every value (``{"total_amount":"12.5"}``) and a typed schema would turn
those into NULL (trap T1).  Casts use ANSI ``cast`` so bad input fails the job,
as a bad number fails the reference; ``strict=False`` uses ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default mode.  Without any option Spark gives each field taken from the result a
# parse of its own, so a record of 18 fields is read 18 times.
ONE_PARSE = {"mode": "PERMISSIVE"}


def parse_json(
    df: DataFrame,
    value_col: str,
    wire_schema: T.StructType,
    casts: dict[str, str] | None = None,
    keep: tuple[str, ...] = (),
    strict: bool = True,
) -> DataFrame:
    """JSON text column -> one typed column per field of ``wire_schema``."""
    parsed = F.from_json(F.col(value_col), wire_schema, ONE_PARSE)
    cols: list[Column] = [F.col(k) for k in keep]
    for field in wire_schema.fields:
        c = parsed.getField(field.name)
        target = (casts or {}).get(field.name)
        if target:
            c = c.cast(target) if strict else c.try_cast(target)
        cols.append(c.alias(field.name))
    return df.select(*cols)
