"""Steps of row-wise work kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, as a generator of one row each.

    Filters are not pushed below a generator: without it a filter on computed columns would
    be rewritten in terms of their inputs and compute them again, rule within rule.  And the
    code in front of it and behind it is generated as functions of their own: one function of
    many rules is too long for the JVM to compile and is interpreted for every row.
    """
    quoted = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    return df.select(F.inline(F.array(F.struct(*quoted))))
