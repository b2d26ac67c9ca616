"""Date expressions for the dump's timestamp text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.sources.schema import DUMP_TIMESTAMP_FORMAT


def parse_dump_date(col: str | Column) -> Column:
    """Dump timestamp text -> DATE; unparsable or impossible dates become NULL.

    ``try_to_timestamp`` keeps a malformed cell from failing the job (ANSI
    mode would otherwise raise); the time of day is dropped.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(F.try_to_timestamp(c, F.lit(DUMP_TIMESTAMP_FORMAT)))
