"""Post dump -> question table (filter, type, date, split tags, lay out)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import parse_dump_date
from tagloom.functions.tags import split_tags
from tagloom.sources.schema import QUESTION_COLUMNS, question_schema


def question_filter() -> Column:
    """A question with tags and a creation date (the ETL's row filter)."""
    return ((F.col("_PostTypeId").try_cast("int") == 1)
            & F.col("_Tags").isNotNull()
            & F.col("_CreationDate").isNotNull())


def questions_from_posts(posts: DataFrame, drop_bad_dates: bool = False) -> DataFrame:
    """Typed question table from raw post rows.

    Input: the all-string dump columns (``_Id`` ...). Output: the question
    table columns in their fixed order, with typed values. Cells that do not
    parse (an integer column holding text, an impossible date) become NULL
    instead of failing the job. With ``drop_bad_dates`` rows whose creation
    date does not parse are removed (otherwise they land in the NULL
    Year/Month partition).
    """
    schema = {f.name: f.dataType for f in question_schema().fields}
    q = posts.where(question_filter())
    created = parse_dump_date("_CreationDate")
    exprs: dict[str, Column] = {}
    for name in QUESTION_COLUMNS:
        src = "_" + name
        if name == "Year":
            exprs[name] = F.year(created)
        elif name == "Month":
            exprs[name] = F.month(created)
        elif name == "label":
            exprs[name] = split_tags("_Tags")
        elif name == "CreationDate":
            exprs[name] = created
        elif schema[name].typeName() == "date":
            exprs[name] = parse_dump_date(src)
        elif schema[name].typeName() == "string":
            exprs[name] = F.col(src)
        else:
            exprs[name] = F.col(src).try_cast(schema[name])
    out = q.select([exprs[n].alias(n) for n in QUESTION_COLUMNS])
    if drop_bad_dates:
        out = out.where(F.col("CreationDate").isNotNull())
    return out


def layout_by_month(questions: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Co-locate each (Year, Month) before a partitioned write.

    Default is a rebalance hint: AQE sizes the partitions at runtime and
    splits a month that holds a large share of the rows, so no task writes an
    outsized file. A fixed ``num_partitions`` gives a plain hash repartition.
    """
    if num_partitions:
        return questions.repartition(num_partitions, "Year", "Month")
    return questions.hint("rebalance", "Year", "Month")
