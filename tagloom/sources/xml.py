"""Post dump in XML: parallel read with rejects, re-chunked write.

A dump is one ``<posts>`` root with one self-closing ``<row .../>`` element
per post, attributes holding the fields. Spark's XML source reads it with a
declared schema (attributes become ``_``-prefixed columns). Every attribute
is read as text: a typed read fails a whole file on one bad cell.

By default a dump with one row per line is read in parallel byte ranges. Dumps
whose elements span lines (``line_wise=False``) are read in parallel as well:
records are cut before every row tag instead of at line ends, and each is
parsed by itself. Either way nothing is lost: what is no row, no root and no
header goes to ``xml_rejects`` with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.sources.schema import raw_post_schema

ROW_TAG = "row"
ROOT_TAG = "posts"


# Reasons of a rejected line.
REASON_MALFORMED = "malformed row element"
REASON_NO_ID = "row without Id"
_CORRUPT = "_corrupt_line"


def _lines(spark: SparkSession, path: str, row_tag: str, root_tag: str, schema) -> DataFrame:
    """Every line of the dump but blank ones, the XML header and the root's
    tags: parsed columns, or the line itself in the corrupt column."""
    fields = [f for f in (schema or raw_post_schema()) if f.name != _CORRUPT]
    df = (spark.read.format("xml")
          .option("rowTag", row_tag).option("multiLine", "false").option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", _CORRUPT)
          .schema(T.StructType([*fields, T.StructField(_CORRUPT, T.StringType(), True)]))
          .load(path))
    frame = rf"^\uFEFF?\s*((<\?[^>]*\?>|<!--[^>]*-->|</?{root_tag}(\s[^>]*)?/?>)\s*)*$"
    return df.where(F.col(_CORRUPT).isNull() | ~F.col(_CORRUPT).rlike(frame))


def _elements(spark: SparkSession, path: str, row_tag: str, root_tag: str, schema) -> DataFrame:
    """Every row element of the dump, over lines or not: parsed columns, or
    the element's text in the corrupt column.

    The text reader splits files at any byte and finds the next record
    delimiter, here the opening of a row tag: a raw ``<`` cannot occur in an
    attribute. What follows an element (comments, the root's end) is left to
    the parser, which reads the element only.
    """
    fields = [f for f in (schema or raw_post_schema()) if f.name != _CORRUPT]
    parsed = T.StructType([*fields, T.StructField(_CORRUPT, T.StringType(), True)])
    opening = f"<{row_tag}"
    value, element = F.col("value"), F.concat(F.lit(opening), F.col("value"))
    # what stands before a file's first row
    head = rf"^\uFEFF?\s*((<\?[^>]*\?>|<!--[^>]*-->|<{root_tag}(\s[^>]*)?/?>|</{root_tag}\s*>)\s*)+$|^\uFEFF?\s*$"
    closed = F.concat(F.lit(opening), F.regexp_replace(value, rf"\s*</{root_tag}\s*>\s*$", ""))
    of_tag = value.rlike(r"^[\s/>]")
    df = spark.read.option("lineSep", opening).text(path).where(~value.rlike(head)).select(
        F.from_xml(F.when(of_tag, closed), parsed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("row"),
        F.when(~of_tag, element).alias("other"))
    names = [f.name for f in fields]
    return df.select(*[F.col(f"row.`{n}`").alias(n) for n in names], F.coalesce("other", f"row.{_CORRUPT}").alias(_CORRUPT))


def _records(spark, path, row_tag, root_tag, schema, line_wise) -> DataFrame:
    return (_lines if line_wise else _elements)(spark, path, row_tag, root_tag, schema)


def read_posts_xml(spark: SparkSession, path: str, row_tag: str = ROW_TAG, schema=None,
                   line_wise: bool = True, root_tag: str = ROOT_TAG) -> DataFrame:
    """Post rows with an Id from XML files (a file, a folder or a glob).

    ``line_wise`` is for dumps with one row element per line (the usual dump
    layout, and what ``write_posts_xml`` produces: newlines inside values are
    written as character references). Otherwise elements may span lines. In
    both cases each file is split into byte ranges of
    ``spark.sql.files.maxPartitionBytes``; what holds no whole row is found by
    :func:`xml_rejects`.
    """
    df = _records(spark, path, row_tag, root_tag, schema, line_wise)
    return df.where(F.col(_CORRUPT).isNull() & F.col("_Id").isNotNull()).drop(_CORRUPT)


def read_posts_document(spark: SparkSession, path: str, row_tag: str = ROW_TAG, schema=None) -> DataFrame:
    """Post rows with an Id, each file parsed as one XML document by one task:
    for small files of any layout. A malformed element fails the read."""
    df = (spark.read.format("xml").option("rowTag", row_tag).option("mode", "FAILFAST")
          .schema(schema or raw_post_schema()).load(path))
    return df.where(F.col("_Id").isNotNull())


def xml_rejects(spark: SparkSession, path: str, row_tag: str = ROW_TAG, root_tag: str = ROOT_TAG,
                line_wise: bool = True) -> DataFrame:
    """(line, reason) of the lines, or elements, that ``read_posts_xml`` does
    not return.

    Read line by line, a row element that spans lines is malformed on each of
    them. ``line`` is NULL for a well-formed row without an Id: its other
    fields are not kept. Read by elements, an element reaches to the next row
    tag; a bare row tag with nothing after it is not told from a file's start.
    """
    df = _records(spark, path, row_tag, root_tag, None, line_wise)
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit(REASON_MALFORMED)).when(
        F.col("_Id").isNull(), F.lit(REASON_NO_ID))
    return df.select(F.trim(F.col(_CORRUPT)).alias("line"), reason.alias("reason")).where(F.col("reason").isNotNull())


def write_posts_xml(df: DataFrame, path: str, max_records_per_file: int | None = None,
                    row_tag: str = ROW_TAG, root_tag: str = ROOT_TAG, mode: str = "overwrite") -> None:
    """Write post rows as XML (``_``-prefixed columns become attributes).

    ``max_records_per_file`` re-chunks the output into files of at most that
    many rows, the parallel-friendly layout for later reads.
    """
    w = (df.write.mode(mode).format("xml")
         .option("rowTag", row_tag).option("rootTag", root_tag))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.save(path)
