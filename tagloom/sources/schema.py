"""Schemas of the post dump and of the question table.

Fixed values (must equal the dump format): the attribute names of a post
row and their logical types, and the order of the question table columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: post row attributes, in dump order, with logical type ---
RAW_POST_FIELDS = [
    ("_Id", "int"),
    ("_PostTypeId", "int"),
    ("_ParentId", "int"),
    ("_AcceptedAnswerId", "int"),
    ("_CreationDate", "string"),
    ("_ClosedDate", "string"),
    ("_CommunityOwnedDate", "string"),
    ("_Score", "int"),
    ("_ViewCount", "int"),
    ("_Body", "string"),
    ("_OwnerUserId", "int"),
    ("_OwnerDisplayName", "string"),
    ("_LastEditorUserId", "int"),
    ("_LastEditorDisplayName", "string"),
    ("_LastEditDate", "string"),
    ("_LastActivityDate", "string"),
    ("_Title", "string"),
    ("_Tags", "string"),
    ("_AnswerCount", "int"),
    ("_CommentCount", "int"),
    ("_FavoriteCount", "int"),
]

# --- fixed values: question table columns, in output order ---
QUESTION_COLUMNS = [
    "Id", "AcceptedAnswerId", "CreationDate", "ClosedDate", "CommunityOwnedDate", "Score",
    "ViewCount", "Body", "OwnerUserId", "OwnerDisplayName", "LastEditorUserId",
    "LastEditorDisplayName", "LastEditDate", "LastActivityDate", "Title", "AnswerCount",
    "CommentCount", "FavoriteCount", "Year", "Month", "label",
]

# --- fixed values: timestamp text format of the dump, e.g. 2018-07-31T21:42:52.667 ---
DUMP_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"

# Identifier columns are widened to 64 bit: a dump past 2^31 posts must not
# silently turn ids into NULL.
ID_COLUMNS = {"Id", "AcceptedAnswerId", "OwnerUserId", "LastEditorUserId"}

INT_FIELDS = [name for name, kind in RAW_POST_FIELDS if kind == "int"]
DATE_FIELDS = ["_CreationDate", "_ClosedDate", "_CommunityOwnedDate", "_LastEditDate",
               "_LastActivityDate"]


def raw_post_schema() -> T.StructType:
    """Every attribute read as a nullable string.

    A typed read makes one bad integer attribute fail the whole file; we read
    text and convert with ``try_cast`` afterwards, so a bad value becomes NULL
    for that cell only.
    """
    return T.StructType([T.StructField(name, T.StringType(), True) for name, _ in RAW_POST_FIELDS])


def question_schema() -> T.StructType:
    """Schema of the question table produced by the ETL, in column order."""
    date_cols = {"CreationDate", "ClosedDate", "CommunityOwnedDate", "LastEditDate",
                 "LastActivityDate"}
    str_cols = {"Body", "OwnerDisplayName", "LastEditorDisplayName", "Title"}
    fields = []
    for name in QUESTION_COLUMNS:
        if name == "label":
            dt = T.ArrayType(T.StringType(), True)
        elif name in date_cols:
            dt = T.DateType()
        elif name in str_cols:
            dt = T.StringType()
        elif name in ID_COLUMNS:
            dt = T.LongType()
        else:
            dt = T.IntegerType()
        fields.append(T.StructField(name, dt, True))
    return T.StructType(fields)
