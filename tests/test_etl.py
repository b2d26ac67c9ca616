import os

import pytest
from pyspark.sql import functions as F

from tagloom.operators.etl import questions_from_posts
from tagloom.sources.questions import load_questions, save_questions
from tagloom.sources.schema import QUESTION_COLUMNS, RAW_POST_FIELDS, raw_post_schema
from tagloom.sources.xml import read_posts_document, read_posts_xml, write_posts_xml, xml_rejects

DUMP = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" CreationDate="2018-07-31T21:42:52.667" Score="5" Title="How  to Parse, in Python" Tags="&lt;Python&gt;&lt;c#&gt;&lt;asp.net-mvc&gt;" Body="b1" />
  <row Id="2" PostTypeId="1" CreationDate="2018-02-31T10:00:00.000" Score="x" Title="bad date" Tags="" Body="b2" />
  <row Id="3" PostTypeId="2" ParentId="1" CreationDate="2018-08-01T00:00:00.000" Body="an answer" />
  <row Id="4" PostTypeId="1" CreationDate="2019-01-05T01:02:03.004" Title="with child" Tags="&lt;java&gt;" Body="b4"><t>t</t></row>
  <row Id="5" PostTypeId="1" Title="no date" Tags="&lt;go&gt;" Body="b5" />
</posts>
"""


DAMAGED = """\ufeff<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" Title="ok" />
  <row Id="2" PostTypeId="1" Title="bare & amp" />
  <row Id="3" PostTypeId="1" Title="after the bad one" />
  <row Id="4" PostTypeId="1"
   Title="two lines" />

  <row PostTypeId="1" Title="no id" />
  <row Id="6" PostTypeId="1" Title="child"><t>t</t></row>
</posts>
"""


def test_no_line_is_lost(spark, tmp_path):
    from tagloom.sources.xml import REASON_MALFORMED, REASON_NO_ID, xml_rejects
    path = tmp_path / "Damaged.xml"
    path.write_text(DAMAGED)
    assert sorted(r["_Id"] for r in read_posts_xml(spark, str(path)).collect()) == ["1", "3", "6"]
    rejects = [(r["line"], r["reason"]) for r in xml_rejects(spark, str(path)).collect()]
    assert sorted(rejects, key=repr) == sorted([
        ('<row Id="2" PostTypeId="1" Title="bare & amp" />', REASON_MALFORMED),
        ('<row Id="4" PostTypeId="1"', REASON_MALFORMED), ('Title="two lines" />', REASON_MALFORMED), (None, REASON_NO_ID)], key=repr)


def test_whole_documents_fail_loudly(spark, tmp_path):
    path = tmp_path / "Damaged.xml"
    path.write_text(DAMAGED)
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_posts_document(spark, str(path)).collect()
    good = "\n".join(x for x in DAMAGED.splitlines() if "amp" not in x)
    path.write_text(good.replace("\ufeff", ""))
    assert sorted(r["_Id"] for r in read_posts_document(spark, str(path)).collect()) == ["1", "3", "4", "6"]


def _dump(tmp_path):
    p = tmp_path / "Posts.xml"
    p.write_text(DUMP)
    return str(p)


def test_read_xml_schema_and_rows(spark, tmp_path):
    df = read_posts_xml(spark, _dump(tmp_path))
    assert len(df.columns) == len(RAW_POST_FIELDS)
    assert df.count() == 5


def test_questions_from_dump(spark, tmp_path):
    q = questions_from_posts(read_posts_xml(spark, _dump(tmp_path)))
    assert q.columns == QUESTION_COLUMNS
    rows = {r["Id"]: r for r in q.collect()}
    assert sorted(rows) == [1, 2, 4]          # answer and dateless row dropped
    assert rows[1]["label"] == ["python", "c#", "asp.net-mvc"]
    assert (rows[1]["Year"], rows[1]["Month"]) == (2018, 7)
    assert str(rows[1]["CreationDate"]) == "2018-07-31"
    assert rows[2]["label"] == []             # empty Tags is not NULL
    assert rows[2]["Score"] is None           # 'x' -> NULL, not a failed file
    assert rows[2]["CreationDate"] is None and rows[2]["Year"] is None   # Feb 31
    assert rows[4]["label"] == ["java"]
    dropped = questions_from_posts(read_posts_xml(spark, _dump(tmp_path)), drop_bad_dates=True)
    assert sorted(r["Id"] for r in dropped.collect()) == [1, 4]


def test_xml_round_trip_and_rechunk(spark, tmp_path):
    df = read_posts_xml(spark, _dump(tmp_path))
    out = str(tmp_path / "rechunked")
    write_posts_xml(df.coalesce(1), out, max_records_per_file=2)
    files = [f for f in os.listdir(out) if f.endswith(".xml")]
    assert len(files) == 3
    back = read_posts_xml(spark, out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    lines = (spark.read.format("xml").option("rowTag", "row").option("multiLine", "false")
             .schema(raw_post_schema()).load(out).where(F.col("_Id").isNotNull()))
    assert lines.count() == 5


def test_partitioned_parquet_and_pruning(spark, tmp_path):
    q = questions_from_posts(read_posts_xml(spark, _dump(tmp_path)), drop_bad_dates=True)
    path = str(tmp_path / "questions")
    save_questions(q, path)
    assert os.path.isdir(os.path.join(path, "Year=2018", "Month=7"))
    back = spark.read.parquet(path)
    assert back.columns[-2:] == ["Year", "Month"]
    sel = load_questions(spark, path, year=2019)
    assert [r["Id"] for r in sel.collect()] == [4]
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Year" in plan
    assert "Body" not in sel._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1][:200]


def test_dynamic_overwrite_keeps_other_months(spark, tmp_path):
    q = questions_from_posts(read_posts_xml(spark, _dump(tmp_path)), drop_bad_dates=True)
    path = str(tmp_path / "incremental")
    save_questions(q, path)
    newer = q.where(F.col("Year") == 2019).withColumn("Score", F.lit(99))
    save_questions(newer, path, dynamic_overwrite=True)
    back = {r["Id"]: r["Score"] for r in spark.read.parquet(path).collect()}
    assert back == {1: 5, 4: 99}          # 2018-07 untouched, 2019-01 replaced
    save_questions(newer, path)            # static overwrite replaces the whole table
    assert [r["Id"] for r in spark.read.parquet(path).collect()] == [4]


def test_one_large_dump_is_read_in_parallel(spark, tmp_path):
    from tagloom.sources.fixtures import posts_fixture
    posts = posts_fixture(spark, "/root/testdata/sf0.01")
    out = str(tmp_path / "one")
    write_posts_xml(posts.coalesce(1), out)
    files = [f for f in os.listdir(out) if f.endswith(".xml")]
    assert len(files) == 1 and os.path.getsize(os.path.join(out, files[0])) > 2 * 1024 * 1024
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(512 * 1024))
    try:
        assert read_posts_document(spark, out).rdd.getNumPartitions() == 1
        df = read_posts_xml(spark, out)
        assert df.rdd.getNumPartitions() > 2
        assert df.count() == posts.count()
        assert sorted(r["_Id"] for r in df.select("_Id").collect()) == \
            sorted(r["_Id"] for r in posts.select("_Id").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


MULTILINE = """﻿<?xml version="1.0" encoding="utf-8"?>
<!-- a dump -->
<posts>
  <row
    Id="1"
    Title="a &lt;row b > c"
    Tags="&lt;x&gt;"
  />
  <row Id="2" Title="same line" /><row Id="3"
Title="t"></row>
  <row Id="4" Title="bare & amp"
  />
  <row Id="5"
  <row Id="6" Title="child"><tag
  a="b">x</tag>
  </row>
  <row Title="no id"
  />
  <rows Id="7"/>
  <row Id="8" Title="last"
/></posts>
"""


def test_elements_over_lines(spark, tmp_path):
    path = tmp_path / "Multi.xml"
    path.write_text(MULTILINE)
    rows = read_posts_xml(spark, str(path), line_wise=False).select("_Id", "_Title").collect()
    assert sorted(map(tuple, rows)) == [("1", "a <row b > c"), ("2", "same line"), ("3", "t"), ("6", "child"), ("8", "last")]
    rejects = [(r["line"], r["reason"]) for r in xml_rejects(spark, str(path), line_wise=False).collect()]
    assert sorted(x[0].split()[1] if x[0] else "" for x in rejects) == ["", "Id=\"4\"", "Id=\"5\"", "Id=\"7\"/>"]
    assert {x[1] for x in rejects if x[0] is None} == {"row without Id"}


@pytest.mark.parametrize("split", [97, 1000, 4096])
def test_elements_do_not_depend_on_splits(spark, tmp_path, split):
    """One file cut at any byte, by several tasks: the rows that parsing it as
    one document gives."""
    rows = [f'<row\n Id="{k}"\n Title="{"é日 &lt;row " * (k % 7)}{k}"\n Body="{"x" * (k * 13 % 301)}"\n/>' for k in range(200)]
    path = tmp_path / "Posts.xml"
    path.write_text('<?xml version="1.0"?>\n<posts>\n' + "\n".join(rows) + "\n</posts>\n")
    whole = read_posts_document(spark, str(path)).select("_Id", "_Title", "_Body").collect()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        df = read_posts_xml(spark, str(path), line_wise=False).select("_Id", "_Title", "_Body")
        assert df.rdd.getNumPartitions() > 1
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, whole)) and len(whole) == 200
        assert xml_rejects(spark, str(path), line_wise=False).collect() == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
