"""Date mentions, by hand-made sentences."""

import pytest
from pyspark.sql import functions as F

from mailweave.operators.query_parse import extract_date_range

FOUND = [
    ("seen on 3/14/2012 there", "2012-03-14", "2012-04-14"),
    ("3 March 2012", "2012-03-03", "2012-04-03"),
    ("the 3rd of March, 2012", "2012-03-03", "2012-04-03"),
    ("March 3rd 2012", "2012-03-03", "2012-04-03"),
    ("Sept. 2012", "2012-09-01", "2012-10-01"),
    ("december, 2012", "2012-12-01", "2013-01-01"),
    ("2011-01-31", "2011-01-31", "2011-02-28"),
    ("2011-02-31 then 2012", None, None),
    ("mail of 2010.", "2010-01-01", "2010-02-01"),
    ("1234 or x2010 or 20100", None, None),
    ("March 3", "2012-03-03", "2012-04-03"),
    ("3 mar", "2012-03-03", "2012-04-03"),
    ("in March", "2012-03-01", "2012-04-01"),
    ("we march, you may", None, None),
    ("May I ask", None, None),
    ("last May", "2012-05-01", "2012-06-01"),
    ("last  July", "2011-07-01", "2011-08-01"),
    ("last 5 March", "2012-03-05", "2012-04-05"),
    ("yesterday", "2012-06-14", "2012-07-14"),
    ("Last week", "2012-06-08", "2012-07-08"),
    ("last month", "2012-05-15", "2012-06-15"),
    ("last year", "2011-06-15", "2011-07-15"),
    ("7-UP from 12 to 13, or 2011", "2011-01-01", "2011-02-01"),
    ("9/2011 or 3/4", "2011-01-01", "2011-02-01"),
    ("1999-Jan", "1999-01-01", "1999-02-01"),
    ("March 2012 and April 2013", "2012-03-01", "2012-04-01"),
    ("", None, None), (None, None, None), ("no date", None, None), ("31 April 2012", None, None), ("0/0/2012", None, None),
]


def test_forms(spark):
    rows = [(k, text) for k, (text, _, _) in enumerate(FOUND)]
    df = spark.createDataFrame(rows, "k int, query string").withColumn("r", extract_date_range(F.col("query"), "2012-06-15"))
    for r in df.select("k", "r.*").collect():
        got = [None if d is None else str(d)[:10] for d in (r.start_date, r.end_date)]
        assert got == list(FOUND[r.k][1:]), FOUND[r.k]


@pytest.mark.parametrize("day, start", [("2012-02-29", "2012-02-22"), ("2012-01-03", "2011-12-27")])
def test_relative_to_a_day(spark, day, start):
    df = spark.range(1).select(extract_date_range(F.lit("news of last week"), day).alias("r"))
    assert str(df.first().r.start_date)[:10] == start
