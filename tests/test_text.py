import math

from pyspark.sql import functions as F

from mailweave.functions import text as tx
from mailweave.functions.vectors import dot, hash_encode, l2_normalize, rank_decay, semantic_weight


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_extract_alias(spark):
    given = [None, " Bob <B@x.com> ", "a.b-c@d.e; z", "H", "<>", "< >x@y", "<a\n>q@r.s"]
    assert column(spark, given, tx.extract_alias) == ["", "b@x.com", "a.b-c@d.e", "h", "", "", "q@r.s"]


def test_clean_body(spark):
    given = ["x y From: a\nUNCLASSIFIED U.S. Dept of STATE 12\nRe: café q\x1cw", None, "no header\nFrom: b"]
    assert column(spark, given, tx.clean_body) == ["a re café q w", "", "no header from b"]


def test_clean_subject(spark):
    assert column(spark, ["Re: Hello", None], tx.clean_subject) == ["re hello", ""]
    stripped = column(spark, ["Re: Hello", "FWD:x"], lambda c: tx.clean_subject(c, strip_reply=True))
    assert stripped == ["hello", "x"]


def test_dates(spark):
    given = ["Friday, March 11, 2011 01:36 PM", "junk", "2012-02-30", None, "3/4/2010", "May 5, 2011 1:00 OM"]
    assert column(spark, given[:1], tx.repair_date_text) == ["Friday, March 11, 2011 01:36 "]
    assert column(spark, given[5:], tx.repair_date_text) == ["May 5, 2011 1:00 "]
    assert column(spark, ["OM x"], tx.repair_date_text) == ["AM x"]
    assert column(spark, given[:5], tx.iso_date) == [
        "2011-03-11T13:36:00", None, None, None, "2010-03-04T00:00:00",
    ]
    repaired = column(spark, given[:1], lambda c: tx.iso_date(tx.repair_date_text(c)))
    assert repaired == ["2011-03-11T01:36:00"]


def test_owner_and_prompt(spark):
    assert column(spark, ["Ann OWNER", None, "x"], lambda c: tx.is_owner(c, "owner")) == [True, False, False]
    assert column(spark, ["hi"], lambda c: tx.query_prompt(c, "t")) == ["Instruct: t\nQuery: hi"]


def test_query_len_and_weight(spark):
    assert column(spark, ["a b  c", "  ", None, "x y"], tx.query_len) == [3, 0, 0, 2]
    weights = column(spark, [1, 4, 8, 20], semantic_weight, "int")
    assert [round(w, 5) for w in weights] == [0.25, 0.46851, 0.70521, 0.71851]


def test_tokens_and_counts(spark):
    assert column(spark, ["It's a.b, B_1! it's"], tx.tokens) == [["it's", "a.b", "b_1", "it's"]]
    counts = column(spark, ["b a b", "", None], tx.term_counts)
    assert [(e.term, e.tf, e.len, e.head) for e in counts[0]] == [("a", 1, 3, True), ("b", 2, 3, False)]
    assert counts[1:] == [[], []]


def test_vectors(spark):
    assert column(spark, [[3.0, 4.0], [0.0, 0.0]], l2_normalize, "array<float>") == [
        [0.6000000238418579, 0.800000011920929],
        [0.0, 0.0],
    ]
    assert column(spark, [[1.0, 2.0]], lambda c: dot(c, c), "array<float>") == [5.0]
    one, two, none = column(spark, ["word word", "word", ""], hash_encode)
    assert one == two and max(one) == 1.0 and sum(none) == 0.0
    assert column(spark, [20], rank_decay, "int")[0] == math.exp(-1)
