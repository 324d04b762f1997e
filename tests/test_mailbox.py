import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from mailweave.operators import mailbox as mb
from mailweave.plans.mailboxes import build_mailboxes, build_vectors
from mailweave.plans.search import fetch
from mailweave.sources import raw as rw
from mailweave.sources import store as st
from mailweave.sources.raw import read_raw_table

EMAILS = '''Id,DocNumber,ExtractedSubject,ExtractedTo,ExtractedFrom,ExtractedCc,ExtractedDateSent,ExtractedBodyText
1,C1,Re: Plan,old,"Owner <O@x.gov>",,"Friday, March 11, 2011 01:36 PM","line one
line ""two"", end"
2,C2,Hi,,bob@y.org,cc,2011-01-01,hello
3,C3,Self,,o@x.gov,,,to myself
4,C4,None,,bob@y.org,,,
5,C5,Other,,zed,,,not for the owner
'''
RECEIVERS = "Id,EmailId,PersonId\n1,1,2\n2,1,9\n3,2,1\n4,3,1\n5,4,1\n6,3,2\n7,5,2\n"
ALIASES = "Id,Alias,PersonId\n1,O@X.gov,1\n2,bob@y.org,3\n3,BOB@y.org,2\n4,gone,77\n"
PERSONS = "Id,Name\n1,The Owner\n2,Bob\n3,Robert\n"


@pytest.fixture
def raw(spark, tmp_path):
    for name, text in (("Emails", EMAILS), ("EmailReceivers", RECEIVERS), ("Aliases", ALIASES), ("Persons", PERSONS)):
        (tmp_path / f"{name}.csv").write_text(text)
    return rw.read_raw(spark, str(tmp_path))


def check_boxes(boxes):
    rows = {(r.folder, r.Id): r for r in boxes.collect()}
    assert set(rows) == {("sent", 1), ("inbox", 2), ("inbox", 3), ("sent", 3)}
    assert rows[("sent", 1)].ExtractedTo == ["Bob"]
    assert rows[("inbox", 3)].ExtractedTo == ["The Owner", "Bob"]
    assert rows[("sent", 1)].ExtractedBodyText == 'line one\nline "two", end'
    assert rows[("inbox", 2)].SenderName == "Bob"
    assert rows[("sent", 1)].subject == "re plan"
    assert str(rows[("sent", 1)].date) == "2011-03-11 01:36:00"


def test_build_mailboxes(raw):
    boxes = build_mailboxes(raw, "owner", keep_clean=True)
    assert build_mailboxes(raw, "owner").columns == mb.MAILBOX_COLUMNS + ["folder"]
    check_boxes(boxes)


def test_build_mailboxes_in_shuffled_form(raw, tiny_broadcast):
    check_boxes(build_mailboxes(raw, "owner", keep_clean=True))


def test_alias_lookups(raw):
    names = {r.Alias: r.Name for r in mb.alias_names(raw["Aliases"], raw["Persons"]).collect()}
    assert names == {"o@x.gov": "The Owner", "bob@y.org": "Bob"}
    lists = {r.Name: r.aliases for r in rw.load_name_aliases(raw).collect()}
    assert lists == {"The Owner": ["o@x.gov"], "Robert": ["bob@y.org"], "Bob": ["bob@y.org"]}


def test_missing_paths_are_errors(spark, tmp_path):
    with pytest.raises(AnalysisException):
        rw.read_raw(spark, str(tmp_path / "none"))
    with pytest.raises(AnalysisException):
        st.load_vectors(spark, str(tmp_path / "none"), "inbox")
    with pytest.raises(ValueError):
        st.load_vectors(spark, str(tmp_path), "drafts")


def test_mailbox_round_trip(spark, raw, tmp_path):
    path = str(tmp_path / "box")
    st.write_mailbox(build_mailboxes(raw, "owner"), path)
    both = {(r.folder, r.Id) for r in st.load_corpus(spark, path).collect()}
    assert both == {("sent", 1), ("inbox", 2), ("inbox", 3)}
    assert {r.Id for r in st.load_corpus(spark, path, "sent").collect()} == {1}
    assert {r.Id for r in st.load_corpus(spark, path, "inbox").collect()} == {2, 3}
    assert {r.folder: r.n_mails for r in mb.mailbox_stats(st.load_corpus(spark, path)).collect()} == {
        "inbox": 2, "sent": 1,
    }
    ranked = spark.createDataFrame(
        [("inbox", 0, 2, 1.0, 0)], "folder string, qid bigint, Id bigint, score double, rank bigint"
    )
    found = fetch(ranked, st.load_corpus(spark, path), 1)
    assert [r.ExtractedSubject for r in found.collect()] == ["Hi"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "(block#" in plan.split("PartitionFilters:")[1].split("]")[0]
    vectors = str(tmp_path / "vectors")
    st.write_vectors(build_vectors(st.load_corpus(spark, path)), vectors)
    assert st.load_vectors(spark, vectors, "sent").count() == 1


def test_loading_a_corpus_is_a_plain_scan(spark, raw, tmp_path):
    path = str(tmp_path / "box")
    boxes = build_mailboxes(raw, "owner")
    st.write_mailbox(boxes.unionByName(boxes), path)
    ids = st.load_corpus(spark, path).select("folder", "Id")
    assert sorted((r.folder, r.Id) for r in ids.collect()) == [("inbox", 2), ("inbox", 3), ("sent", 1)]
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert "Extracted" not in plan.split("ReadSchema:")[1]


def test_dedupe_cuts_copies_before_the_shuffle(spark):
    rows = [("sent", 1, "a")] * 50 + [("inbox", 1, "b"), ("sent", 2, "c")]
    df = spark.createDataFrame(rows, "folder string, Id bigint, x string")
    unique = mb.dedupe_corpus(df)
    assert {tuple(r) for r in unique.collect()} == {("inbox", 1, "b"), ("sent", 2, "c")}
    assert "WindowGroupLimit" in unique._jdf.queryExecution().executedPlan().toString()


def test_recipients_keep_row_order(spark):
    receivers = spark.createDataFrame([(1, 2, 5), (1, 1, 3), (1, 9, 1)], "EmailId bigint, PersonId bigint, ord bigint")
    persons = spark.createDataFrame([(1, "A"), (2, "B")], "Id bigint, Name string")
    assert mb.recipients(receivers, persons).first().ExtractedTo == ["A", "B"]
    assert mb.with_recipients(
        spark.createDataFrame([(1, "x"), (2, "y")], "Id bigint, ExtractedTo string"),
        mb.recipients(receivers, persons),
    ).filter(F.col("Id") == 2).first().ExtractedTo is None


def test_row_order_follows_the_files(spark, tmp_path):
    """The second part is the larger one, which Spark reads first."""
    folder = tmp_path / "Aliases.csv"
    folder.mkdir()
    rows = [(f"a{i}", i) for i in range(402)]
    for name, part in (("part-0.csv", rows[:2]), ("part-1.csv", rows[2:])):
        (folder / name).write_text("Alias,PersonId\n" + "".join(f"{a},{p}\n" for a, p in part))
    for multiline in (True, False):
        read = read_raw_table(spark, str(tmp_path), "Aliases", multiline).orderBy("ord")
        assert [r.PersonId for r in read.collect()] == list(range(402))
