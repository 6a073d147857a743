"""Hand-written cases of the id, text, judge, party and page functions."""

import pytest
from pyspark.sql import functions as F

from lexloom.functions import ids as I
from lexloom.functions import text as T
from lexloom.operators import fetch, judges, parties, stats
from lexloom.sources import html as H


def value(spark, text, f):
    return spark.createDataFrame([(text,)], "x string").select(f(F.col("x")).alias("v")).first().v


@pytest.mark.parametrize(
    "f,text,want",
    [
        (I.clean_case_id, "1:16-cv-12345-2-ABC-DEF", "1:16-cv-12345"),
        (I.clean_case_id, "1-16-cv-00001", "1:16-cv-00001"),
        (I.clean_case_id, "No. 1:16-CV-00843", "1:16-cv-00843"),
        (I.clean_case_id, "1:16-cv-843", "1:16-cv-00843"),
        (I.clean_case_id, "1:16-cv-1234567", "1:16-cv-1234567"),
        (I.weak_ucid, "ilnd;;1:16-cv-00001", "ilnd;;16-cv-00001"),
        (T.detag, "<b>Smith</b> ?", "Smith"),
        (T.detag, "<b></b>", None),
        (T.query_filed, "filed 01/02/20 closed 03/04/20", "2020-01-02"),
        (T.query_closed, "filed 01/02/20", None),
        (T.mdl_code, "MDL No. 2741", 2741),
        (T.mdl_code, "none", None),
        (judges.clean_name, "District Judge Curtis V. Gomez", "curtis v gomez"),
        (judges.last_name, "Hon. John Smith Jr.", "smith"),
        (parties.classify, "Bank of X, Inc.", "other"),
        (parties.classify, None, "other"),
        (fetch.attachment_name, "https://x/doc1/077.pdf", "077"),
        (lambda c: T.iso_date(c).cast("string"), "13/02/2020", "2020-02-13"),
        (lambda c: T.iso_date(c).cast("string"), "abc", None),
        (T.scrub_sensitive, "x 123-45-6789 y", "x             y"),
    ],
)
def test_values(spark, f, text, want):
    assert value(spark, text, f) == want


def test_decompose(spark):
    d = value(spark, "1:16-cv-12345-2-ABC-DEF", I.decompose)
    assert (d.office, d.year, d.case_type, d.case_no, d.judge_names, d.def_no) == ("1", "16", "cv", "12345", None, "2")
    assert value(spark, "2:16-cv-01002-ROS", I.decompose).judge_names == ["ROS"]
    assert value(spark, "nothing", I.decompose) is None


def test_wanted_documents(spark):
    rows = fetch.wanted_documents(spark.createDataFrame([("2,3:5,6_1,7_1:4,x",)], "s string"), "s").collect()
    assert {(r.doc_no, r.attachment) for r in rows} == {(2, 0), (3, 0), (4, 0), (5, 0), (6, 1), (7, 1), (7, 2), (7, 3), (7, 4)}


def test_backfill(spark):
    track = ["", "A", "", "B;;;C", "", "D", ""]
    df = spark.createDataFrame([(1, i, j) for i, j in enumerate(track)], "c int, i int, j string")
    got = judges.backfill(df, "c", ["i"], "j").orderBy("i").collect()
    assert [r.judge_filled for r in got] == ["A", "A", "A", "B;;;C", "A", "D", "D"]


def test_t_quantile():
    assert abs(stats.t_quantile(0.975, 10) - 2.228139) < 1e-5
    assert abs(stats.t_quantile(0.975, 1) - 12.7062) < 1e-3
    assert stats.t_quantile(0.975, 0) is None


def test_docket_entries():
    page = "<table><tr><td>Date Filed</td><td>#</td><td>Docket Text</td></tr><tr><td>01/02/2020</td><td><a href='/doc1/5'>1</a></td><td>Complaint <a href='/doc1/9'>1</a></td></tr><tr><td>01/03/2020</td><td></td><td>Order re <a href='/doc1/5'>1</a></td></tr></table>"
    a, b = H.docket_entries(page)
    assert a["documents"]["1"]["url"] == "/doc1/9" and a["label"] == "1"
    assert b["edges"] == [{"src": 1, "dst": 0, "start": 9, "end": 10}] and b["text"][9:10] == "1" and b["label"] is None
    assert H.docket_entries(None) == [] and H.docket_entries("There are no proceedings") == []


def test_redact_skips_inner_spans(spark):
    df = spark.createDataFrame([("Ann Lee and Lee", [(0, 7, "[A]"), (4, 7, "[B]"), (12, 15, "[B]")])], "t string, s array<struct<start:int,end:int,label:string>>")
    assert df.select(parties.redact(F.col("t"), F.col("s")).alias("v")).first().v in ("[A] and [B]", "Ann [B] and [B]")
