"""Queries over whole texts: what stands late in a long text is met."""

import duckdb

from lexloom.operators import search
from lexloom.plans.catalogue import ORACLES, QUERIES


def test_search_beyond_a_prefix(spark, tmp_path):
    long = "x" * 500
    rows = [(1, 0, "user", long + " le the anvil?"), (2, 0, "user", "le the anvil?"), (3, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: (r.a_start, r.a_end, r.q_start) for r in QUERIES["docket_search_whole"](spark, str(tmp_path)).collect()}
    assert got == {1: (504, 513, 513), 2: (3, 12, 12)}
    assert {r.conv_id: r.flagged for r in QUERIES["case_flagged_any_whole"](spark, str(tmp_path)).collect()} == {1: True, 2: True, 3: False}
    cut = search.search_docket(df, {"a": "the [a-z]+"}, ["le "], meta=["conv_id"], limit=400).collect()  # the limit is optional
    assert {r.conv_id: r.a and r.a.start for r in cut} == {1: None, 2: 3}
    assert {r.conv_id: r.flagged for r in search.cases_flagged(df, "the an", "conv_id", limit=300).collect()} == {1: False, 2: True, 3: False}


def test_injected_cases_in_whole_texts(spark, tmp_path):
    long = "word " * 200
    spark.createDataFrame([(1, long + "n 222-33-4444, a A87654321 b " + long), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, long + "ada byron, Bob Rays and BOB RAY " + long)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(1, "u", f"<p>{long}</p><p>Status: closed</p>"), (2, "u", None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.doc_id: r.scrubbed for r in QUERIES["scrub_sensitive_whole"](spark, str(tmp_path)).collect()}
    assert got == {1: f"q {' ' * 11} {long}n {' ' * 11}, a {' ' * 9} b {long} x {' ' * 11} y {' ' * 9}x z ssn 1234-56 w {' ' * 17}.", 2: None}
    assert [r.redacted for r in QUERIES["redact_spans_whole"](spark, str(tmp_path)).collect()] == [f"[Q]: {long}[P], Bob Rays and [Q] {long} [P] met [Q], then [P]."]
    assert {r.page_id: (r.status, r.party_name) for r in QUERIES["summary_kv"](spark, str(tmp_path)).collect()} == {1: ("closed", "Ann 1"), 2: ("open", "Ann 2")}


def test_numbers_late_in_a_text_are_scrubbed(spark, tmp_path):
    long = "word " * 200
    texts = [long + "n ssn: #222-33-4444, a A87654321 b " + long, "short", "", None, " 1 123-45-6789 123-45-6789 \n"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.scrubbed for r in QUERIES["scrub_sensitive"](spark, str(tmp_path)).collect()}
    end = f" x {' ' * 11} y {' ' * 9} z ssn 1234-56 "
    assert got == {0: f"{long}n {' ' * 17}, a {' ' * 9} b {long}{end}", 1: f"short{end}", 2: end, 3: None, 4: f" 1 {' ' * 11} 123-45-6789 \n{end}"}
    sql = ORACLES["scrub_sensitive"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert dict(duckdb.sql(sql).fetchall()) == got
