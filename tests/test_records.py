"""Parsers and matchers on their own, readers, sinks and streams."""

import datetime
import json
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import graph, judges, linkage, naming, party_tree
from lexloom.plans.catalogue import QUERIES
from lexloom.sources import dom, parties, readers, summary
from lexloom.streaming import ingest


def test_split_keeping():
    assert parties.split_keeping("..A...B....", ["A", "B"]) == [(None, ".."), ("A", "..."), ("B", "....")]
    assert parties.split_keeping("x", []) == [(None, "x")]


def test_contact_of_odd_blocks():
    assert parties.contact([]) == {"office_name": None, "address": None, "phone": None, "fax": None, "email": None}
    assert parties.contact(["555-1234", "Wing B"])["phone"] == "555-1234"  # lines follow and none is an address
    assert parties.contact(["555-1234", "12 Main St"])["phone"] is None  # an inmate's number
    assert parties.contact(["."])["office_name"] is None


def test_pages_that_cannot_be_read():
    for page in (None, "", "<table", "<table cellspacing='5'><tr><td><b>Loose</b></td></tr></table>", "<b><u>Plaintiff</u></b>"):
        assert parties.read_parties(page, True) == []
    assert summary.read_summary(None)["fields"]["case_id"] == "" and summary.read_summary("<center></center>")["parties"] == []


def test_tree_closes_cells_and_rows():
    rows = dom.tree("<table><tr><td>a<td>b<table><tr><td>in</table><tr><td>c</table>").all("table")[0].rows()
    assert [[c.text().strip() for c in r] for r in rows] == [["a", "bin"], ["c"]]


def test_name_spans():
    assert naming.spans_in("Ann Lee", "ANN LEE met A. Lee's aide; Leeds, lee (Bob Lee)") == [(0, 7), (12, 20), (34, 37), (43, 46)]
    assert naming.spans_in("J. R.", "J and R") == [] and naming.spans_in("", "x") == []
    assert naming.clean_name("Dr. José  O'Neil-Smith, Jr.") == "jose o'neil-smith jr"


def test_party_labels_keep_the_longest_and_first():
    lx = party_tree.Lexicon({"gov_entities": ["united states of america"], "us_state_names": ["united states"], "given_names": ["will"], "english_words": ["will"]})
    assert party_tree.refined(lx.labels(party_tree.padded("United States of America")), lx) == [[1, 25, "gov"]]
    assert party_tree.refined(lx.labels(party_tree.padded("Will")), lx) == [[1, 5, "person"]]
    assert party_tree.classify_name(None, None, None, lx)["party_class"] == "other"


def test_fuzzy_names():
    assert linkage.token_set_ratio("Smith, John Q.", "john smith") == 100
    assert linkage.fuzzy_name("USA", ["AUSA"]) is None and linkage.fuzzy_name("L. W.", ["James L. Watson"]) is None
    assert linkage.fuzzy_name("Jonathan Smithson", ["Ann Lee", "Jonathan Smithsen"]) == 1


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p/a.html").write_bytes("<p>é</p>".encode())
    (tmp_path / "p/b.html").write_bytes("<p>é</p>".encode("windows-1252"))
    assert {r.html for r in readers.pages(spark, str(tmp_path / "p")).collect()} == {"<p>é</p>"}
    (tmp_path / "r.jsonl").write_text('{"a": 1}\nno json\n')
    assert sorted((r.a, r._corrupt_record) for r in readers.records(spark, str(tmp_path / "r.jsonl"), "a int").collect() if r.a) == [(1, None)]
    (tmp_path / "t.tsv").write_text("d\tn\n1900-01-01\t-8\n2020-01-02\t5\n")
    rows = readers.delimited(spark, str(tmp_path / "t.tsv"), "d date, n int", sep="\t").collect()
    assert sorted((str(r.d), r.n) for r in rows) == sorted([("None", None), ("2020-01-02", 5)])
    readers.write_cases(spark.createDataFrame([("ccd", 2020, "x")], "court string, year int, ucid string"), str(tmp_path / "c"))
    assert (tmp_path / "c/court=ccd/year=2020").is_dir()
    lines = graph.n_triples(spark.createDataFrame([("a", "p", 'say "x"\ny', "string"), ("a", "q", "b", "uri")], "s string, p string, o string, kind string")).collect()
    assert [r.value for r in lines] == ["<urn:docket:a> <urn:docket:p> \"say 'x'\\ny\" .", "<urn:docket:a> <urn:docket:q> <urn:docket:b> ."]


def test_streams(spark, tmp_path):
    schema = "ts timestamp, event_type string, user_id long"
    (tmp_path / "in").mkdir()
    days = ["2020-01-01 00:00:00", "2020-01-01 05:00:00", "2020-01-09 00:00:00"]
    (tmp_path / "in/a.json").write_text("\n".join(json.dumps({"ts": t, "event_type": "x", "user_id": 1}) for t in days))
    stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    q = ingest.event_counts(stream).writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.n for r in spark.table("counted").collect()) == [1, 2]

    (tmp_path / "cases").mkdir()
    (tmp_path / "cases/a.json").write_text('{"ucid": "a", "version": 1, "x": "old"}\n{"ucid": "a", "version": 2, "x": "new"}\n{"ucid": "b", "version": 1, "x": "b"}')
    cases = spark.readStream.schema("ucid string, version int, x string").json(str(tmp_path / "cases"))
    q = ingest.upsert_stream(cases, str(tmp_path / "table"), str(tmp_path / "check"))
    q.processAllAvailable()
    q.stop()
    assert sorted((r.ucid, r.x) for r in spark.read.parquet(str(tmp_path / "table/v0")).collect()) == [("a", "new"), ("b", "b")]


def test_appointments_are_those_of_all_pairs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(judges, "CHUNK", 2)
    day = lambda n: datetime.date(2000, 1, 1) + datetime.timedelta(n)
    slots = [(i, "abc"[i % 3], day(i % 5), [None, "a", "b"][i % 4 % 3], None if i % 7 == 0 else day(3), "a", day(1)) for i in range(20)] + [(3, "a", day(6), "a", day(0), None, None), (None, "b", None, "c", day(2), None, None)]
    j = spark.createDataFrame(slots, "nid long, court_1 string, date_1 date, court_2 string, date_2 date, court_3 string, date_3 date")
    rows = [(k // 2, "abd"[k % 3], day(k % 6)) for k in range(24)] + [(99, None, day(9)), (98, "a", None), (0, "a", day(0))]
    c = spark.createDataFrame(rows, "k long, court string, day date")
    held = {(s[0], s[i], s[i + 1]) for s in slots for i in (1, 3, 5) if None not in s[1 : i : 2] and s[i] and s[i + 1]}
    want = {(k, court, d, nid) for k, court, d in rows for nid, at, since in held if at == court and d and since < d}
    assert sorted(map(str, judges.appointed(j, 3, c).select("k", "court", "day", "nid").collect())) == sorted(map(str, spark.createDataFrame(list(want), "k long, court string, day date, nid long").collect()))
    got = [tuple(r) for r in judges.appointed(j, 3, c, key="k").collect()]
    assert len(got) == len(set(got)) and set(got) == {(k, nid) for k, _, _, nid in want}


@pytest.mark.parametrize("most", [judges.BROADCAST_JUDGES, 0])
def test_appointments_shuffle_cases_once_and_lie_by_runs_of_judges(spark, monkeypatch, most):
    monkeypatch.setattr(judges, "CHUNK", 3)
    monkeypatch.setattr(judges, "BROADCAST_JUDGES", most)
    day = lambda n: datetime.date(2000, 1, 1) + datetime.timedelta(n)
    j = spark.createDataFrame([(i, "a", day(i), None, None) for i in range(12)], "nid long, court_1 string, date_1 date, court_2 string, date_2 date")
    rows = [(k, "a", day(k % 15)) for k in range(40)]
    kept = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = judges.appointed(j, 2, spark.createDataFrame(rows, "k long, court string, day date"), key="k")
        got = [tuple(r) for r in df.collect()]
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert len(got) == len(set(got)) and set(got) == {(k, nid) for k, _, d in rows for nid in range(12) if day(nid) < d}
    if most:
        assert "SortMergeJoin" not in plan
        assert [nid // 3 for _, nid in got] == sorted(nid // 3 for _, nid in got)


def test_a_case_of_two_courts_meets_a_judge_once(spark, tmp_path):
    day = datetime.datetime(2001, 1, 1)
    spark.createDataFrame([(7, 1, "O", 1.0, day), (7, 2, "O", 1.0, day)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 3), (2, 4)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, 3)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    assert [tuple(r) for r in QUERIES["judge_appointment_asof"](spark, str(tmp_path)).collect()] == [(7, 1)]


def test_plain_pages_read_as_by_the_standard_parser():
    class Calls(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out = []

        def handle_starttag(self, tag, attrs):
            self.out.append((tag, attrs))

        def handle_endtag(self, tag):
            self.out.append(("/", tag))

        def handle_data(self, data):
            self.out.append(data)

        def handle_comment(self, data):
            self.out.append(("!", data))

    def calls(page, known):
        c = Calls()
        if known is None:
            c.feed(page)
            c.close()
        else:
            dom.read(c, page, known)
        return c.out

    plain = ["", "a &amp; b&nbsp;&lt;c", "<TD Valign=top width='40%' x=\"\" nowrap>a<br>b<br/></td><!-- x;y:http://h/z -->", "<a href=/doc1/5>1</a>\n", "<table cellspacing=5 cellspacing='6'><tr><td>x"]
    for page in plain:
        assert dom.tokens(page) is not None and calls(page, dom.tokens(page)) == calls(page, None)
    for page in ("a < b", "<a href=x/>", "<a href='?a=1&b'>", "<script>a<b</script>", "<!doctype html>", "<a", "<p\x0bx>", "<a b=1\xa0>", "<!--a--b-->", "</p x>"):
        assert dom.tokens(page) is None
    odd = "<p><table><tr><td>x<table cellspacing=5><tr><td><b><u>Plaintiff</u></b><tr><td><b>A</b></table></div></table><table><tr><td>y</table><table cellspacing='5'><tr><td><b>B</b><br>C"
    assert parties.read_parties(odd, False) == parties.read_parties(odd + "<", False)[:1] + parties.read_parties(odd, False)[1:] and [p["name"] for p in parties.read_parties(odd, False)] == ["A", "B"]


def test_case_graph_reads_its_rows_once(spark):
    count = "struct<pacer_id:string,text:string,disposition:string>"
    lawyer = "struct<name:string,designation:string,entity_info:struct<address:string,office_name:string>>"
    party = f"struct<name:string,role:string,party_type:string,entity_info:struct<raw_info:string>,judge:string,referred_judges:array<string>,highest_offense_level_opening:string,highest_offense_level_terminated:string,pending_counts:array<{count}>,terminated_counts:array<{count}>,counsel:array<{lawyer}>>"
    rows = f"ucid string, court string, case_id string, case_type string, case_status string, filing_date string, terminating_date string, nature_suit string, cause string, jurisdiction string, lead_case_id string, related_cases array<string>, judge string, referred_judges array<string>, parties array<{party}>, docket array<struct<label:string,date_filed:string,text:string,edges:array<struct<dst:int>>>>"
    one = ("1", "c", None)
    ann = ("Ann", "Defendant", "defendant", (None,), "J", ["K"], None, None, [one, one], [one], [("L", None, (None, "O")), ("M", None, (None, None)), ("N", None, (None, "O"))])
    c = spark.createDataFrame([("c;;1:20-cr-00001", "c", "1:20-cr-00001", "cr", "open", "1/2/2020", None, None, None, None, None, ["1:01-cv-00001"] * 2, None, [], [ann, ann], [("1", "2020-3", "t", [(1,), (1,)]), (None, None, None, [])]), ("c;;1:20-cv-00002", "c", "1:20-cv-00002", "cv", "open", None, None, None, None, None, None, None, "J", ["K"], None, None)], rows)
    g = graph.case_graph(c)
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Union" not in plan
    got = [(r.s, r.p, r.o) for r in g.collect()]
    assert len(got) == len(set(got))
    have = lambda p: sorted((s.split("1:20-", 1)[1], o.split("1:20-", 1)[-1]) for s, q, o in got if q == p)
    assert have("CaseCharge") == [("cr-00001", "cr-00001_p0_c1"), ("cr-00001", "cr-00001_p1_c1")]
    assert have("hasChargeType") == [(f"cr-00001_p{i}_c1", x) for i in (0, 1) for x in ("pending", "terminated")]
    assert have("Firm") == [(f"cr-00001_l{k}", f"cr-00001_f{n}") for k, n in ((0, 0), (0, 2), (2, 1), (2, 3))]
    assert have("assignedToDefendant") == [("cr-00001_2", "cr-00001_p1"), ("cr-00001_3", "cr-00001_p1")]
    assert have("CaseDefenseAttorney")[-1] == ("cr-00001_p1", "cr-00001_l5") and have("hasReferenceToOtherEntry") == [("cr-00001_de0", "cr-00001_de1")]
    assert have("PersonFullName")[-2:] == [("cv-00002_0", "J"), ("cv-00002_1", "K")] and have("RegisterActionDate") == [("cr-00001_de0", "2020-03-01")]
    assert len(have("hasRelatedCase")) == 1


def test_scrub_by_the_stated_law(spark):
    texts = ["\x01a 123-45-6789 b", "x\x01y ssn: #123-45-6789\x01A12345678\x01z\x01", "password=a80579704f8213", "123-45-6789 x", " 123-45-6789 123-45-6789 123-45-6789 ", "é A123456789\U0001f600 SS  1\n a1234567890.", "", None, "q A12345678 A12345679 w", "\x01"]
    law = [r"(?i)([^0-9])((?:ssn?:?)? *#?[0-9]{3}-[0-9]{2}-[0-9]{4})([^0-9])", r"(?i)([^0-9a-z])(a[0-9]{8,9})([^0-9])"]

    def scrubbed(x):
        for p in law:
            x = re.sub(p, lambda m: m[1] + " " * len(m[2]) + m[3], x)
        return x

    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", T.scrub_sensitive(F.col("x")).alias("y")).collect()}
    assert got == {i: x if x is None else scrubbed(x) for i, x in enumerate(texts)}
