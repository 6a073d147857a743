"""Queries of the parsers, links and graphs. The supplied tables hold no court pages, so pages are put together from their rows in
several forms, and the SQL states what each form holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids as I
from ..functions import text as T
from ..operators import bundle, courts, entities, fetch, graph, index, judges, linkage, members, naming, party_tree
from ..sources import cases, parties, reports, summary, thirdparty
from .catalogue import CASES, query, raw_cases, read

#: Tasks that parse the pages made of one small file.
TASKS = 16


def key():
    """The number of a case."""
    return F.col("k")


def _text(*parts):
    """Texts and columns end to end."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _by(forms, of=None, n=None):
    """The form of a row: of several by the row's number."""
    of, n, out = key() if of is None else of, n or len(forms), None
    for i, f in enumerate(forms):
        f = F.lit(f) if isinstance(f, str) or f is None else f
        out = F.when(of % n == i, f) if out is None else out.when(of % n == i, f)
    return out


def _sql_by(forms, of="k"):
    return f"CASE {of} % {len(forms)} " + " ".join(f"WHEN {i} THEN {'NULL' if f is None else f}" for i, f in enumerate(forms)) + " END"


# --- identifiers and paths ------------------------------------------------------------------------------------------------


@query(f"""WITH {CASES} SELECT k, {_sql_by(["case_id", "case_id", "yy || ':' || case_type || '-' || number", "'noyear:0' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0')", "yy || ':' || lpad(CAST(k % 100000 AS VARCHAR), 5, '0')", "case_id", "office || ':' || yy", "office || ':' || yy || '-' || case_type || '-00' || (100 + k % 900)", "'noyear:' || (10000 + k % 90000)", "'12:345'"])} case_id FROM cases""")
def case_id_forms(spark, sf):
    c = raw_cases(spark, sf)
    four, five = (F.lpad((key() % m).cast("string"), n, "0") for m, n in ((10000, 4), (100000, 5)))
    forms = [_text("No. ", F.upper("case_id")), F.replace("case_id", F.lit(":"), F.lit("-")), _text("Bankruptcy ", F.col("case_type"), "-", F.col("yy"), "-", F.col("number")), four, F.concat("yy", five), _text(F.col("case_id"), ", 1:99-cv-00009"), _text("Case Nos. ", F.col("case_id"), "-ABC"), _text(F.col("office"), ":", F.col("yy"), "-", F.upper("case_type"), "-", 100 + key() % 900), (10000 + key() % 90000).cast("string"), _text("12-345-", F.col("number"))]
    return c.select("k", I.clean_case_id(_by(forms)).alias("case_id"))


@query(f"""WITH {CASES} SELECT k, ucid made, 'root/' || court || '/json/' || office || '-' || yy || '-' || case_type || '-' || number || '.json' flat, ucid from_file, 'a/html/b.html' page, 'data/x' relative, k % 2 = 0 third, CAST(year(filed) AS INT) "year" FROM cases""")
def path_helpers(spark, sf):
    c = raw_cases(spark, sf)
    file = _text("\\data\\", F.col("court"), "\\", I.decolonize(F.col("case_id")), ".html")
    path = _by(["x\\recap\\y.json", "x\\other\\recaps.json"])
    return c.select("k", I.ucid_from_parts(F.col("court"), F.col("office"), F.col("yy"), F.col("case_type"), F.col("number").cast("long")).alias("made"), I.flat_path(F.col("ucid"), "root").alias("flat"), I.file_ucid(file, F.col("court")).alias("from_file"), I.page_path(F.lit("a/json/b.json")).alias("page"), I.relative_path(F.lit("/home/proj/data/x"), "proj").alias("relative"), I.is_third_party(path).alias("third"), I.filed_year(F.date_format("filed", "M/d/yyyy")).alias("year"))


@query(f"""WITH {CASES} SELECT replace(ucid, ':', '-') || '_' || (k % 4) doc_id, CASE WHEN k % 3 > 0 THEN 'docs/' || court || '/' || replace(ucid, ':', '-') || '_' || (k % 4) || '_u12345678_t20010' || (1 + k % 3) || '.pdf' END path FROM cases""")
def newest_documents(spark, sf):
    c = raw_cases(spark, sf).withColumn("doc_id", I.document_id(F.col("ucid"), key() % 4))
    versions = c.where(key() % 3 > 0).select("court", "doc_id", F.explode(F.sequence(F.lit(1).cast("long"), 1 + key() % 3)).alias("v"))
    files = versions.select(_text("docs/", F.col("court"), "/", F.col("doc_id"), "_u12345678_t20010", F.col("v"), ".pdf").alias("path"))
    return I.newest_documents(files, c.select("doc_id"))


@query(f"WITH {CASES} SELECT k, replace(ucid, ':', '-') || '_' || (k % 90 + 1) || CASE WHEN k % 3 = 0 THEN '_' || (k % 7 + 1) ELSE '' END doc_id FROM cases")
def header_documents(spark, sf):
    number = _by([_text("Document ", key() % 90 + 1), _text("Doc 999 Document 5 Entry Number ", key() % 90 + 1)])
    page = _text(F.repeat(F.lit("body "), 40), "\n Case ", F.col("case_id"), "-ABC   ", number, F.when(key() % 3 == 0, _text(" Attachment ", key() % 7 + 1)).otherwise(""), " Filed 1/2/20")
    return raw_cases(spark, sf).select("k", I.header_document_id(page, F.col("court")).alias("doc_id"))


@query(f"WITH {CASES} SELECT k, k % 3 = 0 ignore_have_html, case_type <> 'cv' ignore_non_cv, k % 3 <> 0 AND case_type = 'cv' \"use\" FROM cases")
def third_party_use(spark, sf):
    c = raw_cases(spark, sf)
    return I.third_party_use(c, c.where(key() % 3 == 0)).select("k", "ignore_have_html", "ignore_non_cv", "use")


def _members():
    return _text("<p>x</p>Member cases: <table border=0><tr><td><a href='/cgi-bin/DktRpt.pl?", key(), "'>", F.col("case_id"), "</a></td><td><a class=x href='/cgi-bin/DktRpt.pl?7", key(), "'>1:99-cv-00007-ABC</a></td></tr></table> <a href='/cgi-bin/DktRpt.pl?1'>2:00-cv-00001</a>")


@query(f"WITH {CASES}, m AS (SELECT k, unnest([ucid, court || ';;1:99-cv-00007']) member, unnest([CAST(k AS VARCHAR), '7' || k]) member_id FROM cases WHERE k % 2 = 0) SELECT k, member, member_id, 8 AS span_start FROM m")
def member_blocks(spark, sf):
    page = F.when(key() % 2 == 0, _members()).otherwise("no members here")
    c = raw_cases(spark, sf).select("k", I.member_block(page)["start"].alias("span_start"), F.explode(I.member_links(page, F.col("court"))).alias("m"))
    return c.select("k", "m.member", "m.member_id", "span_start")


@query(f"WITH {CASES} SELECT k, {_sql_by(['CAST(k AS INT)', None, 'CAST(k AS INT)', None])} code FROM cases")
def mdl_of_case_ids(spark, sf):
    forms = [_text(F.col("office"), ":", F.col("yy"), "-md-", F.col("number")), F.concat("office", F.lit(":12-cv-"), "number"), F.concat("yy", F.lit("MDL"), "number"), F.lit("none")]
    return raw_cases(spark, sf).select("k", I.mdl_of_case_id(_by(forms)).alias("code"))


# --- texts ----------------------------------------------------------------------------------------------------------------


@query(f"""WITH {CASES} SELECT k, CAST(k % 30 + 1 AS INT) pages, (k % 30 + 1) / 10.0::DOUBLE AS cost, '01/02/2020 03:04:05' "at", 'u' || cust AS "user", 'Docket' what, {_sql_by(["'http://a:80/x'", "'http://b'"])} url, {_sql_by(["'stub'", "'private,stub'"])} labels, CAST(k % 30 + 1 AS INT) billed FROM cases""")
def page_receipts(spark, sf):
    cost = F.format_string("%.1f", (key() % 30 + 1) / F.lit(10.0))
    receipt = _text("<tr><td>Transaction Receipt </td></tr><td>01/02/2020 03:04:05</td>\n<td><b>Pacer Login:</b></td> <td>u", F.col("cust"), "</td>\n<td>Client Code: </td>\n<b>Description:</b> <td>Docket Report</td>\n<td>Search Criteria: ", F.col("case_id"), "</td>\n<td><b>Billable Pages:</b></td><td> ", key() % 30 + 1, " </td><td><b>Cost:</b></td><td> ", cost, " </td>")
    stamp = _by(['\n<!-- {"download_url": "http://a:80/x", "slabels": "stub"} -->', "\n<!-- SCALESDOWNLOAD;user:ab;download_url:http://b;slabels:private,stub -->"])
    page = _text(F.repeat(F.lit("<p>text</p>"), 60), receipt, stamp)
    t, s = T.transaction(page), T.download_stamp(page)
    return raw_cases(spark, sf).select("k", t["billable_pages"].alias("pages"), t["cost"].alias("cost"), t["timestamp"].alias("at"), t["user"].alias("user"), t["description"].alias("what"), s["download_url"].alias("url"), s["slabels"].alias("labels"), T.billed(page)["billable_pages"].alias("billed"))


@query(f"""WITH {CASES} SELECT k, {_sql_by([None, "'01/02/2020'", None, None])} ended, {_sql_by(["'Doe & Co'", "'kept'", None, None])} info, {_sql_by(["true", "true", "false", "true"])} address, {_sql_by(["0", "-9999", "year(filed) - 2000", "0"])}::INT gap, CAST({_sql_by(["1", "0", "1", "0"])} AS INT) at_first, CAST({_sql_by(["2", "2", "2", "2"])} AS INT) at_next FROM cases""")
def info_blocks(spark, sf):
    raw = _by(["<i>Doe &amp; Co</i>", "<i>TERMINATED: 01/02/2020\n</i><i>kept</i>", "12 Main Street<br>Dover", "<i>and</i>"])
    line = _by(["12 Main Street", "P.O. Box 7", "Bar and Co", "Dover, DE 19901"])
    year = F.when(key() % 4 == 0, F.lit(None)).when(key() % 4 == 3, F.year("filed")).otherwise(2000)
    day = F.when(key() % 4 == 1, "none").otherwise(F.date_format("filed", "M/d/yyyy"))
    starts = _by([F.array(F.lit(9), F.lit(2), F.lit(30)), F.array(F.lit(1), F.lit(9), F.lit(30))], n=2)
    starts = F.when(key() % 2 == 0, F.array(F.lit(9), F.lit(2), F.lit(30))).otherwise(F.array(F.lit(1), F.lit(9), F.lit(30)))
    return raw_cases(spark, sf).select("k", T.terminated(raw)["day"].alias("ended"), T.tidy_info(raw).alias("info"), T.is_address(line).alias("address"), T.year_gap(day, year).cast("int").alias("gap"), T.first_index(starts, F.lit(10)).cast("int").alias("at_first"), T.first_index(starts, F.lit(10), "nearest_after").cast("int").alias("at_next"))


@query("SELECT conv_id, turn, text AS back FROM conversations")
def packed_texts(spark, sf):
    return read(spark, sf, "conversations").select("conv_id", "turn", T.unpacked(T.packed(F.col("text"))).alias("back"))


@query(f"""WITH {CASES} SELECT k, {_sql_by(["'Bar LLP'", "'Bar LLP' || chr(10) || 'Unit 3'", None, "'Inmate 302-555-1234'", "'555-1234'"])} office, {_sql_by(["'12 Main St' || chr(10) || 'Dover, DE 19901'", None, "'P.O. Box 9'", None, None])} address, {_sql_by(["'302-555-1234'", "'(302) 555-1234'", None, None, None])} phone, {_sql_by(["'302-555-9999'", None, None, None, None])} fax, {_sql_by(["'a@b.com'", "'c@d.org'", None, None, None])} email FROM cases""")
def contact_blocks(spark, sf):
    block = _by(["Bar LLP|12 Main St|Dover, DE 19901|302-555-1234|Fax: 302-555-9999 Fax|Email: a@b.com", "Bar LLP|Unit 3|(302) 555-1234|Email: c@d.org|Email: e@f.org", "See above for address|P.O. Box 9", "Inmate 302-555-1234", "555-1234"])
    c = raw_cases(spark, sf).select("k", parties.contact_of(F.split(block, "[|]")).alias("c"))
    return c.select("k", F.col("c.office_name").alias("office"), "c.address", "c.phone", "c.fax", "c.email")


@query(f"WITH {CASES} SELECT k, unnest([NULL, 'A', 'B']) mark, unnest(['..' || k, '...', '....']) piece FROM cases")
def split_pieces(spark, sf):
    return raw_cases(spark, sf).select("k", F.explode(parties.pieces_of(_text("..", key(), "A...B...."), ["A", "B"])).alias("p")).select("k", "p.mark", "p.piece")


# --- pages ----------------------------------------------------------------------------------------------------------------

_HEAD = '<tr><td><b><u>{}</u></b></td></tr>'
_LAWYER = "<td>represented&nbsp;by</td><td><b>Amy Bar</b><br>Bar LLP<br>12 Main St<br>Dover, DE 19901<br>302-555-1234<br>Email: a@b.com<br><i>LEAD ATTORNEY</i><br><i>Designation: Retained</i><p><b>Bob Cee</b><br>(See above for address)<br><i>PRO HAC VICE</i><br><i>TERMINATED: 03/04/2020</i></td>"


def _party_page():
    """Civil: a represented plaintiff, a bare respondent, a service list. Criminal: a defendant with counts and the government."""
    name = _text("Party ", F.col("cust"))
    civil = _text('<div><table cellspacing="5">', _HEAD.format("Plaintiff"), '<tr><td valign="top" width="40%"><b>', name, "</b><br><i>a minor</i></td>", _LAWYER, "</tr>", _HEAD.format("Respondent (2)"), "<tr><td><b>Firm &amp; Co</b><br>Acme Hall<br>9 Side Rd<br>Dover, DE 19901<br>302 555 7777<br>x@y.net<br><i>TERMINATED: 01/02/2020</i></td></tr><tr><td><b>Service List</b></td></tr></table></div>")
    criminal = _text('<div><table cellspacing="5"><tr><td>Assigned to: Judge Ann Lee<br>Referred to: Magistrate Judge Bo Ray<br>Appeals court case numbers: 12-1, 12-2</td></tr>', _HEAD.format("Defendant (1)"), "<tr><td><b>", name, "</b></td>", _LAWYER, "</tr><tr><td><b><u>Pending Counts</u></b></td><td><b><u>Disposition</u></b></td></tr><tr><td>18:922(g) FELON ", key(), "<br>(1s)</td><td>30 months</td></tr><tr><td>21:841 DRUGS (2)</td><td></td></tr>", _HEAD.format("Highest Offense Level (Opening)"), "<tr><td>Felony</td></tr>", _HEAD.format("Terminated Counts"), "<tr><td>None</td></tr>", _HEAD.format("Complaints"), "<tr><td>18:2 AIDING</td><td>dismissed</td></tr></table><table cellspacing=5>", _HEAD.format("Plaintiff"), "<tr><td><b>USA</b></td></tr></table></div>")
    return F.when(F.col("case_type") == "cr", criminal).otherwise(civil)


def _parsed(spark, sf):
    c = raw_cases(spark, sf).where("case_type <> 'mc'").withColumn("html", _party_page())
    return c.repartition(TASKS, "k").select("k", "case_type", F.posexplode(parties.parties_of(F.col("html"), F.col("case_type") == "cr")).alias("i", "p"))


@query(f"""WITH {CASES}, p AS (SELECT k, case_type, unnest([0, 1, 2]) i, unnest(['Party ' || cust, 'Firm & Co', 'Service List']) "name", unnest(['Plaintiff', 'Respondent', NULL]) "role", unnest(['plaintiff', 'defendant', NULL]) party_type, NULL::INT pacer_id, unnest([NULL, '302 555 7777', NULL]) phone, unnest([NULL, 'x@y.net', NULL]) email, unnest([NULL, '01/02/2020', NULL]) ended, unnest([NULL, 'Acme Hall', NULL]) office, unnest([2, 0, 0]) lawyers, NULL judge FROM cases WHERE case_type = 'cv'
UNION ALL SELECT k, case_type, unnest([0, 1]), unnest(['Party ' || cust, 'USA']), unnest(['Defendant', 'Plaintiff']), unnest(['defendant', 'plaintiff']), unnest([1, NULL]), NULL, NULL, NULL, NULL, unnest([2, 0]), unnest(['Judge Ann Lee', NULL]) FROM cases WHERE case_type = 'cr') SELECT k, CAST(i AS INT) i, "name", "role", party_type, pacer_id, phone, email, ended, office, CAST(lawyers AS INT) lawyers, judge FROM p""")
def docket_parties(spark, sf):
    p = _parsed(spark, sf)
    return p.select("k", "i", "p.name", "p.role", "p.party_type", "p.pacer_id", "p.entity_info.phone", "p.entity_info.email", F.col("p.entity_info.terminating_date").alias("ended"), F.col("p.entity_info.office_name").alias("office"), F.size("p.counsel").alias("lawyers"), "p.judge")


@query(f"""WITH {CASES} SELECT k, unnest(['Amy Bar', 'Bob Cee']) "name", unnest(['Bar LLP', NULL]) office, unnest(['302-555-1234', NULL]) phone, unnest([true, false]) "lead", unnest([false, true]) pro_hac, unnest([false, true]) see_above, unnest(['Retained', NULL]) designation, unnest([NULL, '03/04/2020']) ended FROM cases WHERE case_type <> 'mc'""")
def docket_counsel(spark, sf):
    c = _parsed(spark, sf).select("k", F.explode("p.counsel").alias("c"))
    return c.select("k", "c.name", F.col("c.entity_info.office_name").alias("office"), "c.entity_info.phone", F.col("c.is_lead_attorney").alias("lead"), F.col("c.is_pro_hac_vice").alias("pro_hac"), F.col("c.has_see_above").alias("see_above"), "c.designation", F.col("c.entity_info.terminating_date").alias("ended"))


@query(f"""WITH {CASES} SELECT k, unnest(['1s', '2']) id, unnest(['18:922(g) FELON ' || k, '21:841 DRUGS']) text, unnest(['30 months', NULL]) disposition, 'Felony' opening, '18:2 AIDING' complaint, 'dismissed' complaint_end, 'Magistrate Judge Bo Ray' referred, '12-1,12-2' appeals FROM cases WHERE case_type = 'cr'""")
def docket_counts(spark, sf):
    c = _parsed(spark, sf).where("p.role = 'Defendant' and case_type = 'cr'").select("k", "p", F.explode("p.pending_counts").alias("c"))
    return c.select("k", F.col("c.pacer_id").alias("id"), "c.text", "c.disposition", F.col("p.highest_offense_level_opening").alias("opening"), F.col("p.complaints_text").alias("complaint"), F.col("p.complaints_disposition").alias("complaint_end"), F.array_join("p.referred_judges", ",").alias("referred"), F.array_join("p.appeals_case_ids", ",").alias("appeals"))


def _case_pages(spark, sf):
    c = raw_cases(spark, sf).repartition(TASKS, "k")  # rows are dealt out, not their pages
    title = F.when(F.col("case_type") == "cr", _text("Case title: USA v. P", key(), "<br>")).otherwise(_text("<br>Party ", key(), " v. Firm<br>"))
    lead = F.when(key() % 3 == 0, _text("Lead case: <a href='/cgi-bin/DktRpt.pl?77'>", F.col("office"), ":", F.col("yy"), "-md-02741</a><br>")).otherwise("")
    flags = _by(["<span>CLOSED</span>", "<span class=x>MDL_2741</span> <span>SEALED</span>", ""])
    related = "<tr><td>Related&nbsp;Cases:&nbsp;</td><td><a href=x>1:01-cv-00001</a><br><a href=y>1:02-cv-00002</a></td></tr></table>"
    entries = "<table><tr><td>Date Filed</td><td>#</td><td>Docket Text</td></tr><tr><td>01/02/2020</td><td><a href='/doc1/5'>1</a></td><td>COMPLAINT by X</td></tr><tr><td>01/03/2020</td><td></td><td>ORDER on <a href='/doc1/5'>1</a></td></tr></table>"
    stamp = _text("\n<!-- SCALESDOWNLOAD;pacer_id:", key(), ";download_url:http://h/x;slabels:", _by(["stub", "private", ""]), " -->")
    page = _text('<table width="100%"><tr><td align="right">', flags, "</td></tr></table><h3>Northern District of Ohio (Eastern)<br>Live (Dover)<br>CIVIL DOCKET FOR CASE #: ", F.col("case_id"), "-ABC</h3>", title, lead, "Assigned to: Judge Ann Lee<br>Date Filed: ", F.date_format("filed", "MM/dd/yyyy"), "<br>", F.when(F.col("status") == "F", "Date Terminated: 01/02/2021<br>").otherwise(""), "Nature of Suit: 110 Insurance<br><table>", F.when(key() % 2 == 0, related).otherwise("</table>"), F.when(key() % 5 == 0, _members()).otherwise(""), _party_page(), entries, stamp)
    return c.select("k", "court", "case_id", page.alias("html"))


@query(f"""WITH {CASES} SELECT k, ucid, case_type, 'Dover' city, case_id || '-ABC' header_case_id, strftime(filed, '%m/%d/%Y') filing_date, CASE WHEN status = 'F' THEN 'closed' ELSE 'open' END case_status, CASE WHEN case_type = 'cr' THEN 'USA v. P' || k ELSE 'Party ' || k || ' v. Firm' END case_name, CASE WHEN k % 3 = 0 THEN office || ':' || yy || '-md-02741' END lead_case_id, CASE WHEN k % 2 = 0 THEN '1:01-cv-00001,1:02-cv-00002' ELSE '' END related, {_sql_by(["'CLOSED'", "'MDL_2741,SEALED'", "''"])} flags, CAST(CASE WHEN k % 3 < 2 THEN 2741 END AS INT) mdl_code, {_sql_by(["'lead_case_id'", "'flag'", None])} mdl_id_source, k % 3 < 2 is_mdl, k % 3 < 2 OR k % 5 = 0 is_multi, CASE WHEN k % 5 = 0 THEN CASE WHEN k % 3 = 0 THEN court || ';;' || office || ':' || yy || '-md-02741' ELSE ucid END END member_case_key, CASE WHEN case_type = 'cv' THEN 'Judge Ann Lee' END judge, k % 3 = 0 is_stub, k % 3 = 1 is_private, CAST(k AS VARCHAR) case_pacer_id, CAST(CASE case_type WHEN 'cv' THEN 3 WHEN 'cr' THEN 2 ELSE 0 END AS INT) n_parties, 2 n_entries, 'pacer' "source" FROM cases""")
def docket_case_rows(spark, sf):
    c = cases.case_rows(_case_pages(spark, sf))
    return c.select("k", "ucid", "case_type", "city", "header_case_id", "filing_date", "case_status", "case_name", "lead_case_id", F.array_join("related_cases", ",").alias("related"), F.array_join("case_flags", ",").alias("flags"), "mdl_code", "mdl_id_source", "is_mdl", "is_multi", "member_case_key", "judge", "is_stub", "is_private", "case_pacer_id", F.size("parties").alias("n_parties"), F.size("docket").alias("n_entries"), "source")


@query(f"WITH {CASES} SELECT k, ucid FROM cases WHERE k % 4 <> 0 AND k % 3 = 0")
def parse_new_only(spark, sf):
    p, c = _case_pages(spark, sf), raw_cases(spark, sf)
    return cases.parse_new(p, done=c.where(key() % 4 == 0), only=c.where(key() % 3 == 0)).select("k", "ucid")


@query(f"WITH {CASES}, m AS (SELECT unnest([ucid, court || ';;1:99-cv-00007']) member, court, CASE WHEN k % 3 = 0 THEN court || ';;' || office || ':' || yy || '-md-02741' ELSE ucid END \"lead\" FROM cases WHERE k % 5 = 0) SELECT DISTINCT member, court, \"lead\" FROM m WHERE court = 'ccd'")
def member_links(spark, sf):
    rows = members.member_rows(cases.case_rows(_case_pages(spark, sf))).persist()
    empty = rows.limit(0)
    return members.add_members(empty, rows.union(rows)).where("court = 'ccd'").select("member", "court", "lead")


@query(f"WITH {CASES} SELECT k, 'ohnd' court, case_id || '-ABC' case_no FROM cases")
def header_courts(spark, sf):
    c = _case_pages(spark, sf).select("k", cases.header_court(F.col("html"), lambda x: linkage.classify_court(x, {"ohio": "oh"})).alias("h"))
    return c.select("k", "h.court", "h.case_no")


_NO_CASE = "<tr><td>Magistrate Judge: <b>Bo Ray</b></td></tr>"


@query(f"""WITH {CASES} SELECT k, case_id, 'P' || k || ' v. Firm' case_name, 'Judge Lee, presiding' presiding, '' referral, strftime(filed, '%m/%d/%Y') date_filed, CASE WHEN case_type = 'cv' THEN 'Dover' END office, CASE WHEN case_type = 'cv' THEN 'plaintiff' END party_role, CASE WHEN case_type = 'cv' THEN 'Party ' || cust END party_name, CASE WHEN case_type = 'cv' THEN 'Amy Bar' END represented_by, CASE WHEN case_type = 'cr' THEN 'Party ' || cust END defendant, CASE WHEN case_type = 'cr' THEN '1' END ind, CASE WHEN case_type = 'cr' THEN 'FRAUD ' || k END count_text, CASE WHEN case_type = 'cr' THEN '18:1' END citation, CASE WHEN case_type = 'cr' THEN 'AIDING' END complaint, CASE WHEN case_type = 'cr' THEN 'A,B' END flags, CAST(k % 30 + 1 AS INT) pages FROM cases WHERE case_type <> 'mc'""")
def case_summaries(spark, sf):
    head = _text('<div id="cmecfMainContent"><center><b>', F.col("case_id"), "</b><br>P", key(), " v. Firm<br>Judge Lee, presiding<br><b>Date filed:</b> ", F.date_format("filed", "MM/dd/yyyy"), "</center>")
    civil = _text("<table><tr><td><b>Office:</b> Dover</td><td><b>Jury demand:</b> None</td></tr></table><table><tr><td><b>Plaintiff</b>: Party  ", F.col("cust"), "</td><td>represented by</td><td>Amy Bar</td><td>Phone: 3</td></tr></table>")
    criminal = _text("<table><tr><td><B><U>Party  ", F.col("cust"), " (1)</B></U></td></tr><tr><td><b>Office:</b> Dover</td></tr><tr><td>Count: 1</td><td>Citation: 18:1</td></tr><tr><td>FRAUD ", key(), "</td></tr><tr><td>Complaint</td><td>Citation: 18:2</td></tr><tr><td>AIDING</td></tr>", _NO_CASE, "<tr><td>Flags: A,B</td></tr></table><table><tr><td>Plaintiff: USA</td></tr></table>")
    receipt = _text("</div>Transaction Receipt 01/02/2020 1:00 \nPacer Login: u1 x Description: Summary \nCase Number: 5 \nBillable Pages: ", key() % 30 + 1, " Cost: 0.10")
    page = _text(head, F.when(F.col("case_type") == "cv", civil).otherwise(criminal), receipt)
    c = raw_cases(spark, sf).where("case_type <> 'mc'").repartition(TASKS, "k").select("k", "case_type", summary.summaries(page).alias("s"), summary.summary_receipt(page)["billable_pages"].alias("pages"))
    f, p, d = F.col("s.fields"), F.get("s.parties", F.lit(0)), F.get("s.defendants", F.lit(0))
    return c.select("k", f["case_id"].alias("case_id"), f["case_name"].alias("case_name"), f["presiding"].alias("presiding"), f["referral"].alias("referral"), f["date_filed"].alias("date_filed"), f["office"].alias("office"), p["role"].alias("party_role"), p["name"].alias("party_name"), p["represented_by"].alias("represented_by"), d["name"].alias("defendant"), d["ind"].alias("ind"), F.get(d["counts"], F.lit(0))["text"].alias("count_text"), F.get(d["counts"], F.lit(0))["citation"].alias("citation"), F.get(d["complaints"], F.lit(0))["text"].alias("complaint"), F.when(F.col("case_type") == "cr", F.array_join(d["flags"], ",")).alias("flags"), "pages")


def _row(*cells):
    return _text("<tr>", *(x for c in cells for x in ("<td>", c, "</td>")), "</tr>")


@query(f"""WITH {CASES}, g AS (SELECT court, min(k) a, max(k) b FROM cases GROUP BY court) SELECT court page, 'ohio northern' district, unnest([a, b])::INT mdl_no, unnest(['In re A', 'In re B']) caption, unnest(['Lee', 'Ray']) judge, unnest([1234, NULL])::INT transferred FROM g""")
def mdl_terminated_report(spark, sf):
    g = raw_cases(spark, sf).groupBy("court").agg(F.min("k").alias("a"), F.max("k").alias("b"))
    page = _text("<table>", _row("Court Code", "", "District", "", "", "", "", "", ""), _row("12", "", "Ohio Northern", "", "", "", "", "", ""), _row("", F.col("a"), "In re A", "Lee", "1,234", "5", "6", "7", "2019"), _row("", F.col("b"), "In re B", "Ray", "", "5", "6", "7", "2018"), _row("", "Total", "", "", "", "", "", "", ""), "</table>")
    return reports.mdl_terminated(g.select(F.col("court").alias("page"), page.alias("html")), "page").join(g.select(F.col("court").alias("page"), "a", "b"), (F.col("a") == F.col("mdl_no")) | (F.col("b") == F.col("mdl_no"))).select("page", "district", "mdl_no", "caption", "judge", "transferred")


@query("""SELECT n_nationkey page, unnest(['ohnd', 'ohnd']) district, unnest(['Lee', 'Raymond']) judge, unnest([n_nationkey + 2000, n_nationkey + 3000])::INT mdl_no, unnest(['Acme', 'Zeta']) caption, unnest([1234, 5])::INT actions_pending FROM nation""")
def mdl_pending_report(spark, sf):
    nation = F.col("n_nationkey")
    page = _text("<table>", _row("Report", "as of today", "", "", "", ""), _row("ohn", "LEE", "", "", "", ""), _row("ohn", "Lee", _text("MDL -", nation + 2000), "IN RE: Acme", "1,234", "2,000"), _row("", "Raymond", _text("MDL -", nation + 3000), "IN RE: Zeta", "5", "6"), _row("Report Totals:", "", "", "", "1", "2"), _row("ohn", "No", "MDL -1", "IN RE: After", "1", "2"), "</table>")
    out = reports.mdl_pending(read(spark, sf, "nation").select(nation.alias("page"), page.alias("html")), "page")
    return out.withColumn("page", (F.col("mdl_no") % 1000).cast("int")).select("page", "district", "judge", "mdl_no", "caption", "actions_pending")


@query(f"WITH {CASES} SELECT k, case_id clean_id, strftime(filed, '20%y-%m-%d') filed, CASE WHEN status = 'F' THEN '2021-03-04' END closed FROM cases WHERE case_type IN ('cv', 'cr')")
def query_reports(spark, sf):
    detail = _text("filed ", F.date_format("filed", "MM/dd/yy"), F.when(F.col("status") == "F", " closed 03/04/21").otherwise(""))
    page = _text("<table>", _row(_text(F.col("case_id"), "-2"), "A v. B", detail), _row("", "", ""), "</table><table><tr><td>x</td><td>y</td><td>z</td></tr></table>")
    return reports.query_report(raw_cases(spark, sf).select("k", page.alias("html")), "k", F.lit("ccd")).select("k", "clean_id", "filed", "closed")


@query("SELECT conv_id, unnest(['1', '1']) line, unnest([0, 2])::INT attachment FROM conversations WHERE turn = 0 AND conv_id % 2 = 0")
def document_link_rows(spark, sf):
    c = read(spark, sf, "conversations").where("turn = 0")
    docs = F.create_map(F.lit("0"), F.struct(F.lit("/doc1/1").alias("url")), F.lit("1"), F.struct(F.lit("/doc1/2").alias("url")), F.lit("2"), F.struct(F.lit("/doc1/3").alias("url")))
    rows = c.select("conv_id", F.lit("1").alias("label"), docs.alias("documents"))
    wanted = fetch.wanted_documents(c.where("conv_id % 2 = 0").select("conv_id", F.lit("1,1_2,9").alias("spec")), "spec").select("conv_id", "doc_no", "attachment")
    return reports.document_links(rows, "conv_id", wanted).select("conv_id", "line", "attachment")


# --- a third party's dump -------------------------------------------------------------------------------------------------


def _dump(spark, sf):
    c = raw_cases(spark, sf)
    null = F.lit(None)
    kind = lambda name, info: F.struct(key().alias("docket_id"), F.lit(name).alias("name"), null.cast("string").alias("date_terminated"), F.lit(info).alias("extra_info"), *(null.cast("string").alias(n) for n in ("criminal_counts", "criminal_complaints", "highest_offense_level_opening", "highest_offense_level_terminated")))
    lawyer = F.array(F.struct(F.lit("Amy Bar").alias("name"), F.lit("Bar LLP\n12 Main St\n302-555-1234").alias("contact_raw"), F.array(F.lit(2), F.lit(1)).alias("roles")))
    party = F.array(F.struct(_text("Party ", F.col("cust")).alias("name"), F.lit("x\nTERMINATED: 01/02/2020").alias("extra_info"), F.array(kind("Consol Plaintiff", "x")).alias("party_types"), lawyer.alias("attorneys")), F.struct(F.lit("Odd").alias("name"), F.lit("y").alias("extra_info"), F.array(kind("Movant", "y"), kind("Movant", "z")).alias("party_types"), F.slice(lawyer, 1, 0).alias("attorneys")))
    doc = lambda t, n, i, d, on: F.struct(F.lit(t).alias("document_type"), F.lit(n).cast("int").alias("attachment_number"), F.lit(i).alias("pacer_doc_id"), F.lit(d).cast("string").alias("description"), F.lit(on).alias("is_available"), F.lit(3).alias("page_count"), F.lit("ia").alias("filepath_ia"), F.lit("lo").alias("filepath_local"))
    entry = lambda day, n, text, docs: F.struct(F.lit(day).alias("date_filed"), F.lit(n).cast("int").alias("entry_number"), F.lit(text).cast("string").alias("description"), docs.alias("recap_documents"))
    docs = F.array(doc(1, None, "d1", "Complaint", True), doc(2, 4, "d2", None, False), doc(3, None, "d3", None, False))
    entries = F.array(entry("2020-01-02", 1, "COMPLAINT", docs), entry("2020-01-03", None, None, docs), entry("2020-01-04", 3, None, F.slice(docs, 1, 0)))
    return c.select(key().alias("id"), F.col("court"), F.upper("case_id").alias("docket_number"), F.lit("A v. B").alias("case_name"), _by(["Lee", "Unassigned"]).alias("assigned_to_str"), _by(["Ray", ""]).alias("referred_to_str"), F.date_format("filed", "yyyy-MM-dd").alias("date_filed"), F.when(F.col("status") == "F", "2021-03-04").alias("date_terminated"), F.lit("").alias("cause"), F.lit("Federal question").alias("jurisdiction_type"), F.lit("None").alias("jury_demand"), F.lit("110").alias("nature_of_suit"), party.alias("parties"), entries.alias("docket_entries"))


@query(f"""WITH {CASES} SELECT k recap_id, ucid, upper(case_id) case_id, CASE WHEN status = 'F' THEN 'closed' ELSE 'open' END case_status, strftime(filed, '%m/%d/%Y') filing_date, {_sql_by(["'Lee'", None])} judge, {_sql_by(["'Ray'", "''"])} referred, NULL cause, 'recap' "source", unnest([0, 1]) i, unnest(['', '1']) ind, unnest([NULL, 'COMPLAINT']) docket_text, unnest(['Complaint', NULL]) description_short, '0,4,_d3' documents, 'https://ecf.' || court || '.uscourts.gov/doc1/d1' url FROM cases WHERE case_type = 'cv'""")
def third_party_cases(spark, sf):
    c = thirdparty.remap(_dump(spark, sf)).select("recap_id", "ucid", "case_id", "case_status", "filing_date", "judge", F.array_join("referred_judges", ",").alias("referred"), "cause", "source", F.posexplode("docket").alias("i", "e"))
    return c.select("recap_id", "ucid", "case_id", "case_status", "filing_date", "judge", "referred", "cause", "source", "i", "e.ind", "e.docket_text", "e.description_short", F.array_join(F.array_sort(F.map_keys("e.documents")), ",").alias("documents"), F.col("e.documents")["0"]["url"].alias("url"))


@query(f"""WITH {CASES} SELECT k id, unnest([0, 1]) party_ind, unnest(['Party ' || cust, 'Odd']) "name", unnest(['Plaintiff', 'Movant']) "role", unnest(['plaintiff', 'misc']) party_type, unnest(['01/02/2020', NULL]) ended, unnest([1, NULL])::INT n_lead, unnest(['Bar LLP', NULL]) office, unnest(['302-555-1234', NULL]) phone, unnest([true, NULL]) notice FROM cases""")
def third_party_parties(spark, sf):
    d = _dump(spark, sf)
    c = thirdparty.counsel_rows(d)
    p = thirdparty.party_rows(d).join(c.withColumnRenamed("name", "lawyer"), ["id", "party_ind"], "left")
    return p.select("id", "party_ind", "name", "role", "party_type", F.col("terminating_date").alias("ended"), F.when(F.col("is_lead_attorney"), 1).alias("n_lead"), F.col("office_name").alias("office"), "phone", F.col("is_notice_attorney").alias("notice"))


# --- index, courts, judges ------------------------------------------------------------------------------------------------


@query(f"""WITH {CASES} SELECT k, ucid, court, CAST(year(filed) AS INT) "year", 'p/' || court || '/json/' || yy || '/x.json' fpath, CASE WHEN case_type = 'cr' THEN 'criminal' ELSE '110 Insurance' END suit, 'ann lee' judge, strftime(filed, '%Y-%m-%d') filed FROM cases WHERE court BETWEEN 'cbd' AND 'cmd'""")
def case_index_rows(spark, sf):
    c = raw_cases(spark, sf)
    rows = c.select(key().cast("int").alias("mdl_code"), F.lit(None).cast("string").alias("download_court"), _text("/r/p/", F.col("court"), "/json/", F.col("yy"), "/x.json").alias("fpath"), F.upper("case_id").alias("case_id"), "case_type", F.date_format("filed", "M/d/yyyy").alias("filing_date"), F.lit(None).cast("string").alias("terminating_date"), F.lit("110 Insurance").alias("nature_suit"), F.lit("Hon. Ann Lee (x)").alias("judge"), *(F.lit(False).alias(n) for n in ("is_multi", "is_mdl", "is_stub")))
    out = index.select_cases(index.read_index(index.case_index(rows, judges.clean_name, "r"), fill_criminal=True), first_court="cbd", last_court="cmd")
    return out.select(F.col("mdl_code").cast("long").alias("k"), "ucid", "court", "year", "fpath", F.col("nature_suit").alias("suit"), "judge", F.col("filing_date").cast("string").alias("filed"))


@query("SELECT o_orderkey k, CAST(year(o_orderdate) AS INT) \"year\", CASE WHEN year(o_orderdate) < 1995 THEN o_orderstatus END a, CASE WHEN year(o_orderdate) >= 1995 THEN o_orderpriority END b FROM orders")
def union_of_years(spark, sf):
    o = read(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    early, late = o.where("year < 1995").select("year", F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("a")), o.where("year >= 1995").select(F.col("o_orderpriority").alias("B"), F.col("o_orderkey").alias("K"), "year")
    return index.union_years([early, late]).select(F.col("K").alias("k"), "year", F.col("A").alias("a"), F.col("B").alias("b"))


@query(f"WITH {CASES} SELECT k, case_id, 'n 123' || chr(32) || repeat(' ', 11) || '.' note FROM cases WHERE k % 2 = 0")
def load_wanted_cases(spark, sf):
    c = raw_cases(spark, sf).select("k", "ucid", F.upper("case_id").alias("case_id"), F.lit("n 123 987-65-4321.").alias("note"))
    return index.load_cases(c, c.where(key() % 2 == 0).union(c.where(key() % 2 == 0)), texts=["note"]).select("k", "case_id", "note")


_COURTS = [("ohnd", "Northern", "Ohio"), ("dcd", None, "District of Columbia"), ("nynd", "Northern", "New York"), ("mad", None, "Massachusetts")]


@query(f"""WITH {CASES} SELECT k, {_sql_by(["'ohnd'", "'dcd'", "'nynd'", None, "'mad'"])} abbreviation, {_sql_by(["'10'", "'110'", None, "'550'", "'12'"])} code, CASE WHEN k % 2 = 0 THEN strftime(filed, '%Y-%m-%d') ELSE '1900-01-01' END "day", court folder, {_sql_by(["'U.S. District Court for the Northern District of Ohio'", "'U.S. District Court for the District of District of Columbia'", "'U.S. District Court for the Northern District of New York'", None, "'U.S. District Court for the District of Massachusetts'"])} title FROM cases""")
def court_names(spark, sf):
    table = spark.createDataFrame(_COURTS, "abbreviation string, cardinal string, state string")
    named = raw_cases(spark, sf).withColumn("name", _by(["ohio northern district", "district of columbia", "new york northern", "atlantis", "Massachusetts"]))
    out = courts.with_court(named, table, "name", ordinal_first=False).join(courts.court_table(table).select("abbreviation", "title"), "abbreviation", "left")
    day = courts.day_or_first(F.when(key() % 2 == 0, F.date_format("filed", "M/d/yyyy")).otherwise("soon"))
    return out.select("k", "abbreviation", courts.suit_code(_by(["10 x", "110 Insurance", "none", "P 550", "12"])).alias("code"), day.cast("string").alias("day"), courts.path_court(_text("a/", F.col("court"), "/json/x.json")).alias("folder"), "title")


@query(f"""WITH {CASES} SELECT k, {_sql_by(["'curtis v gomez'", "''", "'john smith'", "''", "'ann lee'", "'bo ray jr'"])} "name", {_sql_by(["'gomez'", "''", "'smith'", "''", "'lee'", "'ray'"])} "last" FROM cases""")
def judge_name_forms(spark, sf):
    n = _by(["District Judge Curtis V. Gomez", "Unassigned", "Chief Magistrate Judge John Smith referred to X", "Judge", "The Honorable Ann Lee (visiting)", "Hon. Bo Ray, Jr."])
    return raw_cases(spark, sf).select("k", judges.clean_name(n).alias("name"), judges.last_name(n).alias("last"))


_JUDGES = [(1, 1, "Ann", "B", "Lee"), (2, 2, "Bo", "C", "Ray"), (3, 3, "Carl", "D", "Ray"), (4, 4, "J", "Dan", "Lowe"), (5, 5, "Eve", "F", "Raymond")]


@query(f"""WITH {CASES} SELECT k, {_sql_by(["'1'", "CASE WHEN court = 'ccd' AND filed > DATE '1994-01-01' THEN '2' ELSE '9999999' END", "'4'", "'10000005'", "'9999999'", "'9999999'"])} judge_nid FROM cases""")
def judge_links(spark, sf):
    people = spark.createDataFrame(_JUDGES, "nid int, ord int, first_name string, middle_name string, last_name string")
    seats = spark.createDataFrame([(2, "ccd", "1994-01-01"), (3, "cdd", "2050-01-01"), (1, "ccd", "1990-01-01")], "nid int, court string, since string").withColumn("since", F.to_date("since"))
    asked = raw_cases(spark, sf).select("k", "court", F.col("filed").alias("day"), _by(["Judge Ann Lee", "Bo Ray", "Hon. Dan Lowe", "Executive Committee", "Nobody Known", "Zed Lee"]).alias("name"))
    return judges.link(asked, people, seats).select("k", "judge_nid")


@query(f"WITH {CASES} SELECT k, court = 'ccd' AND filed > DATE '1995-06-01' is_senior FROM cases")
def judge_seniority(spark, sf):
    linked = raw_cases(spark, sf).select("k", "court", F.col("filed").alias("day"), F.lit("2").alias("judge_nid"))
    slots = spark.createDataFrame([(2, "ccd", 1, "1995-06-01"), (2, "ccd", 2, "1990-01-01"), (3, "cdd", 1, "1990-01-01")], "nid int, court string, slot int, senior_day string").withColumn("senior_day", F.to_date("senior_day"))
    return judges.senior(linked, slots).select("k", "is_senior")


@query("""WITH t AS (SELECT conv_id, turn, CASE turn % 5 WHEN 1 THEN 'Ann Lee' WHEN 3 THEN 'Bo Ray' END named FROM conversations)
SELECT conv_id, turn, coalesce(last_value(named IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), first_value(named IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), '') judge FROM t""")
def judge_of_entries(spark, sf):
    text = F.when(F.col("turn") % 5 == 1, "ORDER signed by Judge Ann Lee. Set before Judge Bo Ray").when(F.col("turn") % 5 == 3, "MOTION before Magistrate Bo Ray.").otherwise("notice")
    return judges.judge_entries(read(spark, sf, "conversations").withColumn("text", text), "conv_id", ["turn"]).select("conv_id", "turn", "judge")


@query("SELECT conv_id, turn, CASE WHEN turn < 2 THEN CASE WHEN n >= 2 THEN 'Ann Lee' ELSE 'Bo Ray' END ELSE CASE WHEN n >= 4 THEN 'Ann Lee' ELSE ' ' END END judge FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) n FROM conversations)")
def judge_of_blocks(spark, sf):
    text = F.when(F.col("turn") == 0, "before Judge Bo Ray").when(F.col("turn") == 1, "Judge Ann Lee and Judge Ann Lee").when(F.col("turn") == 3, "Judge Ann Lee").otherwise("x")
    return judges.block_entries(read(spark, sf, "conversations").withColumn("text", text), "conv_id", ["turn"], F.col("turn") == 2).select("conv_id", "turn", "judge")


@query(f"WITH {CASES} SELECT 'Party/' || ucid || '_p' || (k % 3) s, 'isInstanceOfEntity' p, 'PartyEntity/' || cust o, 'uri' kind FROM cases WHERE k % 2 = 0")
def entity_instances(spark, sf):
    c = raw_cases(spark, sf)
    rows = entities.of_cases(c.withColumn("id", F.when(key() % 4 >= 0, F.col("cust"))), c.where(key() % 2 == 0))
    return entities.instances(rows, graph.party_uri(F.col("ucid"), key() % 3))


# --- parties ----------------------------------------------------------------------------------------------------------------

_LEXICON = {"given_names": ["john", "mary"], "surnames_common": ["smith", "doe"], "company_words_common": ["inc", "llc", "co"], "gov_words": ["county", "united states"], "us_state_names": ["virginia", "ohio"], "english_words": ["apple", "tree"], "family_words": ["wife"], "role_words_non_professional": ["warden"], "org_words": ["association"], "unknown_words": ["unknown"]}
_NAMES = [("John Smith", None, "individual", "redact"), ("Acme, Inc.", None, "other", "no_redact"), ("Cook County", None, "government", "no_redact"), ("J. D.", None, "individual", "redact"), ("John Smith", "as wife of Mary Doe", "multi-entity", "redact"), ("Ohio", None, "government", "no_redact"), ("Tree Association", None, "other", "no_redact"), ("X on behalf of Y", None, "multi-entity", "no_redact"), ("Apple Tree", None, "other", "no_redact"), ("Mary Virginia", None, "individual", "redact"), ("Bank dba Teller", None, "other", "other"), ("Smith ex rel. Doe", None, "multi-entity", "no_redact"), ("John Smith", "trustee of the fund", "multi-entity", "multi-entity"), ("Warden Doe", None, "individual", "no_redact"), ("Unknown Doe", None, "other", "no_redact"), (None, None, "other", "other"), ("Mary Doe", "individually", "individual", "redact"), ("John Doe and Mary Apple Tree", None, "other", "no_redact")]


def _named(spark, sf):
    of = lambda i: _by([n[i] for n in _NAMES])
    return raw_cases(spark, sf).select("k", of(0).alias("name"), of(1).alias("extra_info"), F.lit(None).cast("string").alias("nos_subtype"))


def _quoted(values):
    return [f"'{v}'" for v in values]


@query(f"WITH {CASES} SELECT k, {_sql_by(_quoted(n[2] for n in _NAMES))} party_class FROM cases")
def party_classes(spark, sf):
    return party_tree.classify_parties(_named(spark, sf), _LEXICON).select("k", "party_class")


@query(f"WITH {CASES} SELECT k, {_sql_by(_quoted(n[3] for n in _NAMES))} party_class FROM cases")
def party_redaction_classes(spark, sf):
    return party_tree.classify_parties(_named(spark, sf), _LEXICON, redaction=True).select("k", "party_class")


@query("SELECT conv_id, turn, unnest([0, 26, 49])::INT AS \"start\", unnest([17, 42, 60])::INT AS \"end\" FROM conversations")
def name_tags(spark, sf):
    head = "John Q. Public Jr moved. (J. Q. Public, Jr.) Mr. John Public too. "
    e = read(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit(head), F.regexp_replace("text", "(?i)public|john", "x")).alias("text"))
    e = e.withColumn("text", F.concat(F.substring("text", 1, len(head)), F.lit("\n\n"), F.expr(f"substring(text, {len(head) + 1})")))
    n = e.select("conv_id").distinct().withColumn("name", F.lit("John Q. Public Jr"))
    return naming.tag_names(e, n, ["conv_id"]).select("conv_id", "turn", "start", "end")


@query("SELECT conv_id, turn, 'A or B saw A. ' || text redacted FROM conversations")
def redacted_entries(spark, sf):
    e = read(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("John Doe saw Bo Ray. "), "text").alias("text"))
    tags = e.select("conv_id", "turn", F.explode(F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(n).alias("label")) for a, b, n in ((0, 8, "A"), (0, 8, "B"), (5, 8, "no"), (13, 19, "A"))))).alias("t")).select("conv_id", "turn", "t.*")
    return naming.redact_entries(e, tags, ["conv_id", "turn"]).select("conv_id", "turn", "redacted")


@query("""SELECT conv_id, turn, '<span class="annotation" data-label="a">Order</span> &lt;b&gt; <span class="annotation" data-label="b">x</span>' docket_html FROM conversations WHERE turn BETWEEN 1 AND 2""")
def annotated_dockets(spark, sf):
    e = read(spark, sf, "conversations").select("conv_id", "turn", F.lit("Order <b> x").alias("text"))
    spans = e.select("conv_id", "turn", F.explode(F.array(F.struct(F.lit(10).alias("start"), F.lit(11).alias("end"), F.lit("b").alias("label")), F.struct(F.lit(0).alias("start"), F.lit(5).alias("end"), F.lit("a").alias("label")))).alias("s")).select("conv_id", "turn", "s.*")
    return bundle.excerpt(bundle.annotated_entries(e, spans, "conv_id", "turn"), "turn", 1, 2).select("conv_id", "turn", "docket_html")


@query(f"WITH {CASES} SELECT k, {_sql_by(['0', '1', '1', None, None, '0'])}::INT pro_se_index FROM cases")
def pro_se_index(spark, sf):
    one = lambda n, info, p: F.struct(F.lit(n).cast("string").alias("name"), F.lit(info).cast("string").alias("info"), F.lit(p).alias("is_pro_se"))
    forms = [F.array(one("Zed", None, True)), F.array(one("Ann Lee", None, True), one("Zed", "PRO SE", True)), F.array(one("Ann Lee", None, False), one("john  SMITH", None, False)), F.array(one("Ann Lee", None, False)), F.array(one("AUSA", None, False)), F.array(one("Smith, John Q.", None, False), one("Ann Lee", None, False))]
    out = forms[-1]
    for i, f in enumerate(forms[:-1]):
        out = F.when(key() % 6 == i, f).otherwise(out)
    return linkage.pro_se_counsel(raw_cases(spark, sf).select("k", _by(["A B", "A B", "John Smith", "Mark Twain", "USA", "Mr John Smith"]).alias("name"), out.alias("counsel"))).select("k", "pro_se_index")


# --- statistics and planning --------------------------------------------------------------------------------------------------


@query(f"""WITH {CASES} SELECT k, {_sql_by([None, "'12'", "'abc'", "'7'"])} nos, strftime(filed, '%Y-%m-%d') date_filed, 'P' || cust plaintiff, 'D' defendant FROM cases WHERE k % 3 <> 0""")
def case_statistics(spark, sf):
    c = raw_cases(spark, sf)
    s = c.where(key() % 3 != 0).select("ucid", F.col("filed").alias("filedate"), _by(["-8", "12.0", "abc", "7"]).alias("nos"), _text("P", F.col("cust")).alias("plt"), F.lit("D").alias("def"))
    s = linkage.statistics_struct(s, {"nos": "nos", "filedate": "date_filed"}, "cv", ["filedate"])
    return linkage.attach_statistics(c, s).where("idb_data is not null").select("k", "idb_data.*")


@query(f"WITH {CASES} SELECT ucid, court || ';;' || yy || '-' || case_type || '-' || number ucid_weak, yy split_year FROM cases WHERE year(filed) >= 1994 AND case_type = 'cv' AND length(number) = 5")
def statistics_by_year(spark, sf):
    c = raw_cases(spark, sf).where("case_type = 'cv' and length(number) = 5")
    s = c.select(F.concat("yy", "number").alias("DOCKET"), F.date_format("filed", "M/d/yyyy").alias("FILEDATE"), F.col("office").alias("OFFICE"), F.col("court").alias("DISTRICT"))
    return linkage.split_years(s, "cv", F.col("DISTRICT"), 1994).select("ucid", "ucid_weak", "split_year")


@query(f"""WITH {CASES}, w AS (SELECT k, CASE WHEN k % 2 = 0 THEN strftime(filed + CAST(i * 31 AS INT), '%m/%d/%Y') ELSE '01/01/2020' END filed_from, CASE WHEN k % 2 = 0 THEN strftime(least(filed + CAST((i + 1) * 31 AS INT), filed + 200), '%m/%d/%Y') ELSE '02/01/2020' END filed_to, i FROM cases, range(7) r(i)) SELECT k, filed_from, filed_to FROM w WHERE k % 2 = 0 OR i = 0""")
def query_windows(spark, sf):
    c = raw_cases(spark, sf).select("k", F.when(key() % 2 == 0, F.date_format("filed", "MM/dd/yyyy")).otherwise("01/01/2020").alias("filed_from"), F.when(key() % 2 == 0, F.date_format(F.date_add("filed", 200), "MM/dd/yyyy")).otherwise("02/01/2020").alias("filed_to"))
    return fetch.split_config(c, [("filed_from", "filed_to")]).select("k", "filed_from", "filed_to")


@query(f"""WITH {CASES} SELECT case_id case_no, strftime(filed + 1, '%m/%d/%Y') date_from, CASE WHEN k % 2 = 0 THEN '2' ELSE '' END def_no FROM cases WHERE court = 'ccd'""")
def docket_updates(spark, sf):
    c = raw_cases(spark, sf).select("ucid", F.date_format("filed", "MM/dd/yyyy").alias("latest_date"), F.when(key() % 2 == 0, 2).alias("def_no"))
    return fetch.update_windows(fetch.docket_requests(c.union(c), "ccd")).select("case_no", "date_from", "def_no")


@query(f"WITH {CASES} SELECT ucid, CAST(CASE WHEN k % 2 = 0 THEN 1 ELSE k % 5 + 1 END AS INT) next_no, 'd/x.task.jsonl' log FROM cases")
def next_versions(spark, sf):
    path = F.when(key() % 2 == 0, "d/x.html").otherwise(_text("d/x_", key() % 5, ".html"))
    return fetch.next_file(raw_cases(spark, sf).select("ucid", path.alias("path"))).withColumn("log", fetch.task_file(F.lit("d/x.csv")))


@query("SELECT o_orderkey k FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) n, sum(o_totalprice) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) spent FROM orders) WHERE n <= 400 AND coalesce(spent, 0) < 20000000")
def within_limits(spark, sf):
    return fetch.within_limits(read(spark, sf, "orders"), ["o_orderkey"], 400, 20_000_000.0, "o_totalprice").select(F.col("o_orderkey").alias("k"))


@query(f"""WITH {CASES} SELECT k, k % 4 = 0 sealed, k % 4 = 1 no_lines, k % 4 = 2 receipt, 'goDLS(''a'',''' || k || ''')' "call", '{{"ucid":"' || ucid || '","completed":true,"downloaded":false,"new_lines":' || (k % 3) || ',"message":"m"}}' line, CAST(k AS VARCHAR) rec, k % 4 = 3 main FROM cases""")
def page_says(spark, sf):
    c = raw_cases(spark, sf)
    page = _by(["This case is SEALED", "There are proceedings for case 1:16-cv-1 but none satisfy the selection criteria", "Transaction Receipt", "plain"])
    s = fetch.page_states(page)
    recs = c.select("ucid", F.explode(F.when(key() % 2 == 0, F.array(F.struct(F.lit(0).alias("d"), key().alias("r")), F.struct(F.lit(2).alias("d"), (key() + 1).alias("r")))).otherwise(F.array(F.struct(F.lit(5).alias("d"), key().alias("r"))))).alias("x")).select("ucid", F.col("x.d").alias("d"), F.lit(None).cast("int").alias("w"), F.col("x.r").cast("string").alias("pacer_id"))
    rec = fetch.case_record(recs, "ucid", "d", "w").withColumnRenamed("pacer_id", "rec")
    line = fetch.task_line(F.col("ucid"), F.lit(True), F.lit(False), key() % 3, F.lit("m"))
    return c.join(rec, "ucid").select("k", s["sealed"].alias("sealed"), s["no_docketlines"].alias("no_lines"), s["receipt"].alias("receipt"), fetch.link_call(F.array(F.lit("a"), key().cast("string"))).alias("call"), line.alias("line"), "rec", fetch.is_main_row(_by(["Attachment 1", "Exhibit", "Part", "Main Document"])).alias("main"))


@query(f"WITH {CASES} SELECT k FROM cases WHERE k % 2 = 0 AND k % 3 <> 0 AND k % 5 <> 0")
def wanted_dockets(spark, sf):
    c = raw_cases(spark, sf)
    return fetch.wanted_dockets(c.select("k", "ucid", F.when(key() % 2 == 0, "1").otherwise(" ").alias("doc_no")), c.where(key() % 3 != 0), c.where(key() % 5 == 0)).select("k")


# --- graphs -------------------------------------------------------------------------------------------------------------------


@query(f"""WITH {CASES}, d AS (SELECT *, 'Case/' || ucid c, 'Party/' || ucid || '_p0' p0, 'Party/' || ucid || '_p1' p1, 'Lawyer/' || ucid || '_l' l, 'Judge/' || ucid || '_' j, 'DocketTable/' || ucid t, 'DocketEntry/' || ucid || '_de' e FROM cases WHERE case_type = 'cr'),
x AS (SELECT c, p0, p1, l, j, t, e, court, case_id, filed, status, ucid, cust, k, case_type FROM d)
SELECT unnest([c,c,c,c,c,c,c,c,t,c,c]) s, unnest(['type','type','CaseGeneralCategoryText','CaseCourt','CaseDocketID','StatusDescriptionText','StartDate','CaseSubCategoryText','type','CaseDefendantParty','CaseInitiatingParty']) p, unnest(['CourtCase','CriminalCase','criminal','Court/' || court,case_id,CASE WHEN status = 'F' THEN 'closed' ELSE 'open' END,strftime(filed, '%Y-%m-%d'),'110 Insurance','RegisterOfActions',p0,p1]) o FROM x
UNION ALL SELECT c, 'RegisterOfActions', t FROM x UNION ALL SELECT c, 'EndDate', '2021-01-02' FROM x WHERE status = 'F'
UNION ALL SELECT 'Case/' || ucid_l, 'hasMemberCase', c FROM (SELECT *, court || ';;' || case_id[1:4] || '-md-02741' ucid_l FROM x WHERE k % 3 = 0)
UNION ALL SELECT c, 'hasRelatedCase', 'Case/' || court || unnest([';;1:01-cv-00001', ';;1:02-cv-00002']) FROM x WHERE k % 2 = 0
UNION ALL SELECT unnest([p0,p0,p0,p0,p1,p1,p1]), unnest(['type','EntityName','ParticipantRoleCategoryText','hasHighestOffenseLevelOpening','type','EntityName','ParticipantRoleCategoryText']), unnest(['CaseDefendantParty','Party ' || cust,'Defendant','Felony','CaseInitiatingParty','USA','Plaintiff']) FROM x
UNION ALL SELECT 'Charge/' || ucid || '_p0_c' || n, unnest(['type','ChargeText','hasChargeType','ChargeSequenceID']), unnest(['Charge',CASE n WHEN '2' THEN '21:841 DRUGS' ELSE '18:922(g) FELON ' || k END,'pending',n]) FROM x, (VALUES ('1s'), ('2')) v(n)
UNION ALL SELECT 'Charge/' || ucid || '_p0_c1s', 'ChargeDisposition', '30 months' FROM x
UNION ALL SELECT unnest([p0, c]), unnest(['PersonCharge', 'CaseCharge']), 'Charge/' || ucid || '_p0_c' || n FROM x, (VALUES ('1s'), ('2')) v(n)
UNION ALL SELECT unnest([j||'0',j||'0',j||'1',j||'1',c,c]), unnest(['PersonFullName','CaseOfficialRoleText','PersonFullName','CaseOfficialRoleText','CaseJudge','CaseJudge']), unnest(['Judge Ann Lee','Assigned Judge','Magistrate Judge Bo Ray','Referred Judge',j||'0',j||'1']) FROM x
UNION ALL SELECT unnest([l||'0',l||'0',l||'0',l||'0',l||'1',l||'1',p0,p0]), unnest(['type','PersonFullName','CaseOfficialRoleText','ContactMailingAddress','type','PersonFullName','CaseDefenseAttorney','CaseDefenseAttorney']), unnest(['CaseDefenseAttorney','Amy Bar','Retained','12 Main St' || chr(10) || 'Dover, DE 19901','CaseDefenseAttorney','Bob Cee',l||'0',l||'1']) FROM x
UNION ALL SELECT unnest(['Firm/'||ucid||'_f0','Firm/'||ucid||'_f0',l||'0']), unnest(['type','OrganizationName','Firm']), unnest(['Firm','Bar LLP','Firm/'||ucid||'_f0']) FROM x
UNION ALL SELECT unnest([e||'0',e||'0',e||'0',e||'0',e||'1',e||'1',e||'1',t,t,t,t,e||'1']), unnest(['type','AdministrativeID','RegisterActionDate','RegisterActionDescriptionText','type','RegisterActionDate','RegisterActionDescriptionText','RegisterAction','RegisterAction','_0','_1','hasReferenceToOtherEntry']), unnest(['RegisterAction','1','2020-01-02','COMPLAINT by X','RegisterAction','2020-01-03','ORDER on 1',e||'0',e||'1',e||'0',e||'1',e||'0']) FROM x""")
def case_triples(spark, sf):
    return graph.case_graph(cases.case_rows(_case_pages(spark, sf)).where("case_type = 'cr'")).select("s", "p", "o")


@query("""SELECT DISTINCT s, p, o FROM (SELECT unnest(['DocketEntry/' || conv_id || '_de' || turn, 'Case/' || conv_id]) s, 'OntologyLabel' p, CASE turn % 2 WHEN 0 THEN 'OntologyLabel/CaseEvent/Attribute/x_y' ELSE 'OntologyLabel/CaseEvent/a_b' END o FROM conversations
UNION ALL SELECT 'DocketEntry/' || conv_id || '_de' || turn, unnest(['hasIfpLabel', 'hasIfpJudgeAttribution']), unnest(['IfpLabel/grant', CASE WHEN turn % 3 = 0 THEN 'JudgeEntity/SJ' || turn END]) FROM conversations) WHERE o IS NOT NULL""")
def label_triples(spark, sf):
    c = read(spark, sf, "conversations")
    on = graph.label_graph(c.select(F.col("conv_id").cast("string").alias("ucid"), F.col("turn").alias("row_ordinal"), F.when(F.col("turn") % 2 == 0, "attribute_x y").otherwise("a b").alias("label")))
    ifp = graph.fee_waiver_graph(c.select(F.col("conv_id").cast("string").alias("ucid"), F.col("turn").alias("row_ordinal"), F.lit("grant").alias("label"), F.when(F.col("turn") % 3 == 0, F.concat(F.lit("SJ"), F.col("turn"))).otherwise("").alias("SJID")))
    return on.unionByName(ifp).select("s", "p", "o")


@query(f"""WITH {CASES} SELECT 'Case/' || ucid s, unnest(['hasIdbFiledate', 'hasIdbNos']) p, unnest([strftime(filed, '%Y-%m-%d'), CAST(k % 9 AS VARCHAR)]) o FROM cases WHERE k % 4 <> 0
UNION ALL SELECT 'Court/' || c, p, o FROM (VALUES ('ohnd','type','Court'),('ohnd','CourtName','N.D. Ohio'),('ohnd','isInCircuit','6'),('ohnd','CourtCategoryCode','FED'),('ohnd','AddressPostalCode','04101'),('ohnd','CountyCode','39001'),('ohnd','CountyCode','00007')) v(c, p, o)
UNION ALL SELECT 'JudgeEntity/SJ1', p, o FROM (VALUES ('type','Judge'),('PersonFullName','Ann Lee'),('JudicialOfficialCategoryText','District'),('hasFJCJudgeDirID','7'),('URLID','http://fjc.gov/node/7'),('PersonRaceText','x'),('PersonSexText','F'),('hasCommissionDate','1999-01-02'),('appointedByParty','Z')) v(p, o)""")
def dimension_triples(spark, sf):
    c = raw_cases(spark, sf)
    stats = graph.statistics_graph(c.select("ucid", F.when(key() % 4 != 0, F.col("filed")).alias("filedate"), (key() % 9).alias("nos"), F.lit(None).cast("string").alias("none")))
    court = graph.court_graph(spark.createDataFrame([("ohnd", "N.D. Ohio", "6", [4101], [39001, 7])], "abbreviation string, name string, circuit string, zip array<int>, fips array<int>"))
    judge = graph.judge_graph(spark.createDataFrame([("SJ1", "Ann Lee", "District", "7", None)], "SJID string, Presentable_Name string, SCALES_Judge_Label string, NID string, BA_MAG_ID string"), spark.createDataFrame([(7, "x", "F", ["1/2/1999"], ["Z"])], "nid int, race string, gender string, commissions array<string>, parties array<string>"))
    return stats.unionByName(court).unionByName(judge).select("s", "p", "o")


@query("""WITH a AS (SELECT *, 'a-' || event_id i FROM events), x AS (SELECT i, unnest(['Arrest/'||i,'Arrest/'||i,'Arrest/'||i,'Arrest/'||i,'Arrest/'||i,'ArrestSubject/'||i,'ArrestCharge/'||i,'ArrestCharge/'||i,'ArrestCharge/'||i,'ArrestCharge/'||i,'ArrestCharge/'||i,'ArrestCharge/'||i]) s,
unnest(['type','ArrestAgency','ArrestSubject','ArrestCharge','ActivityDate','type','type','ChargeText','OffenseUCRCode','OffenseUCRCode','NIBRSReportCategoryCode','NIBRSReportCategoryCode']) p, unnest(['Arrest','PoliceDepartment/a','ArrestSubject/'||i,'ArrestCharge/'||i,strftime(ts,'%Y-%m-%d'),'Person','ArrestCharge',event_type,CASE WHEN user_id % 2 = 0 THEN '13A' END,CASE WHEN user_id % 2 = 0 THEN 'ASSAULT' END,CASE WHEN user_id % 2 = 0 THEN 'A' END,CASE WHEN user_id % 2 = 0 THEN 'B' END]) o FROM a)
SELECT s, p, o FROM x WHERE o IS NOT NULL UNION ALL SELECT DISTINCT 'Incident/a-' || user_id, 'type', 'Incident' FROM events UNION ALL SELECT 'Incident/a-' || user_id, 'IncidentArrest', 'Arrest/a-' || event_id FROM events
UNION ALL SELECT 'Arrest/a-' || event_id, 'ArrestOfficial', 'PoliceOfficer/a-7_8' FROM events WHERE event_id % 3 = 0 UNION ALL SELECT DISTINCT 'PoliceOfficer/a-7_8', unnest(['type','PersonID']), unnest(['LawEnforcementOfficial','7 8']) FROM events WHERE event_id % 3 = 0""")
def arrest_triples(spark, sf):
    e = read(spark, sf, "events")
    none = F.lit("nan")
    a = e.select(F.col("event_id").alias("idx"), F.col("user_id").cast("string").alias("offense_id"), F.date_format("ts", "MM/dd/yyyy").alias("arrest_date"), F.lit("").alias("poss_date"), none.alias("census_block_group_2020"), F.when(F.col("event_id") % 3 == 0, "7 8").otherwise("").alias("rpt_officer_id"), *(none.alias(n) for n in ("birth_year", "race", "sex", "charge_type", "charge_level")), F.col("event_type").alias("charge"))
    x = e.where("user_id % 2 = 0").select(F.col("user_id").cast("string").alias("offense_id"), F.explode(F.array(F.struct(F.lit(1).alias("ord"), F.lit("13A").alias("nibrs_offense"), F.lit("ASSAULT").alias("crime_category"), F.lit("A OR B").alias("aorb")), F.struct(F.lit(2).alias("ord"), F.lit("no").alias("nibrs_offense"), F.lit("no").alias("crime_category"), F.lit("C").alias("aorb")))).alias("x")).select("offense_id", "x.*")
    return graph.arrest_graph(a, x, "a").select("s", "p", "o")


@query("""WITH n AS (SELECT n_nationkey g, 30.0::DOUBLE + n_nationkey % 10 la, -80.0::DOUBLE - n_nationkey lo FROM nation), q AS (SELECT DISTINCT least(a.g, b.g) g, greatest(a.g, b.g) h FROM n a, n b WHERE a.g < 3 AND b.g >= 2 AND b.g < 6) SELECT g, h, 'RelativeLocation/' || g || '_' || h rel FROM q""")
def distance_triples(spark, sf):
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("grp"), (F.lit(30.0) + F.col("n_nationkey") % 10).alias("lat"), (F.lit(-80.0) - F.col("n_nationkey")).alias("lon"))
    g = graph.distance_graph(n.where("grp < 3"), n.where("grp >= 2 and grp < 6"), n)
    rel = g.where("p = 'RelativeLocationDistanceMeasure'").select(F.split(F.split_part("s", F.lit("/"), F.lit(2)), "_").alias("x"), F.col("s").alias("rel")).select(F.get("x", F.lit(0)).try_cast("int").alias("g"), F.get("x", F.lit(1)).try_cast("int").alias("h"), "rel")
    return rel.where("g <= h").distinct()


@query(f"""WITH {CASES}, s AS (SELECT *, 'Sentence/' || ucid || '_de1_s' m, 'Charge/' || ucid || '_p2_c3_from_annotation' c FROM cases WHERE k % 10 = 0)
SELECT unnest([m||'0',m||'0',m||'0',m||'1',m||'1',m||'1']) s, unnest(['type','SentenceDescriptionText','SentenceTerm','type','SentenceDescriptionText','SentenceTerm']) p, unnest(['Sentence','prison','Term/12','Sentence','probation','Term/6.5']) o FROM s
UNION ALL SELECT unnest(['DocketEntry/'||ucid||'_de1','DocketEntry/'||ucid||'_de1','Party/'||ucid||'_p2','Party/'||ucid||'_p2',c,c,c,c]), unnest(['Sentence','Sentence','Sentence','Sentence','type','ChargeSequenceID','ChargeSentence','ChargeSentence']), unnest([m||'0',m||'1',m||'0',m||'1','Charge','3',m||'0',m||'1']) FROM s
UNION ALL SELECT s, p, o FROM (VALUES ('Term/12','type','SentenceTerm'),('Term/12','TermDuration','P12M'),('Term/6.5','type','SentenceTerm'),('Term/6.5','TermDuration','P6M15D')) v(s, p, o)""")
def sentence_triples(spark, sf):
    s = raw_cases(spark, sf).where(key() % 10 == 0).select("ucid", F.lit(1).alias("scales_ind"), F.lit("3.0").alias("count_number"), F.lit(2.0).alias("defendant_ind"), F.array(F.lit("prison"), F.lit("probation")).alias("types"), F.array(F.lit(12.0), F.lit(6.5)).alias("months"))
    return graph.sentence_graph(s).select("s", "p", "o")


@query("""WITH p AS (SELECT *, 'Charge/f-' || p_partkey me, 'Case/f-N' || p_partkey c, 'Booking/j-' || p_partkey b, 'Party/f-' || p_partkey w, 'DocketTable/f-N' || p_partkey t, 'DocketEntry/f-N' || p_partkey || '_de0' e FROM part)
SELECT unnest([me,me,me,me,me,c,c,c,c,c,b,b,b,w,w,w,t,t,e,e,e]) s, unnest(['type','ChargeText','ChargeFiledCase','BondAmount','Booking','type','type','CaseDocketID','CaseGeneralCategoryText','RegisterOfActions','type','BookingFacility','StartDate','type','PersonCharge','PersonSexCode','type','RegisterAction','type','RegisterActionDate','RegisterActionDescriptionText']) p, unnest(['Charge',p_name,c,CAST(CAST(p_size AS DOUBLE) AS VARCHAR),b,'CourtCase','CriminalCase','N'||p_partkey,'criminal',t,'Booking','Facility/j','2020-01-02','BookingSubject',me,'M','RegisterOfActions',e,'RegisterAction','2020-02-03','Plea : done (final)']) o FROM p
UNION ALL SELECT me, unnest(['OffenseUCRCode','NIBRSReportCategoryCode','NIBRSReportCategoryCode','DrugCategoryCode']), unnest(['DRUGS','A','B','Z']) FROM p WHERE p_size % 3 = 0""")
def booking_triples(spark, sf):
    p = read(spark, sf, "part")
    booking = F.struct(F.col("p_partkey").alias("jailing_id"), F.lit("M").alias("gender"), F.lit(None).cast("string").alias("race"), F.lit("01/02/2020").alias("booking_date"), F.lit(None).cast("string").alias("release_date"))
    hearing = F.array(F.struct(F.lit("2020-02-03").alias("hearing_date"), F.lit("Plea").alias("hearing_type"), F.lit("done").alias("result"), F.lit("final").alias("result_type")))
    c = p.select(F.col("p_partkey").alias("charge_id"), F.col("p_name").alias("description"), F.lit(None).cast("string").alias("severity"), _text("N", F.col("p_partkey")).alias("case_nbr"), hearing.alias("hearings"), F.lit(None).cast("string").alias("bond_type"), F.col("p_size").cast("string").alias("bond_amount"), booking.alias("booking"))
    codes = p.select(graph.uri("Charge", "f-", F.col("p_partkey")).alias("s"), (F.col("p_size") % 3).cast("string").alias("abbreviation"))
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    off = graph.offence_graph(codes, make([("0", "drug", "full"), ("1", "none", "x"), ("2", "odd", "x")], "abbreviation string, offense string, fulltext string"), make([("drug", "DRUGS", "A OR B"), ("none", "NOT A CRIME", "A")], "offense string, category string, aorb string"), make([("full", "Z")], "fulltext string, code string"))
    return graph.booking_graph(c, "f", "j").unionByName(off).select("s", "p", "o")
