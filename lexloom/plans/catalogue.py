"""Queries of the docket operators over the supplied tables, each with equivalent SQL.

The tables hold no court data, so they are read under other names: orders with their customers are cases, conversation turns
and line items are docket entries, events are dated actions of a case, pages are saved pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids as I
from ..functions import text as T
from ..operators import fetch, graph, index, judges, linkage, parties, search, stats
from ..sources import html as H
from ..streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def raw_cases(spark: SparkSession, sf: str) -> DataFrame:
    o, c = read(spark, sf, "orders"), read(spark, sf, "customer")
    x = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    kind = F.when(F.col("o_orderstatus") == "F", "cr").when(F.col("o_orderstatus") == "O", "cv").otherwise("mc")
    x = x.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cust"), F.concat(F.lit("c"), F.char(F.lit(97) + F.col("c_nationkey")), F.lit("d")).alias("court"), (F.col("o_orderkey") % 9 + 1).cast("string").alias("office"), F.date_format("o_orderdate", "yy").alias("yy"), kind.alias("case_type"), I.pad_number(F.col("o_orderkey").cast("string")).alias("number"), F.col("o_orderdate").cast("date").alias("filed"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("c_nationkey").alias("nation"))
    return x.withColumn("case_id", F.concat(F.col("office"), F.lit(":"), F.col("yy"), F.lit("-"), F.col("case_type"), F.lit("-"), F.col("number"))).withColumn("ucid", I.ucid(F.col("court"), F.col("case_id"), clean=False)).withColumn("year", F.year("filed"))


CASES = """cases AS (SELECT *, court || ';;' || case_id ucid, CAST(year(filed) AS INT) "year" FROM (SELECT *, office || ':' || yy || '-' || case_type || '-' || number case_id FROM (
 SELECT o_orderkey k, o_custkey cust, 'c' || chr(97 + c_nationkey) || 'd' court, CAST(o_orderkey % 9 + 1 AS VARCHAR) office, strftime(o_orderdate, '%y') yy,
  CASE o_orderstatus WHEN 'F' THEN 'cr' WHEN 'O' THEN 'cv' ELSE 'mc' END case_type, CASE WHEN o_orderkey < 10000 THEN lpad(CAST(o_orderkey AS VARCHAR), 5, '0') ELSE CAST(o_orderkey AS VARCHAR) END number,
  CAST(o_orderdate AS DATE) filed, o_orderstatus status, o_totalprice price, c_nationkey nation FROM orders JOIN customer ON o_custkey = c_custkey)))"""


# --- search -------------------------------------------------------------------------------------------------------------

_NET, _PATS = ["order", "the [a-z]{5,8}ing", "le "], {"the_word": "the [a-z]+", "question": r"\?"}


def _at(text: str, pattern: str) -> tuple[str, str]:
    found = f"regexp_extract({text}, '(?i){pattern}')"
    hit = f"regexp_matches({text}, '(?i){pattern}')"
    start = f"length(regexp_extract({text}, '(?is)^(.*?){pattern}', 1))"
    return f"CASE WHEN {hit} THEN CAST({start} AS INT) END", f"CASE WHEN {hit} THEN CAST({start} + length({found}) AS INT) END"


@query(f"""SELECT conv_id, turn, role, substr(text, 1, 100) excerpt, {_at('substr(text, 1, 400)', 'the [a-z]+')[0]} a_start, {_at('substr(text, 1, 400)', 'the [a-z]+')[1]} a_end,
 {_at('substr(text, 1, 400)', '[?]')[0]} q_start FROM conversations WHERE regexp_matches(text, '(?i)(?:order)|(?:the [a-z]{{5,8}}ing)|(?:le )')""")
def docket_search(spark, sf):
    out = search.search_docket(read(spark, sf, "conversations"), {"a": "the [a-z]+", "q": "[?]"}, _NET, meta=["conv_id", "turn", "role"], limit=400)
    return out.select("conv_id", "turn", "role", "excerpt", F.col("a.start").alias("a_start"), F.col("a.end").alias("a_end"), F.col("q.start").alias("q_start"))


@query(f"SELECT doc_id, {_at('text', '(?:19|20)[0-9]{2}')[0]} year_start, {_at('text', '[a-z0-9.]+@[a-z0-9.]+')[0]} mail_start, {_at('text', '[a-z0-9.]+@[a-z0-9.]+')[1]} mail_end FROM documents")
def pattern_spans(spark, sf):
    t = F.col("text")
    return read(spark, sf, "documents").select("doc_id", T.span(t, "(?:19|20)[0-9]{2}")["start"].alias("year_start"), T.span(t, "[a-z0-9.]+@[a-z0-9.]+")["start"].alias("mail_start"), T.span(t, "[a-z0-9.]+@[a-z0-9.]+")["end"].alias("mail_end"))


@query("SELECT conv_id, turn FROM conversations WHERE (contains(lower(text), 'the ') OR contains(lower(text), 'que')) AND NOT contains(lower(text), 'ing ')")
def find_matching_lines(spark, sf):
    return search.matching_lines(read(spark, sf, "conversations"), ["the ", "que"], ["ing "]).select("conv_id", "turn")


@query("SELECT conv_id, bool_or(regexp_matches(substr(text, 1, 300), '(?i)the an')) flagged FROM conversations GROUP BY conv_id")
def case_flagged_any(spark, sf):
    return search.cases_flagged(read(spark, sf, "conversations"), "the an", "conv_id", limit=300)


@query(f"""SELECT conv_id, turn, role, substr(text, 1, 100) excerpt, {_at('text', 'the [a-z]+')[0]} a_start, {_at('text', 'the [a-z]+')[1]} a_end,
 {_at('text', '[?]')[0]} q_start FROM conversations WHERE regexp_matches(text, '(?i)(?:order)|(?:the [a-z]{{5,8}}ing)|(?:le )')""")
def docket_search_whole(spark, sf):
    out = search.search_docket(read(spark, sf, "conversations"), {"a": "the [a-z]+", "q": "[?]"}, _NET, meta=["conv_id", "turn", "role"])
    return out.select("conv_id", "turn", "role", "excerpt", F.col("a.start").alias("a_start"), F.col("a.end").alias("a_end"), F.col("q.start").alias("q_start"))


@query("SELECT conv_id, bool_or(coalesce(regexp_matches(text, '(?i)the an'), false)) flagged FROM conversations GROUP BY conv_id")
def case_flagged_any_whole(spark, sf):
    return search.cases_flagged(read(spark, sf, "conversations"), "the an", "conv_id")


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '\\([a-z, ]{3,20}\\)')")
def court_motions(spark, sf):
    return search.court_motions(read(spark, sf, "documents")).select("doc_id")


@query("""SELECT user_id, event_id, CAST(date_diff('day', CAST(lag(ts) OVER w AS DATE), CAST(ts AS DATE)) AS INT) gap_days FROM events
 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id) QUALIFY gap_days IS NOT NULL""")
def inter_event(spark, sf):
    return search.inter_event_days(read(spark, sf, "events"), "user_id", F.col("ts").cast("date"), ["ts", "event_id"]).select("user_id", "event_id", "gap_days")


@query("SELECT l_orderkey, strftime(max(l_shipdate), '%m/%d/%Y') latest_date FROM lineitem GROUP BY 1")
def latest_entry_date(spark, sf):
    return search.latest_date(read(spark, sf, "lineitem"), "l_orderkey", F.col("l_shipdate"))


@query("""WITH b AS (SELECT l_orderkey, min(l_shipdate) b_min, max(l_shipdate) b_max, min(l_linenumber % 5) FILTER (l_linenumber % 5 <> 0) b_low, max(l_linenumber % 5) FILTER (l_linenumber % 5 <> 0) b_high FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1),
x AS (SELECT l_orderkey, l_shipdate d, nullif(l_linenumber % 5, 0) n FROM lineitem WHERE l_linenumber % 2 = 1),
e AS (SELECT x.l_orderkey, count(*) FILTER (d <= b_min) / nullif(count(b_min), 0) early, count(*) FILTER (d >= b_max) / nullif(count(b_max), 0) late, count(*) FILTER (n <= b_low) / nullif(count(n + b_low), 0) low, count(*) FILTER (n >= b_high) / nullif(count(n + b_high), 0) high FROM x LEFT JOIN b ON b.l_orderkey = x.l_orderkey GROUP BY 1)
SELECT l_orderkey, CASE WHEN early > late AND early >= 0.8 THEN 'before' WHEN late > early AND late >= 0.8 THEN 'after' WHEN low > high THEN 'before' WHEN low <= high THEN 'after' ELSE 'before' END place FROM e""")
def insert_extra_entries(spark, sf):
    li = read(spark, sf, "lineitem").withColumn("ind", F.col("l_linenumber") % 5)
    return search.insert_extra(li.where("l_linenumber % 2 = 0"), li.where("l_linenumber % 2 = 1"), "l_orderkey", "l_shipdate", "ind")


# --- identifiers --------------------------------------------------------------------------------------------------------


@query(f"WITH {CASES} SELECT k, ucid FROM cases")
def ucid_build(spark, sf):
    c = raw_cases(spark, sf)
    return c.select("k", I.ucid(F.col("court"), F.upper("case_id")).alias("ucid"))


@query(f"WITH {CASES} SELECT k, court, case_id case_no FROM cases")
def ucid_parse(spark, sf):
    return raw_cases(spark, sf).select("k", I.parse_ucid(F.col("ucid")).alias("p")).select("k", "p.court", "p.case_no")


@query(f"WITH {CASES} SELECT k, court || ';;' || yy || '-' || case_type || '-' || number weak FROM cases")
def ucid_weak(spark, sf):
    return raw_cases(spark, sf).select("k", I.weak_ucid(F.col("ucid")).alias("weak"))


@query(f"WITH {CASES} SELECT k, office, yy \"year\", case_type, number case_no, CASE WHEN k % 3 = 0 THEN 'ABC,DE' END judges, CASE WHEN k % 2 = 0 THEN CAST(k % 7 + 1 AS VARCHAR) END def_no FROM cases")
def case_id_decompose(spark, sf):
    dirty = F.concat(F.replace("case_id", F.lit(":"), F.lit("-")), F.when(F.col("k") % 3 == 0, "-ABC--DE").otherwise(""), F.when(F.col("k") % 2 == 0, F.concat(F.lit("-"), (F.col("k") % 7 + 1).cast("string"))).otherwise(""))
    d = raw_cases(spark, sf).select("k", I.decompose(dirty).alias("d"))
    return d.select("k", "d.office", "d.year", "d.case_type", "d.case_no", F.array_join("d.judge_names", ",").alias("judges"), "d.def_no")


@query(f"WITH {CASES} SELECT k, case_id FROM cases")
def case_id_clean(spark, sf):
    form = F.when(F.col("k") % 4 == 0, F.concat(F.lit("No. "), F.upper("case_id"))).when(F.col("k") % 4 == 1, F.replace("case_id", F.lit(":"), F.lit("-"))).when(F.col("k") % 4 == 2, F.concat("case_id", F.lit("-ABC"))).otherwise(F.concat("case_id", F.lit("-2")))
    return raw_cases(spark, sf).select("k", I.clean_case_id(form).alias("case_id"))


@query(f"WITH {CASES} SELECT k, office || '-' || yy || '-' || case_type || '-' || number || '_' || (k % 3) || '.html' file, 'root/' || court || '/json/' || yy || '/' || office || '-' || yy || '-' || case_type || '-' || number || '.json' path FROM cases")
def case_paths(spark, sf):
    return raw_cases(spark, sf).select("k", I.case_file(F.col("case_id"), version=F.col("k") % 3).alias("file"), I.expected_path(F.col("ucid"), "root").alias("path"))


_DOCS = f"WITH {CASES}, d AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), x AS (SELECT k, l_linenumber n, replace(ucid, ':', '-') || '_' || l_linenumber || CASE WHEN l_linenumber % 2 = 0 THEN '_' || (k % 5 + 1) ELSE '' END doc_id, ucid FROM cases JOIN d ON l_orderkey = k)"


def _documents(spark, sf):
    d = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    x = raw_cases(spark, sf).join(d, F.col("k") == F.col("l_orderkey"))
    return x.select("k", F.col("l_linenumber").alias("n"), "ucid", I.document_id(F.col("ucid"), F.col("l_linenumber"), F.when(F.col("l_linenumber") % 2 == 0, F.col("k") % 5 + 1)).alias("doc_id"))


@query(_DOCS + " SELECT k, n, doc_id, doc_id || '_u' || substr(md5('user' || k % 10), 1, 8) || '_t210106.pdf' file FROM x")
def document_id(spark, sf):
    return _documents(spark, sf).select("k", "n", "doc_id", I.document_file(F.col("doc_id"), F.concat(F.lit("user"), (F.col("k") % 10).cast("string")), F.lit("2021-01-06").cast("date")).alias("file"))


@query(_DOCS + " SELECT k, n, ucid, n doc_index, CASE WHEN n % 2 = 0 THEN CAST(k % 5 + 1 AS INT) END attachment, '2021-01-06' downloaded FROM x")
def document_fname_parse(spark, sf):
    f = _documents(spark, sf).select("k", "n", I.parse_document_file(F.concat("doc_id", F.lit("_u12345678_t210106.pdf"))).alias("p"))
    return f.select("k", "n", "p.ucid", "p.doc_index", "p.attachment", F.col("p.downloaded").cast("string").alias("downloaded"))


@query("SELECT page_id, CASE page_id % 10 WHEN 9 THEN NULL ELSE CASE WHEN page_id % 7 = 0 THEN 'https://dcecf.psc.uscourts.gov/' ELSE 'https://ecf.c' || chr(97 + CAST(page_id % 26 AS INT)) || 'd.uscourts.gov/' END || list_extract(['cgi-bin/iquery.pl', 'doc1', 'cgi-bin/login.pl', 'cgi-bin/login.pl?logout', 'cgi-bin/DktRpt.pl', 'cgi-bin/possible_case_numbers.pl', 'cgi-bin/qrySummary.pl', 'cgi-bin/AsccaseDisplay.pl', 'cgi-bin/HistDocQry.pl'], CAST(page_id % 10 + 1 AS INT)) END url FROM pages")
def site_urls(spark, sf):
    names = F.array(*(F.lit(n) for n in ("query", "doc_link", "login", "logout", "docket", "possible_case", "summary", "members", "history", "none")))
    court = F.when(F.col("page_id") % 7 == 0, "psc").otherwise(F.concat(F.lit("c"), F.char(F.lit(97) + F.col("page_id") % 26), F.lit("d")))
    return read(spark, sf, "pages").select("page_id", I.site_url(court, F.get(names, (F.col("page_id") % 10).cast("int"))).alias("url"))


# --- text ---------------------------------------------------------------------------------------------------------------


@query("SELECT page_id, nullif(trim(regexp_replace(regexp_replace(html, '(?s)\\*\\*\\*.*?\\*\\*\\*', '', 'g'), '<[^<]+?>', '', 'g'), '<>?! '), '') plain, length(regexp_replace(html, '(?s)<.+?>', '', 'g')) n FROM pages")
def detag_text(spark, sf):
    return read(spark, sf, "pages").select("page_id", T.detag(F.col("html")).alias("plain"), F.length(T.scrub_tags(F.col("html"))).cast("long").alias("n"))


@query("SELECT page_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&amp;', '&'), '&nbsp;', ' '), '^\\)+', ''), '\\(+$', ''), ' +', ' ', 'g')), '') title FROM pages")
def clean_text(spark, sf):
    return read(spark, sf, "pages").select("page_id", T.clean_line(F.regexp_extract("html", "<h1>(.*?)</h1>", 1)).alias("title"))


def _by_law(pattern: str) -> str:
    """SQL: in x, a found text but its first and last character becomes blanks, between the parts that the pattern splits off."""
    found = "left(z[2], 1) || repeat(' ', length(z[2]) - 2) || right(z[2], 1)"
    return f"CASE WHEN x IS NOT NULL THEN array_to_string(list_transform(list_zip(string_split_regex(x, '{pattern}'), regexp_extract_all(x, '{pattern}')), lambda z: z[1] || coalesce({found}, '')), '') END"


@query(f"""WITH a AS (SELECT doc_id, text || ' x 123-45-6789 y A12345678 z ssn 1234-56 ' x FROM documents),
b AS (SELECT doc_id, {_by_law("(?i)[^0-9](?:ssn?:?)? *#?[0-9]{3}-[0-9]{2}-[0-9]{4}[^0-9]")} x FROM a)
SELECT doc_id, {_by_law("(?i)[^0-9a-z]a[0-9]{8,9}[^0-9]")} scrubbed FROM b""")
def scrub_sensitive(spark, sf):
    t = F.concat("text", F.lit(" x 123-45-6789 y A12345678 z ssn 1234-56 "))
    return read(spark, sf, "documents").select("doc_id", T.scrub_sensitive(t).alias("scrubbed"))


def _blanked(text: str) -> str:
    """SQL: a blank for each character of a number, one replacement for each form, as DuckDB cannot repeat by a match's length."""
    forms = [(f"[sS][sS][nN]:{' ' * n}{h}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}", "[^0-9]", 4 + n + len(h) + 11) for n in (0, 1) for h in ("#", "")]
    forms += [(f"{' ' * n}{h}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}", "[^0-9]", n + len(h) + 11) for n in (1, 0) for h in ("#", "")]
    for pattern, edge, n in [*forms, *((f"[aA][0-9]{{{k}}}", "[^0-9]", k + 1) for k in (8, 9))]:
        before = "[^0-9A-Za-z]" if pattern.startswith("[aA]") else edge
        text = f"regexp_replace({text}, '({before}){pattern}({edge})', '\\1{' ' * n}\\2', 'g')"
    return text


@query(f"SELECT doc_id, {_blanked("'q 987-65-4321 ' || text || ' x 123-45-6789 y A12345678x z ssn 1234-56 w SSN: #123-45-6789.'")} scrubbed FROM documents")
def scrub_sensitive_whole(spark, sf):
    t = F.concat(F.lit("q 987-65-4321 "), "text", F.lit(" x 123-45-6789 y A12345678x z ssn 1234-56 w SSN: #123-45-6789."))
    return read(spark, sf, "documents").select("doc_id", T.scrub_sensitive(t).alias("scrubbed"))


@query("SELECT o_orderkey, 'u' || o_custkey \"user\", CAST(o_orderkey % 30 + 1 AS INT) billable_pages, CAST((o_orderkey % 30 + 1) / 10.0 AS DOUBLE) cost FROM orders")
def receipt_fields(spark, sf):
    r = F.concat(F.lit("<b>Site</b> Login: u"), F.col("o_custkey"), F.lit(" Client Code: <i>x</i> Description: Docket Report Search Criteria: "), F.col("o_orderkey"), F.lit(" Billable Pages: "), F.col("o_orderkey") % 30 + 1, F.lit(" Cost: "), F.format_string("%.2f", (F.col("o_orderkey") % 30 + 1) / F.lit(10.0)))
    return read(spark, sf, "orders").select("o_orderkey", T.receipt(r).alias("r")).select("o_orderkey", "r.user", "r.billable_pages", F.col("r.cost").cast("double").alias("cost"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') filed, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') END closed FROM orders WHERE year(o_orderdate) >= 2000")
def query_dates(spark, sf):
    o = read(spark, sf, "orders").where("year(o_orderdate) >= 2000")
    s = F.concat(F.lit("filed "), F.date_format("o_orderdate", "MM/dd/yy"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" closed "), F.date_format(F.date_add("o_orderdate", 30), "MM/dd/yy"))).otherwise(""))
    return o.select("o_orderkey", T.query_filed(s).alias("filed"), T.query_closed(s).alias("closed"))


@query("SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(max(l_shipdate) AS DATE)) AS INT) n_days FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate")
def date_gap(spark, sf):
    last = search.latest_date(read(spark, sf, "lineitem"), "l_orderkey", F.col("l_shipdate"))
    return read(spark, sf, "orders").join(last, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", T.days_between(F.col("latest_date"), F.date_format("o_orderdate", "M/d/yyyy")).alias("n_days"))


@query("""SELECT o_orderkey, CAST(CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(date_trunc('month', o_orderdate) AS DATE) WHEN 2 THEN CAST(o_orderdate AS DATE) WHEN 3 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS VARCHAR) iso FROM orders""")
def date_normalise(spark, sf):
    k = F.col("o_orderkey") % 5
    s = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM")).when(k == 2, F.date_format("o_orderdate", "MM/dd/yyyy")).when(k == 3, F.date_format("o_orderdate", "MM/yyyy")).otherwise("abc")
    return read(spark, sf, "orders").select("o_orderkey", T.iso_date(s).cast("string").alias("iso"))


# --- index --------------------------------------------------------------------------------------------------------------


@query(f"WITH {CASES}, e AS (SELECT l_orderkey, max(l_shipdate) ends, count(*) n FROM lineitem GROUP BY 1) SELECT ucid, court, \"year\", case_type, CAST(filed AS VARCHAR) filed, CASE WHEN status = 'F' THEN CAST(CAST(ends AS DATE) AS VARCHAR) END terminated, CASE WHEN status = 'F' THEN 'closed' ELSE 'open' END case_status, coalesce(n, 0) n_entries FROM cases LEFT JOIN e ON l_orderkey = k")
def case_index(spark, sf):
    e = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_shipdate").alias("ends"), F.count("*").alias("n"))
    done = F.col("status") == "F"
    return raw_cases(spark, sf).join(e, "k", "left").select("ucid", "court", "year", "case_type", F.col("filed").cast("string").alias("filed"), F.when(done, F.col("ends").cast("date").cast("string")).alias("terminated"), F.when(done, "closed").otherwise("open").alias("case_status"), F.coalesce("n", F.lit(0)).alias("n_entries"))


@query(f"WITH {CASES} SELECT \"year\", court, case_type, count(*) case_count FROM cases WHERE price > 1000 GROUP BY ALL")
def case_counts(spark, sf):
    return index.case_counts(raw_cases(spark, sf), ["case_type"], "price > 1000")


@query(f"WITH {CASES} SELECT k, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS version, CASE WHEN k % 3 = 0 THEN round(price * 2, 2) ELSE round(price, 2) END price FROM cases")
def index_upsert_keep_last(spark, sf):
    old = raw_cases(spark, sf).select("k", F.lit(1).alias("version"), F.round("price", 2).alias("price"))
    new = raw_cases(spark, sf).where("k % 3 = 0").select("k", F.lit(2).alias("version"), F.round(F.col("price") * 2, 2).alias("price"))
    return index.upsert(old, new, "k", "version")


@query("SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT 'case_' || l_linenumber || '.html')), '|') paths, min('s' || l_linenumber) summary_path FROM lineitem GROUP BY 1")
def group_dockets(spark, sf):
    f = read(spark, sf, "lineitem").select("l_orderkey", F.concat(F.lit("case_"), "l_linenumber", F.lit(".html")).alias("path"), F.concat(F.lit("s"), "l_linenumber").alias("s")).distinct()
    return index.group_files(f, "l_orderkey", "path", "s").select("l_orderkey", F.array_join("paths", "|").alias("paths"), "summary_path")


@query("SELECT conv_id, role, text, min(turn) turn FROM conversations GROUP BY conv_id, role, text")
def docket_aggregate_dedup(spark, sf):
    c = read(spark, sf, "conversations")
    both = c.withColumn("version", F.lit(0)).union(c.where("turn % 2 = 0").withColumn("version", F.lit(1)))
    return index.merge_versions(both, "conv_id", "version", "turn", ["role", "text"]).select("conv_id", "role", "text", "turn")


@query("SELECT o_custkey lead, array_to_string(list_sort(list(DISTINCT o_orderkey)), ',') members FROM orders GROUP BY 1")
def member_groups(spark, sf):
    o = read(spark, sf, "orders")
    return index.member_groups(o.union(o), "o_custkey", "o_orderkey").select(F.col("o_custkey").alias("lead"), F.array_join("members", ",").alias("members"))


@query("SELECT conv_id, role, CAST(max(turn) AS BIGINT) turn FROM conversations GROUP BY 1, 2")
def label_positions(spark, sf):
    return index.label_positions(read(spark, sf, "conversations"), "conv_id", "role", "turn")


@query("SELECT k, CASE WHEN k % 4 < 3 THEN CAST(k % 90000 + 10 AS INT) END code, k % 4 < 3 is_mdl, k % 4 < 3 OR k % 7 = 0 is_multi FROM (SELECT o_orderkey k FROM orders)")
def mdl_flags(spark, sf):
    k = F.col("o_orderkey")
    n = (k % 90000 + 10).cast("string")
    flag = F.when(k % 4 == 0, F.concat(F.lit("MDL No. "), n)).when(k % 4 == 1, F.concat(F.lit("x mdl-"), n)).when(k % 4 == 2, F.concat(F.lit("MDL_"), n)).otherwise("JURY")
    x = read(spark, sf, "orders").select(k.alias("k"), T.mdl_code(flag).alias("code"), F.when(k % 7 == 0, k).alias("lead"), F.lit(None).cast("string").alias("none"))
    return index.multi_flags(x, F.col("code").isNotNull(), F.col("lead"), F.col("none"), F.col("none")).select("k", "code", "is_mdl", "is_multi")


@query("SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, l_quantity, array_to_string(list_sort(list_distinct([x for x in [l_returnflag, l_linestatus, CASE WHEN l_linenumber > 3 THEN 'X' END] if x IS NOT NULL])), ',') statutes FROM lineitem")
def statute_set(spark, sf):
    li = read(spark, sf, "lineitem").withColumn("x", F.when(F.col("l_linenumber") > 3, "X"))
    return index.statute_set(li, ["l_returnflag", "l_linestatus", "x"]).select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_quantity", F.array_join("statutes", ",").alias("statutes"))


# --- courts, codes, judges ----------------------------------------------------------------------------------------------

_STATES = {"illinois": "IL", "new york": "NY", "texas": "TX", "west virginia": "WV", "virginia": "VA"}


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'ilnd' WHEN 1 THEN 'dcd' WHEN 2 THEN 'wvsd' WHEN 3 THEN 'nysd' WHEN 4 THEN 'txed' END court FROM orders""")
def court_classify(spark, sf):
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, "Northern District of Illinois").when(k == 1, "District of Columbia").when(k == 2, "Southern District of West Virginia").when(k == 3, "NYSD").otherwise("TEXAS EASTERN")
    return read(spark, sf, "orders").select("o_orderkey", linkage.classify_court(raw, _STATES).alias("court"))


@query("""WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN (p_partkey % 40) || ' ' || p_name ELSE split_part(p_type, ' ', 1) || ' ' || p_brand || ' (' || split_part(p_type, ' ', 2) || ')' END q FROM part),
codes AS (SELECT row_number() OVER (ORDER BY p_type) AS code, p_type AS name FROM (SELECT DISTINCT p_type FROM part)),
w AS (SELECT p_partkey, q, TRY_CAST(nullif(regexp_extract(q, '^\\s*([0-9]+)', 1), '') AS INT) num, list_distinct([x for x in string_split_regex(lower(translate(q, '():-', '    ')), '\\s+') if x <> '']) ws FROM t),
h AS (SELECT p_partkey, code, len(ws) k, len([x for x in ws if list_contains(string_split_regex(lower(name), '\\s+'), x)]) n FROM w, codes WHERE num IS NULL),
b AS (SELECT p_partkey, code FROM h WHERE n * 2 > k OR (n * 2 >= k AND k > 2 AND n > 0) QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY n DESC, code) = 1)
SELECT w.p_partkey, CAST(CASE WHEN num IS NULL THEN b.code ELSE c.code END AS INT) code FROM w LEFT JOIN b ON b.p_partkey = w.p_partkey LEFT JOIN codes c ON c.code = num""")
def nos_match(spark, sf):
    p = read(spark, sf, "part")
    q = F.when(F.col("p_partkey") % 5 == 0, F.concat((F.col("p_partkey") % 40).cast("string"), F.lit(" "), "p_name")).otherwise(F.concat(F.split_part("p_type", F.lit(" "), F.lit(1)), F.lit(" "), "p_brand", F.lit(" ("), F.split_part("p_type", F.lit(" "), F.lit(2)), F.lit(")")))
    from pyspark.sql.window import Window

    codes = p.select("p_type").distinct().select(F.row_number().over(Window.orderBy("p_type")).alias("code"), F.col("p_type").alias("name"))  # a dimension of a few hundred rows
    return linkage.match_codes(p.select("p_partkey", q.alias("q")), "q", codes, "code", "name").select("p_partkey", "code")


@query("SELECT c_custkey, lower(replace(c_name, '#', ' no ')) AS name, regexp_extract(lower(c_name), '([^# ]+)$', 1) AS last FROM customer")
def judge_clean_name(spark, sf):
    k = F.col("c_custkey") % 4
    n = F.replace("c_name", F.lit("#"), F.lit(" No "))
    raw = F.when(k == 0, F.concat(F.lit("District Judge "), n)).when(k == 1, F.concat(F.lit("Honorable "), n, F.lit(" (retired)"))).when(k == 2, F.concat(F.lit("Mag. Judge "), n, F.lit(", unassigned"))).otherwise(F.concat(n, F.lit(" Jr.")))
    c = judges.clean_name(raw)
    return read(spark, sf, "customer").select("c_custkey", F.when(k == 3, F.regexp_replace(c, " jr$", "")).otherwise(c).alias("name"), judges.last_name(raw).alias("last"))


@query("""WITH n AS (SELECT DISTINCT 'a' || c_custkey % 50 || ' ' || CASE WHEN c_custkey % 2 = 0 THEN 'm ' ELSE '' END || 'z' || c_custkey % 20 AS name FROM customer),
x AS (SELECT name, CASE WHEN len(string_split(name, ' ')) > 2 THEN split_part(name, ' ', 1) || ' ' || split_part(name, ' ', 3) END short FROM n)
SELECT name, CASE WHEN short IN (SELECT name FROM n) THEN short ELSE name END mapped FROM x""")
def judge_unique_map(spark, sf):
    k = F.col("c_custkey")
    n = F.concat(F.lit("a"), (k % 50).cast("string"), F.lit(" "), F.when(k % 2 == 0, "m ").otherwise(""), F.lit("z"), (k % 20).cast("string"))
    return judges.unique_mapping(read(spark, sf, "customer").select(n.alias("name")))


_TRACK = "CASE WHEN event_type = 'purchase' THEN 'j' || event_id % 5 WHEN event_type = 'login' AND event_id % 3 = 0 THEN 'a;;;b' ELSE '' END"


@query(f"""WITH e AS (SELECT *, {_TRACK} judge FROM events), o AS (SELECT *, CASE WHEN NOT contains(judge, ';;;') AND judge <> '' THEN judge END x FROM e)
SELECT event_id, CASE WHEN contains(judge, ';;;') THEN judge ELSE coalesce(last_value(x IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 first_value(x IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), '') END judge_filled FROM o""")
def judge_backfill(spark, sf):
    e = read(spark, sf, "events").withColumn("judge", F.expr("CASE WHEN event_type = 'purchase' THEN concat('j', event_id % 5) WHEN event_type = 'login' AND event_id % 3 = 0 THEN 'a;;;b' ELSE '' END"))
    return judges.backfill(e, "user_id", ["ts", "event_id"], "judge").select("event_id", "judge_filled")


@query("""WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN 'j' || event_id % 5 END judge, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS INT) AS block FROM events),
t AS (SELECT user_id, block, judge FROM (SELECT user_id, block, judge, count(*) c FROM e WHERE judge IS NOT NULL GROUP BY 1, 2, 3) QUALIFY row_number() OVER (PARTITION BY user_id, block ORDER BY c DESC, judge) = 1)
SELECT event_id, e.block, t.judge block_judge FROM e LEFT JOIN t ON t.user_id = e.user_id AND t.block = e.block""")
def judge_blocks(spark, sf):
    e = read(spark, sf, "events").withColumn("judge", F.expr("CASE WHEN event_id % 2 = 0 THEN concat('j', event_id % 5) END"))
    return judges.blocks(e, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", "judge").select("event_id", "block", "block_judge")


@query(f"""WITH {CASES}, j AS (SELECT s_suppkey nid, 'c' || chr(97 + s_nationkey) || 'd' court, DATE '1996-01-01' + CAST(s_suppkey % 1000 AS INT) since FROM supplier
 UNION ALL SELECT s_suppkey, 'c' || chr(97 + (s_nationkey + 1) % 25) || 'd', DATE '1999-01-01' FROM supplier WHERE s_suppkey % 3 <> 0)
SELECT DISTINCT k, nid FROM cases JOIN j ON j.court = cases.court WHERE since < filed""")
def judge_appointment_asof(spark, sf):
    s = read(spark, sf, "supplier")
    court = lambda n: F.concat(F.lit("c"), F.char(F.lit(97) + n), F.lit("d"))
    j = s.select(F.col("s_suppkey").alias("nid"), court(F.col("s_nationkey")).alias("court_1"), F.date_add(F.lit("1996-01-01").cast("date"), (F.col("s_suppkey") % 1000).cast("int")).alias("date_1"), F.when(F.col("s_suppkey") % 3 != 0, court((F.col("s_nationkey") + 1) % 25)).alias("court_2"), F.lit("1999-01-01").cast("date").alias("date_2"), F.lit(None).cast("string").alias("court_3"), F.lit(None).cast("date").alias("date_3"))
    return judges.appointed(j, 3, raw_cases(spark, sf).select("k", "court", "filed"), "court", "filed", "k")


# --- statistics and linkage ---------------------------------------------------------------------------------------------


@query("""WITH o AS (SELECT user_id % 10 court, user_id % 40 judge, CAST(event_type = 'purchase' AS DOUBLE) r FROM events),
j AS (SELECT court, judge, CAST(count(*) AS DOUBLE) n, sum(r) s, sum(r * r) q FROM o GROUP BY ALL), c AS (SELECT court, sum(n) cn, sum(s) cs, sum(q) cq FROM j GROUP BY 1),
x AS (SELECT court, judge, n, cn - n m, s / n a, (cs - s) / (cn - n) b, q, cq FROM j JOIN c USING (court) WHERE cn > n),
v AS (SELECT *, greatest(q / n - a * a, 0) / n va, greatest((cq - q) / m - b * b, 0) / m vb FROM x)
SELECT court, judge, round(a - b, 6) diff, round(sqrt(va + vb), 6) se, round((va + vb) * (va + vb) / (va * va / (n - 1) + vb * vb / (m - 1)), 4) df FROM v WHERE va + vb > 0 AND n > 1 AND m > 1""")
def court_variation(spark, sf):
    o = read(spark, sf, "events").select((F.col("user_id") % 10).alias("court"), (F.col("user_id") % 40).alias("judge"), (F.col("event_type") == "purchase").cast("int").alias("resolution"))
    return stats.welch(o).select("court", "judge", F.round("diff", 6).alias("diff"), F.round("se", 6).alias("se"), F.round("df", 4).alias("df"))


@query()
def court_variation_bounds(spark, sf):
    o = read(spark, sf, "events").select((F.col("user_id") % 10).alias("court"), (F.col("user_id") % 40).alias("judge"), (F.col("event_type") == "purchase").cast("int").alias("resolution"))
    return stats.court_variation(o)


@query(f"""WITH {CASES}, s0 AS (SELECT CASE WHEN k % 3 = 0 THEN court || ';;9:' || yy || '-' || case_type || '-' || number ELSE ucid END ucid, court || ';;' || yy || '-' || case_type || '-' || number weak, filed, k % 100 disp FROM cases WHERE k % 5 <> 0),
s AS (SELECT * FROM s0 QUALIFY row_number() OVER (PARTITION BY ucid ORDER BY filed, disp) = 1), c AS (SELECT ucid, court || ';;' || yy || '-' || case_type || '-' || number weak, filed FROM cases),
one AS (SELECT c.ucid, disp, 1 stage FROM c JOIN s ON s.ucid = c.ucid)
SELECT * FROM one UNION ALL SELECT c.ucid, disp, 2 FROM c JOIN s ON s.weak = c.weak AND s.filed = c.filed WHERE c.ucid NOT IN (SELECT ucid FROM s) AND s.ucid NOT IN (SELECT ucid FROM c)""")
def stats_merge(spark, sf):
    c = raw_cases(spark, sf).withColumn("ucid_weak", I.weak_ucid(F.col("ucid")))
    wrong = F.concat("court", F.lit(";;9:"), "yy", F.lit("-"), "case_type", F.lit("-"), "number")
    s = c.where("k % 5 <> 0").select(F.when(F.col("k") % 3 == 0, wrong).otherwise(F.col("ucid")).alias("ucid"), "ucid_weak", F.col("filed").alias("filedate"), (F.col("k") % 100).alias("disp"))
    return linkage.two_stage(c.select("ucid", "ucid_weak", F.col("filed").alias("filing_date")), s).select("ucid", "disp", "stage")


@query("SELECT o_orderkey mdl_no, o_orderpriority caption, 'terminated' AS status FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_orderpriority, 'pending' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'F'")
def mdl_union(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("mdl_no"), F.col("o_orderpriority").alias("caption"), "o_orderstatus")
    return linkage.mdl_all(o.where("o_orderstatus = 'F'").drop("o_orderstatus"), o.where("mdl_no % 2 = 0").drop("o_orderstatus"))


@query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) e FROM embeddings) SELECT a.vec_id AS "left", b.vec_id AS "right", round(list_cosine_similarity(a.e, b.e), 6) similarity FROM v a, v b
WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) > 0.2 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.e, b.e) DESC, b.vec_id) <= 3""")
def ngram_cosine_topk(spark, sf):
    v = read(spark, sf, "embeddings")
    return linkage.cosine_top(v, v.where("vec_id % 20 = 0"), 3, "vec_id", "embedding", 0.2).withColumn("similarity", F.round("similarity", 6))


@query("SELECT doc_id, len(t) n, array_to_string(t[1:5], '|') first_grams FROM (SELECT doc_id, [substr(x, i, 3) for i in range(1, greatest(length(x) - 1, 1))] t FROM (SELECT doc_id, regexp_replace(text, '[,\\-./]|\\sBD', '', 'g') x FROM documents))")
def char_ngrams(spark, sf):
    g = T.char_ngrams(F.col("text"))
    return read(spark, sf, "documents").select("doc_id", F.size(g).cast("long").alias("n"), F.array_join(F.slice(g, 1, 5), "|").alias("first_grams"))


@query("SELECT c_custkey, c_custkey % 3 = 0 OR c_custkey % 5 = 0 is_pro_se FROM customer")
def pro_se(spark, sf):
    k = F.col("c_custkey")
    p = read(spark, sf, "customer").select("c_custkey", F.lit("Ann Lee").alias("party"), F.when(k % 3 == 0, "ANN LEE").otherwise("Bob Ray").alias("counsel"), F.when(k % 5 == 0, "12 Main St PRO SE").alias("info"))
    return linkage.pro_se(p, "party", "counsel", "info").select("c_custkey", "is_pro_se")


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'other' WHEN 1 THEN 'government' WHEN 2 THEN 'individual' WHEN 3 THEN 'multi-entity' WHEN 4 THEN 'individual' ELSE 'other' END party_class FROM customer""")
def party_class(spark, sf):
    k = F.col("c_custkey") % 6
    n = F.when(k == 0, "Acme Widgets, Inc.").when(k == 1, "City of Springfield").when(k == 2, "John Doe").when(k == 3, "United States ex rel Smith").when(k == 4, "Ada Byron").otherwise("")
    return read(spark, sf, "customer").select("c_custkey", parties.classify(n).alias("party_class"))


@query("SELECT conv_id, turn, substr(text, 1, 10) || ' [P] met [Q], then [P].' redacted FROM conversations")
def redact_spans(spark, sf):
    e = read(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.substring("text", 1, 10), F.lit(" Ada Byron met Bob Ray, then Ada Byron.")).alias("text"))
    names = e.select("conv_id").distinct().withColumn("n", F.explode(F.array(F.struct(F.lit("Ada Byron").alias("name"), F.lit("[P]").alias("label")), F.struct(F.lit("Bob Ray").alias("name"), F.lit("[Q]").alias("label"))))).select("conv_id", "n.*")
    spans = parties.name_spans(e, names, ["conv_id"]).groupBy("conv_id", "turn", "text").agg(F.collect_list(F.struct("start", "end", "label")).alias("spans"))
    return spans.select("conv_id", "turn", parties.redact(F.col("text"), F.col("spans")).alias("redacted"))


@query("""SELECT conv_id, turn, regexp_replace(regexp_replace('Bob Ray: ' || text || ' Ada Byron met Bob Ray, then Ada Byron.', '(?i)\\bAda Byron\\b', '[P]', 'g'), '(?i)\\bBob Ray\\b', '[Q]', 'g') redacted FROM conversations""")
def redact_spans_whole(spark, sf):
    e = read(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("Bob Ray: "), "text", F.lit(" Ada Byron met Bob Ray, then Ada Byron.")).alias("text"))
    names = e.select("conv_id").distinct().withColumn("n", F.explode(F.array(F.struct(F.lit("Ada Byron").alias("name"), F.lit("[P]").alias("label")), F.struct(F.lit("Bob Ray").alias("name"), F.lit("[Q]").alias("label"))))).select("conv_id", "n.*")
    spans = parties.name_spans(e.where("text is not null"), names, ["conv_id"]).groupBy("conv_id", "turn", "text").agg(F.collect_list(F.struct("start", "end", "label")).alias("spans"))
    return spans.select("conv_id", "turn", parties.redact(F.col("text"), F.col("spans")).alias("redacted"))


# --- fetch planning -----------------------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT o_orderkey k, unnest([{'d': 2, 'a': 0}, {'d': 3, 'a': 0}, {'d': 4, 'a': 0}, {'d': 5, 'a': 0}, {'d': 6, 'a': CAST(o_orderkey % 4 + 1 AS INT)}, {'d': 7, 'a': 1}, {'d': 7, 'a': 2}, {'d': 7, 'a': 3}]) x FROM orders) SELECT k, CAST(x.d AS INT) doc_no, CAST(x.a AS INT) attachment FROM s""")
def wanted_docs(spark, sf):
    s = read(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("2, 3:5,x,6_"), (F.col("o_orderkey") % 4 + 1).cast("string"), F.lit(",7_1:3,2")).alias("spec"))
    return fetch.wanted_documents(s, "spec").select("k", "doc_no", "attachment")


@query("""WITH r AS (SELECT o_custkey k, CAST(min(o_orderdate) AS DATE) a, CAST(max(o_orderdate) AS DATE) b FROM orders GROUP BY 1), g AS (SELECT *, date_diff('day', a, b) gap FROM r),
n AS (SELECT *, unnest(range(0, CASE WHEN gap >= 180 THEN CAST(ceil(gap / 31.0) AS BIGINT) ELSE 1 END)) i FROM g)
SELECT k, CAST(CASE WHEN gap >= 180 THEN a + CAST(i * 31 AS INT) ELSE a END AS VARCHAR) window_from, CAST(CASE WHEN gap >= 180 THEN least(a + CAST((i + 1) * 31 AS INT), b) ELSE b END AS VARCHAR) window_to FROM n""")
def date_windows(spark, sf):
    r = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return fetch.date_windows(r, "a", "b").select("k", F.col("window_from").cast("string").alias("window_from"), F.col("window_to").cast("string").alias("window_to"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10) AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_custkey % 7 <> 0")
def pending_work(spark, sf):
    o, li = read(spark, sf, "orders"), read(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return fetch.pending(o, "o_orderkey", li.where("l_quantity > 10"), li.where("l_returnflag = 'R'"), o.where("o_custkey % 7 = 0")).select("o_orderkey")


@query(f"WITH {CASES} SELECT k, case_type FROM cases WHERE court = 'ccd' QUALIFY row_number() OVER (PARTITION BY cust ORDER BY k) = 1")
def docket_input(spark, sf):
    return fetch.first_per_case(raw_cases(spark, sf), "court", "ccd", "cust", [F.col("k")]).select("k", "case_type")


# --- graph --------------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN contains(lower(p_name || ' ' || p_type), 'recycled') THEN NULL WHEN contains(lower(p_name || ' ' || p_type), 'promo') THEN 'A' WHEN contains(lower(p_name || ' ' || p_type), 'steel') THEN 'B' WHEN contains(lower(p_name || ' ' || p_type), 'part') THEN 'C' END code FROM part")
def drug_keyword(spark, sf):
    return read(spark, sf, "part").select("p_partkey", graph.keyword_code(F.concat_ws(" ", "p_name", "p_type"), [("promo", "A"), ("steel", "B"), ("part", "C")], ["recycled"]).alias("code"))


@query("""WITH n AS (SELECT n_nationkey k, n_regionkey r, CAST(30 + n_nationkey % 10 AS DOUBLE) la, CAST(-80 - n_nationkey / 3.0 AS DOUBLE) lo FROM nation)
SELECT a.k a, b.k b, round(2 * 3958.8 * asin(sqrt(pow(sin((radians(b.la) - radians(a.la)) / 2), 2) + cos(radians(a.la)) * cos(radians(b.la)) * pow(sin((radians(b.lo) - radians(a.lo)) / 2), 2))), 4) miles FROM n a JOIN n b ON a.r = b.r AND a.k < b.k""")
def haversine_pairs(spark, sf):
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"), (F.lit(30) + F.col("n_nationkey") % 10).cast("double").alias("la"), (F.lit(-80) - F.col("n_nationkey") / F.lit(3.0)).cast("double").alias("lo"))
    a, b = (n.select("r", *(F.col(c).alias(f"{c}{i}") for c in ("k", "la", "lo"))) for i in (1, 2))
    return a.join(b, "r").where("k1 < k2").select(F.col("k1").alias("a"), F.col("k2").alias("b"), F.round(graph.miles(F.col("la1"), F.col("lo1"), F.col("la2"), F.col("lo2")), 4).alias("miles"))


@query(f"""WITH {CASES} SELECT 'case:' || ucid s, unnest(['type', 'court', 'category', 'filed']) p, unnest([CASE WHEN case_type = 'cr' THEN 'CriminalCase' ELSE 'CivilCase' END, court, case_type, strftime(filed, '%Y-%m-%d')]) o, unnest(['uri', 'uri', 'string', 'date']) kind FROM cases
UNION ALL SELECT 'case:' || ucid, 'terminated', strftime(filed, '%Y-%m-%d'), 'date' FROM cases WHERE status = 'F'""")
def triples_case(spark, sf):
    c = raw_cases(spark, sf)
    return graph.triples(c, F.concat(F.lit("case:"), "ucid"), [("type", F.when(F.col("case_type") == "cr", "CriminalCase").otherwise("CivilCase"), "uri"), ("court", F.col("court"), "uri"), ("category", F.col("case_type"), "string"), ("filed", F.col("filed"), "date"), ("terminated", F.when(F.col("status") == "F", F.col("filed")), "date")], unique=True)


@query("SELECT 'entry:' || conv_id || '_de' || turn s, 'hasReferenceToOtherEntry' p, 'entry:' || conv_id || '_de' || (turn - 1) o, 'uri' kind FROM conversations WHERE turn > 0")
def triples_edges(spark, sf):
    e = lambda t: F.concat(F.lit("entry:"), F.col("conv_id").cast("string"), F.lit("_de"), t.cast("string"))
    return graph.triples(read(spark, sf, "conversations"), e(F.col("turn")), [("hasReferenceToOtherEntry", F.when(F.col("turn") > 0, e(F.col("turn") - 1)), "uri")])


@query("""SELECT 'case:' || o_orderkey s, 'hasOOrderpriority' p, o_orderpriority o, 'string' kind FROM orders UNION ALL SELECT 'case:' || o_orderkey, 'hasOOrderstatus', o_orderstatus, 'string' FROM orders WHERE o_orderstatus <> 'O'""")
def triples_unpivot(spark, sf):
    o = read(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O")))
    return graph.unpivoted(o, F.concat(F.lit("case:"), F.col("o_orderkey").cast("string")), ["o_orderpriority", "o_orderstatus"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'P' || (o_orderkey % 50) || 'M' || CASE o_orderkey % 2 WHEN 0 THEN 15 ELSE 0 END || 'D' END term FROM orders")
def sentence_terms(spark, sf):
    k = F.col("o_orderkey")
    return read(spark, sf, "orders").select("o_orderkey", graph.term_text(F.when(k % 4 != 0, (k % 50) + F.when(k % 2 == 0, 0.5).otherwise(0.0))).alias("term"))


# --- pages and streams --------------------------------------------------------------------------------------------------


@query()
def html_docket_parse(spark, sf):
    row = lambda d, i, t: F.concat(F.lit("<tr><td>"), F.lit(d), F.lit("</td><td><a href='/doc1/"), F.col("conv_id").cast("string"), F.lit(i), F.lit("'>"), F.lit(i), F.lit("</a></td><td>"), t, F.lit("</td></tr>"))
    c = read(spark, sf, "conversations").where("turn = 0")
    page = F.concat(F.lit("<h3>x</h3><table><tr><td>Date Filed</td><td>#</td><td>Docket Text</td></tr>"), row("01/02/2020", "1", F.lit("COMPLAINT (Attachments: <a href='/doc1/99'>1</a>)")), row("02/03/2020", "2", F.concat(F.lit("ORDER on <a href='/doc1/"), F.col("conv_id").cast("string"), F.lit("1'>1</a> Motion"))), F.lit("</table>"))
    return H.parse_dockets(c.select("conv_id", page.alias("html")), "conv_id").select("conv_id", F.size("entries").alias("n"), F.col("entries")[1]["text"].alias("second"), F.col("entries")[1]["edges"][0]["dst"].alias("edge_to"), F.map_keys(F.col("entries")[0]["documents"])[1].alias("attachment"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') filing_date, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%m/%d/%Y') END terminating_date, CASE WHEN o_orderkey % 2 = 0 THEN 'Judge X' END judge, '110 Insurance' nature_suit, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END case_status FROM orders")
def html_header(spark, sf):
    d = F.date_format("o_orderdate", "MM/dd/yyyy")
    page = F.concat(F.lit("<td>Date Filed: "), d, F.lit("<br>"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Date Terminated: "), d)).otherwise(""), F.lit("<br>Assigned to: "), F.when(F.col("o_orderkey") % 2 == 0, "Judge X").otherwise("Unassigned"), F.lit("<br>Nature of Suit: 110 Insurance<br></td>Docket Text Date Filed: 1/1/1900"))
    return H.header_fields(read(spark, sf, "orders").select("o_orderkey", page.alias("html"))).select("o_orderkey", "filing_date", "terminating_date", "judge", "nature_suit", "case_status")


@query("SELECT page_id, 'open' status, 'Ann ' || page_id party_name FROM pages")
def summary_kv(spark, sf):
    page = F.concat(F.lit("<ul><li>Status: open</li><li>Party  Name: Ann "), F.col("page_id").cast("string"), F.lit(" </li></ul><p>no label</p>"), F.coalesce("html", F.lit("")))
    return read(spark, sf, "pages").select("page_id", H.summary_pairs(page).alias("m")).select("page_id", F.col("m")["status"].alias("status"), F.col("m")["party_name"].alias("party_name"))


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') window_start, event_type, count(*) n FROM events GROUP BY ALL")
def stream_counts(spark, sf):
    e = read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.event_counts(e).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) g FROM e) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') session_start, strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') session_end, count(*) n FROM s GROUP BY user_id, g""")
def stream_sessions(spark, sf):
    e = read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.sessions(e, gap="6 hours").withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("session_start", "session_end")})


from . import records  # noqa: E402,F401  (its queries are part of the catalogue)
