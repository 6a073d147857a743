"""Case identifiers as Column expressions: office:yy-type-number, and the court;;case key built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bound

# The parts of the case-id grammar.
OFFICE, YEAR, TYPE, NUMBER = r"[0-9A-Za-z]", r"[0-9]{2}", r"[A-Za-z]{1,4}", r"[0-9]{3,10}"
GRAMMAR = rf"({OFFICE}):({YEAR})-({TYPE})-({NUMBER})((?:--?[A-Za-z]{{1,4}}){{0,3}})(-[0-9]{{1,3}})?(_?[0-9]+)?"


def _group(c: Column, pattern: str, i: int) -> Column:
    """A group of the first match; null instead of empty."""
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def colonize(c: Column) -> Column:
    return F.when(c.contains(":"), c).otherwise(F.regexp_replace(c, r"^([^-]*)-", "$1:"))


def decolonize(c: Column) -> Column:
    return F.regexp_replace(c, r"^([^:]*):", "$1-")


def pad_number(n: Column, width: int = 5) -> Column:
    """Zeros on the left up to width; longer numbers stay whole."""
    return F.when(F.length(n) < width, F.lpad(n, width, "0")).otherwise(n)


def decompose(c: Column) -> Column:
    """struct<office, year, case_type, case_no, judge_names array, def_no, update_ind>; null without a match."""
    return bound(colonize(c), _parts)


def _parts(x: Column) -> Column:
    judges = F.filter(F.split(F.regexp_replace(F.regexp_extract(x, GRAMMAR, 5), "-+", "-"), "-"), lambda j: j != "")
    parts = F.struct(*(_group(x, GRAMMAR, i).alias(n) for i, n in enumerate(("office", "year", "case_type", "case_no"), 1)), F.when(F.size(judges) > 0, judges).alias("judge_names"), F.replace(_group(x, GRAMMAR, 6), F.lit("-"), F.lit("")).alias("def_no"), F.replace(_group(x, GRAMMAR, 7), F.lit("_"), F.lit("")).alias("update_ind"))
    return F.when(x.rlike(GRAMMAR), parts)


def build_case_id(parts: Column, with_defendant: bool = False, lower_type: bool = False) -> Column:
    kind = F.lower(parts["case_type"]) if lower_type else parts["case_type"]
    plain = F.concat(parts["office"], F.lit(":"), parts["year"], F.lit("-"), kind, F.lit("-"), pad_number(parts["case_no"]))
    return F.concat(plain, F.coalesce(F.concat(F.lit("-"), parts["def_no"]), F.lit(""))) if with_defendant else plain


def clean_case_id(c: Column, with_defendant: bool = False, lower_type: bool = False) -> Column:
    """The canonical id of a dirty one; text that has none comes back as far as it was cleaned.

    What a docket writes around the id is taken off first (a list after a comma, words such as ``no.``), then the bare forms
    (type before year, number alone, year and number in one) are brought to year and number."""
    rebuilt = lambda x: F.coalesce(bound(decompose(x), lambda d: build_case_id(d, with_defendant, lower_type)), x)
    return bound(bound(bound(F.regexp_replace(F.lower(c), "j:", "J:"), _unwrapped), _numbered), lambda x: rebuilt(colonize(x)))


def _unwrapped(x: Column) -> Column:
    listed = F.when(x.rlike("^no[.] [0-9,]+"), F.replace(x, F.lit(","))).otherwise(F.split_part(x, F.lit(","), F.lit(1)))
    return bound(listed, lambda y: F.regexp_replace(F.when(y.contains("nos.") & ~y.contains(";"), F.split_part(y, F.lit("-"), F.lit(1))).otherwise(y), r"(?s)^.*(?:nos?[.]|number|bankruptcy)", ""))


def _numbered(x: Column) -> Column:
    turned = bound(F.translate(F.btrim(x, F.lit(": ")), " ", "-"), lambda y: F.regexp_replace(y, r"(?s)^([a-z]+)-([0-9]{2})-([0-9]+).*$", "$2-$1-$3"))
    year = lambda y: F.when(y.rlike("^[0-9]{4}$"), F.concat(F.lit("noyear:0"), y)).when(y.rlike("^[0-9]{5}$"), F.concat(F.lit("noyear:"), y)).when(y.rlike("^[0-9]{7}$"), F.concat(F.substring(y, 1, 2), F.lit(":"), F.substring(y, 3, 5))).otherwise(F.translate(y, ";(", "--"))
    return bound(bound(turned, year), lambda y: F.when(y.rlike("^[0-9]{2,}-[0-9]+-."), F.regexp_extract(y, "^([0-9]+-[0-9]+)", 1)).otherwise(y))


def is_main(c: Column) -> Column:
    """Whether the id has no defendant number; for other text, whether it doesn't end in -1."""
    return bound(decompose(c), lambda d: F.coalesce(F.when(d.isNotNull(), d["def_no"].isNull()), ~c.endswith("-1")))


def ucid(court: Column, case_id: Column, clean: bool = True) -> Column:
    return F.concat(court, F.lit(";;"), clean_case_id(case_id) if clean else case_id)


def weak_ucid(u: Column) -> Column:
    return F.regexp_replace(u, r"[0-9A-Za-z]:", "")


def parse_ucid(u: Column) -> Column:
    p = r"^([a-z]{2,5});;(.*)$"
    return F.when(u.rlike(p), F.struct(F.regexp_extract(u, p, 1).alias("court"), F.regexp_extract(u, p, 2).alias("case_no")))


def docket_core(c: Column) -> Column:
    """Year and number of an id with colon or dashes."""
    p = r"([0-9]{2})-[A-Za-z]{1,4}-([0-9]+)"
    return F.concat(F.regexp_extract(c, p, 1), F.regexp_extract(c, p, 2))


def case_file(c: Column, defendant: Column | None = None, version: Column | None = None, ext: str = "html") -> Column:
    out = decolonize(clean_case_id(c))
    for sep, part in (("-", defendant), ("_", version)):
        if part is not None:
            out = F.concat(out, F.coalesce(F.concat(F.lit(sep), part.cast("string")), F.lit("")))
    return F.concat(out, F.lit("." + ext))


def expected_path(u: Column, root: str, subdir: str = "json", ext: str = "json") -> Column:
    parts = parse_ucid(u)
    return F.concat_ws("/", F.lit(root), parts["court"], F.lit(subdir), F.regexp_extract(parts["case_no"], r":([0-9]{2})-", 1), case_file(parts["case_no"], ext=ext))


def entity_path(u: Column, root: str) -> Column:
    parts = parse_ucid(u)
    return F.concat_ws("/", F.lit(root), parts["court"], F.regexp_extract(parts["case_no"], r":([0-9]{2})-", 1), F.concat(parts["court"], F.lit("-"), decolonize(parts["case_no"]), F.lit(".jsonl")))


def document_id(u: Column, index: Column, attachment: Column | None = None) -> Column:
    base = F.concat_ws("_", F.replace(u, F.lit(":"), F.lit("-")), index.cast("string"))
    if attachment is None:
        return base
    return F.when(F.coalesce(attachment, F.lit(0)) != 0, F.concat_ws("_", base, attachment.cast("string"))).otherwise(base)


def user_hash(user: Column) -> Column:
    return F.substring(F.md5(user.cast("binary")), 1, 8)


def document_file(doc_id: Column, user: Column, day: Column, ext: str = "pdf") -> Column:
    return F.concat(doc_id, F.lit("_u"), user_hash(user), F.lit("_t"), F.date_format(day, "yyMMdd"), F.lit("." + ext))


def parse_document_file(name: Column) -> Column:
    p = r"^([a-z]{2,5};;[^_]+)_([0-9]+)(?:_([0-9]+))?_u([0-9a-z]+)_t([0-9]{6})\.([a-z]+)$"
    return F.when(name.rlike(p), F.struct(F.regexp_replace(F.regexp_extract(name, p, 1), r"^([a-z]+;;[0-9A-Za-z])-", "$1:").alias("ucid"), F.regexp_extract(name, p, 2).cast("int").alias("doc_index"), _group(name, p, 3).cast("int").alias("attachment"), F.regexp_extract(name, p, 4).alias("user_hash"), F.to_date(F.try_to_timestamp(F.regexp_extract(name, p, 5), F.lit("yyMMdd"))).alias("downloaded")))


# Addresses of a court's site. The training court has a host of its own.
PAGES = {"query": "cgi-bin/iquery.pl", "login": "cgi-bin/login.pl", "logout": "cgi-bin/login.pl?logout", "docket": "cgi-bin/DktRpt.pl", "doc_link": "doc1", "possible_case": "cgi-bin/possible_case_numbers.pl", "summary": "cgi-bin/qrySummary.pl", "members": "cgi-bin/AsccaseDisplay.pl", "history": "cgi-bin/HistDocQry.pl"}
TRAINING_COURT, TRAINING_HOST = "psc", "https://dcecf.psc.uscourts.gov/"


def site_url(court: Column, page: Column) -> Column:
    """The address of a page of a court's site; null for unknown pages."""
    base = F.when(court == TRAINING_COURT, TRAINING_HOST).otherwise(F.concat(F.lit("https://ecf."), court, F.lit(".uscourts.gov/")))
    out = F.lit(None).cast("string")
    for name, rest in PAGES.items():
        out = F.when(page == name, F.concat(base, F.lit(rest))).otherwise(out)
    return out


def ucid_from_parts(court: Column, office: Column, year: Column, case_type: Column, number: Column) -> Column:
    """The key of a case from its parts; the year is two digits, the number is filled to five."""
    return F.concat(court, F.lit(";;"), office.cast("string"), F.lit(":"), F.substring(F.lpad(year.cast("string"), 4, "0"), 3, 2), F.lit("-"), case_type, F.lit("-"), pad_number(number.cast("string")))


def flat_path(u: Column, root: str, subdir: str = "json", ext: str = "json", defendant: Column | None = None) -> Column:
    """Where files lay before folders had years."""
    parts = parse_ucid(u)
    return F.concat_ws("/", F.lit(root), parts["court"], F.lit(subdir), case_file(parts["case_no"], defendant, ext=ext))


def file_ucid(path: Column, court: Column) -> Column:
    """The key of the case that a file is named after."""
    return ucid(court, colonize(F.regexp_replace(F.element_at(F.split(std_path(path), "/"), -1), r"[.][^.]*$", "")))


def std_path(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def relative_path(path: Column, root: str) -> Column:
    """What follows the project's folder, where the path goes through it."""
    return bound(std_path(path), lambda p: F.when(F.array_contains(F.split(p, "/"), root), F.regexp_replace(p, rf"^.*?(?:^|/)\Q{root}\E/", "")).otherwise(p))


def is_third_party(path: Column) -> Column:
    """Whether a folder of the path is the third party's."""
    return F.array_contains(F.split(std_path(path), "/"), "recap")


def page_path(path: Column) -> Column:
    """The page that a parsed case comes from."""
    return F.replace(path, F.lit("json"), F.lit("html"))


def filed_year(day: Column) -> Column:
    """The year of a month/day/year text."""
    return F.element_at(F.split(day, "/"), -1).try_cast("int")


def newest_documents(files: DataFrame, wanted: DataFrame, name: str = "path") -> DataFrame:
    """wanted (doc_id) with the path of its file: of files of one document the last by path; null where there is none."""
    file = F.element_at(F.split(std_path(F.col(name)), "/"), -1)
    known = files.select(F.regexp_extract(file, r"^([a-z]{2,5};;[^_]+_[0-9]+(?:_[0-9]+)?)_u[0-9a-z]+_t[0-9]{6}[.]", 1).alias("doc_id"), F.col(name)).where("doc_id <> ''")
    return wanted.join(known.groupBy("doc_id").agg(F.max(name).alias(name)), "doc_id", "left")


def header_document_id(first_page: Column, court: Column) -> Column:
    """The id of a document from the text of its first page, whose last 100 characters state case, document and attachment."""
    x = F.right(F.regexp_replace(F.trim(first_page), r"\s+", " "), F.lit(100))
    number = F.coalesce(_group(x, r"(?i)entry number:? *([0-9]+)", 1), _group(x, r"(?i)document:? *(?:no[.]? *|number:? *)?([0-9]+)", 1))
    case = _group(x, rf"({GRAMMAR})", 1)
    return document_id(ucid(court, case), number, _group(x, r"(?i)attachment:? *([0-9]+)", 1).cast("int"))


def third_party_use(cases: DataFrame, pages_at: DataFrame, key: str = "ucid", case_id: str = "case_id") -> DataFrame:
    """cases with ignore_have_html, ignore_non_cv and use: a third party's case counts where no page was saved and it is civil."""
    kind = F.coalesce(decompose(F.col(case_id))["case_type"], F.lit(""))
    have = pages_at.select(key, F.lit(True).alias("_have")).distinct()
    out = cases.join(have, key, "left").withColumn("ignore_have_html", F.coalesce("_have", F.lit(False))).withColumn("ignore_non_cv", kind != "cv").drop("_have")
    return out.withColumn("use", ~F.col("ignore_have_html") & ~F.col("ignore_non_cv"))


# Links of docket pages.
MEMBER_LINK = r"(?s)<a.+?href\S+?[.]pl[?]([0-9]+)\S+?>(\S+?)<"
MEMBER_BLOCK = r"(?is)Member cases?: (?:<table .+?</table>|<a.+?</a>)"
CONDENSED = rf"({YEAR})-?({TYPE})-?({NUMBER})"


def member_block(html: Column) -> Column:
    """struct<start, end> of a page's list of member cases; null without one."""
    at = F.regexp_instr(html, F.lit(MEMBER_BLOCK)) - 1
    return F.when(at >= 0, F.struct(at.alias("start"), (at + F.length(F.regexp_extract(html, MEMBER_BLOCK, 0))).alias("end")))


def member_links(html: Column, court: Column) -> Column:
    """array<struct<member, member_id>> of the links in a page's list of member cases."""
    block = F.regexp_extract(html, MEMBER_BLOCK, 0)
    pairs = F.arrays_zip(F.regexp_extract_all(block, F.lit(MEMBER_LINK), F.lit(2)).alias("c"), F.regexp_extract_all(block, F.lit(MEMBER_LINK), F.lit(1)).alias("i"))
    return F.transform(pairs, lambda p: F.struct(ucid(court, p["c"]).alias("member"), p["i"].alias("member_id")))


def mdl_of_case_id(c: Column) -> Column:
    """The number of an id whose type is md, ml or mdl; dashes may be missing."""
    return F.when(F.lower(F.regexp_extract(c, CONDENSED, 2)).isin("md", "ml", "mdl"), F.regexp_extract(c, CONDENSED, 3).try_cast("int"))
