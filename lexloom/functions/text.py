"""Cleaning of docket text and dates as Column expressions. Cleaners turn empty results into null."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def detag(c: Column, space: bool = False) -> Column:
    """Without *** pairs and tags, and without <, >, ?, ! and blanks at the ends."""
    x = F.regexp_replace(c, r"(?s)\*\*\*.*?\*\*\*", "")
    return blank_to_null(F.btrim(F.regexp_replace(x, r"<[^<]+?>", " " if space else ""), F.lit("<>?! ")))


def scrub_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<.+?>", "")


def clean_line(c: Column) -> Column:
    x = F.replace(F.replace(c, F.lit("&amp;"), F.lit("&")), F.lit("&nbsp;"), F.lit(" "))
    x = F.replace(F.replace(F.replace(x, F.lit("\\'"), F.lit("'")), F.lit("\\n"), F.lit(" ")), F.lit("\\t"), F.lit(" "))
    x = F.regexp_replace(F.regexp_replace(x, r"^\)+", ""), r"\(+$", "")
    return blank_to_null(F.trim(F.regexp_replace(x, " +", " ")))


def lawyer_line(c: Column) -> Column:
    return F.btrim(F.split_part(c, F.lit("<!--"), F.lit(1)), F.lit("/<> "))


def breaks_to_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"<br ?/?>", "\n")


# Numbers that are blanked, between what may not be part of them.
SSN = r"(?i)([^0-9])((?:ssn?:?)? *#?[0-9]{3}-[0-9]{2}-[0-9]{4})([^0-9])"
A_NUMBER = r"(?i)([^0-9a-z])(a[0-9]{8,9})([^0-9])"


def scrub_sensitive(c: Column) -> Column:
    """Social-security numbers and A-numbers become blanks of the same length, where other text stands on both sides."""
    def blanked(x: Column, pattern: str, holds_marker: bool) -> Column:
        # odd places of the split by a marker are the found texts
        parts = F.split(F.regexp_replace(x, pattern, "$1\u0001$2\u0001$3"), "\u0001")
        marked = F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.repeat(F.lit(" "), F.length(p))).otherwise(p)), "")
        # a text that holds the marker is split at the matches, whose first and last characters are the edges: a second search
        inner = lambda m: F.concat(F.substring(m, 1, 1), F.repeat(F.lit(" "), F.length(m) - 2), F.substring(m, -1, 1))
        split = F.array_join(F.zip_with(F.split(x, pattern), F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), lambda p, m: F.concat(p, F.coalesce(inner(m), F.lit("")))), "")
        return split if holds_marker else marked

    both = lambda held: blanked(blanked(c, SSN, held), A_NUMBER, held)
    return F.when(c.contains("\u0001"), both(True)).otherwise(both(False))


def span(c: Column, pattern: str, limit: int | None = None) -> Column:
    """struct<start, end> of the first match, case-insensitive, 0-based and half-open; null without one."""
    x = F.substring(c, 1, limit) if limit else c
    p = f"(?i){pattern}"
    start = F.regexp_instr(x, F.lit(p)) - 1
    return F.when(start >= 0, F.struct(start.alias("start"), (start + F.length(F.regexp_extract(x, p, 0))).alias("end")))


def last_index(part: str, c: Column) -> Column:
    at = F.instr(F.reverse(c), part[::-1])
    return F.when(at > 0, F.length(c) - at - len(part) + 1)


def receipt(c: Column) -> Column:
    """struct of a page's receipt: user, description, criteria, pages int, cost decimal; null where there is none."""
    p = r"Login: *(\S+) +Client Code: *\S* *Description: *(.*?) +Search Criteria: *(.*?) +Billable Pages: *([0-9]+) +Cost: *([0-9.]+)"
    x = F.regexp_replace(scrub_tags(c), r"\s+", " ")
    return F.when(x.rlike(p), F.struct(*(F.regexp_extract(x, p, i).alias(n) for i, n in enumerate(("user", "description", "criteria"), 1)), F.regexp_extract(x, p, 4).try_cast("int").alias("billable_pages"), F.regexp_extract(x, p, 5).try_cast("decimal(10,2)").alias("cost")))


def stamp(c: Column) -> Column:
    """The key:value pairs of a page's trailing download comment; values may hold colons."""
    body = F.regexp_extract(c, r"(?s).*<!--\s*([a-z_]+:[^>]*?)\s*-->", 1)
    pairs = F.transform(F.filter(F.split(body, ";"), lambda p: p.contains(":")), lambda p: F.struct(F.trim(F.split(p, ":", 2)[0]), F.split(p, ":", 2)[1]))
    return F.map_from_entries(pairs)


# The receipt at a page's end, as text and in its markup.
RECEIPT = r"(?is)Transaction Receipt (.+?)\s+Pacer Login:\s*([a-zA-Z0-9]+).+?Description:\s+(.+?)\s+[a-zA-Z\s]+:\s+(.+?)\s+Billable Pages:\s+([0-9]+)\s+Cost:\s+([0-9]+[.][0-9]+)"
RECEIPT_MARKUP = r"(?s)Billable Pages.+?>\s?([0-9]+)\s<.+?Cost.+?>\s?([0-9]+[.][0-9]+)\s?<"


def transaction(html: Column) -> Column:
    """struct of a page's receipt: timestamp, user, description, search_criteria, billable_pages int, cost double; null where
    there is none."""
    x = scrub_tags(html)
    parts = [F.regexp_extract(x, RECEIPT, i).alias(n) for i, n in enumerate(("timestamp", "user", "description", "search_criteria"), 1)]
    return F.when(x.rlike(RECEIPT), F.struct(*parts, F.regexp_extract(x, RECEIPT, 5).try_cast("int").alias("billable_pages"), F.regexp_extract(x, RECEIPT, 6).try_cast("double").alias("cost")))


def billed(html: Column) -> Column:
    """struct<billable_pages, cost> from the markup of a receipt."""
    return F.when(html.rlike(RECEIPT_MARKUP), F.struct(F.regexp_extract(html, RECEIPT_MARKUP, 1).try_cast("int").alias("billable_pages"), F.regexp_extract(html, RECEIPT_MARKUP, 2).try_cast("double").alias("cost")))


def download_stamp(html: Column) -> Column:
    """What the download left at a page's end, as a map: a JSON comment in the last line, else pairs after SCALESDOWNLOAD."""
    last = F.regexp_extract(html, r"(?s)(?:^|\n)<!--\s*(\{[^\n]*\})\s*-->\s*$", 1)
    pairs = F.split(F.regexp_extract(F.substring(html, 401, 1 << 30), r"(?s)<!-- SCALESDOWNLOAD;(.+) -->", 1), ";")
    plain = F.map_from_entries(F.transform(F.filter(pairs, lambda p: p.contains(":")), lambda p: F.struct(F.split(p, ":", 2)[0], F.split(p, ":", 2)[1])))
    return F.coalesce(F.when(last != "", F.from_json(last, "map<string,string>")), plain)


def entry_lines(info: Column) -> Column:
    """The lines of a lawyer's block before the first italics, without markup, empty ones and what says PRO SE."""
    lines = F.transform(F.split(F.split_part(info, F.lit("<i>"), F.lit(1)), "<br"), lawyer_line)
    return F.filter(lines, lambda x: (x != "") & ~x.contains("PRO SE"))


def terminated(info: Column) -> Column:
    """struct<day, rest>: the first date that follows ``TERMINATED: `` and the text without all of those."""
    mark = r"TERMINATED: ([^\n]*)(?:\n|$)"
    return F.struct(F.when(info.contains("TERMINATED: "), F.regexp_extract(info, mark, 1)).alias("day"), F.regexp_replace(info, mark, "").alias("rest"))


def tidy_info(raw: Column) -> Column:
    """The notes under a name (what is in italics, without dates of termination): null where there are none, as the block then
    holds an address alone."""
    x = detag(breaks_to_newlines(raw))
    kept = F.filter(F.transform(F.split(clean_line(terminated(x)["rest"]), "\n"), clean_line), lambda y: y.isNotNull())
    out = blank_to_null(F.btrim(F.array_join(kept, "\n"), F.lit("\n/<> ")))
    return F.when((out != "and") & F.replace(raw, F.lit("<i>TERMINATED")).contains("<i>"), out)


def is_address(line: Column) -> Column:
    """Whether a line looks like one of an address: a house number, a box, or a state with a postal code."""
    return F.coalesce(line.rlike(r"^[0-9]+[A-Za-z]? +\S|(?i:^P[.]?O[.]? Box )|, [A-Z]{2}[.]? +[0-9]{5}"), F.lit(False))


def year_gap(day: Column, year: Column) -> Column:
    """A text's year less the wanted one: 0 if none is wanted, -9999 if the text has none."""
    found = F.regexp_extract(day, r"([0-9]{4})", 1).try_cast("int")
    return F.when(year.isNull(), 0).otherwise(F.coalesce(found - year, F.lit(-9999)))


def first_index(starts: Column, phrase_at: Column, mode: str = "first") -> Column:
    """Index of the entity that an entry's phrase is about: the earliest one, or with ``nearest_after`` the first after the
    phrase (the earliest, if none follows)."""
    first = F.array_position(starts, F.array_min(starts)) - 1
    if mode == "first":
        return first
    after = F.array_min(F.filter(starts, lambda s: s >= phrase_at))
    return F.coalesce(F.array_position(starts, after) - 1, first)


def packed(c: Column) -> Column:
    """Text as zlib in base 64."""
    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        import base64
        import zlib

        return x.map(lambda v: None if v is None else base64.b64encode(zlib.compress(v.encode())).decode())

    return run(c)


def unpacked(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        import base64
        import zlib

        return x.map(lambda v: None if v is None else zlib.decompress(base64.b64decode(v)).decode())

    return run(c)


def forward_date(c: Column) -> Column:
    """mm/dd/yy as 20yy-mm-dd."""
    p = F.split(c, "/")
    return F.concat_ws("-", F.concat(F.lit("20"), p[2]), p[0], p[1])


def query_filed(c: Column) -> Column:
    return forward_date(F.ltrim(F.split_part(c, F.lit(" closed"), F.lit(1)), F.lit("filed ")))


def query_closed(c: Column) -> Column:
    return F.when(c.contains(" closed "), forward_date(F.trim(F.split_part(c, F.lit(" closed "), F.lit(2)))))


def slash_date(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit("M/d/yyyy")))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(slash_date(later), slash_date(earlier))


def iso_date(c: Column) -> Column:
    """An ISO prefix, else the first of yyyy-MM, M/d/yyyy, d/M/yyyy and M/yyyy that fits; null if none does."""
    iso = F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd"))))
    # a form is tried only where its mark stands, as a failed parse costs far more
    return F.coalesce(iso, *(F.when(c.contains("-" if "-" in f else "/"), F.to_date(F.try_to_timestamp(c, F.lit(f)))) for f in ("yyyy-M", "M/d/yyyy", "d/M/yyyy", "M/yyyy")))


def nos_number(c: Column) -> Column:
    return F.replace(F.split_part(F.trim(c), F.lit(" "), F.lit(1)), F.lit(":"), F.lit("")).try_cast("int")


def mdl_code(c: Column) -> Column:
    """The number after MDL (No., - or _)."""
    return blank_to_null(F.regexp_extract(c, r"(?i)mdl[ \-_]?(?:no. ?)?([0-9]{2,5})", 1)).try_cast("int")


def bound(value: Column, body) -> Column:
    """body of a value computed once; inside a lambda an expression is computed again for each element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def char_ngrams(c: Column, n: int = 3) -> Column:
    def grams(ch: Column) -> Column:
        return F.when(F.size(ch) >= n, F.transform(F.sequence(F.lit(1), F.size(ch) - n + 1), lambda i: F.array_join(F.slice(ch, i, F.lit(n)), ""))).otherwise(F.array().cast("array<string>"))

    return bound(F.filter(F.split(F.regexp_replace(c, r"[,\-./]|\sBD", ""), ""), lambda x: x != ""), grams)
