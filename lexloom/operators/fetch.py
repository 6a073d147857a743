"""Planning of what to fetch: date windows, document numbers, what is done already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids as I


def date_windows(ranges: DataFrame, first: str, last: str, days: int = 31, from_days: int = 180) -> DataFrame:
    """ranges with window_from and window_to: consecutive windows that share their bounds, the last one ending at last;
    ranges shorter than from_days stay whole."""
    gap = F.datediff(last, first)
    n = F.when(gap >= from_days, F.ceil(gap / days).cast("int")).otherwise(1)
    step = F.when(gap >= from_days, days).otherwise(gap)
    out = ranges.withColumn("_i", F.explode(F.sequence(F.lit(0), n - 1)))
    return out.withColumn("window_from", F.date_add(first, (F.col("_i") * step).cast("int"))).withColumn("window_to", F.least(F.date_add(first, ((F.col("_i") + 1) * step).cast("int")), F.col(last))).drop("_i")


def wanted_documents(requests: DataFrame, spec: str) -> DataFrame:
    """requests exploded to doc_no and attachment by a text like ``2,3:5,6_1,7_1:4``; attachment 0 is the line's document.
    Parts that don't fit the grammar are left out."""
    part = requests.withColumn("_p", F.explode(F.split(F.translate(spec, " ", ""), ",")))
    plain, range_, one, many = r"^([0-9]+)$", r"^([0-9]+):([0-9]+)$", r"^([0-9]+)_([0-9]+)$", r"^([0-9]+)_([0-9]+):([0-9]+)$"
    g = lambda p, i: F.regexp_extract("_p", p, i).try_cast("int")
    pair = lambda a, b: F.struct(a.alias("doc_no"), b.alias("attachment"))
    zero = F.lit(0)
    up = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    found = F.when(F.col("_p").rlike(plain), F.array(pair(g(plain, 1), zero))).when(F.col("_p").rlike(range_), F.transform(up(g(range_, 1), g(range_, 2)), lambda i: pair(i, zero))).when(F.col("_p").rlike(one), F.array(pair(g(one, 1), g(one, 2)))).when(F.col("_p").rlike(many), F.transform(up(g(many, 2), g(many, 3)), lambda i: pair(g(many, 1), i)))
    return part.withColumn("_d", F.explode(found)).select(*requests.columns, "_d.doc_no", "_d.attachment").distinct()


def pending(wanted: DataFrame, key: str, present: DataFrame | None = None, done: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """wanted cases that are on disk (present), not done and not excluded."""
    out = wanted if present is None else wanted.join(present.select(key), key, "left_semi")
    for gone in (done, excluded):
        out = out if gone is None else out.join(gone.select(key), key, "left_anti")
    return out


def first_per_case(requests: DataFrame, court: str, wanted_court: str, case: str, order: list[Column]) -> DataFrame:
    from .index import first_per_key

    return first_per_key(requests.where(F.col(court) == wanted_court), [case], order)


def link_arguments(c: Column) -> Column:
    """The quoted arguments of a goDLS(...) call."""
    return F.regexp_extract_all(F.regexp_extract(c, r"goDLS\((.*?)\)", 1), F.lit("'([^']*)'"), F.lit(1))


def attachment_name(c: Column) -> Column:
    """Digits stay; of an address the last part's stem; of other text up to ten letters and digits."""
    return F.when(c.rlike("^[0-9]+$"), c).when(c.contains("/"), F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", "")).otherwise(F.substring(F.regexp_replace(c, "[^0-9A-Za-z]", ""), 1, 10))


def sealed(c: Column) -> Column:
    return F.lower(c).rlike("seal|restric|redac|protectiv")


def split_config(config: DataFrame, dates: list[tuple[str, str]], max_gap: int = 180, chunk: int = 31) -> DataFrame:
    """Query settings, one row for each window: the first pair of date columns whose days lie max_gap or more apart is cut into
    windows of chunk days, written as MM/DD/YYYY; settings without such a pair stay as they are."""
    rows = config.withColumn("_id", F.monotonically_increasing_id())
    days = lambda a, b: F.datediff(F.to_date(F.try_to_timestamp(F.col(b), F.lit("M/d/yyyy"))), F.to_date(F.try_to_timestamp(F.col(a), F.lit("M/d/yyyy"))))
    pick = F.lit(-1)
    for i in reversed(range(len(dates))):
        pick = F.when(F.coalesce(days(*dates[i]) >= max_gap, F.lit(False)), i).otherwise(pick)
    rows = rows.withColumn("_pick", pick)
    out = rows.where("_pick < 0")
    for i, (a, b) in enumerate(dates):
        day = {c: F.to_date(F.try_to_timestamp(F.col(c), F.lit("M/d/yyyy"))) for c in (a, b)}
        cut = date_windows(rows.where(F.col("_pick") == i).withColumn("_a", day[a]).withColumn("_b", day[b]), "_a", "_b", chunk, max_gap)
        out = out.unionByName(cut.withColumns({a: F.date_format("window_from", "MM/dd/yyyy"), b: F.date_format("window_to", "MM/dd/yyyy")}).select(*rows.columns))
    return out.drop("_id", "_pick")


def docket_requests(rows: DataFrame, court: str) -> DataFrame:
    """Requests (case_no, latest_date, def_no) of a court from rows with ucid: one for each case, empty for no defendant."""
    from .index import least_per_key

    parts = I.parse_ucid(F.col("ucid"))
    has = lambda c: F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")
    mine = rows.select(parts["court"].alias("court"), parts["case_no"].alias("case_no"), has("latest_date").alias("latest_date"), F.coalesce(has("def_no"), F.lit("")).alias("def_no")).where(F.col("court") == court)
    return least_per_key(mine, ["case_no"], ["latest_date"]).drop("court")


def update_windows(requests: DataFrame, latest: str = "latest_date") -> DataFrame:
    """requests with date_from: the day after the latest entry that is known."""
    day = F.to_date(F.try_to_timestamp(F.col(latest), F.lit("M/d/yyyy")))
    return requests.withColumn("date_from", F.date_format(F.date_add(day, 1), "MM/dd/yyyy"))


def next_file(files: DataFrame, case: str = "ucid", path: str = "path") -> DataFrame:
    """(case, next_no): the number of the next version of a case's file; files without a number are the first."""
    n = F.coalesce(F.nullif(F.regexp_extract(path, r"_([0-9]+)[.][a-z]+$", 1), F.lit("")).try_cast("int"), F.lit(0))
    return files.groupBy(case).agg((F.max(n) + 1).alias("next_no"))


def task_line(ucid: Column, completed: Column, downloaded: Column, new_lines: Column, message: Column | None = None, outpath: Column | None = None) -> Column:
    """A line of an update's log, as JSON."""
    parts = [ucid.alias("ucid"), completed.alias("completed"), downloaded.alias("downloaded"), new_lines.alias("new_lines")]
    return F.to_json(F.struct(*parts, *([message.alias("message")] if message is not None else []), *([outpath.alias("outpath")] if outpath is not None else [])))


def task_file(path: Column) -> Column:
    """Where an update's log lies: beside its table, with another ending."""
    return F.concat(F.regexp_replace(path, r"[.][^./]*$", ""), F.lit(".task.jsonl"))


def within_limits(wanted: DataFrame, order: list[str], cases: int | None = None, cost: float | None = None, price: str = "cost") -> DataFrame:
    """wanted in order until a number of cases or their summed cost is reached, as a run would stop: a limit that is the feature.
    The running sum is over a run's work list, which one machine walks."""
    from pyspark.sql.window import Window

    w = Window.orderBy(*order)
    out = wanted.withColumn("_n", F.row_number().over(w)).withColumn("_spent", F.sum(price).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    out = out.where(F.col("_n") <= cases) if cases is not None else out
    out = out.where(F.coalesce("_spent", F.lit(0.0)) < cost) if cost is not None else out
    return out.drop("_n", "_spent")


def case_record(records: DataFrame, case: str, defendant: str, wanted: str, record: str = "pacer_id") -> DataFrame:
    """(case, record): the site's record of a case: the only one, else that of the wanted defendant, the case's own (0) without."""
    chosen = F.coalesce(F.col(wanted).cast("string"), F.lit("0"))
    hit = F.min(F.when(F.col(defendant).cast("string") == chosen, F.col(record)))
    return records.groupBy(case).agg(F.when(F.count("*") == 1, F.min(record)).otherwise(hit).alias(record))


# What pages say.
PAGE_STATES = {"sealed": "(?i)seal|restric|redac|protectiv", "no_docketlines": "(?:There are )?[Pp]roceedings for case .{1,50} (?:but none satisfy the selection criteria|are not available)", "invalid_case": "(?i)not a valid case|invalid case", "no_data": "(?i)no (?:case )?(?:data|information) (?:found|available)", "no_permission": "(?i)do not have permission", "receipt": "Transaction Receipt", "redaction_agreement": "(?i)redaction agreement", "selection": "(?i)document selection menu", "none_found": "(?i)no (?:associated|member) cases"}


def page_states(html: Column, head: int | None = None) -> Column:
    """struct of what a page, or its first characters, says; null pages say nothing."""
    x = F.coalesce(F.substring(html, 1, head) if head else html, F.lit(""))
    return F.struct(*(x.rlike(p).alias(n) for n, p in PAGE_STATES.items()))


def is_main_row(label: Column) -> Column:
    """Whether a row of a document menu is the main document."""
    x = F.lower(F.trim(label))
    return x.startswith("main") | x.contains("main document") | x.startswith("document number")


def link_call(arguments: Column) -> Column:
    """A goDLS(...) call of an array of arguments."""
    return F.concat(F.lit("goDLS("), F.array_join(F.transform(arguments, lambda a: F.concat(F.lit("'"), a, F.lit("'"))), ","), F.lit(")"))


def run_hours(at: Column, first: int = 20, last: int = 4, zone: str = "US/Central") -> Column:
    """Whether a moment (UTC) is within the hours of a run, which may pass midnight."""
    hour = F.hour(F.from_utc_timestamp(at, zone))
    return (hour >= first) | (hour < last) if first > last else (hour >= first) & (hour < last)


def wanted_dockets(requests: DataFrame, on_disk: DataFrame, documents: DataFrame | None = None, every: bool = False) -> DataFrame:
    """Requests (ucid, doc_no) that have a number (or all, if asked) and a saved page, of cases without any document so far."""
    out = requests if every else requests.where(F.col("doc_no").isNotNull() & (F.trim("doc_no") != ""))
    out = out.join(on_disk.select("ucid").distinct(), "ucid", "left_semi")
    return out if documents is None else out.join(documents.select("ucid").distinct(), "ucid", "left_anti")
