"""Search over docket entries, and what is measured on the entries found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T


def search_docket(entries: DataFrame, patterns: dict[str, str], wide_net: list[str] | Column, text: str = "text", meta: list[str] | None = None, computed: dict[str, Column] | None = None, limit: int | None = None, only_matches: bool = False, excerpt: int = 100) -> DataFrame:
    """Entries that the wide net catches, with an excerpt and each named pattern's first span in the first ``limit``
    characters. wide_net: patterns, of which one must be found, or a condition. The net is one regular expression, so the
    pattern spans are looked for in what it catches alone."""
    caught = wide_net if isinstance(wide_net, Column) else F.col(text).rlike("(?i)" + "|".join(f"(?:{p})" for p in wide_net))
    out = entries.where(caught).select(*(meta or [c for c in entries.columns if c != text]), F.substring(text, 1, excerpt).alias("excerpt"), *(c.alias(n) for n, c in (computed or {}).items()), *(T.span(F.col(text), p, limit).alias(n) for n, p in patterns.items()))
    return out.where(F.coalesce(*(F.col(n) for n in patterns)).isNotNull()) if only_matches and patterns else out


def spans_of(row: DataFrame, names: list[str]) -> Column:
    """The non-null spans as array<struct<start, end, label>>."""
    return F.filter(F.array(*(F.when(F.col(n).isNotNull(), F.struct(F.col(n)["start"].alias("start"), F.col(n)["end"].alias("end"), F.lit(n).alias("label"))) for n in names)), lambda s: s.isNotNull())


def matching_lines(entries: DataFrame, phrases: list[str], excluded: list[str] = (), text: str = "text", lower: bool = True, beginning: bool = False) -> DataFrame:
    """Entries with any of the phrases and none of the excluded ones, anywhere or at the beginning."""
    t = F.lower(text) if lower else F.col(text)
    has = lambda p: t.startswith(p) if beginning else t.contains(p)
    any_of = lambda ps: F.lit(False) if not ps else has(ps[0]) if len(ps) == 1 else has(ps[0]) | any_of(ps[1:])
    return entries.where(any_of(list(phrases)) & ~any_of(list(excluded)))


def cases_flagged(entries: DataFrame, pattern: str, case: str, text: str = "text", limit: int | None = None) -> DataFrame:
    """(case, flagged): whether any entry's first characters match."""
    t = F.substring(text, 1, limit) if limit else F.col(text)
    return entries.groupBy(case).agg(F.bool_or(F.coalesce(t.rlike("(?i)" + pattern), F.lit(False))).alias("flagged"))


def court_motions(entries: DataFrame, text: str = "text") -> DataFrame:
    """Entries with a parenthesised lower-case phrase of 3 to 20 characters."""
    return entries.where(F.col(text).rlike(r"\([a-z, ]{3,20}\)"))


def inter_event_days(events: DataFrame, case: str, day: Column, order: list[str]) -> DataFrame:
    """Days between an event and the one before it in its case; a case's first event has no row."""
    w = Window.partitionBy(case).orderBy(*order)
    return events.withColumn("gap_days", F.datediff(day, F.lag(day).over(w))).where(F.col("gap_days").isNotNull())


def latest_date(entries: DataFrame, case: str, day: Column) -> DataFrame:
    return entries.groupBy(case).agg(F.date_format(F.max(day), "MM/dd/yyyy").alias("latest_date"))


def insert_extra(base: DataFrame, extra: DataFrame, case: str, day: str, index: str, threshold: float = 0.8, default: str = "before") -> DataFrame:
    """(case, place): whether a case's extra entries go before or after its base entries. By dates, where at least threshold
    of the extra ones lie on one side and more than on the other; else by the entry numbers (not null or 0): before, if more of
    the extra ones are at most the least of the base than at least its greatest; else default. Without base entries: default."""
    number = F.nullif(F.col(index), F.lit(0))
    b = base.groupBy(case).agg(F.min(day).alias("b_min"), F.max(day).alias("b_max"), F.min(number).alias("b_low"), F.max(number).alias("b_high"))
    share = lambda c: F.avg(c.cast("double"))  # noqa: E731  of the rows where the comparison has both sides
    sides = [share(F.col(day) <= F.col("b_min")).alias("early"), share(F.col(day) >= F.col("b_max")).alias("late"), share(number <= F.col("b_low")).alias("low"), share(number >= F.col("b_high")).alias("high")]
    e = extra.join(b, case, "left").groupBy(case).agg(*sides)
    by_day = F.when((F.col("early") >= threshold) & (F.col("early") > F.col("late")), "before").when((F.col("late") >= threshold) & (F.col("late") > F.col("early")), "after")
    return e.select(case, F.coalesce(by_day, F.when(F.col("low") > F.col("high"), "before").when(F.col("low") <= F.col("high"), "after"), F.lit(default)).alias("place"))


def has_edges(entries: Column) -> Column:
    """Whether any of a case's entries refers to another."""
    return F.exists(entries, lambda e: F.size(e["edges"]) > 0)


def edges_to(edges: Column, target: Column) -> Column:
    return F.filter(edges, lambda e: e["dst"] == target)


def usable_docket(texts: Column) -> Column:
    """Whether a docket (array of texts) can be read for judges: not empty, opened by a committee's order, a clerical error or
    not to be used."""
    bad = lambda t: t.isNull() | F.lower(t).rlike("clerical error|in error|shall not be used")
    return (F.size(texts) > 0) & ~F.coalesce(F.lower(F.get(texts, F.lit(0))).contains("executive committee"), F.lit(False)) & ~F.exists(texts, bad)
