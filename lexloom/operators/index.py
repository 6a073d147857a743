"""The case index: counts, versions of a case, and groups of cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import ids as I
from ..functions import text as T


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the first in an order that must be total."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


#: Rows of a dimension that may be held by every task.
SMALL = 100_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """df, marked for a broadcast if its counted rows are few; else a join shuffles."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def least_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key, the least by the order and then by all columns. Least rows are found before the shuffle, so a hot key costs
    a row for each task."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*(F.col(c) for c in order), *(F.col(c) for c in rest if c not in order))
    best = df.groupBy(*keys).agg(F.min(row).alias("_r"))
    return best.select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*df.columns)


def case_counts(index: DataFrame, by: list[str] = (), where: str | None = None) -> DataFrame:
    """Cases by year, court and further columns; null groups count too."""
    rows = index.where(F.expr(where)) if where else index
    return rows.groupBy("year", "court", *by).agg(F.count("*").alias("case_count"))


def upsert(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """old with the rows of new in the place of those with their key: the highest version stays."""
    both = old.unionByName(new, allowMissingColumns=True)
    newest = both.groupBy(key).agg(F.max_by(F.struct(*both.columns), version).alias("_r"))  # combined before the shuffle
    return newest.select("_r.*")


def add_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.join(old.select(key), key, "left_anti"), allowMissingColumns=True)


def group_files(files: DataFrame, key: str, path: str, summary: str | None = None) -> DataFrame:
    """A row per case with its sorted paths; a case has few versions."""
    return files.groupBy(key).agg(F.array_sort(F.collect_list(path)).alias("paths"), *([F.min(summary).alias("summary_path")] if summary else []))


def merge_versions(entries: DataFrame, case: str, version: str, position: str, content: list[str]) -> DataFrame:
    """The entries of all versions of a case, each content once: where it first stood."""
    return least_per_key(entries, [case, *content], [version, position])


def member_groups(links: DataFrame, lead: str, member: str) -> DataFrame:
    """Each lead case with its distinct members, sorted."""
    return links.select(lead, member).distinct().groupBy(lead).agg(F.array_sort(F.collect_list(member)).alias("members"))


def label_positions(entries: DataFrame, case: str, label: str, position: str) -> DataFrame:
    """Position of each entry label in its case; of labels that repeat, the last."""
    return entries.groupBy(case, label).agg(F.max(position).alias(position))


def statute_set(df: DataFrame, columns: list[str], name: str = "statutes") -> DataFrame:
    """Several columns collapsed into their sorted set of non-null values."""
    return df.withColumn(name, F.array_sort(F.array_distinct(F.filter(F.array(*columns), lambda x: x.isNotNull())))).drop(*columns)


def multi_flags(cases: DataFrame, mdl: Column, lead: Column, members: Column, other_courts: Column) -> DataFrame:
    return cases.withColumn("is_mdl", F.coalesce(mdl, F.lit(False))).withColumn("is_multi", F.coalesce(mdl, F.lit(False)) | lead.isNotNull() | members.isNotNull() | other_courts.isNotNull())


def case_index(cases: DataFrame, judge_name, root: str | None = None) -> DataFrame:
    """The index of case rows (court, case_id, fpath and fields of a parsed case): court, year, fpath, dates, clean id, type,
    suit, judge and flags, with the key. Files of a third party have the court of their download. What can't be read is null."""
    third = I.is_third_party(F.col("fpath"))
    court = F.when(third, F.col("download_court")).otherwise(F.element_at(F.split(I.std_path(F.col("fpath")), "/"), -4))
    path = I.relative_path(F.col("fpath"), root) if root else I.std_path(F.col("fpath"))
    out = cases.select(court.alias("court"), I.filed_year(F.col("filing_date")).alias("year"), path.alias("fpath"), "filing_date", "terminating_date", I.clean_case_id(F.col("case_id")).alias("case_id"), "case_type", F.coalesce("nature_suit", F.lit("")).alias("nature_suit"), judge_name(F.col("judge")).alias("judge"), "is_multi", "is_mdl", "mdl_code", "is_stub")
    return out.withColumn("ucid", I.ucid(F.col("court"), F.col("case_id"), clean=False))


def read_index(index: DataFrame, fill_criminal: bool = False) -> DataFrame:
    """The index with its dates as days, and ``criminal`` for the suit of criminal cases if asked."""
    out = index.withColumns({c: T.slash_date(F.col(c)) for c in ("filing_date", "terminating_date")})
    return out.withColumn("nature_suit", F.when(F.col("case_type") == "cr", "criminal").otherwise(F.col("nature_suit"))) if fill_criminal else out


def select_cases(index: DataFrame, courts: list[str] | None = None, years: list[int] | None = None, first_court: str | None = None, last_court: str | None = None) -> DataFrame:
    """Index rows of courts (listed, or in an alphabetical range) and years; the folders' names prune what is read."""
    out = index
    for col, some in (("court", courts), ("year", years)):
        out = out.where(F.col(col).isin(*some)) if some else out
    out = out.where(F.col("court") >= first_court) if first_court else out
    return out.where(F.col("court") <= last_court) if last_court else out


def load_cases(cases: DataFrame, wanted: DataFrame, key: str = "ucid", texts: list[str] = ("text",), scrub: bool = True) -> DataFrame:
    """The wanted cases' rows with clean ids, sensitive numbers blanked in their texts unless told not to."""
    out = cases.join(wanted.select(key).distinct(), key, "left_semi")
    out = out.withColumn("case_id", I.clean_case_id(F.col("case_id"))) if "case_id" in out.columns else out
    return out.withColumns({t: T.scrub_sensitive(F.col(t)) for t in texts}) if scrub else out


def entries_by_label(entries: DataFrame, case: str, label: str, position: str, wanted: DataFrame) -> DataFrame:
    """The positions of wanted (case, label) entries; of labels that repeat in a case the last."""
    return label_positions(entries, case, label, position).join(wanted.select(case, label).distinct(), [case, label], "left_semi")


def union_years(years: list[DataFrame], year: str = "year") -> DataFrame:
    """Yearly tables whose columns differ in order, case or presence as one, by upper-cased names."""
    out = None
    for df in years:
        df = df.toDF(*(c if c == year else c.upper() for c in df.columns))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def with_hash(df: DataFrame, text: str, name: str = "hash") -> DataFrame:
    """df with a hash of a text that is the same in every run."""
    return df.withColumn(name, F.xxhash64(text))
