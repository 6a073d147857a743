"""Courts and natures of suit: names, abbreviations, full titles, clean values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Directions in a court's name.
CARDINALS = ("northern", "southern", "eastern", "western", "central", "middle")


def court_name(cardinal: Column, state: Column) -> Column:
    """cardinal-state in lower case with dashes; the state alone without a direction."""
    return F.translate(F.lower(F.concat_ws("-", cardinal, state)), " ", "-")


def full_title(cardinal: Column, state: Column) -> Column:
    return F.concat(F.lit("U.S. District Court for the "), F.coalesce(F.concat(cardinal, F.lit(" ")), F.lit("")), F.lit("District of "), state)


def name_key(name: Column, ordinal_first: bool = True) -> Column:
    """A court's written name as in the table of courts: without ``district`` (but for Columbia), the direction first."""
    x = F.when(name.contains("district") & ~name.contains("columbia"), F.rtrim(F.replace(name, F.lit("district"), F.lit("")))).otherwise(name)
    if not ordinal_first:
        words = F.split(x, r"\s+")
        x = F.when(F.element_at(words, -1).isin(*CARDINALS), F.concat_ws(" ", F.element_at(words, -1), F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), " "))).otherwise(x)
    return F.translate(F.lower(F.trim(x)), " ", "-")


def court_table(courts: DataFrame) -> DataFrame:
    """courts (abbreviation, cardinal, state) with courtname and title. A dimension: one row for each court there is."""
    return courts.withColumn("courtname", court_name(F.col("cardinal"), F.col("state"))).withColumn("title", full_title(F.col("cardinal"), F.col("state")))


def with_court(df: DataFrame, courts: DataFrame, name: str, ordinal_first: bool = True) -> DataFrame:
    """df with the abbreviation of the court it names; null for unknown names."""
    known = court_table(courts).select(F.col("courtname").alias("_key"), "abbreviation")
    return df.withColumn("_key", name_key(F.col(name), ordinal_first)).join(known, "_key", "left").drop("_key")


def suit_code(c: Column) -> Column:
    """The first two or three digits of a nature of suit."""
    return F.nullif(F.regexp_extract(c, "([0-9]{2,3})", 1), F.lit(""))


def path_court(path: Column, renamed: dict[str, str] | None = None, place: int = -3) -> Column:
    """The court that a file's folder is named after; some folders have another name than their court."""
    folder = F.get(F.reverse(F.split(path, "/")), F.lit(-place - 1))
    out = folder
    for old, new in (renamed or {}).items():
        out = F.when(folder == old, new).otherwise(out)
    return out


def day_or_first(c: Column) -> Column:
    """A month/day/year text as a day; 1900-01-01 if it is none."""
    return F.coalesce(F.to_date(F.try_to_timestamp(c, F.lit("M/d/yyyy"))), F.lit("1900-01-01").cast("date"))


def as_text(c: Column) -> Column:
    """The value as text, empty for none."""
    return F.coalesce(c.cast("string"), F.lit(""))
