"""Member and lead cases as a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids as I


def member_rows(cases: DataFrame) -> DataFrame:
    """(member, member_id, court, lead, lead_case_id) of case rows that list members."""
    return cases.where("member_case_key is not null").select(F.explode("members").alias("m"), "court", F.col("member_case_key").alias("lead"), "lead_case_id").select("m.member", "m.member_id", "court", "lead", "lead_case_id")


def add_members(links: DataFrame, new: DataFrame) -> DataFrame:
    """links with those of the new ones whose lead has none yet; each pair of member and lead once."""
    return tidy_members(links.unionByName(new.join(links.select("lead").distinct(), "lead", "left_anti")))


def tidy_members(links: DataFrame) -> DataFrame:
    """One row for each member and lead: of several the smallest, so that the choice doesn't hang on the order of files."""
    rest = [c for c in links.columns if c not in ("member", "lead")]
    return links.groupBy("member", "lead").agg(F.min(F.struct(*rest)).alias("r")).select("member", "lead", *(F.col(f"r.{c}").alias(c) for c in rest))


def seen_members(links: DataFrame, court: str) -> DataFrame:
    return links.where(F.col("court") == court).select("member").distinct()


def member_requests(rows: DataFrame, court: str) -> DataFrame:
    """Distinct requests (ucid, case_no, pacer_id) of a court: those whose key is of the court, and those by the site's id."""
    own = I.parse_ucid(F.col("ucid"))["court"] == court
    return rows.where(F.coalesce(own, F.lit(False)) | F.col("pacer_id").isNotNull()).distinct()
