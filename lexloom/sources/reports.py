"""Reports that come as tables of a page: query results, links to documents, lists of multi-district litigation."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import ids as I
from ..functions import text as T
from .dom import tree


def table_rows(pages: DataFrame, key: str, html: str = "html", first_only: bool = False) -> DataFrame:
    """(key, table_idx, row_idx, cells array<string>) of the pages' tables, cells with single blanks."""

    @F.pandas_udf("array<struct<table_idx:int,row_idx:int,cells:array<string>>>")
    def read(html: pd.Series) -> pd.Series:
        def rows(page):
            found = tree(page).all("table")
            return [{"table_idx": t, "row_idx": r, "cells": [" ".join(c.text().replace("\xa0", " ").split()) for c in cells]} for t, table in enumerate(found[:1] if first_only else found) for r, cells in enumerate(table.rows())]

        return pd.Series([rows(x) for x in html], dtype=object)

    return pages.select(key, F.explode(read(F.col(html))).alias("r")).select(key, "r.table_idx", "r.row_idx", "r.cells")


def query_report(pages: DataFrame, key: str, court: Column, case_type: str | None = None, html: str = "html") -> DataFrame:
    """(key, case_id, name, details, case_type, clean_id, court, filed, closed) of query result pages: their first table's rows
    with three cells; civil and criminal cases, or those of one type."""
    r = table_rows(pages, key, html, first_only=True).where("size(cells) >= 3").select(key, F.col("cells")[0].alias("case_id"), F.col("cells")[1].alias("name"), F.col("cells")[2].alias("details"))
    r = r.where("case_id <> '' and name <> '' and details <> ''").withColumn("case_type", F.split_part("case_id", F.lit("-"), F.lit(2)))
    r = r.where(F.col("case_type") == case_type) if case_type else r.where(F.col("case_type").isin("cr", "cv"))
    return r.withColumns({"clean_id": I.clean_case_id(F.col("case_id")), "court": court, "filed": T.query_filed(F.col("details")), "closed": T.query_closed(F.col("details"))})


def reported_cases(report: DataFrame, on_disk: DataFrame | None = None) -> DataFrame:
    """(ucid): the distinct cases of a report (defendants of one case are one), of those on disk (ucid) if given."""
    out = report.select(F.concat(F.col("court"), F.lit(";;"), F.col("clean_id")).alias("ucid")).distinct()
    return out if on_disk is None else out.join(on_disk.select("ucid").distinct(), "ucid", "left_semi")


def document_links(entries: DataFrame, key: str, wanted: DataFrame | None = None, attachments: bool = False) -> DataFrame:
    """(key, line, attachment, url) of the documents that entries (key, label, documents map) link to: the line's own has
    attachment 0. Without ``wanted`` (key, doc_no, attachment) all lines' own, and attachments if asked; else those wanted."""
    link = entries.select(key, F.col("label").alias("line"), F.explode("documents").alias("a", "d")).select(key, "line", F.col("a").try_cast("int").alias("attachment"), F.col("d.url").alias("url")).where("attachment is not null and line is not null")
    if wanted is None:
        return link if attachments else link.where("attachment = 0")
    return link.join(wanted.select(key, F.col("doc_no").cast("string").alias("line"), "attachment").distinct(), [key, "line", "attachment"], "left_semi")


def filled(rows: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """rows with the last value before or at each of them, in page order."""
    w = Window.partitionBy(key).orderBy("table_idx", "row_idx").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def whole_number(c: Column) -> Column:
    """A number with commas; null for empty text."""
    return F.replace(c, F.lit(",")).try_cast("int")


def mdl_terminated(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(district, mdl_no, caption, judge, transferred, filed, closed, remanded, year_termination) of reports on terminated lists.
    A row that begins with a number names the district of the rows after it; data rows have an empty and a numeric cell."""
    r = table_rows(pages, key, html)
    cell = lambda i: F.get("cells", F.lit(i))
    district = F.when(cell(0).rlike("^[0-9]"), F.lower(cell(2)))
    data = filled(r, key, district, "district").where(cell(0).eqNullSafe("") & F.coalesce(cell(1).rlike("^[0-9]+$"), F.lit(False)))
    number = lambda i, n: whole_number(cell(i)).alias(n)
    return data.select("district", number(1, "mdl_no"), cell(2).alias("caption"), cell(3).alias("judge"), number(4, "transferred"), number(5, "filed"), number(6, "closed"), number(7, "remanded"), number(8, "year_termination"))


def mdl_pending(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(district, judge, mdl_no, caption, actions_pending, actions_total) of reports on pending lists: from the first row whose
    second cell is in capitals up to the totals. A row that lacks its district has the one before it."""
    r = table_rows(pages, key, html)
    w = Window.partitionBy(key).orderBy("table_idx", "row_idx").rowsBetween(Window.unboundedPreceding, 0)
    cell = lambda i: F.get("cells", F.lit(i))
    capital = F.coalesce((cell(1) == F.upper(cell(1))) & cell(1).rlike("[A-Z]"), F.lit(False))
    totals = F.coalesce(F.lower(cell(0)).startswith("report totals"), F.lit(False))
    short = lambda i: F.when(F.length(cell(i)).between(2, 4), cell(i))
    inside = r.withColumn("_on", F.max(capital).over(w)).withColumn("_over", F.max(totals).over(w)).where("_on and not _over")
    data = filled(inside, key, F.coalesce(short(0), short(1)), "_district").withColumn("c", F.filter("cells", lambda x: x != "")).where("size(c) >= 5")
    row = F.when(F.size("c") == 5, F.concat(F.array("_district"), "c")).otherwise(F.col("c"))
    data = data.select(row.alias("c"))
    last = lambda i, mark: F.trim(F.element_at(F.split(F.col("c")[i], mark), -1))
    return data.select(F.lower(F.concat(F.col("c")[0], F.lit("d"))).alias("district"), F.col("c")[1].alias("judge"), whole_number(last(2, "MDL -")).alias("mdl_no"), last(3, "IN RE: ").alias("caption"), whole_number(F.col("c")[4]).alias("actions_pending"), whole_number(F.col("c")[5]).alias("actions_total"))


def first_per_list(lists: DataFrame) -> DataFrame:
    """One row for each number of a list, the one of the earliest closing."""
    order = F.struct(F.coalesce("closed", F.lit(1 << 30)), *(F.col(c) for c in sorted(lists.columns)))
    return lists.groupBy("mdl_no").agg(F.min_by(F.struct(*lists.columns), order).alias("r")).select("r.*")


def no_docket(html: Column) -> Column:
    """Whether a page says that no proceedings are available."""
    from .cases import NO_DOCKET

    return html.rlike(NO_DOCKET)
