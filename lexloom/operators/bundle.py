"""Annotated docket text and bundles of cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def annotated(text: Column, spans: Column) -> Column:
    """text as markup in which each span (array<struct<start, end, label>>, not overlapping) is a highlighted element."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"))))
    cut = lambda a, b: _escaped(F.substring(text, a + 1, b - a))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, s: F.struct(F.concat(acc["out"], cut(acc["at"], s["start"]), F.lit('<span class="annotation" data-label="'), s["label"], F.lit('">'), cut(s["start"], s["end"]), F.lit("</span>")).alias("out"), s["end"].cast("int").alias("at"))
    return F.aggregate(order, begin, step, lambda acc: F.concat(acc["out"], cut(acc["at"], F.length(text))))


def annotated_entries(entries: DataFrame, spans: DataFrame, case: str, row: str, text: str = "text") -> DataFrame:
    """entries with docket_html: their text with the spans (case, row, start, end, label) of their row."""
    by = spans.groupBy(case, row).agg(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "label")).alias("_spans"))
    none = F.array().cast("array<struct<start:int,end:int,label:string>>")
    return entries.join(by, [case, row], "left").withColumn("docket_html", annotated(F.col(text), F.coalesce("_spans", none))).drop("_spans")


def excerpt(annotated_rows: DataFrame, row: str, first: int, last: int) -> DataFrame:
    """The annotated entries of a range of rows, both ends included."""
    return annotated_rows.where(F.col(row).between(first, last))


def bundle(index: DataFrame, wanted: DataFrame, key: str = "ucid", notes: str | None = None) -> DataFrame:
    """The index rows of wanted cases (by key or path), with a link column and the bundle's notes."""
    return index.join(wanted.select(key).distinct(), key, "left_semi").withColumn("link", F.concat(F.translate(F.col(key), ";:", "--"), F.lit(".html"))).withColumn("notes", F.lit(notes))


def write_bundle(rows: DataFrame, path: str, html: str = "docket_html") -> None:
    """An HTML file for each task's cases, as text lines, and the index as CSV beside it."""
    rows.select(html).write.mode("overwrite").text(f"{path}/html")
    rows.drop(html).write.mode("overwrite").csv(f"{path}/index", header=True)
