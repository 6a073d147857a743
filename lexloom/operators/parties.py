"""Party classification by word lists, and redaction of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound

#: A small word list: label to words. Real lists are an argument.
LEXICON = {"org": ["inc", "llc", "corp", "company", "bank", "association", "ltd", "lp"], "gov": ["united states", "state of", "county", "city of", "department", "commissioner", "secretary"], "role": ["warden", "sheriff", "officer", "trustee", "administrator", "agent"], "person": ["john", "mary", "james", "doe"]}


def clean_party(c: Column) -> Column:
    """Lower case without punctuation, blanks single and at both ends."""
    x = F.translate(F.lower(F.regexp_replace(c, r"[-\n]", " ")), '.,;:()[]"', "")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(x, r"\s+", " ")), F.lit(" "))


def labels(c: Column, lexicon: dict[str, list[str]] = LEXICON) -> Column:
    """The labels whose words stand in the cleaned text, sorted."""
    x = clean_party(c)
    hit = lambda words: x.rlike("|".join(f" {w} " for w in words))
    return F.array_sort(F.filter(F.array(*(F.when(hit(ws), name) for name, ws in lexicon.items())), lambda v: v.isNotNull()))


def multi_entity(c: Column) -> Column:
    """Wording that names one party for another."""
    return F.lower(c).rlike(r"ex rel|on behalf of|in behalf of|o/b/o|for the use and benefit of|by and through|similarly situated|in his official capacity")


def classify(c: Column, lexicon: dict[str, list[str]] = LEXICON) -> Column:
    """other, multi-entity, government or individual, by the first rule that fits."""
    x, found = clean_party(c), labels(c, lexicon)
    has = lambda k: F.array_contains(found, k)
    return F.when(F.coalesce(F.trim(x), F.lit("")) == "", "other").when(x.rlike(" doing business as | dba | d/b/a "), "other").when(multi_entity(c), "multi-entity").when((F.size(found) > 0) & (F.size(F.array_except(found, F.array(F.lit("person"), F.lit("role")))) == 0), "individual").when(has("gov") & ~has("org"), "government").when(has("org"), "other").when(x.contains(" and ") | x.contains("&"), "other").when(x.contains(" doe "), "individual").otherwise(F.when(F.size(F.split(F.trim(x), " ")) == 1, "other").otherwise("individual"))


def party_hash(name: Column, extra: Column) -> Column:
    return F.upper(F.md5(F.concat_ws(" | ", name, extra).cast("binary")))


def name_spans(entries: DataFrame, names: DataFrame, on: list[str], text: str = "text", name: str = "name") -> DataFrame:
    """(entry columns, name, start, end): every whole-word occurrence of each name in its case's entries. Entries without the
    name fall to the cheap test in the join."""
    both = entries.join(names, on).where(F.lower(text).contains(F.lower(name)))
    cut = F.split(F.concat(F.lit(" "), F.lower(text), F.lit(" ")), F.concat(F.lit(r"(?<![\w])\Q"), F.lower(name), F.lit(r"\E(?![\w])")))
    # after i pieces and i-1 names comes the i-th name; the blank put before the text is taken off again
    ends = lambda c: F.when(F.size(c) > 1, F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda i: F.aggregate(F.slice(c, F.lit(1), i), F.lit(0), lambda a, p: a + F.length(p)) + (i - 1) * F.length(name) - 1)).otherwise(F.array().cast("array<int>"))
    return both.withColumn("start", F.explode(bound(cut, ends))).withColumn("end", F.col("start") + F.length(name))


def redact(text: Column, spans: Column) -> Column:
    """text with spans (array<struct<start, end, label>>) replaced by their labels, from right to left; a span inside one
    already replaced is skipped."""
    order = F.sort_array(F.transform(spans, lambda s: F.struct((-s["start"]).alias("a"), (-s["end"]).alias("b"), s["label"].alias("label"))))
    start = F.struct(text.alias("t"), F.lit(1 << 30).alias("at"))
    step = lambda acc, s: F.when(-s["b"] <= acc["at"], F.struct(F.concat(acc["t"].substr(F.lit(1), -s["a"]), s["label"], acc["t"].substr(1 - s["b"], F.length(acc["t"]))).alias("t"), (-s["a"]).alias("at"))).otherwise(acc)
    return F.aggregate(order, start, step, lambda acc: acc["t"])
