"""Joins with outside tables: statistics by case key, multi-district lists, codes, names."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .index import least_per_key, small


def two_stage(cases: DataFrame, stats: DataFrame, key: str = "ucid", weak: str = "ucid_weak", case_day: str = "filing_date", stat_day: str = "filedate", unique: bool = False) -> DataFrame:
    """cases with statistics rows: by the full key first, what is left by the weak key and the filing day against rows not
    used yet. stage says which. Of statistics rows with one key the earliest counts. unique: one row a case in stage two."""
    cols = [c for c in stats.columns if c not in (key, weak, stat_day)]
    s = least_per_key(stats, [key], [stat_day])
    one = cases.join(s.drop(weak, stat_day), key).withColumn("stage", F.lit(1))
    rest = cases.join(s.select(key), key, "left_anti")
    free = s.join(cases.select(key), key, "left_anti").withColumnRenamed(stat_day, case_day).drop(key)
    two = rest.join(free, [weak, case_day]).withColumn("stage", F.lit(2))
    if unique:
        two = least_per_key(two, [key], cols)
    return one.unionByName(two)


def mdl_all(terminated: DataFrame, pending: DataFrame, key: str = "mdl_no") -> DataFrame:
    """Terminated lists, then pending ones that aren't among them, with their status."""
    return terminated.withColumn("status", F.lit("terminated")).unionByName(pending.join(terminated.select(key), key, "left_anti").withColumn("status", F.lit("pending")), allowMissingColumns=True)


def match_codes(texts: DataFrame, text: str, codes: DataFrame, number: str, name: str) -> DataFrame:
    """texts with the code whose name shares most of the text's words: the first such code by number, where the share is over
    a half, or a half of more than two words. Texts that begin with a number get exactly that code. codes is a dimension
    table, sent to every task word by word."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.translate(text, "():-", "    ")), r"\s+"), lambda w: w != ""))
    keyed = texts.withColumn("_row", F.xxhash64(text)).withColumn("_w", words).withColumn("_number", F.regexp_extract(text, r"^\s*([0-9]+)", 1).try_cast("int"))
    distinct = keyed.select("_row", "_w", "_number").dropDuplicates(["_row"])
    by_word = small(codes.select(F.col(number).alias("_code"), F.explode(F.array_distinct(F.split(F.lower(name), r"\s+"))).alias("_word")))
    hits = distinct.where("_number is null").select("_row", F.size("_w").alias("_k"), F.explode("_w").alias("_word")).join(by_word, "_word").groupBy("_row", "_k", "_code").agg(F.count("*").alias("_n"))
    good = hits.where((F.col("_n") * 2 > F.col("_k")) | ((F.col("_n") * 2 >= F.col("_k")) & (F.col("_k") > 2)))
    best = good.groupBy("_row").agg(F.max_by("_code", F.struct("_n", -F.col("_code"))).alias("_best"))
    exact = small(codes.select(F.col(number).alias("_number"), F.col(number).alias("_exact")).distinct())
    return keyed.join(best, "_row", "left").join(exact, "_number", "left").withColumn("code", F.when(F.col("_number").isNull(), F.col("_best")).otherwise(F.col("_exact"))).drop("_row", "_w", "_number", "_best", "_exact")


def classify_court(c: Column, states: dict[str, str], cardinals: tuple[str, ...] = ("northern", "southern", "eastern", "western", "middle", "central")) -> Column:
    """A court's abbreviation from its name: state code, first letter of the direction, d. Abbreviations stay; Columbia is dcd."""
    x = F.lower(c)
    state = F.regexp_extract(x, "(" + "|".join(sorted(states, key=lambda s: (-len(s), s))) + ")", 1)
    code = F.lit(None).cast("string")
    for name, short in states.items():
        code = F.when(state == name, short.lower()).otherwise(code)
    side = F.substring(F.regexp_extract(x, "(" + "|".join(cardinals) + ")", 1), 1, 1)
    return F.when(x.contains("columbia"), "dcd").when(x.rlike(r"^[a-z]{3,4}$"), x).otherwise(F.concat(code, side, F.lit("d")))


#: Queries that are held by every task at a time: a block of so many.
QUERY_BLOCK = 4096


def cosine_top(vectors: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str, floor: float = 0.0) -> DataFrame:
    """(left, right, similarity): the k most similar other vectors of each query, the smaller id on ties. A stated query set
    against all rows: blocks of queries of fixed size are sent to the tasks one after the other, vectors meet them as a matrix
    product for each Arrow batch, and only a batch's k best for each query leave it."""
    import numpy as np
    import pyarrow as pa

    spark = vectors.sparkSession
    some = queries.select(F.col(id_col).cast("long").alias("left"), F.col(vector_col).cast("array<double>").alias("v"))
    blocks = max(1, -(-some.count() // QUERY_BLOCK))
    unit = lambda rows: (m := np.array(rows, float)) / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-300)
    parts = None
    for b in range(blocks):
        block = some.where(F.pmod(F.xxhash64("left"), F.lit(blocks)) == b).toArrow()
        if not block.num_rows:
            continue
        held = spark.sparkContext.broadcast((block["left"].to_numpy(), unit(block["v"].to_pylist())))

        def best(batches, held=held):
            ids, q = held.value
            for x in batches:
                if not x.num_rows:
                    continue
                right = x.column(0).to_numpy()
                s = q @ unit(x.column(1).to_pylist()).T
                s[ids[:, None] == right] = -2.0
                # the k best of the batch; with what equals the last of them, so that ties are left to the ids
                last = -np.partition(-s, min(k, s.shape[1]) - 1, axis=1)[:, min(k, s.shape[1]) - 1]
                i, j = np.nonzero((s >= last[:, None]) & (s > floor))
                yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(right[j]), pa.array(s[i, j])], ["left", "right", "similarity"])

        part = vectors.select(F.col(id_col).cast("long").alias("right"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(best, "left long, right long, similarity double")
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return spark.createDataFrame([], "left long, right long, similarity double")
    w = Window.partitionBy("left").orderBy(F.desc("similarity"), "right")
    return parts.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")


def pro_se(parties: DataFrame, party: str, counsel: str, info: str) -> DataFrame:
    """Whether a party stands for itself: its counsel says so, or is called the same."""
    plain = lambda c: F.trim(F.regexp_replace(F.lower(c), "[^a-z ]", ""))
    return parties.withColumn("is_pro_se", F.coalesce(F.upper(info).contains("PRO SE"), F.lit(False)) | F.coalesce((plain(F.col(party)) == plain(F.col(counsel))) & (plain(F.col(party)) != ""), F.lit(False)))


#: Names of at most so many characters are compared by parts.
SHORT = 8


def _ratio(a: str, b: str) -> float:
    """Share of matching characters of two texts, in hundredths: twice the longest common subsequence over their lengths."""
    if not a or not b:
        return 0.0
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return 200 * row[-1] / (len(a) + len(b))


def token_set_ratio(a: str, b: str, partial: bool = False) -> float:
    """Likeness of two names whose words may be in any order: the shared words alone or with either's others; partial: 100 if
    any word is shared, else the best match of the shorter text with a part of the longer."""
    x, y = (set("".join(c if c.isalnum() else " " for c in t.lower()).split()) for t in (a, b))
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if partial:
        if both:
            return 100.0
        short, long = sorted((left, right), key=len)
        return max((_ratio(short, long[i : i + len(short)]) for i in range(len(long) - len(short) + 1)), default=0.0) if short else 0.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max(_ratio(both, one) if both else 0.0, _ratio(both, two) if both else 0.0, _ratio(one, two))


def fuzzy_name(name: str | None, others: list[str | None], threshold: float = 85) -> int | None:
    """Index of the most similar of the other names, the first of equals; none under the threshold, for the USA, or for initials.
    From the first short name on, parts are compared."""
    if not name or name.lower().strip() == "usa" or all(len(t) == 1 for t in name.replace(".", " ").split()):
        return None
    partial, best, at = len(name) <= SHORT, threshold, None
    for i, other in enumerate(others):
        if other:
            partial = partial or len(other) <= SHORT
            score = token_set_ratio(other, name, partial)
            if score > best or score >= best and at is None:
                best, at = score, i
    return at


def pro_se_counsel(parties: DataFrame, name: str = "name", counsel: str = "counsel") -> DataFrame:
    """parties with pro_se_index: which of its counsel (array<struct<name, info, is_pro_se>>) a party itself is. The only one, if
    any says so; of several the only one whose name or notes say PRO SE; else one of the same name; else the most similar."""
    c, plain = F.col(counsel), lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))
    said = F.exists(c, lambda x: F.coalesce(x["is_pro_se"], F.lit(False)))
    places = F.filter(F.transform(c, lambda x, i: F.when(F.concat_ws("\n", x["name"], x["info"]).contains("PRO SE"), i)), lambda i: i.isNotNull())
    same = F.array_position(F.transform(c, lambda x: F.coalesce(plain(x["name"]) == plain(F.col(name)), F.lit(False))), F.lit(True)) - 1

    @F.pandas_udf("int")
    def fuzzy(n: pd.Series, others: pd.Series) -> pd.Series:
        return pd.Series([fuzzy_name(x, [] if y is None else list(y)) for x, y in zip(n, others, strict=True)], dtype="Int32")

    sure = F.when(said & (F.size(c) == 1), 0).when(said & (F.size(places) == 1), places[0]).when(same >= 0, same)
    out = parties.withColumn("_sure", F.when(F.coalesce(F.size(c), F.lit(0)) > 0, sure).cast("int"))
    names = F.when(F.col("_sure").isNull(), F.transform(c, lambda x: x["name"]))
    return out.withColumn("pro_se_index", F.coalesce("_sure", fuzzy(F.col(name), names))).drop("_sure")


# What stands for no value in the statistics.
NO_VALUE = ("-8", "-8.0", "")


def statistic(c: Column) -> Column:
    """A value of the statistics: whole numbers as such, -8 and empty as null, other text as it is."""
    x = F.trim(c.cast("string"))
    return F.when(x.isin(*NO_VALUE) | x.isNull(), None).when(x.rlike(r"^[0-9]+[.][0-9]+$"), x.try_cast("double").try_cast("bigint").cast("string")).otherwise(x)


def statistics_struct(stats: DataFrame, renamed: dict[str, str], case_type: str, dates: list[str] = ()) -> DataFrame:
    """stats with idb_data: their columns by new names, with the sides: those named in civil cases, the government against the
    defendant in criminal ones."""
    value = lambda c: F.date_format(c, "yyyy-MM-dd") if c in dates else statistic(F.col(c))
    sides = [("plaintiff", F.col("plt") if case_type == "cv" else F.lit("USA")), ("defendant", F.col("def") if case_type == "cv" else F.col("name"))]
    return stats.withColumn("idb_data", F.struct(*(value(c).alias(n) for c, n in renamed.items()), *(v.alias(n) for n, v in sides)))


def statistics_columns(case_type: str, columns: list[str]) -> list[str]:
    """The columns that a kind of case has."""
    return [c for c in columns if c != "name"] if case_type == "cv" else ["docket", "filedate", "termdate", "office", "circuit", "district", "county", "tapeyear", "name"]


def attach_statistics(cases: DataFrame, stats: DataFrame, key: str = "ucid") -> DataFrame:
    """cases with the statistics of their key; those of a third party take the dates from them."""
    s = stats.groupBy(key).agg(F.min_by("idb_data", F.to_json("idb_data")).alias("idb_data"))
    return cases.join(s, key, "left")


def split_years(stats: DataFrame, case_type: str, court: Column, since: int = 0, year: str = "DOCKET") -> DataFrame:
    """stats with ucid, ucid_weak and split_year in front, for a write by year: the docket's year, or that of the filing. Rows
    filed before ``since`` go."""
    from ..functions import ids as I

    filed = F.element_at(F.split("FILEDATE", "/"), -1).try_cast("int")
    split = filed.cast("string") if year == "FILEDATE" else F.substring("DOCKET", 1, 2)
    key = I.ucid_from_parts(court, F.col("OFFICE"), F.substring("DOCKET", 1, 2), F.lit(case_type), F.expr("substring(DOCKET, 3)"))
    return stats.where(filed >= since).select(key.alias("ucid"), I.weak_ucid(key).alias("ucid_weak"), split.alias("split_year"), *stats.columns)
