"""Judge, counsel, firm and party entities: dimension files, a case's rows, and links from names of a case to entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of entity files and their keys.
KINDS = {"judge": "SJID", "counsel": "SCID", "firm": "SFID", "party": "SPID"}
JUDGE = "name string, Presentable_Name string, SJID string, SCALES_Judge_Label string, Head_UCIDs array<string>, Tot_UCIDs int, Full_Name string, NID string, BA_MAG_ID string"


def entity_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A dimension of entities, JSON lines."""
    return spark.read.schema(schema).json(path)


def table_file(spark: SparkSession, path: str, schema: str, latin: bool = False) -> DataFrame:
    """A dimension as CSV with a header (cities, firm rankings, companies)."""
    return spark.read.schema(schema).csv(path, header=True, encoding="ISO-8859-1" if latin else "UTF-8")


def padded_id(c: Column, width: int = 10) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def of_cases(entities: DataFrame, wanted: DataFrame, key: str = "ucid") -> DataFrame:
    """The entity rows of the wanted cases; none for cases without any."""
    return entities.join(wanted.select(key).distinct(), key, "left_semi")


def instances(rows: DataFrame, uri: Column, kind: str = "PartyEntity", entity: str = "id", where: Column | None = None) -> DataFrame:
    """(s, p, o, kind): each row's name in its case is an instance of its entity."""
    kept = rows if where is None else rows.where(where)
    return kept.where(F.col(entity).isNotNull()).select(uri.alias("s"), F.lit("isInstanceOfEntity").alias("p"), F.concat(F.lit(f"{kind}/"), F.col(entity).cast("string")).alias("o"), F.lit("uri").alias("kind")).distinct()


def heads(entities: DataFrame, key: str, cases: str = "Head_UCIDs") -> DataFrame:
    """(ucid, entity): the cases that an entity is known by."""
    return entities.select(F.explode(cases).alias("ucid"), F.col(key).alias("entity")).distinct()


def disambiguated(mentions: DataFrame, clusters: DataFrame, on: list[str], entity: str = "entity") -> DataFrame:
    """mentions (names in cases) with the entity of their cluster; null where none is known."""
    known = clusters.groupBy(*on).agg(F.min(entity).alias(entity))
    return mentions.join(known, on, "left")
