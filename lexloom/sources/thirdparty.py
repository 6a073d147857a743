"""Cases of a third party's dump in the shape of parsed ones, by expressions over its nested columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids as I
from ..functions import text as T
from .parties import ROLES, contact_of

LAWYER = "name:string,contact_raw:string,roles:array<int>"
PARTY_TYPE = "docket_id:bigint,name:string,date_terminated:string,extra_info:string,criminal_counts:string,criminal_complaints:string,highest_offense_level_opening:string,highest_offense_level_terminated:string"
DOCUMENT = "document_type:int,attachment_number:int,pacer_doc_id:string,description:string,is_available:boolean,page_count:int,filepath_ia:string,filepath_local:string"
SCHEMA = f"id bigint, court string, docket_number string, case_name string, assigned_to_str string, referred_to_str string, date_filed string, date_terminated string, cause string, jurisdiction_type string, jury_demand string, nature_of_suit string, parties array<struct<name:string,extra_info:string,party_types:array<struct<{PARTY_TYPE}>>,attorneys:array<struct<{LAWYER}>>>>, docket_entries array<struct<date_filed:string,entry_number:int,description:string,recap_documents:array<struct<{DOCUMENT}>>>>"
# Codes of a lawyer's roles, and of kinds of documents.
NOTICE, LEAD, PRO_HAC_VICE = 1, 2, 4
LINE, ATTACHMENT = 1, 2


def documents(docs: Column, court: Column) -> Column:
    """An entry's documents by key: 0 for its own, the number of an attachment, else _ and the document's id."""
    base = I.site_url(court, F.lit("doc_link"))

    def one(d: Column) -> Column:
        key = F.when(d["document_type"] == LINE, "0").when((d["document_type"] == ATTACHMENT) & (F.coalesce(d["attachment_number"], F.lit(0)) > 0), d["attachment_number"].cast("string")).otherwise(F.concat(F.lit("_"), d["pacer_doc_id"]))
        there = lambda c: F.when(d["is_available"], d[c]).alias(c)
        return F.struct(key.alias("key"), F.struct(F.concat(base, F.lit("/"), d["pacer_doc_id"]).alias("url"), d["is_available"].alias("is_available"), there("page_count"), there("filepath_ia"), there("filepath_local")).alias("value"))

    pairs = F.transform(F.coalesce(docs, F.array()), one)
    # of documents with one key the last counts
    last = F.filter(F.transform(pairs, lambda p, i: F.struct(p["key"].alias("key"), p["value"].alias("value"), i.alias("i"))), lambda p: F.size(F.filter(F.slice(pairs, p["i"] + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"])) == 0)
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"], p["value"])))


def entries(rows: Column, court: Column, newest_first: bool = False) -> Column:
    """Docket entries; those without a description have their first document's as a short one, those without any go."""
    def one(r: Column) -> Column:
        short = F.get(F.filter(F.transform(F.coalesce(r["recap_documents"], F.array()), lambda d: T.blank_to_null(d["description"])), lambda x: x.isNotNull()), F.lit(0))
        own = T.blank_to_null(r["description"])
        number = F.when(F.coalesce(r["entry_number"], F.lit(0)) != 0, r["entry_number"].cast("string")).otherwise("")
        return F.struct(F.date_format(T.iso_date(r["date_filed"]), "MM/dd/yyyy").alias("date_filed"), number.alias("ind"), own.alias("docket_text"), F.when(own.isNull(), short).alias("description_short"), documents(r["recap_documents"], court).alias("documents"))

    out = F.filter(F.transform(F.coalesce(rows, F.array()), one), lambda e: e["docket_text"].isNotNull() | e["description_short"].isNotNull())
    return F.reverse(out) if newest_first else out


def role_titles(name: Column) -> Column:
    title, kind = name, F.lit("misc")
    for role, (t, k) in ROLES.items():
        title, kind = F.when(name == role, t).otherwise(title), F.when(name == role, k).otherwise(kind)
    return F.struct(title.alias("role"), kind.alias("party_type"))


def party_rows(cases: DataFrame) -> DataFrame:
    """(id, party_ind, name, role, party_type, info, terminating_date): a row for each party. The role is that of the case's own
    entry; what a party says about itself goes where its entries for several cases disagree, as it was then copied."""
    p = cases.select("id", F.posexplode("parties").alias("party_ind", "p"))
    types = F.coalesce(F.col("p.party_types"), F.array())
    own = F.get(F.filter(types, lambda t: t["docket_id"] == F.col("id")), F.lit(0))
    about = lambda t: F.struct(t["extra_info"], t["date_terminated"], t["name"], t["criminal_counts"], t["criminal_complaints"], t["highest_offense_level_opening"], t["highest_offense_level_terminated"])
    torn = (F.size(types) > 1) & (F.size(F.array_distinct(F.transform(types, about))) > 1)
    ended = T.terminated(F.coalesce(F.col("p.extra_info"), F.lit("")))["day"]
    r = role_titles(own["name"])
    return p.select("id", "party_ind", T.blank_to_null(F.col("p.name")).alias("name"), r["role"].alias("role"), r["party_type"].alias("party_type"), F.when(~torn, T.blank_to_null(F.col("p.extra_info"))).alias("info"), F.when(~torn, ended).alias("terminating_date"))


def counsel_rows(cases: DataFrame) -> DataFrame:
    """(id, party_ind, counsel_ind, name, office_name, address, phone, fax, email, flags): a row for each lawyer of a party. A
    lawyer who only repeats the party that stands for itself has no office."""
    p = cases.select("id", F.posexplode("parties").alias("party_ind", "p")).select("id", "party_ind", F.col("p.name").alias("party"), F.posexplode("p.attorneys").alias("counsel_ind", "a"))
    lines = F.filter(F.transform(F.split(F.coalesce(F.col("a.contact_raw"), F.lit("")), "\n"), T.lawyer_line), lambda x: (x != "") & ~x.contains("PRO SE"))
    c = p.withColumn("c", contact_of(lines)).withColumn("is_pro_se", F.coalesce(F.col("a.contact_raw"), F.lit("")).contains("PRO SE"))
    has = lambda code, n: F.coalesce(F.array_contains("a.roles", code), F.lit(False)).alias(n)
    same = F.col("is_pro_se") & F.coalesce(F.col("a.name") == F.col("party"), F.lit(False))
    return c.select("id", "party_ind", "counsel_ind", T.blank_to_null(F.col("a.name")).alias("name"), F.when(~same, F.col("c.office_name")).alias("office_name"), "c.address", "c.phone", "c.fax", "c.email", "is_pro_se", has(LEAD, "is_lead_attorney"), has(PRO_HAC_VICE, "is_pro_hac_vice"), has(NOTICE, "is_notice_attorney"))


def remap(cases: DataFrame, every_type: bool = False, newest_first: bool = True) -> DataFrame:
    """Case rows of the dump's cases: civil ones, or all. Parties and counsel are rows of their own (see above)."""
    short = F.element_at(F.split(F.btrim(F.col("court"), F.lit("/")), "/"), -1)
    court = F.when(F.col("court").contains("http"), short).otherwise(F.col("court"))
    key = I.ucid(F.col("court"), F.col("docket_number"))
    odd = (key == "neb;;") | key.rlike(r"^insb;;0:[0-9]{2}-bk-[a-z]{3}[0-9]{2}")
    key = F.when(odd, F.concat(F.split_part(key, F.lit(";;"), F.lit(1)), F.lit(";;0:noyear-bk-noid"), F.col("id").cast("string"))).otherwise(key)
    day = lambda c: F.date_format(T.iso_date(F.col(c)), "MM/dd/yyyy")
    out = cases.select(
        key.alias("ucid"), T.blank_to_null(F.col("docket_number")).alias("case_id"), T.blank_to_null(F.col("case_name")).alias("case_name"), F.split_part(key, F.lit("-"), F.lit(2)).alias("case_type"), T.blank_to_null(court).alias("court"),
        F.when(day("date_terminated").isNull(), "open").otherwise("closed").alias("case_status"), day("date_filed").alias("filing_date"), day("date_terminated").alias("terminating_date"),
        F.nullif(T.blank_to_null(F.col("assigned_to_str")), F.lit("Unassigned")).alias("judge"), F.filter(F.array("referred_to_str"), lambda x: x.isNotNull() & (x != "")).alias("referred_judges"),
        T.blank_to_null(F.col("cause")).alias("cause"), T.blank_to_null(F.col("jurisdiction_type")).alias("jurisdiction"), T.blank_to_null(F.col("jury_demand")).alias("jury_demand"), T.blank_to_null(F.col("nature_of_suit")).alias("nature_suit"),
        F.col("id").alias("recap_id"), entries(F.col("docket_entries"), F.col("court"), newest_first).alias("docket"), F.lit("recap").alias("source"),
    )
    return out if every_type else out.where("case_type = 'cv'")


def dump_index(cases: DataFrame) -> DataFrame:
    """The dump's cases as an index: id, court, clean id, name, dates, nature of suit and judge."""
    return cases.select("id", "court", I.clean_case_id(F.col("docket_number")).alias("case_id"), "case_name", "date_filed", "date_terminated", "nature_of_suit", "assigned_to_str")
