"""Summary pages: header, civil parties, criminal defendants with their counts and complaints, as one struct a page."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T
from .dom import Node, tree

# Fields that every summary has, empty if the page lacks them; form of a defendant's name and number.
ALWAYS = ("case_id", "case_name", "presiding", "referral", "date_filed", "date_terminated", "date_of_last_filing")
DEFENDANT = re.compile(r"(?s)^(.+?)\s* \((\S+)\)$")
#: Tags nested against each other, and paragraphs that are never closed.
_BROKEN = re.compile(r"<B><U>|</B></U>|<U><B>|</U></B>|</?p>", re.I)
_PAIRS = "map<string,string>"
PARTY = f"role:string,name:string,represented_by:string,contact:{_PAIRS}"
SUMMARY = f"fields:{_PAIRS},parties:array<struct<{PARTY}>>,defendants:array<struct<name:string,ind:string,fields:{_PAIRS},flags:array<string>,counts:array<{_PAIRS}>,complaints:array<{_PAIRS}>,plaintiffs:array<struct<{PARTY}>>>>"


def _words(n: Node) -> str:
    return n.text().replace("\xa0", " ").strip()


def _key(label: str) -> str:
    return "_".join(label.lower().split())


def pairs(cell: Node) -> dict[str, str]:
    """label: value of a cell; of a cell that holds a table, those of all its rows."""
    inner = cell.all("tr") if cell.all("table") else [cell]
    out = {}
    for n in inner:
        label, colon, value = _words(n).partition(":")
        if colon:
            out[_key(label)] = value.strip().replace("  ", " ")
    return out


def people(table: Node) -> list[dict]:
    """Rows of ``role: name``, perhaps followed by who represents it and how to reach them."""
    out = []
    for cells in table.rows():
        if not cells:
            continue
        role, _, name = _words(cells[0]).partition(":")
        there = len(cells) > 3 and " ".join(_words(cells[1]).split()) == "represented by"
        out.append({"role": _key(role), "name": name.strip().replace("  ", " "), "represented_by": _words(cells[2]) if there else None, "contact": pairs(cells[3]) if there else {}})
    return out


def _header(center: Node) -> dict[str, str]:
    values = [v for v in ((k if isinstance(k, str) else k.text()).replace("\xa0", " ").strip() for k in center.kids) if v]
    out = dict(zip(("case_id", "case_name"), values, strict=False))
    rest = values[2:]
    for key, mark in (("presiding", "presiding"), ("referral", "referr")):
        if rest and mark in rest[0]:
            out[key] = rest.pop(0)
    out.update({_key(label.rstrip(":")): value for label, value in zip(rest[::2], rest[1::2], strict=False)})
    return out


def _defendant(table: Node, others: Node | None) -> dict:
    fields: dict[str, str] = {}
    found: dict[str, list[dict]] = {"counts": [], "complaints": []}
    name = ind = None
    waiting: tuple[str, dict] | None = None  # a count or complaint whose text is the next row
    for i, cells in enumerate(table.rows()):
        words = " ".join(w for w in map(_words, cells) if w)
        if not words:
            continue
        if i == 0:
            m = DEFENDANT.match(words)
            name, ind = (m[1].strip().replace("  ", " "), m[2]) if m else (words, None)
        elif words.startswith("Count:"):
            waiting = "counts", {k: v for c in cells for k, v in pairs(c).items()}
        elif words.startswith("Complaint") and waiting is None:
            waiting = "complaints", {k: v for c in cells[1:] for k, v in pairs(c).items()}
        elif waiting is not None:
            found[waiting[0]].append(waiting[1] | {"text": words})
            waiting = None
        elif words.startswith("Magistrate"):
            label, _, value = words.partition(":")
            fields[_key(label)] = value.strip()
        else:
            for c in cells:
                fields.update(pairs(c))
    flags = fields.pop("flag", fields.pop("flags", "")).split(",")
    if "other_court_cases" in fields:
        fields["other_court_case"] = fields.pop("other_court_cases")
    return {"name": name, "ind": ind, "fields": fields, "flags": [x.strip() for x in flags if x.strip()], **found, "plaintiffs": people(others) if others else []}


def read_summary(page: str | None) -> dict:
    root = tree(_BROKEN.sub("", page or ""))
    main = next((n for n in root.all("div") if n.attrs.get("id") == "cmecfMainContent"), root)
    center = next(iter(main.all("center")), None)
    fields = dict.fromkeys(ALWAYS, "") | (_header(center) if center else {})
    tables = [k for k in main.kids if isinstance(k, Node) and k.tag == "table"]
    out: dict = {"fields": fields, "parties": [], "defendants": []}
    kind = re.search(r":\d{2}-([A-Za-z]{1,4})-\d{3}", fields["case_id"])
    if kind and kind[1] == "cr":
        out["defendants"] = [_defendant(t, tables[i + 1] if i + 1 < len(tables) else None) for i, t in enumerate(tables) if i % 2 == 0]
    elif kind and kind[1] == "cv" and tables:
        last = None
        for cells in tables[0].rows():
            for c in cells:
                if ":" in _words(c) and (c.all("b") or last is None):
                    got = pairs(c)
                    fields.update(got)
                    last = next(reversed(got), last)
                elif last and _words(c):
                    fields[last] = _words(c)
        out["parties"] = people(tables[1]) if len(tables) > 1 else []
    return out


def summaries(html: Column) -> Column:
    """struct<fields, parties, defendants> of summary pages; a page of another kind has the fields that it shows."""

    @F.pandas_udf(f"struct<{SUMMARY}>")
    def read(html: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_summary(x) for x in html], columns=["fields", "parties", "defendants"])

    return read(html)


def summary_receipt(html: Column) -> Column:
    """billable_pages, cost and download_timestamp (empty without a receipt) of a summary page."""
    r = T.transaction(html)
    return F.struct(r["billable_pages"].alias("billable_pages"), r["cost"].alias("cost"), F.coalesce(r["timestamp"], F.lit("")).alias("download_timestamp"))
