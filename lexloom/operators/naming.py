"""Names of parties in docket texts: whole names, and surnames with the given names, initials and suffixes round them."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parties import redact

# Suffixes of a name, offices before one, and bodies that an office belongs to.
SUFFIXES = frozenset("sr jr ii iii iv v md phd esq dds cpa rn".split())
AFFIXES = ("trustee", "executor", "administrator", "officer", "warden", "sheriff", "sergeant", "captain", "doctor", "dr", "mr", "mrs", "ms")
POSTS, BODIES = ("director", "secretary", "commissioner", "administrator"), ("department", "office", "bureau", "board")
EXACT_ONLY = 1000  # parties of a case from which on only whole names are looked for
_OFFICE = re.compile(rf"(?i)(?:{'|'.join(POSTS)})(?: of|,+) (?:the )?(?:{'|'.join(BODIES)})")
_AFFIX = re.compile(rf"(?i)(?:^|\s)(?:{'|'.join(AFFIXES)})[.]?(?:\s|$)")
_MARKS = ".,:;"


def clean_name(name: str) -> str:
    """Lower case without offices, accents, numbers and marks; sr and jr in one form, blanks single."""
    name = name.strip()
    for pattern in (_OFFICE, _AFFIX):
        m = pattern.search(name)
        if m:  # an office at the end leaves what is before it, another what follows
            name = name[: m.start()] if m.end() >= len(name) else name[m.end() :]
    name = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    name = re.sub(r"(?i)'s(?= )|(?<=s)'(?= )", "", name)
    name = re.sub(r"[0-9{}\[\]()]", "", name)
    name = re.sub(r"[!\"#%&*+,/=?@^_`~$|\\]", " ", name)
    name = re.sub(r"[.](?=\S)", " ", name).replace(".", "")
    name = re.sub(r"'(?=\s|$)|(?<=\s)'|^'|(?:^|(?<=\s))-+(?=\s|$)|^-|-$", "", name)
    name = re.sub(r" ?- ?", "-", name)
    name = re.sub(r"(?i) (?:snr|senior)\b", " sr", name)
    name = re.sub(r"(?i) (?:jnr|junior)\b", " jr", name)
    return " ".join(name.lower().split())


class Anchor:
    """A surname with what may stand before and after it."""

    def __init__(self, name: str):
        words = clean_name(name).split()
        n = len(words)
        while n > 1 and len(words) - n < 2 and words[n - 1] in SUFFIXES:
            n -= 1
        self.surname, self.after = (words[n - 1], words[n:]) if words else ("", [])
        self.before = words[: words.index(self.surname)] if words else []
        self.initials = {w[0] for w in self.before}

    def given(self, word: str) -> bool:
        return word in self.before or word in self.initials or len(word) == 1 and word in self.initials

    def around(self, text: str, start: int, end: int) -> tuple[int, int]:
        """The span of a surname extended over given names before it and over suffixes or given names after it. A bracket ends
        the search; a word that doesn't belong to the name does too."""
        left, tokens = start, list(re.finditer(r"\S+", text[:start]))
        for t in reversed(tokens[len(tokens) - len(self.before) :] if self.before else []):
            if re.search(r"[>)\]}]", t[0]):
                break
            cut = max((t[0].rfind(c) for c in "<([{"), default=-1) + 1
            words = clean_name(t[0][cut:]).split()
            if not words or not all(self.given(w) for w in words):
                break
            left = t.start() + cut
            if cut:
                break
        right = end
        past = re.compile(r"[.,:;]*").match(text, end).end()
        for t in list(re.finditer(r"\S+", text[past:]))[: len(self.after) + len(self.before)]:
            if re.search(r"[<(\[{]", t[0]):
                break
            cut = min((t[0].find(c) for c in ">)]}" if c in t[0]), default=len(t[0]))
            words = clean_name(t[0][:cut]).split()
            if not words or not all(w in self.after or self.given(w) for w in words):
                break
            right = past + t.start() + cut
            if cut < len(t[0]):
                break
        return left, right


def _unmarked(text: str, start: int, end: int) -> tuple[int, int]:
    while end > start and text[end - 1] in _MARKS:
        end -= 1
    return start, end


def spans_in(name: str, text: str, exact_only: bool = False) -> list[tuple[int, int]]:
    """Where a text speaks of a name, whole or by its surname; surnames of one letter are not looked for."""
    whole = [(m.start(), m.end()) for m in re.finditer(rf"(?i)(?<!\w){re.escape(name.strip())}(?:'s)?(?!\w)", text)] if name.strip() else []
    out = set(whole)
    a = Anchor(name)
    if not exact_only and len(a.surname) > 1 and a.surname in text.lower():
        for m in re.finditer(rf"(?i)(?<!\w){re.escape(a.surname)}(?:'s)?(?!\w)", text):
            if not any(s <= m.start() and m.end() <= e for s, e in whole):
                out.add(_unmarked(text, *a.around(text, m.start(), m.end())))
    return sorted(out)


def tag_names(entries: DataFrame, names: DataFrame, on: list[str], text: str = "text", name: str = "name") -> DataFrame:
    """(on, entry columns, name, start, end): the spans of each case's names in its entries. Cases with over EXACT_ONLY names
    are searched for whole names alone. The surname must stand in the entry, which is tested before any Python runs."""
    last = F.element_at(F.split(F.lower(F.trim(F.regexp_replace(name, r"(?i)[,.]|\b(?:jr|sr|ii|iii|iv|esq|md|phd)\b", ""))), r"\s+"), -1)
    many = names.groupBy(*on).agg((F.count("*") > EXACT_ONLY).alias("_many"))
    both = entries.join(names.join(many, on).withColumn("_last", last), on).where(F.lower(text).contains(F.col("_last")))

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def run(n: pd.Series, t: pd.Series, many: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b} for a, b in spans_in(x, y, bool(z))] for x, y, z in zip(n, t, many, strict=True)], dtype=object)

    return both.withColumn("_s", F.explode(run(name, text, "_many"))).withColumn("start", F.col("_s.start")).withColumn("end", F.col("_s.end")).drop("_s", "_last", "_many")


def short_hash(name: Column, extra: Column) -> Column:
    """The first seven characters of a party's hash."""
    return F.substring(F.upper(F.md5(F.concat_ws(" | ", name, extra).cast("binary"))), 1, 7)


def redact_entries(entries: DataFrame, tags: DataFrame, keys: list[str], text: str = "text", label: str = "label") -> DataFrame:
    """entries with redacted: the tagged spans (keys, start, end, label) replaced, from right to left. A span inside another is
    skipped; equal spans of several parties are replaced by all their labels, joined by ``or``."""
    same = tags.groupBy(*keys, "start", "end").agg(F.array_join(F.array_sort(F.collect_set(label)), " or ").alias("label"))
    by = same.groupBy(*keys).agg(F.collect_list(F.struct("start", "end", "label")).alias("_spans"))
    inner = F.filter("_spans", lambda s: ~F.exists("_spans", lambda o: ((o["start"] < s["start"]) & (o["end"] >= s["end"])) | ((o["start"] <= s["start"]) & (o["end"] > s["end"]))))
    return entries.join(by, keys, "left").withColumn("redacted", F.when(F.col("_spans").isNull(), F.col(text)).otherwise(redact(F.col(text), inner))).drop("_spans")
