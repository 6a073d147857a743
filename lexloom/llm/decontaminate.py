"""Benchmark decontamination with DataFrame functions alone.

The windows of all benchmark items are a set of bounded size, held by every task as a hash set (the optimiser's InSet).
Each document's words are scanned in place: positions of anchor words (the longest word of each window) are found first, the
windows around them are looked up in the set of exact normalised windows, and what remains is matched with its items by a
broadcast join. No window of a clean document ever becomes a row. Above ``max_windows`` the anchors and windows are joined by
a shuffle instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Windows of all items that may be held by every task: about 100 bytes each.
MAX_WINDOWS = 200_000
_HITS = "array<struct<s:int,len:int,win:string>>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What parts words: all of ASCII but letters and digits.
_PARTS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """The words: runs of ASCII letters and digits and anything outside ASCII, A-Z lower-cased; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _PARTS, _UPPER.lower() + " " * len(_PARTS))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def item_windows(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(item_id string, win string, len int, anchor string, at int): an item's distinct windows; fewer words than width, but
    not none, are one window. anchor is the window's longest word, at its first place."""
    w = items.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - width + 1)))
    win = w.select("item_id", "w", at.alias("s")).select("item_id", F.slice("w", F.col("s"), F.lit(width)).alias("p"))
    longest = F.array_max(F.transform("p", lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    return win.select("item_id", F.array_join("p", " ").alias("win"), F.size("p").alias("len"), longest.alias("anchor"), (F.array_position("p", longest) - 1).cast("int").alias("at")).distinct()


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """docs' columns plus _n_words int and _hits array<struct<s, len, win>>: the places (from 0) where a window occurs.

    The words of a hit may repeat and overlap. Null and empty texts have no words and no hits; items without words have no
    window.
    """
    win = item_windows(items, item_id, item_text, width)
    known = win.select("win", "len", "anchor", "at").distinct().limit(max_windows + 1).collect()
    if len(known) > max_windows:
        return _scan_joined(docs, win, text_col)
    lengths: dict[int, dict[str, set]] = {}
    for r in known:
        mine = lengths.setdefault(r.len, {"at": set(), "win": set()})
        mine["at"].add(r["at"])
        mine["win"].add(r.win)
    anchors = sorted({r.anchor for r in known})

    def hits(w: Column) -> Column:
        if not known:
            return F.array().cast(_HITS)
        places = F.when(F.size(w) > 0, F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i).isin(anchors))).otherwise(F.array().cast("array<int>"))
        return _with(places, lambda at: F.concat(*[_windows_at(w, at, n, sorted(k["at"]), sorted(k["win"])) for n, k in sorted(lengths.items())]))

    seen = docs.withColumn("_scan", _with(words(F.col(text_col)), lambda w: F.struct(F.size(w).alias("n"), hits(w).alias("hits"))))
    return seen.withColumn("_n_words", F.col("_scan.n")).withColumn("_hits", F.col("_scan.hits")).drop("_scan")


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once; an expression used inside a lambda would be computed again for each element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _windows_at(w: Column, at: Column, n: int, offsets: list[int], wins: list[str]) -> Column:
    """Hits of windows of n words, whose anchors stand at these offsets, around the places at."""
    shifts = F.array(*[F.lit(x) for x in offsets])
    starts = F.array_distinct(F.flatten(F.transform(at, lambda i: F.transform(shifts, lambda o: i - o))))
    inside = F.filter(starts, lambda s: (s >= 0) & (s + n <= F.size(w)))
    made = F.transform(inside, lambda s: F.struct(s.alias("s"), F.lit(n).alias("len"), F.array_join(F.slice(w, s + 1, n), " ").alias("win")))
    return F.filter(made, lambda h: h["win"].isin(wins))


def _scan_joined(docs: DataFrame, win: DataFrame, text_col: str) -> DataFrame:
    """The same for a set of windows too large to hold: anchor places meet the windows in a shuffled join, which sends each
    candidate back to its document by a row number."""
    base = docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_w", words(F.col(text_col)))
    places = base.select("_row", F.posexplode("_w").alias("_p", "anchor"))
    asked = places.join(win.select("anchor", "at", "len").distinct(), "anchor").select("_row", (F.col("_p") - F.col("at")).alias("s"), "len").where("s >= 0").distinct()
    cut = asked.join(base.select("_row", "_w"), "_row").where(F.col("s") + F.col("len") <= F.size("_w")).select("_row", "s", "len", F.array_join(F.slice("_w", F.col("s") + 1, F.col("len")), " ").alias("win"))
    hits = cut.join(win.select("win").distinct(), "win", "left_semi").groupBy("_row").agg(F.collect_set(F.struct("s", "len", "win")).alias("_hits"))
    empty = F.array().cast(_HITS)
    return base.join(hits, "_row", "left").withColumn("_n_words", F.size("_w")).withColumn("_hits", F.coalesce("_hits", empty)).drop("_row", "_w")


def _hit_places() -> Column:
    return F.array_distinct(F.flatten(F.transform("_hits", lambda h: F.sequence(h["s"], h["s"] + h["len"] - 1))))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """A row per document: doc_id, n_words long, n_hit long (words inside any occurrence of a window), n_items long and
    items_sha256 string (the items with occurring windows), contaminated boolean.

    A repeated id keeps each of its rows. The hash of no items is that of the empty string.
    """
    found = scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), items, "doc_id", "text", item_id, item_text, width, max_windows)
    found = found.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "_n_words", F.size(_hit_places()).alias("_n_hit"), F.array_distinct(F.transform("_hits", lambda h: h["win"])).alias("_wins"))
    win = item_windows(items, item_id, item_text, width).select("item_id", "win").distinct()
    small = win.limit(max_windows + 1).count() <= max_windows
    by = found.select("_row", "doc_id", "_n_words", "_n_hit", F.explode_outer("_wins").alias("win")).join(F.broadcast(win) if small else win, "win", "left")
    out = by.groupBy("_row", "doc_id", "_n_words", "_n_hit").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    return out.select("doc_id", F.col("_n_words").cast("long").alias("n_words"), F.col("_n_hit").cast("long").alias("n_hit"), F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("_n_hit") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WINDOW, whole: bool = False, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """docs with their columns: where windows occur, those spans are cut from the text (the words around keep their exact
    characters), or the whole document goes. Documents without hits are untouched; one with nothing left goes too."""
    found = scan(docs, items, text_col=text_col, item_id=item_id, item_text=item_text, width=width, max_windows=max_windows)
    part = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # the text still has its capitals
    # pieces: a word with what follows it; the first also has what stands before it
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(rf"(?:^{part}*)?{part.replace('[', '[^')}+{part}*"), F.lit(0))
    empty = F.size("_hits") == 0
    gone = F.lit(True) if whole else F.lit(False)

    def without(v: Column) -> Column:
        return F.array_join(F.transform(v["left"], lambda i: F.get(v["p"], i)), "")

    rest = _with(F.struct(pieces.alias("p"), F.array_except(F.sequence(F.lit(0), F.col("_n_words") - 1), _hit_places()).alias("left")), without)
    # kept texts as an array of one or none: a filter would be pushed below the scan and repeat it
    kept = F.when(empty, F.array(F.col(text_col))).otherwise(F.when(gone, F.array().cast("array<string>")).otherwise(F.filter(F.array(rest), lambda x: F.trim(x) != "")))
    return found.select(*[c for c in docs.columns if c != text_col], F.explode(kept).alias(text_col)).select(*docs.columns)
