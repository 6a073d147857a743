"""Set-similarity join on word shingles by partition of the universe and the pigeonhole principle.

Two sets X and Y with J(X, Y) >= t differ in at most H = (1-t)/(1+t) * (|X|+|Y|) tokens. Tokens are hashed into segments. With
n segments of threshold 0 (equal subsets) or 1 (subsets at most one token apart, found through one-deletion neighbourhoods),
a similar pair must agree within the threshold of some segment once the thresholds plus one sum to H+1. Sets are put in size
bands a factor 1/t apart, so that only a band and the next one can hold similar sets; each join group is one band with the
next, and :func:`allocate` picks its segments by cost.

Segments of few tokens (empty, or holding only a passage that many documents share) match without likeness. A group of plain
segments therefore has ``spare`` more of them, and each set leaves out its ``spare`` segments of fewest tokens: the order by
(tokens, signature) is the same for both sets of a pair, so at least ``need`` equal segments are kept by both. Nothing is
lost by it, whatever the skew.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch, small_batches
from .shingles import fingerprints, shingle_sets
from .words import U, mix, slices, text_bytes, trimmed

#: Up to so many ids of documents are broadcast as a filter (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Sets that a task remembers to have signed, so that copies are signed once; then it forgets them, which costs rows only.
SEEN = 1_000_000


class Plan(NamedTuple):
    plain: int  # segments with threshold 0
    near: int  # segments with threshold 1
    spare: int  # plain segments that a set leaves out
    need: int  # equal kept segments of any similar pair


def bands(num: int, den: int, most: int) -> np.ndarray:
    """Largest set size of each band, up to one that reaches ``most``; similar sets are in one band or neighbours."""
    his = [1]
    while his[-1] < most:
        his.append(max(his[-1] + 1, his[-1] * den // num))
    return np.array(his)


@lru_cache(None)
def allocate(hi: int, num: int, den: int) -> Plan | None:
    """The cheapest segments for sets of up to ``hi`` tokens with sets up to 1/t larger; None where only equal sets are
    similar. Cost: signatures of a set, and for each segment the chance of a subset too small to tell documents apart."""
    h = (den - num) * (hi + hi * den // num) // (den + num)
    if h == 0:
        return None
    small = lambda tokens: 50 * math.exp(-tokens) * (1 + tokens)
    spare, need = 2 + h // 3, 3
    n = h + spare + need
    best = (n + n * small(hi / n) / 4, Plan(n, 0, spare, need))
    for near in range(1, (h + 1) // 2 + 1 if h < 16 else 0):  # one-deletion neighbourhoods of larger sets cost more than they save
        plain = h + 1 - 2 * near
        n = plain + near
        best = min(best, (plain + near * (1 + hi / n) + n * small(hi / n), Plan(plain, near, 0, 1)))
    return best[1]


#: Low bits of a signature that hold its join group, so that rows are two numbers.
GROUP_BITS = 7


def _finish(lo: np.ndarray, hi: np.ndarray, count: np.ndarray, segment: np.ndarray, group: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        sig = mix(lo.astype(U) + (hi.astype(U) << U(32)) + mix(count.astype(U) * U(0x9FB21C651E98DF25) + segment.astype(U) * U(0xD6E8FEB86659FD93) + group.astype(U) * U(0xA0761D6478BD642F)))
        return (sig >> U(GROUP_BITS) << U(GROUP_BITS)) | group.astype(U)


def signatures(row: np.ndarray, shingle: np.ndarray, size: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, signature) of sets given as (row, shingle), for both join groups of each set's band."""
    if not len(row):
        return
    his = bands(num, den, int(size.max()))
    band = np.searchsorted(his, size)
    for back in (0, 1):
        group = band - back
        plans = {int(g): p for g in np.unique(group[size > 0]) if g >= 0 and (p := allocate(int(his[g]), num, den))}
        if not plans:
            continue
        table = np.zeros((len(his) + 1, 4), np.int64)
        for g, p in plans.items():
            table[g] = p
        use = np.where(group >= 0, table[group, 0] + table[group, 1], 0)
        use[size == 0] = 0
        base = np.concatenate([[0], np.cumsum(use)])
        if not base[-1]:
            continue
        mine = use[row] > 0
        r, s = row[mine], shingle[mine]
        seg = (((s >> U(32)) * use[r].astype(U)) >> U(32)).astype(np.int64)
        at = base[r] + seg
        m = mix(s ^ U(0x589965CC75374CC3))
        lo, hi = (m & U(0x3FFFFFF)).astype(np.float64), (m >> U(38)).astype(np.float64)
        slo, shi, cnt = (np.bincount(at, weights=w, minlength=base[-1]) for w in (lo, hi, None))
        owner = np.repeat(np.arange(len(size)), use)
        segment = np.arange(base[-1]) - base[owner]
        g = group[owner]
        sig = _finish(slo.astype(np.int64), shi.astype(np.int64), cnt, segment, g)
        spare = table[g, 2]
        if spare.any():
            order = np.lexsort((sig, cnt, owner))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order)) - base[owner]
            keep = rank >= spare
        else:
            keep = np.ones(len(sig), bool)
        yield owner[keep], sig[keep]
        near = segment[at] < table[group[r], 1]
        if near.any():
            a = at[near]
            yield r[near], _finish((slo[a] - lo[near]).astype(np.int64), (shi[a] - hi[near]).astype(np.int64), cnt[a] - 1, segment[a], g[a])


def _sizes(docs: DataFrame, width: int, salt: int = 0) -> DataFrame:
    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                row, s = shingle_sets(*text_bytes(b.column(1)), width)
                size, fp, proof = fingerprints(row, s, b.num_rows, salt)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(fp.view(np.int64)), pa.array(proof.view(np.int64))], ["doc_id", "n_shingles", "cls", "proof"])

    return docs.mapInArrow(trimmed(run), "doc_id long, n_shingles long, cls long, proof long")


def _signed(docs: DataFrame, width: int, num: int, den: int, salt: int = 0) -> DataFrame:
    def run(batches):
        seen: set[int] = set()  # sets that this task has signed: copies are dropped before the shuffle
        for batch in batches:
            for b in slices(batch, "text"):
                row, s = shingle_sets(*text_bytes(b.column(1)), width)
                size, fp, _ = fingerprints(row, s, b.num_rows, salt)
                fp = fp.view(np.int64)
                if len(seen) > SEEN:
                    seen.clear()
                new = np.zeros(len(fp), bool)
                for i, f in enumerate(fp.tolist()):
                    if f not in seen:
                        seen.add(f)
                        new[i] = True
                mine = new[row]
                for owner, sig in signatures(row[mine], s[mine], np.where(new, size, 0), num, den):
                    yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(fp[owner])], ["sig", "cls"])

    return docs.mapInArrow(trimmed(run), "sig long, cls long")


def _sets(docs: DataFrame, width: int, salt: int = 0) -> DataFrame:
    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                row, s = shingle_sets(*text_bytes(b.column(1)), width)
                size, fp, _ = fingerprints(row, s, b.num_rows, salt)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(s.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), lists], ["cls", "tokens"])

    return docs.mapInArrow(trimmed(run), "cls long, tokens array<long>")


def _stars(batches):
    """Of rows sorted by (sig, cls): each further set of a signature with the signature's first one. Holds one row between
    batches, so a signature may have any number of sets."""
    last = None
    for b in batches:
        sig, cls = (b.column(i).to_numpy() for i in range(2))
        if not len(sig):
            continue
        n = len(sig)
        first, again = np.ones(n, bool), np.zeros(n, bool)
        first[1:] = sig[1:] != sig[:-1]
        again[1:] = ~first[1:] & (cls[1:] == cls[:-1])
        at = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        pivot = cls[at]
        if last is not None and last[0] == sig[0]:
            stop = int(np.argmax(first[1:])) + 1 if first[1:].any() else n
            pivot[:stop] = last[1]
            first[0], again[0] = False, last[2] == cls[0]
        last = (sig[-1], pivot[-1], cls[-1])
        keep = ~first & ~again
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (sig, pivot, cls)], ["sig", "pivot", "cls"])


def _sets_of(wanted: DataFrame, docs: DataFrame, sizes: DataFrame, width: int, scratch: Scratch, salt: int = 0) -> DataFrame:
    """(cls, tokens) of the wanted (cls) sets, from one document each."""
    first = scratch.write(sizes.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("doc_id")).select("doc_id"))
    ids = F.broadcast(first) if first.count() <= BROADCAST_IDS else first
    sets = scratch.write(_sets(docs.join(ids, "doc_id", "left_semi"), width, salt).dropDuplicates(["cls"]))
    scratch.drop(first)
    return sets


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Of candidate pairs (a, b) of set ids those that are similar, as (src, dst)."""
    a = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    b = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))
    near = (F.size("x") * den >= F.size("y") * num) & (F.size("y") * den >= F.size("x") * num)
    both = pairs.join(b, "b").join(a, "a").where(near).withColumn("common", F.size(F.array_intersect("x", "y")))
    return scratch.write(both.where(F.col("common") * den >= (F.size("x") + F.size("y") - F.col("common")) * num).select(F.col("a").alias("src"), F.col("b").alias("dst")))


def _hopeful(sets: DataFrame, num: int, den: int, scratch: Scratch, rounds: int = 2) -> DataFrame:
    """(cls, n, most) of the sets that can be similar to another one given. Tokens that no other given set has are lost to
    every pair: with e tokens left of n, J >= t asks for a partner of at most e(1+t)/t - n tokens (``most``) and at least
    t*n. Sets without such sizes go, which makes more tokens unique, so it is done again."""
    left = sets
    for _ in range(rounds):
        alone = left.select("cls", F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"), F.min("cls").alias("cls")).where("n = 1")
        shared = left.select("cls", F.size("tokens").alias("n")).join(alone.groupBy("cls").agg(F.count("*").alias("lone")), "cls", "left")
        most = F.floor((F.col("n") - F.coalesce("lone", F.lit(0))) * (den + num) / num) - F.col("n")
        facts = scratch.write(shared.select("cls", "n", most.alias("most")).where(F.col("most") * den >= F.col("n") * num))
        left = sets.join(facts.select("cls"), "cls", "left_semi")
    return facts


def _spokes(num: int, den: int):
    """Of rows (centre, c, cls, component, x, df): the tokens that tell a set x from its signatures' centre c and that another
    set must share to be similar to it, as (centre, token, cls, component, linked, n, d, slack, pos, few).

    With D = the symmetric difference of a set and the centre, two sets differ in |Dx| + |Dy| - 2|Dx & Dy| tokens. J >= t asks
    for at most (1-t)/(1+t) * (|x|+|y|), so for |Dx & Dy| >= (slack x + slack y) / 2(den+num) with slack = (den+num)|D| -
    (den-num)|x|. A set is linked to its centre where slack <= (den-num)|c|, and no set has less than -(den-num)|c|; two sets of
    different components are not both linked, so their D's meet, and in the first tokens of an order that both have in common:
    first what the centre lacks, rare tokens first, then what it has, common tokens first. ``few`` is how many of the first
    tokens are enough for two sets neither of which is linked."""
    up, down = den + num, den - num

    def run(batches):
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(10)]
            held = 0
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                c, x = (np.asarray(row.column(i).flatten().to_numpy(), np.int64) for i in (1, 4))
                cd, xd = (np.asarray(row.column(i).flatten().to_numpy(), np.int64) for i in (2, 5))
                new, lost = ~np.isin(x, c), ~np.isin(c, x)
                d, n = int(new.sum() + lost.sum()), len(x)
                slack = up * d - down * n
                linked = slack <= down * len(c)
                few = d - max(1, -(-(slack + down * len(c) + 1) // (2 * up))) + 1
                most = few
                if not linked and slack * num <= down * len(c) * (num + 2 * den):  # some linked set may be within reach
                    most = d - max(1, -(-(slack - down * len(c)) // (2 * up))) + 1
                if most <= 0:
                    continue
                i, j = np.lexsort((x[new], xd[new])), np.lexsort((c[lost], -cd[lost]))
                token = np.concatenate([x[new][i], c[lost][j]])[:most]
                alone = np.concatenate([xd[new][i] <= 1, np.zeros(len(j), bool)])[:most]
                pos = np.flatnonzero(~alone)
                k = len(pos)
                if k:
                    for at, v in enumerate((row.column(0)[0].as_py(), None, row.column(3)[0].as_py(), row.column(6)[0].as_py(), linked, n, d, slack, None, few)):
                        out[at].append(token[pos] if at == 1 else pos if at == 8 else np.full(k, v))
                    held += k
                if held > 1 << 18 or (held and r == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in out], ["centre", "token", "cls", "component", "linked", "n", "d", "slack", "pos", "few"])
                    out, held = [[] for _ in range(10)], 0

    return run


def _residual(mixed: DataFrame, centres: DataFrame, sets: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Candidate pairs (a, b) of sets in different components of mixed (sig, cls, component): all that can be similar."""
    facts = _hopeful(sets.join(mixed.select("cls").distinct(), "cls", "left_semi"), num, den, scratch)
    spokes = mixed.join(facts.select("cls"), "cls", "left_semi").join(centres, "sig").where("cls <> centre").select("centre", "cls", "component").distinct()
    spokes = scratch.write(spokes)
    torn = spokes.groupBy("centre").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("centre")
    hopeful = sets.join(spokes.select("cls").distinct(), "cls", "left_semi")
    often = hopeful.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    wanted = spokes.select("cls").union(torn.select(F.col("centre").alias("cls"))).distinct()
    loose = sets.join(wanted, "cls", "left_semi").select("cls", F.explode("tokens").alias("token"))
    ranked = scratch.write(loose.join(often, "token", "left").groupBy("cls").agg(F.collect_list(F.struct("token", F.coalesce("df", F.lit(0)).alias("df"))).alias("t")).select("cls", F.col("t.token").alias("x"), F.col("t.df").alias("xd")))
    c = ranked.select(F.col("cls").alias("centre"), F.col("x").alias("c"), F.col("xd").alias("cd"))
    rows = spokes.join(torn, "centre", "left_semi").join(ranked, "cls").join(c, "centre").select("centre", "c", "cd", "cls", "x", "xd", "component")
    marks = scratch.write(rows.mapInArrow(trimmed(_spokes(num, den)), "centre long, token long, cls long, component long, linked boolean, n long, d long, slack long, pos long, few long"))
    x, y = (marks.select("centre", "token", *(F.col(k).alias(f"{k}_{s}") for k in ("cls", "component", "linked", "n", "d", "slack", "pos", "few"))) for s in "xy")
    sized = (F.col("n_x") * den >= F.col("n_y") * num) & (F.col("n_y") * den >= F.col("n_x") * num)
    soon = F.col("linked_x") | F.col("linked_y") | ((F.col("pos_x") < F.col("few_x")) & (F.col("pos_y") < F.col("few_y")))
    rest = F.least(F.col("d_x") - F.col("pos_x"), F.col("d_y") - F.col("pos_y"))  # tokens that two sets can share from their first shared one on
    enough = rest * (2 * (den + num)) >= F.col("slack_x") + F.col("slack_y")
    met = x.join(y, ["centre", "token"]).where((F.col("component_x") < F.col("component_y")) & sized & soon & enough)
    out = scratch.write(met.select(F.least("cls_x", "cls_y").alias("a"), F.greatest("cls_x", "cls_y").alias("b")).distinct())
    scratch.drop(spokes, ranked, marks, facts)
    return out


def jaccard_groups(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, n_shingles long, component_id long): the groups of documents chained by J >= num/den over the sets of
    their distinct ``width``-word shingles.

    component_id is the smallest id reachable by links. Null and empty texts (and texts of white space) have the empty set:
    n_shingles 0, linked with nothing. Texts with equal sets are one node from the start, so thousands of copies cost no pair.
    A repeated id gives a row each time. An id that is null keeps its own row and component null. No row, signature or pair is
    capped or sampled. Shingles are compared by 64-bit hashes.

    First every signature's sets are checked against its most shared one, which settles groups of near copies in linear time.
    Then only pairs of sets in different components can add a link, and such a pair must have something in common that the
    centre of their signature hasn't, or lack the same of it: those tokens are joined, so sets that merely derive from one text
    never meet, and the result is exact.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "jaccard")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    salt, sizes = 0, scratch.write(_sizes(docs, width))
    while sizes.groupBy("cls").agg(F.min("proof").alias("lo"), F.max("proof").alias("hi")).where("lo <> hi").limit(1).count():
        scratch.drop(sizes)  # two sets of equal fingerprints, told apart by a second one: other fingerprints
        salt += 1
        sizes = scratch.write(_sizes(docs, width, salt))
    known = docs.where("doc_id is not null")
    stars = scratch.write(_signed(known, width, num, den, salt).repartition("sig").sortWithinPartitions("sig", "cls").mapInArrow(trimmed(_stars), "sig long, pivot long, cls long"))
    members = scratch.write(stars.select("sig", "cls").union(stars.select("sig", F.col("pivot").alias("cls")).distinct()))
    scratch.drop(stars)
    # a text that others were made from shares all its signatures, they each lack some: it is the centre to check first
    weight = members.groupBy("cls").agg(F.count("*").alias("w"))
    centres = scratch.write(members.join(weight, "cls").groupBy("sig").agg(F.max(F.struct("w", "cls")).alias("c")).select("sig", F.col("c.cls").alias("centre")))
    pairs = scratch.write(members.join(centres, "sig").where("cls <> centre").select(F.least("cls", "centre").alias("a"), F.greatest("cls", "centre").alias("b")).distinct())
    sets = _sets_of(pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct(), known, sizes, width, scratch, salt)
    edges = _verified(pairs, sets, num, den, scratch)
    comps = connected_components(spark, edges, scratch)

    labelled = members.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    apart = labelled.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("sig")
    mixed = scratch.write(labelled.join(apart, "sig", "left_semi"))
    if mixed.limit(1).count():
        found = _verified(_residual(mixed, centres, sets, num, den, scratch).join(pairs, ["a", "b"], "left_anti"), sets, num, den, scratch)
        if found.limit(1).count():
            comps = connected_components(spark, edges.union(found), scratch)
    scratch.drop(centres)
    scratch.drop(members, pairs, mixed, sets)
    least = sizes.where("n_shingles > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    grouped = least.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    roots = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = scratch.write(grouped.select("cls", "component").join(roots, "component").select("cls", "component_id"))
    lone = F.col("n_shingles") == 0
    out = sizes.join(named, "cls", "left")
    return out.select("doc_id", "n_shingles", F.when(lone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"))


#: Column of the rows' own keys.
ROW = "lexloom_row"


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs without those rows that another row's group already stands for: of each group the row of smallest id stays, one
    of them if the id is repeated, and one with a null id only if all of the group have none. Rows are told apart by a key of
    their own, so repeated and null ids are rows like any other."""
    keyed = Scratch(docs.sparkSession, "copies").write(docs.withColumn(ROW, F.monotonically_increasing_id()))
    groups = jaccard_groups(keyed, id_col=ROW, **options).select(F.col("doc_id").alias(ROW), "component_id")
    named = groups.join(keyed.select(ROW, F.col(id_col).alias("id")), ROW)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", ROW))[ROW]
    stay = named.groupBy("component_id").agg(first.alias(ROW)).select(ROW)
    return keyed.join(stay, ROW, "left_semi").select(*docs.columns)
