"""Balanced label propagation: linked documents move to the shard of most of their neighbours, under quotas.

Documents that share a hub (here: an equal text) are neighbours. The state is a table of cells, (hub, shard, documents), so a
hub of any size costs eight rows. Each round every hub's cells propose to move to its fullest shard with room; how much may
move from shard to shard is bounded by the swaps that the opposite proposals allow plus the free capacity, and handed out by
size classes, largest hubs first. A last step deals whatever exceeds a shard's capacity to those with room, so the law holds
exactly: row counts at most one apart.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch

#: Parts of a shard that are ranked apart, so that no task orders a whole shard.
PARTS = 512


def _cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy("h1", "h2", "shard").agg(F.sum("n").alias("n"))


def _propagate(cells: DataFrame, total: int, shards: int, rounds: int, scratch: Scratch) -> DataFrame:
    """Cells after the rounds. Only sums by (from, to, size class) reach the driver: shards * shards * 64 rows at most."""
    cap = np.array([total // shards + (s < total % shards) for s in range(shards)])
    cells = scratch.write(cells)
    for _ in range(rounds):
        load = np.zeros(shards, np.int64)
        for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            load[r.shard] = r.n
        free = np.maximum(0, cap - load)
        counts = F.map_from_entries(F.collect_list(F.struct("shard", "n")))  # a hub has at most one cell a shard
        # the fullest cell whose shard has room (any shard, if none has: then only swaps move); fuller cells stay
        roomy = [s for s in range(shards) if free[s]] or list(range(shards))
        best = F.array_max(F.transform(F.filter(F.map_entries("at"), lambda e: e["key"].isin(roomy)), lambda e: F.struct(e["value"].alias("n"), (-e["key"]).alias("k"))))
        hubs = cells.groupBy("h1", "h2").agg(counts.alias("at")).where(F.size("at") > 1).withColumn("best", best).where("best is not null")
        asked = hubs.select("h1", "h2", "best", F.explode(F.map_entries("at")).alias("e"), (-F.col("best")["k"]).alias("to"))
        asked = asked.where(F.struct(F.col("e")["value"].alias("n"), (-F.col("e")["key"]).alias("k")) < F.col("best")).select("h1", "h2", F.col("e")["key"].alias("from"), "to", F.col("e")["value"].alias("n"))
        asked = scratch.write(asked.withColumn("cls", F.floor(F.log2("n")).cast("int")))
        sums = {(r["from"], r["to"], r["cls"]): r.n for r in asked.groupBy("from", "to", "cls").agg(F.sum("n").alias("n")).collect()}
        if not sums:
            break
        want = np.zeros((shards, shards), np.int64)
        for (s, t, _), n in sums.items():
            want[s, t] += n
        allowed = np.minimum(want, want.T)  # swaps leave the loads as they are
        for t in range(shards):
            extra, room = want[:, t] - allowed[:, t], int(free[t])
            for s in np.argsort(-extra, kind="stable"):
                take = min(int(extra[s]), room)
                allowed[s, t] += take
                room -= take
        if not allowed.any():
            break
        share = []
        for s in range(shards):
            for t in range(shards):
                left = int(allowed[s, t])
                for c in sorted((k[2] for k in sums if k[:2] == (s, t)), reverse=True):
                    take = min(left, sums[s, t, c])
                    share.append((s, t, c, take, sums[s, t, c]))
                    left -= take
        share = F.broadcast(cells.sparkSession.createDataFrame(share, "from int, to int, cls int, take long, of long"))  # a row for each size class
        moved = asked.join(share, ["from", "to", "cls"]).select("h1", "h2", "from", "to", F.floor(F.col("n") * F.col("take") / F.col("of")).cast("long").alias("m")).where("m > 0")
        change = moved.select("h1", "h2", F.col("from").alias("shard"), (-F.col("m")).alias("n")).union(moved.select("h1", "h2", F.col("to").alias("shard"), F.col("m").alias("n")))
        new = scratch.write(_cells(cells.union(change)).where("n > 0"))
        scratch.drop(cells, asked)
        cells = new
    return cells


def _spread(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), key), F.lit(n)).cast("int")


def balanced_shards(docs: DataFrame, shards: int = 8, rounds: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, size long (UTF-8 bytes plus 1), text_crc32 long, law string ('rows'), shard int, slot long
    (gapless from 0 in each shard), grown_shard int (null: the law isn't ``key``).

    Null texts count as empty: size 1, checksum 0, and equal to other empty ones. Null and repeated ids keep each of their
    rows. Fewer rows than shards leave shards empty. Equal texts stay together except where a group exceeds a shard or the
    exact balance cuts it.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    base = scratch.write(base)
    total = base.count()
    start = base.select("h1", "h2", _spread(F.col("row"), shards).alias("shard"))
    cells = _cells(start.withColumn("n", F.lit(1).cast("long")))
    hubs = cells.groupBy("h1", "h2").agg(F.sum("n").alias("all")).where("all > 1")
    linked = _propagate(cells.join(hubs.select("h1", "h2"), ["h1", "h2"], "left_semi"), total, shards, rounds, scratch)
    homes = linked.groupBy("h1", "h2").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("at"), F.sum("n").alias("all"))  # at most a struct a shard

    # a document takes its hub's shards by their shares; which one depends on its row alone
    point = F.pmod(F.xxhash64(F.lit(3), "row"), F.lit(1 << 30)) / float(1 << 30) * F.col("all")
    before = F.transform(F.sequence(F.lit(1), F.size("at")), lambda i: F.struct(F.aggregate(F.slice("at", 1, i), F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("end"), F.element_at("at", i)["shard"].alias("shard")))
    wished = base.join(homes, ["h1", "h2"], "left").withColumn("single", F.col("all").isNull())
    wished = wished.withColumn("point", point)
    chosen = F.get(F.filter(before, lambda e: F.col("point") < e["end"]), F.lit(0))["shard"]
    wished = wished.withColumn("wish", F.when(F.col("single"), _spread(F.col("row"), shards)).otherwise(F.coalesce(chosen, F.element_at("at", -1)["shard"])))
    wished = scratch.write(wished.select("row", "doc_id", "size", "text_crc32", "single", "wish", _spread(F.col("row") + 1, PARTS).alias("part")))

    # ranks within a shard: linked documents first, part by part; what comes after the capacity is dealt to shards with room
    count = np.zeros((shards, 2, PARTS), np.int64)
    for r in wished.groupBy("wish", "single", "part").count().collect():  # shards * 2 * PARTS rows at most
        count[r.wish, int(r.single), r.part] = r["count"]
    cap = np.array([total // shards + (s < total % shards) for s in range(shards)])
    first = np.cumsum(count.reshape(shards, -1), 1) - count.reshape(shards, -1)
    load = count.sum((1, 2))
    kept = np.minimum(load, cap)
    over = np.cumsum(load - kept) - (load - kept)
    room_end = np.cumsum(cap - kept)
    offsets = F.broadcast(spark.createDataFrame([(s, bool(k // PARTS), k % PARTS, int(first[s, k])) for s in range(shards) for k in range(2 * PARTS)], "wish int, single boolean, part int, before long"))
    rank = F.row_number().over(Window.partitionBy("wish", "single", "part").orderBy("row")) - 1
    ranked = wished.withColumn("rank", rank).join(offsets, ["wish", "single", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    lookup = lambda values, i: F.get(F.array(*[F.lit(int(v)) for v in values]), i)
    stays = F.col("rank") < lookup(kept, F.col("wish"))
    spill = F.col("rank") - lookup(kept, F.col("wish")) + lookup(over, F.col("wish"))
    to = sum((F.when(spill >= int(e), 1).otherwise(0) for e in room_end[:-1]), F.lit(0))
    out = ranked.withColumn("shard", F.when(stays, F.col("wish")).otherwise(to).cast("int"))
    slot = F.when(stays, F.col("rank")).otherwise(spill - lookup(np.concatenate([[0], room_end[:-1]]), F.col("shard")) + lookup(kept, F.col("shard")))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
