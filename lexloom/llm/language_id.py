"""Language identification by prediction by partial matching (PPM-C with exclusion) over bytes.

Each language has a tree of byte contexts up to ORDER bytes long with the counts of what followed them. A byte costs its
code length: in the longest known context, with the escape probabilities of the contexts that don't hold it and with the
bytes those do hold excluded further down, ending in a uniform code over all other byte values. The statistics are frozen, so
that cost depends on the last ORDER+1 bytes alone; it is tabulated once for every context of the tree and looked up for
whole batches of texts. The language of the shortest code wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches
from .words import give_back, slices, text_bytes, trimmed

ORDER = 3
#: The trees are learned from about so many labelled rows of each language, the ones of smallest hash.
SAMPLE_ROWS = 3000
#: Contexts of full length that a tree keeps, by count; shorter contexts are all kept.
MAX_CONTEXTS = 12_000


class Model:
    """Code lengths in bits: cost[row of the context, class of the byte, language]."""

    def __init__(self, languages: list[str], counts: list[tuple[int, int, int]]):
        """counts: (language's number, four bytes as one big-endian number, occurrences)."""
        self.languages = languages
        table = np.array(counts, np.int64).reshape(-1, 3)
        lang, gram, n = table.T
        b = np.stack([(gram >> s) & 255 for s in (24, 16, 8, 0)], 1)
        seen = np.unique(b) if len(b) else np.zeros(1, np.int64)
        self.classes = np.full(256, len(seen), np.uint8 if len(seen) < 255 else np.int32)
        self.classes[seen] = np.arange(len(seen))
        a = self.a = len(seen) + 1  # the last class stands for each of the bytes never seen
        c = self.classes[b].astype(np.int64) if len(b) else b
        k = len(languages)
        low = [np.zeros((a**o, a, k)) for o in range(3)]
        full = (c[:, 0] * a + c[:, 1]) * a + c[:, 2]
        for o in range(3):
            context = sum((c[:, 2 - j] * a**j for j in range(o)), np.zeros(len(c), np.int64))
            np.add.at(low[o], (context, c[:, 3], lang), n)
        weight = np.bincount(full, weights=n, minlength=1) if len(full) else np.zeros(1)
        kept = np.argsort(-weight, kind="stable")[:MAX_CONTEXTS]
        kept = np.sort(kept[weight[kept] >= 4])
        rows = np.zeros((len(kept), a, k))
        if len(kept):
            at = np.minimum(np.searchsorted(kept, full), len(kept) - 1)
            mine = kept[at] == full
            np.add.at(rows, (at[mine], c[mine, 3], lang[mine]), n[mine])
        pairs = np.flatnonzero(low[2].sum((1, 2)) > 0)
        # rows of the table: kept triples, then pairs, then single bytes
        self.row = np.tile(len(kept) + len(pairs) + np.arange(a, dtype=np.int32), a * a)
        pair_row = np.full(a * a, -1, np.int32)
        pair_row[pairs] = len(kept) + np.arange(len(pairs))
        both = np.tile(pair_row, a)
        self.row = np.where(both >= 0, both, self.row).astype(np.int32)
        self.row[kept] = np.arange(len(kept))
        self.cost = np.empty((len(kept) + len(pairs) + a, a, k), np.float32)
        for first in range(0, len(kept), 2000):
            ids = kept[first : first + 2000]
            self.cost[first : first + len(ids)] = self._code([rows[first : first + 2000], low[2][ids % (a * a)], low[1][ids % a], low[0][np.zeros(len(ids), int)]])
        self.cost[len(kept) : len(kept) + len(pairs)] = self._code([low[2][pairs], low[1][pairs % a], low[0][np.zeros(len(pairs), int)]])
        self.cost[len(kept) + len(pairs) :] = self._code([low[1], low[0][np.zeros(a, int)]])

    def _code(self, orders: list[np.ndarray]) -> np.ndarray:
        p, rest, out = np.zeros_like(orders[0]), np.ones((len(orders[0]), 1, orders[0].shape[2])), np.zeros(orders[0].shape, bool)
        for c in orders:
            c = np.where(out, 0.0, c)
            total, kinds = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True)
            some = total > 0
            over = np.where(some, total + kinds, 1.0)
            p += rest * c / over
            rest = np.where(some, rest * kinds / over, rest)
            out |= c > 0
        left = 256 - out.sum(1, keepdims=True)
        return -np.log2(np.maximum(np.where(out, p, rest / np.maximum(left, 1)), 1e-30)).astype(np.float32)

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each row's bytes in each language; a row starts as if after line breaks."""
        n, k = len(offsets) - 1, len(self.languages)
        out = np.zeros((n, k))
        size = np.diff(offsets)
        padded = np.full(len(data) + 3 * n, self.classes[10], np.int32)
        at = np.arange(len(data)) + 3 * (np.repeat(np.arange(n), size) + 1)
        padded[at] = self.classes[data]
        context = self.row[(padded[at - 3] * self.a + padded[at - 2]) * self.a + padded[at - 1]].astype(np.int64)
        flat, key = self.cost.reshape(-1, k), context * self.a + padded[at]
        full = np.flatnonzero(size)
        if len(full):
            out[full] = np.add.reduceat(flat[key], offsets[full], axis=0, dtype=np.float64)
        return out


def in_fold(id_col: Column, parts: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; null ids don't."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(parts)) == fold, F.lit(False))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The trees of all languages in labelled (rows without text or language don't count); None without any."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna(subset=["text", "lang"])
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    share = F.lit(0)
    for i, name in enumerate(languages):
        share = F.when(F.col("lang") == name, int(min(1.0, sample_rows / sizes[name]) * (1 << 30))).otherwise(share)
    picked = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share).select("text", F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int").alias("lang"))

    def grams(batches):
        for batch in batches:
            for b in slices(batch, "text", 1 << 18):
                data, offsets = text_bytes(b.column(0))
                lang = b.column(1).to_numpy() - 1
                for k in np.unique(lang):
                    codes = []
                    for r in np.flatnonzero(lang == k):
                        x = np.concatenate([np.full(3, 10, np.uint8), data[offsets[r] : offsets[r + 1]]]).astype(np.int64)
                        codes.append((x[:-3] << 24) | (x[1:-2] << 16) | (x[2:-1] << 8) | x[3:])
                    gram, n = np.unique(np.concatenate(codes), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), k, np.int32)), pa.array(gram), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    counted = picked.mapInArrow(trimmed(grams), "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).orderBy("lang", "gram").toArrow()
    return Model(languages, np.stack([counted.column(i).to_numpy().astype(np.int64) for i in range(3)], 1))


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """docs' columns plus lang_pred string and lang_score double: the language of the shortest code and its posterior under
    equal priors. Texts that are null, empty or without any letter, and all texts without a model, are ``und`` with score 0."""
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.withColumn("lang_pred", F.lit("und")).withColumn("lang_score", F.lit(0.0))
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_CONTEXTS

    @F.pandas_udf("lang string, score double")
    def best(text):
        import pandas as pd

        m, total = held.value, []
        batch = pa.RecordBatch.from_arrays([pa.array(text, pa.string())], ["text"])
        for b in slices(batch, "text", 1 << 18):
            total.append(m.bits(*text_bytes(b.column(0))))
        bits = np.concatenate([*total, np.zeros((0, len(m.languages)))])
        nats = -(bits - bits.min(1, keepdims=True)) * np.log(2.0)
        chance = np.exp(nats)
        pick = bits.argmin(1)
        give_back()
        return pd.DataFrame({"lang": np.array(m.languages, object)[pick], "score": chance[np.arange(len(bits)), pick] / chance.sum(1)})

    seen = docs.withColumn("_best", best(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return seen.withColumn("lang_pred", F.when(letters, F.col("_best.lang")).otherwise("und")).withColumn("lang_score", F.when(letters, F.col("_best.score")).otherwise(0.0)).drop("_best")


def identify(docs: DataFrame, parts: int = 4, fold: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out boolean, lang_pred string, score double): learned from the rows outside the fold that have a
    language, predicted for every row. A repeated id keeps each of its rows; null ids are learned from and not held out."""
    held = in_fold(F.col(id_col), parts, fold)
    model = train(docs.where(~held), text_col, lang_col, id_col)
    out = predict(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return out.select("doc_id", in_fold(F.col("doc_id"), parts, fold).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
