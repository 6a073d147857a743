"""Document quality by hierarchical empirical Bayes.

A logistic classifier gives each document's own evidence. Its host has a posterior over the host's documents, shrunk towards
the corpus by a strength that the spread between hosts tells; each path of a host has one shrunk towards the host. Sites with
few documents thus lean on their prior. A document's quality combines its evidence with its path's posterior. All sums are
grouped aggregations; only the classifier is fitted on a bounded sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language_id import in_fold
from .scratch import Scratch, small_batches
from .words import hash_spans, lower_table, separators, slices, split_words, text_bytes

SAMPLE_ROWS = 20_000
_LOWER, _SPACE = lower_table(), separators("space")
_KINDS = np.zeros((256, 7))
for _i, _set in enumerate((range(97, 123), range(65, 91), range(48, 58), (32, 9), (10, 13), [c for c in range(33, 127) if not chr(c).isalnum()], range(128, 256))):
    _KINDS[list(_set), _i] = 1
N_FEATURES = 7 + 8


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of byte kinds, sizes, and repetition of words and lines, a row per text."""
    n, size = len(offsets) - 1, np.diff(offsets)
    x = np.zeros((n, N_FEATURES))
    row = np.repeat(np.arange(n), size)
    for k in range(7):
        x[:, k] = np.bincount(row, weights=_KINDS[data, k], minlength=n) / np.maximum(size, 1)
    low = _LOWER[data]
    starts, ends, rows = split_words(low, offsets, _SPACE)
    words = np.bincount(rows, minlength=n)
    h = hash_spans(low, starts, ends)
    pairs = np.unique(np.stack([rows.astype(np.uint64), h], 1), axis=0) if len(h) else np.zeros((0, 2), np.uint64)
    x[:, 7] = np.bincount(pairs[:, 0].astype(np.int64), minlength=n) / np.maximum(words, 1)
    line = np.zeros(256, bool)
    line[10] = True
    ls, le, lr = split_words(low, offsets, line)
    lines = np.bincount(lr, minlength=n)
    lp = np.unique(np.stack([lr.astype(np.uint64), hash_spans(low, ls, le)], 1), axis=0) if len(ls) else np.zeros((0, 2), np.uint64)
    x[:, 8] = np.bincount(lp[:, 0].astype(np.int64), minlength=n) / np.maximum(lines, 1)
    length = np.bincount(rows, weights=ends - starts, minlength=n)
    x[:, 9] = length / np.maximum(words, 1) / 10
    x[:, 10] = np.sqrt(np.maximum(0, np.bincount(rows, weights=(ends - starts) ** 2, minlength=n) / np.maximum(words, 1) - (10 * x[:, 9]) ** 2)) / 10
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    x[:, 11] = np.bincount(rows, weights=(_KINDS[last, 5] > 0), minlength=n) / np.maximum(words, 1)
    x[:, 12], x[:, 13], x[:, 14] = np.log1p(words) / 10, np.log1p(lines) / 5, words / np.maximum(lines, 1) / 100
    return x


class Classifier:
    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 15):
        """Logistic regression on standardised features and their squares, by Newton's method."""
        self.mean, self.sd = x.mean(0), x.std(0) + 1e-9
        a = self._design(x)
        w = np.zeros(a.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            g = a.T @ (p - y) + ridge * w
            h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
            w -= np.linalg.solve(h, g)
        self.w = w

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -6, 6)
        return np.concatenate([np.ones((len(z), 1)), z, z * z], 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._design(x) @ self.w, -12, 12)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Classifier | None:
    """From the labelled documents of smallest hash, about sample_rows; None without labels of both kinds."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).dropna().groupBy("id").agg(F.max("y").alias("y"))
    near = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, sample_rows / max(1, marks.count())) * (1 << 30))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(near).join(marks.where(near), "id").select("text", "y")

    def measured(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                x = features(*text_bytes(b.column(0)))
                yield pa.RecordBatch.from_arrays([b.column(1), pa.array(x.tolist(), pa.list_(pa.float64()))], ["y", "x"])

    got = rows.mapInArrow(measured, "y double, x array<double>").orderBy("x", "y").toPandas()
    if got.y.nunique() < 2:
        return None
    return Classifier(np.stack(got.x.to_numpy()), got.y.to_numpy())


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, mean: Column, parent: Column) -> float:
    """Prior strength by the method of moments: how many documents the parent is worth, from the spread of group means around
    their parents beyond what their sizes explain."""
    within = (parent * (1 - parent))
    r = groups.agg(F.sum(F.col("n") * (mean - parent) ** 2).alias("between"), F.sum(within).alias("chance"), F.sum(F.col("n") * within).alias("scale"), F.count("*").alias("k")).first()
    if not r.k or not r.scale:
        return 1e6
    spread = max((r.between - r.chance) / r.scale, 1e-6)
    return float(min(max(1 / spread - 1, 1.0), 1e6))


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, parts: int = 5, fold: int = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """A row per document: doc_id, held_out boolean, evidence double (the classifier alone), host_prior and path_prior double
    (posterior means), score double (0 to 1), high boolean (score >= 0.5).

    Labels inside the fold are not learned from. Null hosts and paths are sites of their own; null and empty texts have the
    evidence of an empty text. Without labels of both kinds every evidence is even. A repeated id keeps each of its rows.
    """
    known = labels.where(~in_fold(F.col(id_col), parts, fold))
    model = train(docs, known, id_col, text_col, label_col)
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def evidence(text):
        import pandas as pd

        if held.value is None:
            return pd.Series(np.zeros(len(text)))
        out = [held.value(features(*text_bytes(b.column(0)))) for b in slices(pa.RecordBatch.from_arrays([pa.array(text, pa.string())], ["text"]), "text")]
        return pd.Series(np.concatenate([*out, np.zeros(0)]))

    scratch = Scratch(docs.sparkSession, "quality")
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), evidence(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("z"))
    base = scratch.write(base.withColumn("p", 1 / (1 + F.exp(-F.col("z")))))
    paths = scratch.write(base.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count("*").alias("n")))
    hosts = scratch.write(paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    r = hosts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    overall = min(max((r.s or 0.5) / (r.n or 1), 1e-6), 1 - 1e-6)
    a = _strength(hosts, F.col("s") / F.col("n"), F.lit(overall))
    hosts = hosts.select("host", ((F.col("s") + a * overall) / (F.col("n") + a)).alias("host_prior"))
    joined = scratch.write(paths.join(hosts, "host"))
    b = _strength(joined, F.col("s") / F.col("n"), F.col("host_prior"))
    posterior = joined.select("host", "path", "host_prior", ((F.col("s") + b * F.col("host_prior")) / (F.col("n") + b)).alias("path_prior"))
    clip = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    total = F.col("z") + _logit(clip(F.col("path_prior"))) - float(np.log(overall / (1 - overall)))
    out = base.join(posterior, ["host", "path"])
    return out.select("doc_id", in_fold(F.col("doc_id"), parts, fold).alias("held_out"), F.col("p").alias("evidence"), "host_prior", "path_prior", (1 / (1 + F.exp(-total))).alias("score")).withColumn("high", F.col("score") >= 0.5)
