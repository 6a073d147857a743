"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's score is a logistic function of its hashed words and word beginnings, and of how much else of the document tells;
a document is toxic if any of its sentences is: 1 - prod(1 - s) over those with a telling word (the others score 0, so that length
alone never adds up). Only documents have labels, so the gradient of the document's
likelihood is passed to each sentence by how much it is to blame, which lets the model find the offending ones.

Features that tell are counted in parallel; the task that fits gets those alone, so its memory follows what tells and not the
length of the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language_id import in_fold
from .scratch import small_batches
from .words import U, give_back, hash_spans, lower_table, separators, slices, split_words, text_bytes, trimmed

#: Hash buckets of words (of beginnings as many); documents learned from at most (of about so many, by hash); decision.
BUCKETS, SAMPLE_ROWS, THRESHOLD = 1 << 18, 12_000, 0.7
#: Bytes of the word beginnings that are features beside the word.
BEGINNINGS = (4, 5, 6)
KINDS = 1 + len(BEGINNINGS)
#: Log-likelihood ratio from which a feature counts as telling.
EVIDENCE = 10.0
_LOWER, _ALNUM = lower_table(), separators("alnum")
_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of whole texts: (row of each sentence, first byte of each sentence, sentence of each word, feature ids (kinds, words))."""
    data = _LOWER[data]
    starts, ends, rows = split_words(data, offsets, _ALNUM)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros((1 + len(BEGINNINGS), 0), np.int64)
    stops = np.concatenate([[0], np.cumsum(_END[data])])
    code = stops[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (code[1:] != code[:-1]) | (rows[1:] != rows[:-1])
    sentence = np.cumsum(new) - 1
    kinds = [hash_spans(data, starts, e) >> U(64 - 18) for e in (ends, *(np.minimum(starts + k, ends) for k in BEGINNINGS))]
    return rows[new], starts[new], sentence, np.stack([k.astype(np.int64) + i * BUCKETS for i, k in enumerate(kinds)])


def _ranges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a[0]..b[0]-1, a[1]..b[1]-1 and so on."""
    size = b - a
    return np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


class Hits:
    """The telling words of whole texts: their sentences, and what else of each document tells."""

    def __init__(self, doc: np.ndarray, sentence: np.ndarray, ids: np.ndarray, words: np.ndarray):
        """doc, sentence (numbered through all texts, ascending) and ids (kinds, -1 for what doesn't tell) of each telling word;
        number of words of each document."""
        self.ids = ids
        numbers, self.of, count = np.unique(sentence, return_inverse=True, return_counts=True)
        self.numbers, self.count = numbers, count
        self.doc = doc[np.searchsorted(sentence, numbers)]
        other = np.bincount(doc, minlength=len(words))[self.doc] - count
        self.facts = np.stack([np.log1p(other), np.log1p(100 * other / np.maximum(words[self.doc], 1)), np.ones(len(numbers))])


class Model:
    """weights by feature, 0 for those that don't tell; facts: weights of what else tells; bias."""

    def __init__(self, weights: np.ndarray, tells: np.ndarray, facts: np.ndarray, bias: float):
        self.weights, self.tells, self.facts, self.bias = weights.astype(np.float32), tells, facts, bias

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Noisy-or of each row (0 without telling words), and row, first byte and score of each sentence with telling words."""
        row, first, sentence, ids = features(data, offsets)
        hits = found(row, sentence, ids, self.tells, len(offsets) - 1)
        z = np.bincount(hits.of, weights=np.where(hits.ids >= 0, self.weights[hits.ids], 0).sum(0), minlength=len(hits.doc)) + self.facts @ hits.facts + self.bias
        s = _logistic(z)
        calm = np.bincount(hits.doc, weights=np.log1p(-np.minimum(s, 1 - 1e-9)), minlength=len(offsets) - 1)
        return np.abs(np.expm1(calm)), hits.doc, first[hits.numbers], s


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def found(row: np.ndarray, sentence: np.ndarray, ids: np.ndarray, tells: np.ndarray, docs: int) -> Hits:
    """The telling words among features."""
    known = tells[ids]
    some = known.any(0)
    return Hits(row[sentence[some]], sentence[some], np.where(known, ids, -1)[:, some], np.bincount(row[sentence], minlength=docs))


def telling(n: np.ndarray, k: np.ndarray, base: float, least: float | None = None) -> np.ndarray:
    """Mask over features in n documents, k of them toxic: those found in toxic documents more often than chance explains, by
    the likelihood ratio of the counts. The rest would only let rare words learn single documents by heart."""
    least = EVIDENCE if least is None else least
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(k > 0, k * np.log(k / (n * base)), 0) + np.where(n > k, (n - k) * np.log((n - k) / (n * (1 - base))), 0))
        return (n > 0) & (k > n * base) & (ratio >= least)


def fit(hits: Hits, labels: np.ndarray, epochs: int = 60, rate: float = 0.5, decay: float = 1e-4, batch: int = 128, seed: int = 0) -> Model:
    """Adagrad on the noisy-or likelihood of document labels, over the telling features."""
    used, ids = np.unique(hits.ids, return_inverse=True)
    ids = ids.reshape(hits.ids.shape)
    if len(used) and used[0] < 0:  # the last weight stays zero
        used, ids = used[1:], np.where(ids == 0, len(used) - 1, ids - 1)
    w, g, bias, gb = np.zeros(len(used) + 1), np.full(len(used) + 1, 1e-3), -4.0, 1e-3
    u, gu = np.zeros(len(hits.facts)), np.full(len(hits.facts), 1e-3)
    docs = len(labels)
    first_s, first_w = np.searchsorted(hits.doc, np.arange(docs + 1)), np.searchsorted(hits.of, np.arange(len(hits.doc) + 1))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(docs)
        for at in range(0, docs, batch):
            these = order[at : at + batch]
            a, b = first_s[these], first_s[these + 1]
            span, of = _ranges(a, b), np.repeat(np.arange(len(these)), b - a)
            a, b = first_w[span], first_w[span + 1]
            word, inst = _ranges(a, b), np.repeat(np.arange(len(span)), b - a)
            s = _logistic(np.bincount(inst, weights=w[ids[:, word]].sum(0), minlength=len(span)) + u @ hits.facts[:, span] + bias)
            p = -np.expm1(np.bincount(of, weights=np.log1p(-np.minimum(s, 1 - 1e-9)), minlength=len(these)))
            odds = np.where(labels[these].astype(bool), -(1 - p) / np.maximum(p, 1e-6), 1.0)
            blame = s * odds[of]  # of a sentence: d(-log likelihood)/dz
            grad = sum(np.bincount(part, weights=blame[inst], minlength=len(w)) for part in ids[:, word]) + decay * w
            grad[-1] = 0
            g += grad**2
            w -= rate * grad / np.sqrt(g)
            step = hits.facts[:, span] @ blame
            gu += step**2
            u -= 0.1 * step / np.sqrt(gu)
            step = blame.sum()
            gb += step**2
            bias -= 0.1 * step / np.sqrt(gb)
    weights, tells = np.zeros(KINDS * BUCKETS), np.zeros(KINDS * BUCKETS, bool)
    weights[used], tells[used] = w[:-1], True
    return Model(weights, tells, u, float(bias))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """From a bounded sample of labelled documents, of which the fitting task sees the telling words; None without labels of
    both kinds. Where labels repeat an id the largest counts."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna().groupBy("id").agg(F.max("y").alias("y"))
    n = marks.count()
    near = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, sample_rows / max(1, n)) * (1 << 30))
    chosen = marks.where(near)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(near)
    # chosen is the bounded sample's ids, so texts outside it are left behind before any shuffle
    rows = texts.join(F.broadcast(chosen), "id").where("text is not null").select(F.xxhash64("id", "text").alias("k"), "text", "y")
    small_batches(docs.sparkSession)

    def tallied(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                y = b.column(2).to_numpy() > 0
                row, _, sentence, ids = features(*text_bytes(b.column(1)))
                pair = np.unique(ids.astype(np.int64) * b.num_rows + row[sentence]) if len(sentence) else np.zeros(0, np.int64)
                f, n = np.unique(pair // b.num_rows, return_counts=True)
                k = np.bincount(np.searchsorted(f, pair // b.num_rows), weights=y[pair % b.num_rows], minlength=len(f)).astype(np.int64)
                f, n, k = np.append(f, -1), np.append(n, b.num_rows), np.append(k, int(y.sum()))  # -1: all documents
                yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(n), pa.array(k)], ["f", "n", "k"])

    counts = rows.mapInArrow(trimmed(tallied), "f long, n long, k long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    counts = counts.where("f < 0 or k > 0")  # at most one row for each feature
    f, n, k = (np.asarray(c.to_numpy(), float) for c in counts.toArrow().columns)
    every = f < 0
    if not every.any() or not 0 < k[every][0] < n[every][0]:
        return None
    good = telling(n, k, k[every][0] / n[every][0]) & ~every
    tells = np.zeros(KINDS * BUCKETS, bool)
    tells[f[good].astype(np.int64)] = True
    held = docs.sparkSession.sparkContext.broadcast(tells)

    def sparse(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                row, _, sentence, ids = features(*text_bytes(b.column(1)))
                h = found(row, sentence, ids, held.value, b.num_rows)
                doc = h.doc[h.of]
                ends = np.searchsorted(doc, np.arange(b.num_rows + 1))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.astype(np.int32))) for x in (h.numbers[h.of], *h.ids)]
                words = np.bincount(row[sentence], minlength=b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(words), *lists], ["k", "y", "words", "at", *(f"f{i}" for i in range(KINDS))])

    def learn(batches):
        parts = [pa.Table.from_batches([b]) for b in batches]
        if not parts:
            return
        t = pa.concat_tables(parts).combine_chunks().sort_by([("k", "ascending"), ("words", "ascending"), ("y", "ascending")])
        size = t["at"].combine_chunks().value_lengths().to_numpy()
        doc = np.repeat(np.arange(t.num_rows), size)
        at, *ids = (t[c].combine_chunks().flatten().to_numpy() for c in ("at", *(f"f{i}" for i in range(KINDS))))
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        m = fit(Hits(doc, np.cumsum(new) - 1, np.stack(ids), t["words"].to_numpy()), t["y"].to_numpy())
        at = np.flatnonzero(m.tells)
        yield pa.RecordBatch.from_arrays([pa.array([at.tolist()], pa.list_(pa.int64())), pa.array([m.weights[at].tolist()], pa.list_(pa.float32())), pa.array([m.facts.tolist()], pa.list_(pa.float64())), pa.array([m.bias])], ["at", "w", "facts", "bias"])

    lists = ", ".join(f"f{i} array<int>" for i in range(KINDS))
    thin = rows.mapInArrow(trimmed(sparse), f"k long, y int, words long, at array<int>, {lists}")
    got = thin.repartition(1).mapInArrow(trimmed(learn), "at array<long>, w array<float>, facts array<double>, bias double").collect()
    if not got:
        return None
    w, tells = np.zeros(KINDS * BUCKETS), np.zeros(KINDS * BUCKETS, bool)
    at = np.array(got[0].at, np.int64)
    w[at], tells[at] = got[0].w, True
    return Model(w, tells, np.array(got[0].facts), got[0].bias)


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """docs' columns plus toxic_score double and toxic_at array<struct<start long, score double>>: the noisy-or of the
    sentences, and the byte offsets of those that reach the threshold alone. Null and empty texts score 0, as do all without
    a model."""
    if model is None:
        return docs.withColumn("toxic_score", F.lit(0.0)).withColumn("toxic_at", F.array().cast("array<struct<start:long,score:double>>"))
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # KINDS * BUCKETS weights

    @F.pandas_udf("score double, at array<struct<start:long,score:double>>")
    def judged(text):
        import pandas as pd

        scores, places = [], []
        batch = pa.RecordBatch.from_arrays([pa.array(text, pa.string())], ["text"])
        for b in slices(batch, "text", 1 << 18):
            data, offsets = text_bytes(b.column(0))
            p, row, first, s = held.value.documents(data, offsets)
            scores.append(p)
            found: list[list] = [[] for _ in range(b.num_rows)]
            for i in np.flatnonzero(s >= THRESHOLD):
                found[row[i]].append({"start": int(first[i] - offsets[row[i]]), "score": float(s[i])})
            places += found
        give_back()
        return pd.DataFrame({"score": np.concatenate([*scores, np.zeros(0)]), "at": places})

    seen = docs.withColumn("_judged", judged(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return seen.withColumn("toxic_score", F.col("_judged.score")).withColumn("toxic_at", F.col("_judged.at")).drop("_judged")


def detect(docs: DataFrame, labels: DataFrame, parts: int = 3, fold: int = 1, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out boolean, score double, predicted int, spans): learned from the labels outside the fold; predicted is 1
    from THRESHOLD on. A repeated id keeps each of its rows."""
    known = labels.where(~in_fold(F.col(id_col), parts, fold))
    out = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), train(docs, known, id_col, text_col, label_col))
    return out.select("doc_id", in_fold(F.col("doc_id"), parts, fold).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"), F.col("toxic_at").alias("spans"))
