"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text is pre-tokenised in chunks. The pattern looks only forward, so from any true boundary on the pre-tokens don't depend on
what stands before: where a boundary of one chunk is also one of the next, the two have resynchronised and are stitched.
The chunks of very long texts are dealt to different tasks; the rare gap that no boundary closes is pre-tokenised on from the
last true boundary until it meets one. Pre-tokens are encoded one by one by the ranks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches
from .words import slices, trimmed

#: Characters of a chunk, and by how many the next one is overlapped; texts over LONG are dealt to several tasks.
CHUNK, OVERLAP, LONG = 1 << 13, 256, 1 << 16
#: Last pre-tokens of a cut chunk that the rest of the text may change: "'l" is two pre-tokens at an end, but one of "'ll".
UNSURE = 2
#: Pre-tokens whose ids a worker remembers.
REMEMBERED = 1 << 17


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Encoder:
    """Pre-tokens and ids of one rank file's text; also holds the bytes of each id."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        # only pre-tokens are encoded by it, so its own pattern stays trivial: it keeps a copy for each of many threads
        piece = tiktoken.Encoding("own", pat_str=r"[\s\S]", mergeable_ranks=table, special_tokens={})._encode_single_piece

        class Known(dict):
            def __missing__(self, text):
                if len(self) >= REMEMBERED:
                    self.clear()
                self[text] = ids = np.array(piece(text), np.int32).tobytes()
                return ids

        self.pattern, self.known = regex.compile(pattern), Known()
        top = max(table.values(), default=-1) + 1
        size = np.zeros(top, np.int64)
        for b, i in table.items():
            size[i] = len(b)
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.bytes = np.zeros(self.start[-1], np.uint8)
        for b, i in table.items():
            self.bytes[self.start[i] : self.start[i + 1]] = np.frombuffer(b, np.uint8)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as int32 bytes, by chunks that overlap and are stitched."""
        if len(text) <= CHUNK:
            return b"".join(map(self.known.__getitem__, self.pattern.findall(text)))
        return self.stitch((self.chunk(text[k : k + CHUNK + OVERLAP], k, k + CHUNK + OVERLAP >= len(text)) for k in range(0, len(text), CHUNK)), text)

    def chunk(self, text: str, at: int, last: bool) -> tuple[np.ndarray, np.ndarray, bytes]:
        """A chunk that starts at ``at`` in its text: starts of its pre-tokens (and the end of the last), the number of ids of
        each, the ids. Without what the chunk's end may have changed, unless the text ends there too."""
        found = self.pattern.findall(text)
        if not last:
            del found[-UNSURE:]
        ids = [self.known[p] for p in found]
        starts = at + np.concatenate([[0], np.cumsum([len(p) for p in found])]).astype(np.int64)
        return starts, np.array([len(x) // 4 for x in ids], np.int64), b"".join(ids)

    def stitch(self, chunks: Iterable[tuple[np.ndarray, np.ndarray, bytes]], text: str) -> bytes:
        """The ids of a text from those of its chunks, in order; one chunk is held at a time."""
        out, at = [], 0
        for starts, counts, ids in chunks:
            while at < starts[-1]:
                k = int(np.searchsorted(starts, at))
                if starts[k] == at:
                    first = np.concatenate([[0], np.cumsum(counts)])
                    out.append(ids[4 * first[k] :])
                    at = int(starts[-1])
                else:  # not yet in step: one more pre-token from the true boundary
                    piece = self.pattern.match(text, at)[0]
                    out.append(self.known[piece])
                    at += len(piece)
        while at < len(text):
            piece = self.pattern.match(text, at)[0]
            out.append(self.known[piece])
            at += len(piece)
        return b"".join(out)

    def decoded(self, rows: list[bytes]) -> pa.Array:
        """The bytes of rows of ids, decoded."""
        data, offsets = self.decode(np.frombuffer(b"".join(rows), np.int32).astype(np.int64), np.cumsum([0] + [len(x) // 4 for x in rows]))
        return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, end to end, and where those of each row (rows: offsets into ids) start."""
        size = self.start[ids + 1] - self.start[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[ids] - ends[:-1], size)
        at += np.arange(len(at))
        return self.bytes[at], ends[rows]


_encoders: dict[tuple[bytes, str], Encoder] = {}


def _encoder(ranks: bytes, pattern: str) -> Encoder:
    """A worker's encoder, kept through a task."""
    if (ranks, pattern) not in _encoders:
        _encoders[ranks, pattern] = Encoder(ranks, pattern)
    return _encoders[ranks, pattern]


def _ids(rows: list[bytes]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(x) // 4 for x in rows]), pa.int32()), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", long: int = LONG, chunk: int = CHUNK, overlap: int = OVERLAP, check: bool = False) -> DataFrame:
    """(doc_id, ids array<int>), a row per document: the ids of the whole text as the tiktoken library would encode it without
    special tokens. Null and empty texts have no ids. A repeated id keeps each of its rows. check adds decoded binary, the bytes
    that the ids decode to, in the same pass."""
    spark = docs.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))  # the fixed vocabulary file, under a megabyte
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "ids", "decoded"][: 2 + check]
    schema = f"doc_id {kind}, ids array<int>" + ", decoded binary" * check

    def whole(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                enc = _encoder(ranks.value, pattern)
                ids = [enc.encode(t) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), _ids(ids), *([enc.decoded(ids)] if check else [])], names)
        _encoders.clear()  # workers outlive their tasks and would keep it beside other stages' models

    def pieces(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                enc = _encoder(ranks.value, pattern)
                done = [enc.chunk(t, k * chunk, last) for t, k, last in zip(*(b.column(i).to_pylist() for i in (4, 2, 3)), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array([x[i].tolist() for x in done], pa.list_(pa.int64())) for i in (0, 1)), pa.array([x[2] for x in done], pa.binary())], [*b.schema.names, "starts", "counts", "ids"])

    def stitched(table: pa.Table) -> pa.Table:
        enc = _encoder(ranks.value, pattern)
        rows = sorted(table.select(["k", "text", "starts", "counts", "ids"]).to_pylist(), key=lambda r: r["k"])
        text = "".join(r["text"][:chunk] for r in rows)
        ids = enc.stitch([(np.array(r["starts"]), np.array(r["counts"], np.int64), r["ids"]) for r in rows], text)
        enc.known.clear()
        return pa.table([table["doc_id"].slice(0, 1), _ids([ids]), *([enc.decoded([ids])] if check else [])], names)

    size = F.length("text")
    short = docs.where(size <= long).mapInArrow(trimmed(whole), schema)
    cut = docs.where(size > long).withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text", F.explode(F.sequence(F.lit(0), ((size - 1) / chunk).cast("int"))).alias("k"))
    cut = cut.select("row", "doc_id", "k", ((F.col("k") + 1) * chunk >= size).alias("last"), F.substring("text", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("text"))
    cut = cut.repartition("row", "k").mapInArrow(trimmed(pieces), f"row long, doc_id {kind}, k int, last boolean, text string, starts array<long>, counts array<long>, ids binary")
    return short.union(cut.groupBy("row").applyInArrow(stitched, schema))


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """encoded (doc_id, ids) plus decoded binary: the bytes of the ids, end to end. Null ids decode to nothing."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            enc = _encoder(ranks.value, pattern)
            lists = b.column(1)
            flat = lists.flatten().to_numpy()
            rows = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            for at in range(0, max(1, b.num_rows), 512):
                part = rows[at : at + 513]
                data, offsets = enc.decode(flat[part[0] : part[-1]].astype(np.int64), part - part[0])
                raw = pa.Array.from_buffers(pa.binary(), len(part) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, 512), lists.slice(at, 512), raw], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(trimmed(run), f"doc_id {kind}, ids array<int>, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of rows with ids and decoded."""
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
