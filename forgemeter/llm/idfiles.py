"""Token ids in binary shards with Elias-Fano encoded document boundaries.

A shard holds the ids of consecutive documents as one little-endian array, and three
non-decreasing sequences as Elias-Fano code: where each document ends, the ids of the documents
(less the first), and nothing else. Of a value's bits the low ones are stored as they are, the
high ones in unary: value k's bit stands at ``high + k``, so the k-th value is the place of the
k-th set bit less k. A select structure keeps the place of every 512th set bit, so one
look-up scans few words. For n documents in u ids that is 2 + log2(u / n) bits a document, and
no table of 64-bit offsets.

    magic "FMEF0001" | header: 8 x int64 | ids | ends: low, high, samples | doc ids: the same

Executors write the shards with pyarrow's file systems under a name of their own and move them
into place; the manifest, a table written by Spark after them, says which shards count.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgemeter.llm import tables, tokens
from forgemeter.session import new_run_folder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SHARD_IDS = 4_000_000
SAMPLE = 512
MAGIC = b"FMEF0001"
_HEADER = struct.Struct("<8q")
_ENTRY = (
    "part int, shard int, path string, n_docs long, n_ids long, first_doc_id long, null_docs long"
)


@dataclass
class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    n: int
    low_bits: int
    low: np.ndarray  # bits, packed
    high: np.ndarray  # bits, packed
    samples: np.ndarray  # place of every SAMPLE-th set bit

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits)
        low = ((values[:, None] >> shifts) & 1).astype(np.uint8).ravel()
        places = (values >> low_bits) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        high[places] = 1
        return cls(
            n, low_bits, np.packbits(low, bitorder="little"), np.packbits(high, bitorder="little"),
            places[::SAMPLE].astype("<u4"),
        )

    def _low(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, dtype=np.int64)
        start, stop = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.low[start // 8 : (stop + 7) // 8], bitorder="little")
        bits = bits[start % 8 :][: stop - start].reshape(count, self.low_bits).astype(np.int64)
        return bits @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, k: int) -> int:
        """The k-th value, from the nearest sample on."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        sample = k // SAMPLE
        start = int(self.samples[sample])
        stop = int(self.samples[sample + 1]) + 1 if sample + 1 < len(self.samples) else None
        base = start // 8
        bits = np.unpackbits(
            self.high[base : None if stop is None else (stop + 7) // 8], bitorder="little"
        )
        bits[: start % 8] = 0
        place = 8 * base + int(np.flatnonzero(bits)[k % SAMPLE])
        return ((place - k) << self.low_bits) | int(self._low(k, 1)[0])

    def values(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((places - np.arange(self.n)) << self.low_bits) | self._low(0, self.n)

    def to_bytes(self) -> bytes:
        sizes = struct.pack(
            "<5q", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples)
        )
        return sizes + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, raw: memoryview) -> tuple[EliasFano, int]:
        n, low_bits, a, b, c = struct.unpack_from("<5q", raw)
        low = np.frombuffer(raw, np.uint8, a, 40)
        high = np.frombuffer(raw, np.uint8, b, 40 + a)
        samples = np.frombuffer(raw, "<u4", c, 40 + a + b)
        return cls(n, low_bits, low, high, samples), 40 + a + b + 4 * c


class Shard:
    """A shard's bytes: ``document(k)`` without touching the others."""

    def __init__(self, raw: bytes):
        view = memoryview(raw)
        if bytes(view[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a shard of token ids")
        self.n_docs, self.n_ids, width, self.first, self.nulls, at, *_ = _HEADER.unpack_from(
            view, len(MAGIC)
        )
        self.ids = np.frombuffer(view, f"<u{width}", self.n_ids, at)
        at += width * self.n_ids
        self.ends, size = EliasFano.from_bytes(view[at:])
        self.doc_ids, _ = EliasFano.from_bytes(view[at + size :])

    def span(self, k: int) -> tuple[int, int]:
        return (self.ends.select(k - 1) if k else 0), self.ends.select(k)

    def document(self, k: int) -> np.ndarray:
        start, stop = self.span(k)
        return self.ids[start:stop]

    def doc_id(self, k: int) -> int | None:
        return None if k < self.nulls else self.first + self.doc_ids.select(k - self.nulls)


def shard_bytes(doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray) -> bytes:
    """A shard of documents in ascending order of doc_id, nulls first."""
    nulls = sum(x is None for x in doc_ids)
    known = np.array(doc_ids[nulls:], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    at = len(MAGIC) + _HEADER.size
    header = _HEADER.pack(len(doc_ids), len(ids), ids.dtype.itemsize, first, nulls, at, 0, 0)
    codes = EliasFano.of(ends).to_bytes() + EliasFano.of(known - first).to_bytes()
    return MAGIC + header + ids.tobytes() + codes


def write_shard(path: str, raw: bytes) -> None:
    """Whole or not at all: a task that runs again writes the same bytes over it."""
    files, inner = fs.FileSystem.from_uri(path)
    files.create_dir(inner.rpartition("/")[0], recursive=True)
    own = f"{inner}.{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        out.write(raw)
    files.move(own, inner)


def read_shard(path: str) -> Shard:
    files, inner = fs.FileSystem.from_uri(path)
    with files.open_input_file(inner) as source:
        return Shard(source.read())


def write_ids(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Encode documents into shards under ``folder``, in ascending order of doc_id; the manifest.

    A null text is empty, a null doc_id comes first, equal doc_ids stand together ordered by text,
    columns besides doc_id and text are ignored, and no rows make no shards. A shard ends with the
    document that takes it to ``shard_ids``, so a task holds that many ids and a document."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        doc_ids: list[int | None] = []
        found: list[np.ndarray] = []
        shard = size = 0

        def flush() -> pd.DataFrame:
            path = f"{folder}/ids-{part:06d}-{shard:06d}.bin"
            ends = np.cumsum([len(x) for x in found])
            write_shard(path, shard_bytes(doc_ids, np.concatenate(found), ends))
            nulls = sum(x is None for x in doc_ids)
            first = doc_ids[nulls] if nulls < len(doc_ids) else None
            row = (part, shard, path, len(doc_ids), int(ends[-1]), first, nulls)
            names = [field.split()[0] for field in _ENTRY.split(", ")]
            return pd.DataFrame([row], columns=names).astype({"first_doc_id": "Int64"})

        for batch in batches:
            encoder = tokens.encoder(tokenizer_path)
            encoded, kind = encoder.encode(batch["text"].tolist()), encoder.id_type(end_id)
            for doc_id, raw in zip(batch["doc_id"].tolist(), encoded, strict=True):
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                found.append(np.frombuffer(raw + end, dtype="<u4").astype(kind))
                size += len(found[-1])
                if size >= shard_ids:
                    yield flush()
                    shard, size, doc_ids, found = shard + 1, 0, [], []
        if doc_ids:
            yield flush()

    ranged = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(tables.shuffle_partitions(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return tables.stage(ranged.mapInPandas(encode, _ENTRY), "idfiles-manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """Every document of the shards: its ids' place in the whole, their number and checksum.

    A task reads one shard at a time."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"], strict=True):
                shard = read_shard(path)
                ends = shard.ends.values()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                wide = shard.ids.astype("<u4").tobytes()
                sums = [
                    zlib.crc32(wide[4 * a : 4 * b])
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                known = (shard.doc_ids.values() + shard.first).tolist()
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([None] * shard.nulls + known, dtype="Int64"),
                        "start": base + starts,
                        "n_tokens": ends - starts,
                        "ids_crc32": sums,
                        "path": path,
                    }
                )

    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    spread = tables.shuffle_partitions(manifest.sparkSession)
    placed = manifest.select("path", base.alias("base")).repartition(spread, "path")
    return placed.mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, path string"
    )


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    out = new_run_folder(spark, "idfiles")
    docs = tables.read_table(spark, folder, "documents")
    manifest = write_ids(docs, out, tokens.tokenizer_path(TOKENIZER), END_ID)
    return read_ids(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op4_token_files": op4_token_files}
ORACLES: dict[str, str] = {}
