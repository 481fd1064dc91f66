"""Packing token sequences by concatenating and cutting.

Documents are dealt by ranges of doc_id, so the partitions in order hold them in order. The first
pass encodes a partition and gives each document its place within it; the partition totals, summed
up in order, give each partition its base. The second pass adds the base and cuts what crosses a
window's edge. Every window but the last is full. A document is cut in as many pieces as windows
it touches; ``cut_before`` and ``cut_after`` mark the pieces at a boundary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgemeter.llm import tables, tokens

WINDOW = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1

_ENCODED = "part int, doc_id long, at long, n long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, cut_before boolean, cut_after boolean, ids binary"
)


def encode_in_order(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Each document's ids (unsigned 16-bit where the vocabulary allows, else 32-bit) and the
    number of ids before it in its partition. A null text is empty; equal doc_ids stay in one
    partition, ordered by text."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, at = TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            encoder = tokens.encoder(path)
            found = [x + end for x in encoder.encode(batch["text"].tolist())]
            kind = encoder.id_type(end_id)
            n = np.array([len(x) // 4 for x in found], dtype=np.int64)
            ids = [np.frombuffer(x, dtype="<u4").astype(kind).tobytes() for x in found]
            yield pd.DataFrame(
                {"part": part, "doc_id": batch["doc_id"], "at": at + n.cumsum() - n, "n": n, "ids": ids}
            ).astype({"part": "int32"})
            at += int(n.sum())

    ranged = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(tables.shuffle_partitions(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return tables.stage(ranged.mapInPandas(encode, _ENCODED), "packing-encoded")


def bases(encoded: DataFrame) -> DataFrame:
    """Ids before each partition: one row per partition."""
    totals = encoded.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents: their ids as little-endian unsigned bytes of 16 bits, or of 32 where
    the vocabulary needs it, their checksum as 32-bit ids, and their place. Needs ``doc_id`` and ``text``, other columns are ignored; a
    null or empty text is one end id, a repeated row is packed again, a null doc_id comes first,
    and no rows give no pieces."""
    path = tokenizer_path or tokens.tokenizer_path(TOKENIZER)
    encoded = encode_in_order(docs, path, end_id)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, base, at, n, ids in batch[["doc_id", "base", "at", "n", "ids"]].itertuples(
                index=False, name=None
            ):
                first = base + at
                size = len(ids) // n
                wide = np.frombuffer(ids, dtype=f"<u{size}").astype("<u4").tobytes()
                start = 0
                while start < n:
                    sequence, offset = divmod(first + start, window)
                    length = min(window - offset, n - start)
                    stop = start + length
                    rows.append(
                        (doc_id, start, length, zlib.crc32(wide[4 * start : 4 * stop]), n, sequence,
                         offset, start > 0, stop < n, ids[size * start : size * stop])
                    )
                    start = stop
            names = [field.split()[0] for field in _PIECES.split(", ")]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    # One row per partition, so the size of this broadcast is the number of partitions.
    placed = encoded.join(F.broadcast(bases(encoded)), "part")
    return placed.select("doc_id", "base", "at", "n", "ids").mapInPandas(cut, _PIECES)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Training rows of exactly ``window`` ids, padded at the end."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("filled"))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for parts, filled in zip(batch["parts"], batch["filled"], strict=True):
                raw = b"".join(p["ids"] for p in parts)
                got = np.frombuffer(raw, dtype=f"<u{len(raw) // filled}").astype(np.int32)
                rows.append(np.pad(got, (0, window - len(got)), constant_values=pad_id).tolist())
            yield pd.DataFrame(
                {"sequence_id": batch["sequence_id"], "filled": batch["filled"], "ids": rows}
            )

    return joined.mapInPandas(fill, "sequence_id long, filled long, ids array<int>")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(tables.read_table(spark, folder, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
        "cut_before", "cut_after",
    )


QUERIES = {"op1_packing": op1_packing}
ORACLES: dict[str, str] = {}
