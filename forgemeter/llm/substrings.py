"""Passages that repeat, found by doubling the length of windows.

A window of ``target`` words can only repeat if what it holds repeats. So the first level looks at
short windows, the next at windows twice as long, but only where the level before found a repeat, and so
on up to the target or until no candidates survive. Below the target a window is judged by one
of the shorter windows in it, the one with the least hash: equal windows choose equally, so none is
missed, and about two in (target - length + 2) positions are dealt out in place of all. At the
target every surviving window is compared with all others by 96 bits of hash; the first in order of
document and place stays, words under a later one go.

What repeats within a task's own rows is settled there: only one row of each key leaves it, so a
passage in a third of all documents reaches the next task once for each batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.llm import tables

TARGET = 20
FIRST = 5
CHUNK_WORDS = 1_000_000
OPEN, SHARED, SETTLED = 0, 1, 2

_ROW = "key long, kind int, o long, tag long, pos int, mask int, blob binary"
_NAMES = [field.split()[0] for field in _ROW.split(", ")]
_HIT = "o long, tag long, pos int, mask int, blob binary"
_HITS = [field.split()[0] for field in _HIT.split(", ")]
_SECOND_SEED = 0x5EED


def levels(first: int, target: int) -> list[int]:
    """Lengths from about ``first`` to ``target``, each twice the one before (less one if odd).

    A mask of 31 bits holds the places of the last step, so ``target`` is at most 60."""
    if not 2 <= target <= 60:
        raise ValueError("windows have 2 to 60 words")
    out = [target, (target + 1) // 2]
    while out[-1] > first:
        out.append((out[-1] + 1) // 2)
    return out[::-1]


def least_inside(grams: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` hashes the place of the least, the first of equals."""
    runs = np.lib.stride_tricks.sliding_window_view(grams, span)
    return runs.argmin(axis=1) + np.arange(len(runs))


def _chunks(batch: pd.DataFrame) -> Iterator[list[tuple]]:
    """The batch's documents in order, each once, in runs of about CHUNK_WORDS words."""
    rows = batch.drop_duplicates(["o", "tag"]).sort_values(["o", "tag"], kind="stable")
    out, size = [], 0
    for row in rows.itertuples(index=False, name=None):
        out.append(row)
        size += len(row[2]) // 6 + 1
        if size >= CHUNK_WORDS:
            yield out
            out, size = [], 0
    if out:
        yield out


def _candidates(hashes: np.ndarray, places: np.ndarray | None, before: int, target: int):
    """Starts of target windows whose chosen window of the level before repeats; with the choice."""
    n = len(hashes) - target + 1
    if places is None:
        return np.arange(n), None
    chosen = least_inside(tables.window_hashes(hashes, before), target - before + 1)
    marked = np.zeros(len(hashes), dtype=bool)
    marked[places] = True
    starts = np.flatnonzero(marked[chosen])
    return starts, chosen[starts]


def _places(pos, blobs) -> np.ndarray:
    parts = [np.frombuffer(b, dtype="<i4") for b in blobs]
    return np.concatenate([np.asarray(pos, dtype=np.int64), *parts]).astype(np.int64)


def _frame(**columns) -> pd.DataFrame:
    size = len(columns["key"])
    filled = {"kind": OPEN, "o": 0, "tag": 0, "pos": 0, "mask": 0, "blob": None} | columns
    out = pd.DataFrame({name: filled[name] for name in _NAMES}, index=range(size))
    return out.astype({"kind": "int32", "tag": "int64", "pos": "int32", "mask": "int32"})


def _settled(owners: list[tuple[int, int]], found: dict[int, np.ndarray]) -> pd.DataFrame:
    """A row per document of places known to repeat, dealt out evenly."""
    which = list(found)
    spread = tables.mix(np.array([owners[d][0] for d in which], dtype=np.int64).view(np.uint64))
    return _frame(
        key=spread.view(np.int64),
        kind=SETTLED,
        o=[owners[d][0] for d in which],
        tag=[owners[d][1] for d in which],
        blob=[found[d].astype("<i4").tobytes() for d in which],
    )


def _by_document(docs: np.ndarray, values: np.ndarray) -> dict[int, np.ndarray]:
    """Values by document number; the numbers ascend."""
    if not len(docs):
        return {}
    edges = np.flatnonzero(np.diff(docs)) + 1
    firsts = docs[np.concatenate([[0], edges])]
    return dict(zip(firsts.tolist(), np.split(values, edges), strict=True))


def shorter_rows(batches, length: int, before: int | None, target: int) -> Iterator[pd.DataFrame]:
    """Rows of a level below the target: key and place of the windows chosen by candidates."""
    for batch in batches:
        for rows in _chunks(batch):
            owners, docs, pos, keys = [], [], [], []
            for o, tag, text, *hits in rows:
                hashes = tables.word_hashes(text)
                owners.append((o, tag))
                if len(hashes) < target:
                    continue
                starts, _ = _candidates(hashes, _places(*hits) if hits else None, before, target)
                grams = tables.window_hashes(hashes, length)
                own = np.unique(least_inside(grams, target - length + 1)[starts])
                docs.append(np.full(len(own), len(owners) - 1))
                pos.append(own)
                keys.append(grams[own].view(np.int64))
            if not docs:
                continue
            doc, place, key = np.concatenate(docs), np.concatenate(pos), np.concatenate(keys)
            unique, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
            alone = counts[inverse] == 1
            who = np.array(owners, dtype=np.int64)
            yield _frame(
                key=key[alone], o=who[doc[alone], 0], tag=who[doc[alone], 1], pos=place[alone]
            )
            yield _frame(key=unique[counts > 1], kind=SHARED)
            yield _settled(owners, _by_document(doc[~alone], place[~alone]))


def target_rows(batches, before: int, target: int) -> Iterator[pd.DataFrame]:
    """Rows of the target level: under the key of the chosen shorter window the hashes of the
    windows around it, by their distance before it (``mask``); and starts that repeat right here."""
    for batch in batches:
        for rows in _chunks(batch):
            owners, docs, starts, chosen, one, two, keys = [], [], [], [], [], [], []
            for o, tag, text, *hits in rows:
                hashes = tables.word_hashes(text)
                owners.append((o, tag))
                if len(hashes) < target:
                    continue
                own, choice = _candidates(hashes, _places(*hits), before, target)
                if not len(own):
                    continue
                other = tables.word_hashes(text, seed=_SECOND_SEED)
                docs.append(np.full(len(own), len(owners) - 1))
                starts.append(own)
                chosen.append(choice)
                one.append(tables.window_hashes(hashes, target)[own])
                two.append(tables.window_hashes(other, target)[own].astype(np.uint32))
                keys.append(tables.window_hashes(hashes, before)[choice].view(np.int64))
            if not docs:
                continue
            doc, start, choice, a, b, key = map(
                np.concatenate, (docs, starts, chosen, one, two, keys)
            )
            later = _later(a, b)
            yield _settled(owners, _by_document(doc[later], start[later]))
            doc, start, choice, a, b, key = (x[~later] for x in (doc, start, choice, a, b, key))
            if not len(doc):
                continue
            edges = np.flatnonzero((np.diff(doc) != 0) | (np.diff(choice) != 0)) + 1
            firsts = np.concatenate([[0], edges])
            pairs = np.empty(len(a), dtype=[("a", "<u8"), ("b", "<u4")])
            pairs["a"], pairs["b"] = a, b
            raw = pairs.tobytes()
            stops = np.concatenate([edges, [len(a)]])
            bits = np.add.reduceat(1 << (choice - start), firsts)
            who = np.array(owners, dtype=np.int64)
            yield _frame(
                key=key[firsts],
                o=who[doc[firsts], 0],
                tag=who[doc[firsts], 1],
                pos=choice[firsts],
                mask=bits,
                blob=[raw[12 * i : 12 * j] for i, j in zip(firsts.tolist(), stops.tolist())],
            )


def _later(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which (a, b) equal an earlier one."""
    order = np.lexsort((np.arange(len(a)), b, a))
    same = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
    out = np.zeros(len(a), dtype=bool)
    out[order[1:][same]] = True
    return out


def shorter_hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by key, document and place: the places whose key stands at several."""
    rest: pd.DataFrame | None = None

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        place = rows[["key", "o", "tag", "pos", "kind"]]
        rows = rows[~place.duplicated().to_numpy() | (rows["kind"] == SETTLED).to_numpy()]
        open_rows = rows[rows["kind"] != SETTLED]
        key = open_rows["key"].to_numpy()
        size = np.unique(key, return_inverse=True, return_counts=True)
        many = size[2][size[1]] > 1
        shared = np.unique(key[(open_rows["kind"] == SHARED).to_numpy()])
        hit = (many | np.isin(key, shared)) & (open_rows["kind"] == OPEN).to_numpy()
        return pd.concat([open_rows[hit], rows[rows["kind"] == SETTLED]])[_HITS]

    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = int((rows["key"] == rows["key"].iat[-1]).to_numpy().argmax())
        yield found(rows.iloc[:last])
        rest = rows.iloc[last:]
    if rest is not None:
        yield found(rest)


def target_hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by key, document and place: the windows that an earlier row has too.

    Of the key that a batch ends in, the hashes met so far go on to the next."""
    key, seen = None, np.empty(0, dtype=[("a", "<u8"), ("b", "<u4")])
    for batch in batches:
        done = batch[batch["kind"] == SETTLED]
        rows = batch[batch["kind"] == OPEN]
        rows = rows[~rows[["key", "o", "tag", "pos", "mask"]].duplicated().to_numpy()]
        if len(rows):
            if key is None or rows["key"].iat[0] != key:
                seen = seen[:0]
            own = np.frombuffer(b"".join(rows["blob"]), dtype=seen.dtype)
            pairs = np.concatenate([seen, own])
            later = _later(pairs["a"], pairs["b"])
            counts = rows["blob"].map(len).to_numpy() // 12
            row = np.repeat(np.arange(len(rows)), counts)
            key = rows["key"].iat[-1]
            in_last = np.concatenate(
                [np.full(len(seen), rows["key"].iat[0] == key), (rows["key"] == key).to_numpy()[row]]
            )
            kept, later = pairs[in_last & ~later], later[len(seen) :]
            seen = kept
            # The windows of a row stand in order of their start, so farthest before the choice first.
            mask = rows["mask"].to_numpy().astype(np.int64)
            shifts = np.concatenate([_bits(m) for m in mask.tolist()])
            flagged = np.bincount(row[later], (1 << shifts)[later], len(rows)).astype(np.int64)
            out = rows.assign(mask=flagged.astype(np.int32), blob=None)[flagged > 0]
            done = pd.concat([out, done])
        yield done[_HITS]


_BITS: dict[int, np.ndarray] = {}


def _bits(mask: int) -> np.ndarray:
    """Set bits from the highest."""
    found = _BITS.get(mask)
    if found is None:
        bits = [k for k in range(mask.bit_length() - 1, -1, -1) if mask >> k & 1]
        found = _BITS[mask] = np.array(bits, dtype=np.int64)
    return found


def ordered(docs: DataFrame) -> DataFrame:
    """The rows with ``o``, their place in order, and ``tag``, which parts rows of one doc_id: 32 bits
    each of two hashes of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    least = F.lit(-(1 << 63)).cast("long")
    tag = F.shiftleft(F.hash(text).cast("long"), 32).bitwiseOR(
        F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))
    )
    return docs.withColumns({"o": F.coalesce(F.col("doc_id").cast("long"), least), "tag": tag})


def repeated_starts(docs: DataFrame, first: int = FIRST, target: int = TARGET) -> DataFrame:
    """(o, tag, pos, mask, blob) lists per document of starts of windows that stand earlier too."""
    spark = docs.sparkSession
    texts = ordered(docs).select(
        "o", "tag", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    hits, before = None, None
    for length in levels(first, target):
        source = texts
        if hits is not None:
            source = texts.join(hits, ["o", "tag"])
        if length < target:
            source = source if hits is None else source.select("o", "tag", "text", "pos", "blob")
            rows = source.mapInPandas(
                lambda batches, k=length, b=before: shorter_rows(batches, k, b, target), _ROW
            )
            judge = shorter_hits
        else:
            source = source.select("o", "tag", "text", "pos", "blob")
            rows = source.mapInPandas(lambda batches, b=before: target_rows(batches, b, target), _ROW)
            judge = target_hits
        found = tables.stage(
            rows.repartition(tables.shuffle_partitions(spark), "key")
            .sortWithinPartitions("key", "o", "tag", "pos")
            .mapInPandas(judge, _HIT),
            f"substrings-{length}",
        )
        none = F.col("blob").isNull()
        hits = found.groupBy("o", "tag").agg(
            F.collect_list(F.when(none, F.col("pos"))).alias("pos"),
            F.collect_list(F.when(none, F.col("mask"))).alias("mask"),
            F.collect_list("blob").alias("blob"),
        )
        if found.isEmpty():
            break
        before = length
    return hits


def remove_repeats(docs: DataFrame, first: int = FIRST, target: int = TARGET) -> DataFrame:
    """The rows with n_words, n_removed and ``kept_text``, the words left joined by one space.

    A word goes if a window of ``target`` words over it stands earlier too: in a smaller doc_id, or
    earlier in the same document; windows are judged on the input. A null text has no words; a
    null doc_id comes before all others and its rows, like others of one doc_id, are ordered by a
    hash of their text; rows equal in both are one document. Other columns are kept, those with the
    names this adds are replaced."""
    starts = repeated_starts(docs, first, target)
    added = ["n_words", "n_removed", "kept_text", "o", "tag", "starts", "mask", "blob"]
    rows = ordered(docs.drop(*added)).join(
        starts.withColumnRenamed("pos", "starts"), ["o", "tag"], "left"
    )

    @F.pandas_udf("n_words long, n_removed long, kept_text string")
    def cut(text: pd.Series, pos: pd.Series, mask: pd.Series, blob: pd.Series) -> pd.DataFrame:
        out = []
        for t, p, m, b in zip(text, pos, mask, blob, strict=True):
            found = (t or "").encode("utf-8", "surrogatepass").split()
            n = len(found)
            if p is not None and n:
                near = [q - _bits(int(x)) for q, x in zip(p, m, strict=True)]
                at = np.concatenate([*near, *(np.frombuffer(x, dtype="<i4") for x in b), []])
                edge = np.zeros(n + 1, dtype=np.int64)
                at = at.astype(np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, np.minimum(at + target, n), -1)
                gone = edge[:n].cumsum() > 0
                if gone.any():
                    found = [w for w, g in zip(found, gone.tolist()) if not g]
            out.append((n, n - len(found), b" ".join(found).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text"])

    done = rows.withColumn("_cut", cut("text", "starts", "mask", "blob"))
    return done.drop("o", "tag", "starts", "mask", "blob").select("*", "_cut.*").drop("_cut")


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.read_table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


QUERIES = {"op3_substring_dedup": op3_substring_dedup}
ORACLES = {
    "op3_substring_dedup": r"""
        WITH texts AS (
            SELECT doc_id, list_filter(
                regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        words AS (
            SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM texts),
        windows AS (
            SELECT doc_id, i AS p, list(word) OVER (PARTITION BY doc_id ORDER BY i
                ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS held
            FROM words),
        ranked AS (
            SELECT doc_id, p, row_number() OVER (
                PARTITION BY array_to_string(held, ' ') ORDER BY doc_id, p) AS nth
            FROM windows WHERE len(held) = 20),
        gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(p, p + 19)) AS i FROM ranked WHERE nth > 1),
        kept AS (
            SELECT words.doc_id, count(gone.i) AS n_removed,
                string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE gone.i IS NULL) AS rest
            FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i
            GROUP BY words.doc_id)
        SELECT texts.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
            sha256(coalesce(rest, '')) AS kept_sha256
        FROM texts LEFT JOIN kept ON kept.doc_id = texts.doc_id
    """
}
