"""Collocations: phrases of two to five words that a language has far more often than chance.

Words become numbers, dealt out by frequency within a language. A phrase of k + 1 words is a pair: the
number of its first k words and that of its last. Pairs of numbers lie in tiles of SIDE by SIDE; a tile
that many pairs fall into is counted by direct address (``bincount`` over its cells), and the pairs of all
other tiles as sorted coordinates. Frequent phrases are numbered anew by frequency, and the next length
starts from them.

The texts are read once, into blocks of at most BLOCK words of one language: local word codes, and the
block's own list of words. Words get their global numbers by a join of what a block has with what is
frequent, and go back to the block as its dictionary; so a dictionary is as large as its block, and the
table of frequent words, which grows with the corpus, is never sent whole (Spark broadcasts one that it
knows to be small).

Phrases are counted where they meet: the different pairs of a part of a block, and the different runs of
LONGEST words from each place on, go with their counts to groups by a hash of their first words (two of a
pair, BY of a run). A group has all places of its phrases, so it counts every length from BY on by itself.
Each place is dealt once as a pair and once as a run, whatever is frequent, so what is moved never exceeds
two rows a place, and no length sends anything back to the blocks.

Numbers are stored and moved packed: a block's codes and its frequent words' numbers, the dictionary that a
block is sent, and what is dealt.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgemeter.llm import tables

LEAST = 100
LONGEST = 5
TOP = 2_000
# Words of one language in a block, and of all languages held by a task at a time.
BLOCK = 1 << 19
HELD = 1 << 20
# A block goes out in pieces of about so many words, cut between phrases.
PIECE = 1 << 16
# So many words of a language are dealt at a time, from all its blocks in a task, since short rows pack badly. A
# task holds this many times as many, packed.
PART = 1 << 20
PARTS = 16
# So many places of frequent words are packed by block at a time.
PLACES = 1 << 20
# Bytes of a text that are split at a time.
CHUNK = 1 << 22
# log2 of a tile's side; a tile is dense if it has at least one pair for so many of its cells.
SIDE_BITS = 9
CELLS_A_PAIR = 16
# A pair is one 63-bit number: 32 bits of a phrase's and 31 of a word's.
WORD_BITS = 31
# Longer phrases go to groups by their first words, and a language has a group for so many of its words.
BY = 3
GROUP = 1 << 19

BREAK = b"\xff"
_SPLIT = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 10
)


def word_lists(text: str) -> Iterator[list[bytes]]:
    """A text's words in lists of bounded size, with BREAK, a byte that UTF-8 never has, between pieces."""
    raw = text.encode("utf-8", "surrogatepass").translate(_SPLIT)
    start = 0
    while start < len(raw):
        stop = start + CHUNK
        if stop < len(raw):
            cut = max(raw.rfind(b, start, stop) for b in (b" ", b"\t", BREAK))
            if cut < 0:
                cut = min((at for b in (b" ", b"\t", BREAK) if (at := raw.find(b, stop)) >= 0), default=len(raw))
            stop = cut + 1
        # After the translation only the space and the tab are white space to split().
        yield raw[start:stop].replace(BREAK, b" \xff ").split()
        start = stop


class _Block:
    """The words of one language in a task since the last flush."""

    def __init__(self) -> None:
        self.codes: dict[bytes, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__
        self.codes[BREAK]  # noqa: B018 - the break is code 0
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        for found in word_lists(text):
            self.parts.append(np.fromiter(map(self.codes.__getitem__, found), np.int32, len(found)))
            self.size += len(found)
        self.parts.append(np.zeros(1, np.int32))
        self.size += 1


CODEC = pa.Codec("zstd", compression_level=1)


def _packed(columns: np.ndarray, steps: bool = True) -> bytes:
    """32-bit numbers, first all their low bytes, then the next: high ones are mostly zero, which packs well.
    With ``steps`` the first row, which mostly rises, is kept as its steps."""
    columns = np.array(columns, "<i4", order="C")
    if steps:
        columns[0, 1:] = np.diff(columns[0])
    planes = columns.view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1)
    return columns.shape[1].to_bytes(4, "little") + CODEC.compress(planes.tobytes(), asbytes=True)


def _unpacked(parts: pd.Series, rows: int, steps: bool = True) -> np.ndarray:
    """The columns of all parts, one part after the other."""
    sizes = [_size(x) for x in parts]
    columns = np.empty((rows, sum(sizes)), np.int32)
    stop = 0
    for part, size in zip(parts, sizes):
        start, stop = stop, stop + size
        raw = CODEC.decompress(part[4:], 4 * rows * size, asbytes=True)
        planes = np.frombuffer(raw, np.uint8).reshape(rows, 4, size).transpose(0, 2, 1)
        columns[:, start:stop] = np.ascontiguousarray(planes).view("<i4")[:, :, 0]
        if steps:
            np.cumsum(columns[0, start:stop], dtype=np.int32, out=columns[0, start:stop])
    return columns


def _size(part: bytes) -> int:
    return int.from_bytes(part[:4], "little")


def _packed_words(words: np.ndarray) -> bytes:
    return _packed(words[None, :], steps=False)


def _unpacked_words(part: bytes) -> np.ndarray:
    return _unpacked([part], 1, steps=False)[0]


def _cut(breaks: np.ndarray, size: int, piece: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``piece`` elements that end at a break; a longer stretch without one stays whole."""
    start = 0
    while start < size:
        stop = start + piece
        if stop >= size:
            stop = size
        else:
            at = int(np.searchsorted(breaks, stop, "right"))
            if at and breaks[at - 1] > start:
                stop = int(breaks[at - 1])
            else:
                stop = int(breaks[at]) if at < len(breaks) else size
        yield start, stop
        start = stop


def text_blocks(docs: DataFrame, most: int = BLOCK, piece: int = PIECE) -> DataFrame:
    """Rows of two kinds: (block, lang, codes) packed pieces, with code 0 between phrases, and (block, lang,
    word, code, n) for each different word of a block. A null language is ``und``, a null text empty."""

    def flush(lang: str, block: _Block, number: int) -> Iterator[pd.DataFrame]:
        whole = np.concatenate(block.parts)
        counts = np.bincount(whole, minlength=len(block.codes))
        listed = [w.decode("utf-8", "surrogatepass") for w in islice(block.codes, 1, None)]
        for start in range(0, len(listed), 50_000):
            part = listed[start : start + 50_000]
            codes = np.arange(start + 1, start + 1 + len(part))
            yield pd.DataFrame(
                {"block": number, "lang": lang, "word": part, "code": codes, "n": counts[codes], "codes": None}
            )
        for start, stop in _cut(np.flatnonzero(whole == 0), len(whole), piece):
            packed = _packed_words(whole[start:stop])
            yield pd.DataFrame(
                {"block": [number], "lang": lang, "word": None, "code": 0, "n": 0, "codes": [packed]}
            )

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, _Block] = {}
        total = 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                block = held.setdefault(lang, _Block())
                total -= block.size
                block.add(text)
                total += block.size
                while total >= HELD or block.size >= most:
                    large = lang if block.size >= most else max(held, key=lambda x: held[x].size)
                    gone = held.pop(large)
                    yield from flush(large, gone, number)
                    total, number = total - gone.size, number + 1
                    if large == lang:
                        break
        for lang, block in held.items():
            yield from flush(lang, block, number)
            number += 1

    picked = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    schema = "block long, lang string, word string, code long, n long, codes binary"
    return tables.stage(picked.mapInPandas(build, schema), "phrases-blocks")


def ranked(counts: DataFrame, tie: str, limit: int) -> DataFrame:
    """Each language's rows numbered from 0 by ``a``, the greatest first."""
    placed = tables.numbered(counts.withColumn("less", -F.col("a")), ["lang", "less", tie], "phrases-ranked")
    starts = placed.groupBy("lang").agg(F.min("number").alias("first"))
    own = F.col("number") - F.col("first")
    fits = F.when(own < limit, own).otherwise(
        F.raise_error(F.lit("more frequent phrases in a language than numbers")).cast("long")
    )
    return placed.join(starts, "lang").select(
        "lang", fits.alias("id"), "a", *[c for c in counts.columns if c not in ("lang", "a")]
    )


def tile_counts(
    left: np.ndarray, right: np.ndarray, times: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """How often each pair occurs: dense tiles by direct address, the others as sorted coordinates. A pair
    counts once, or as often as ``times`` has it."""
    side = 1 << SIDE_BITS
    _, tile, sizes = np.unique(
        (left >> SIDE_BITS) << 32 | (right >> SIDE_BITS), return_inverse=True, return_counts=True
    )
    dense = sizes * CELLS_A_PAIR >= side * side
    keys, counts = [], []
    apart = ~dense[tile]
    if dense.any():
        order = np.argsort(tile, kind="stable")
        stops = np.cumsum(sizes)
        for t in np.flatnonzero(dense):
            at = order[stops[t] - sizes[t] : stops[t]]
            row, column = left[at] & (side - 1), right[at] & (side - 1)
            weights = None if times is None else times[at]
            cells = np.bincount(row << SIDE_BITS | column, weights, side * side)
            there = np.flatnonzero(cells)
            high, low = left[at[0]] & ~np.int64(side - 1), right[at[0]] & ~np.int64(side - 1)
            keys.append((high + (there >> SIDE_BITS)) << WORD_BITS | (low + (there & (side - 1))))
            counts.append(cells[there])
    pairs = left[apart] << WORD_BITS | right[apart]
    if times is None:
        found, n = np.unique(pairs, return_counts=True)
    else:
        found, spot = np.unique(pairs, return_inverse=True)
        n = np.bincount(spot, times[apart], len(found))
    # Weighted sums are floats, exact below 2^53.
    return np.concatenate([*keys, found]), np.concatenate([*counts, n]).astype(np.int64)


def _kept(words: np.ndarray) -> bytes | None:
    """Only the stretches of two frequent words or more, packed, with a break between them."""
    known = words >= 0
    at = np.flatnonzero(known[:-1] & known[1:])
    if not len(at):
        return None
    keep = np.zeros(len(words), bool)
    keep[at] = keep[at + 1] = True
    place = np.flatnonzero(keep)
    gaps = np.flatnonzero(np.diff(place) > 1) + 1
    return _packed_words(np.insert(words[place], gaps, -1))


def _joined(parts: list[bytes]) -> np.ndarray:
    """The parts' words, with a break after each."""
    end = np.full(1, -1, np.int32)
    return np.concatenate([x for part in parts for x in (_unpacked_words(part), end)])


def by_block(places: DataFrame) -> DataFrame:
    """(of, known): the (of, code, id) rows of a block together, packed before they are moved to it."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                size += len(batch)
            if held and (batch is None or size >= PLACES):
                of, code, number = (np.concatenate([x[c].to_numpy() for x in held]) for c in ("of", "code", "id"))
                order = np.lexsort((code, of))
                of, columns = of[order], np.stack([code, number])[:, order]
                starts = np.flatnonzero(np.append(len(of) > 0, of[1:] != of[:-1]))
                packed = [_packed(x) for x in np.split(columns, starts[1:], axis=1)] if len(of) else []
                yield pd.DataFrame({"of": of[starts], "known": packed})
                held, size = [], 0

    return places.select("of", "code", "id").mapInPandas(pack, "of long, known binary")


def number_words(pieces: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The pieces of each block with its frequent words' numbers, from its codes and numbers in ``by_block``."""

    def encode(parts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        rows = []
        codes = [_unpacked_words(x) for x in parts["codes"]]
        numbers = np.full(max((int(c.max()) for c in codes), default=0) + 1, -1, np.int32)
        if len(known):
            listed = _unpacked(known["known"], 2)
            numbers[listed[0]] = listed[1]
        for block, lang, local in zip(parts["block"], parts["lang"], codes):
            kept = _kept(numbers[local])
            if kept:
                rows.append((block, lang, kept))
        return pd.DataFrame(rows, columns=["block", "lang", "words"])

    schema = "block long, lang string, words binary"
    return pieces.groupBy("block").cogroup(dictionary.groupBy("of")).applyInPandas(encode, schema)


def _runs(words: np.ndarray, longest: int) -> np.ndarray:
    """A column for each place with BY words before the next break: ``longest`` words, -1 after the break."""
    padded = np.concatenate([words, np.full(longest, -1, np.int32)])
    known = padded >= 0
    at = np.flatnonzero(np.logical_and.reduce([known[i : len(words) + i] for i in range(BY)]))
    runs = np.empty((longest, len(at)), np.int32)
    for i in range(longest):
        runs[i] = padded[at + i]
        if i >= BY:
            runs[i, runs[i - 1] < 0] = -1
    return runs


def _different(runs: np.ndarray) -> np.ndarray:
    """The different columns in order, and below them how often each is there."""
    runs = runs[:, np.lexsort(runs[::-1])]
    fresh = np.flatnonzero(np.append(runs.size > 0, (runs[:, 1:] != runs[:, :-1]).any(axis=0)))
    return np.vstack([runs[:, fresh], np.diff(np.append(fresh, runs.shape[1]))])


def _different_pairs(words: np.ndarray) -> np.ndarray:
    """The different pairs in order, and below them how often each is there."""
    wide = words.astype(np.int64)
    at = np.flatnonzero((wide[:-1] >= 0) & (wide[1:] >= 0))
    pair, n = tile_counts(wide[at], wide[at + 1])
    order = np.argsort(pair)
    return np.stack([pair >> WORD_BITS, pair & ((1 << WORD_BITS) - 1), n])[:, order]


def deal(stretches: DataFrame, longest: int) -> DataFrame:
    """(lang, width, bucket, runs): the different pairs, and the different runs of up to ``longest`` words, of
    a language's next blocks with their counts, by a hash of their first words. ``stretches`` has the number of
    ``buckets`` of its language."""

    def dealt(lang: str, buckets: int, parts: list[bytes]) -> Iterator[pd.DataFrame]:
        words = _joined(parts)
        for width in sorted({2, longest}) if longest > 1 else ():
            columns = _different_pairs(words) if width == 2 else _different(_runs(words, width))
            if not columns.size:
                continue
            by = min(width, BY)
            hashed = tables.window_hashes(columns[:by].T.astype(np.uint64).ravel(), by)[::by]
            bucket = (hashed % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            columns, bucket = columns[:, order], bucket[order]
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            packed = [_packed(x) for x in np.split(columns, starts[1:], axis=1)]
            yield pd.DataFrame({"lang": lang, "width": width, "bucket": bucket[starts], "runs": packed})

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, int], list[bytes]] = {}
        sizes: dict[tuple[str, int], int] = defaultdict(int)
        for batch in batches:
            for lang, buckets, part in zip(batch["lang"], batch["buckets"], batch["words"]):
                own, size = (lang, buckets), _size(part)
                if own in held and sizes[own] + size > PART:
                    sizes.pop(own)
                    yield from dealt(*own, held.pop(own))
                held.setdefault(own, []).append(part)
                sizes[own] += size
                if sum(sizes.values()) > PARTS * PART:
                    own = max(sizes, key=sizes.__getitem__)
                    sizes.pop(own)
                    yield from dealt(*own, held.pop(own))
        for own, parts in held.items():
            yield from dealt(*own, parts)

    columns = stretches.select("lang", "buckets", "words")
    return columns.mapInPandas(build, "lang string, width int, bucket long, runs binary")


def count_dealt(dealt: DataFrame, least: int) -> DataFrame:
    """(lang, ids, a): the phrases of two words and more that occur ``least`` times, as their words' numbers."""

    def count(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        lang, width, _ = key
        columns = _unpacked(parts["runs"], width + 1)
        runs, times = columns[:-1].astype(np.int64), columns[-1]
        known, phrase = 1, runs[0]
        if width >= BY:
            # Phrases shorter than BY are not whole here, so they are numbered and not judged.
            known = BY - 1
            for k in range(1, known):
                _, phrase = np.unique(phrase << WORD_BITS | runs[k], return_inverse=True)
        ids, a = [], []
        for k in range(known, width):
            at = np.flatnonzero((phrase >= 0) & (runs[k] >= 0))
            pair, n = tile_counts(phrase[at], runs[k, at], times[at])
            pair, n = pair[n >= least], n[n >= least]
            if not len(pair):
                break
            order = np.argsort(-n, kind="stable")
            number = np.empty(len(pair), np.int64)
            number[order] = np.arange(len(pair))
            by = np.argsort(pair)
            own = phrase[at] << WORD_BITS | runs[k, at]
            spot = by[np.minimum(np.searchsorted(pair, own, sorter=by), len(pair) - 1)]
            longer = np.full(len(phrase), -1, np.int64)
            longer[at] = np.where(pair[spot] == own, number[spot], -1)
            phrase = longer
            example = np.empty(len(pair), np.int64)
            there = np.flatnonzero(phrase >= 0)
            example[phrase[there]] = there
            ids += list(runs[: k + 1, example].T)
            a += n[order].tolist()
        rows = {"lang": lang, "ids": pd.Series(ids, dtype=object), "a": pd.Series(a, dtype=np.int64)}
        return pd.DataFrame(rows)

    groups = dealt.groupBy("lang", "width", "bucket")
    return groups.applyInPandas(count, "lang string, ids array<long>, a long")


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = BLOCK, piece: int = PIECE,
    group: int = GROUP,
) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, a) of all phrases of up to ``longest`` words that occur ``least`` times, words
    included, and (lang, n), the words of each language."""
    blocks = text_blocks(docs, most, piece)
    own = blocks.filter(F.col("word").isNotNull()).select("block", "lang", "word", "code", "n")
    totals = tables.stage(own.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")

    # One shuffle of what the blocks have: a word's places, at most one a block, stay with it.
    places = F.collect_list(F.struct(F.col("block").alias("of"), "code")).alias("places")
    counted = tables.stage(
        own.repartition("lang", "word")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("a"), places)
        .filter(F.col("a") >= least),
        "phrases-counted",
    )
    words = tables.stage(ranked(counted.select("lang", "word", "a"), "word", 1 << WORD_BITS), "phrases-words")
    apart = (F.col("places.of").alias("of"), F.col("places.code").cast("array<int>").alias("code"))
    known = counted.select("lang", "word", *apart).join(words.select("lang", "word", "id"), ["lang", "word"])
    dictionary = by_block(known.select("id", F.inline(F.arrays_zip("of", "code"))))
    pieces = blocks.filter(F.col("codes").isNotNull()).select("block", "lang", "codes")
    stretches = tables.stage(number_words(pieces, dictionary), "phrases-stretches")
    tables.release(blocks)
    tables.release(counted)
    buckets = totals.select("lang", F.ceil(F.col("n") / group).alias("buckets"))
    dealt = deal(stretches.join(buckets, "lang"), longest)
    numbers = tables.stage(count_dealt(dealt, least), "phrases-numbers")
    tables.release(stretches)
    phrases = (
        numbers.select("lang", "ids", "a", F.posexplode("ids").alias("at", "id"))
        .join(words.select("lang", "id", "word"), ["lang", "id"])
        .groupBy("lang", "ids", "a")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"))
        .select("lang", F.size("ids").alias("k"), F.concat_ws(" ", "parts.word").alias("phrase"), "a")
    )
    found = tables.stage(phrases, "phrases-found")
    return words.select("lang", F.lit(1).alias("k"), F.col("word").alias("phrase"), "a").unionAll(found), totals


def _ratio(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in decimals of 38 digits."""
    wide = (a * 1000).cast("decimal(20,0)") * n.cast("decimal(18,0)")
    by = left.cast("decimal(19,0)") * right.cast("decimal(19,0)")
    return F.call_function("div", wide, by)


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, most: int = BLOCK,
    piece: int = PIECE, group: int = GROUP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases, from (lang, text).

    A candidate's score is that of its worst cut; one that a longer candidate always contains is dropped.
    Null texts are empty, and tables without a frequent phrase give no rows."""
    found, totals = frequent_phrases(docs, least, longest, most, piece, group)
    candidates = found.filter("k > 1").join(totals, "lang")
    words = F.split("phrase", " ")
    cuts = candidates.select(
        "lang", "k", "phrase", "a", "n", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    ).select(
        "*",
        F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("k")), " ").alias("rest"),
    )
    count = found.select("lang", "phrase", "a")
    scored = (
        cuts.join(count.toDF("lang", "first", "l"), ["lang", "first"])
        .join(count.toDF("lang", "rest", "r"), ["lang", "rest"])
        .withColumn("score", _ratio(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    )
    lengths = F.sequence(F.lit(2), F.col("k") - 1)
    parts = F.flatten(
        F.transform(
            lengths,
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("k") - size + 1),
                lambda at: F.array_join(F.slice(words, at, size), " "),
            ),
        )
    )
    inside = (
        found.filter("k > 2")
        .select("lang", "a", F.explode(parts).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    alone = scored.join(inside, ["lang", "phrase"], "left").filter("around is null or 100 * around < 100 * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        alone.select("lang", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(tables.read_table(spark, folder, "documents"))


QUERIES = {"op11_collocations": op11_collocations}
ORACLES = {
    "op11_collocations": r"""
        WITH docs AS (
            SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        pieces AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
            FROM docs, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) u(piece)),
        totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
        f AS (
            SELECT lang, k, array_to_string(ws[p:p + k - 1], ' ') AS phrase, count(*) AS a
            FROM pieces, unnest(generate_series(1, len(ws))) u(p), unnest(generate_series(1, 5)) v(k)
            WHERE p + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 100),
        c AS (SELECT f.*, n, string_split(phrase, ' ') AS ws FROM f JOIN totals USING (lang) WHERE k > 1),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, c.n, cut, l.a AS l, r.a AS r,
                ((1000::HUGEINT * c.a * c.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
            FROM c, unnest(generate_series(1, k - 1)) u(cut)
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:cut], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[cut + 1:], ' ')),
        worst AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        alone AS (
            SELECT * FROM worst w WHERE NOT EXISTS (
                SELECT 1 FROM f g WHERE g.lang = w.lang AND len(string_split(g.phrase, ' ')) >
                    len(string_split(w.phrase, ' ')) AND g.a >= w.a
                    AND contains(' ' || g.phrase || ' ', ' ' || w.phrase || ' ')))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
            phrase, a, l, r, n, score
        FROM alone QUALIFY rank <= 2000
    """
}
