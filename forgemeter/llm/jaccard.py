"""Documents joined by the Jaccard similarity of their five-word shingles.

Three global orders of the shingles filter the candidates: the first drops documents, and a pair must
share a prefix token in each of the other two.

1. By hash. A document's prefix is long enough that a similar document shares not one but several
   tokens with it there (a twentieth of the smaller set). Tokens that no other set has in its prefix
   are dropped, and so are documents left with too few: most documents end here.
2. By rarity among the documents left, over their whole sets. What very many documents share (a
   licence, a passage) comes last and is in few prefixes, and a document of which too
   much is its own alone ends here.
3. By rarity in powers of two, and then by another hash.

Documents that share a prefix token of the second order form a family. First each is compared with
the most central document under each of its tokens, and the links are joined into components; then,
family by family and in blocks, the documents of different components are compared, all
filters intersected before the whole sets. So a group of copies costs a star and not all its pairs,
no pair is ever a row but for those of the star, and no link between components is missed. A row is
copied once per block of its family, so what is shuffled grows with the square of a family over BLOCK,
also where different texts are chained into one by shared passages. Equal sets are folded beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgemeter.llm import tables
from forgemeter.llm.components import components, local_roots

SHINGLE = 5
PERCENT = 75
# Rows whose sets a worker holds at a time.
BATCH = 1_000
# In a batch, a token in the prefixes of so many sets is hot: its rows are spread over so many keys.
HOT_IN_BATCH = 32
SPREAD = 16
BLOCK = 256
LARGE = 64


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """A text's set as sorted 64-bit hashes. Fewer words than ``width`` are one shingle."""
    hashes = tables.word_hashes(text or "", lower=True)
    return np.unique(tables.window_hashes(hashes, min(width, len(hashes)) or 1))


def shared_at_least(n: int, percent: int) -> int:
    """Tokens two sets share at least if one has n and they are similar."""
    return -(-percent * n // 100)


def slack(n):
    return n // 20 + 1


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - shared_at_least(n, percent) + slack(n))


def _apart(tokens: list[np.ndarray]) -> dict[str, list[np.ndarray]]:
    """The sets of a batch as ``cold`` and ``hot`` tokens: hot ones are frequent in the batch."""
    unique, counts = np.unique(np.concatenate(tokens or [[]]), return_counts=True)
    often = unique[counts >= HOT_IN_BATCH]
    hot = [np.isin(t, often, kind="sort") if len(often) else np.zeros(len(t), bool) for t in tokens]
    return {
        "cold": [t[~h].view(np.int64) for t, h in zip(tokens, hot)],
        "hot": [t[h].view(np.int64) for t, h in zip(tokens, hot)],
    }


def set_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row its set's size, signature and prefix in the first order. Of equal sets in a batch only
    the first with a doc_id has a prefix: rows without one are never linked."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in tables.parts_of(batches, BATCH):
            seen: set[bytes] = set()
            n, signs, prefixes = [], [], []
            for text, known in zip(batch["text"], batch["doc_id"].notna(), strict=True):
                tokens = shingles(text, width)
                sign = xxhash.xxh3_128_digest(tokens.tobytes())
                first = known and sign not in seen
                kept = prefix_length(len(tokens), percent) if first else 0
                if known:
                    seen.add(sign)
                n.append(len(tokens))
                signs.append(sign)
                prefixes.append(tokens[:kept])
            ids = [int.from_bytes(s[:8], "little", signed=True) for s in signs]
            doc_id = batch["doc_id"].astype("Int64")
            yield pd.DataFrame({"doc_id": doc_id, "n": n, "sign": signs, "id": ids} | _apart(prefixes))

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n long, sign binary, id long, cold array<long>, hot array<long>"
    return tables.stage(picked.mapInPandas(build, schema), "jaccard-sets")


def repeated_tokens(sets: DataFrame) -> DataFrame:
    """(id, n, token, df) of the tokens, of those in ``cold`` and ``hot``, that more than one set has,
    with the number of sets that have them.

    The count is combined before it is shuffled. Back to the sets it goes by a join; there a token that is hot
    in a batch has one of SPREAD numbers beside it, so that its rows lie in many tasks."""
    hot = F.col("at") >= F.size("cold")
    posts = sets.select(
        "id", F.col("n").cast("int"), "cold", F.posexplode(F.concat("cold", "hot")).alias("at", "token")
    ).select(
        "id", "n", "token",
        F.when(hot, F.pmod(F.xxhash64("id"), F.lit(SPREAD)) + 1).otherwise(0).cast("int").alias("part"),
    )
    counts = posts.groupBy("token").agg(
        F.count("*").alias("df"),
        F.min("id").alias("least"),
        F.max("id").alias("most"),
        F.max("part").alias("part"),
    )
    repeated = tables.stage(
        counts.filter("least <> most").select("token", "df", (F.col("part") > 0).alias("hot")), "jaccard-counts"
    )
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SPREAD))).otherwise(F.array(F.lit(0)))
    return posts.join(
        repeated.select("token", "df", F.explode(parts).alias("part")), ["token", "part"]
    ).select("id", "n", "token", "df")


def survivors(hits: DataFrame, percent: int) -> DataFrame:
    """The sets with enough repeated tokens in the first order's prefix."""
    smallest = F.ceil(F.col("n") * percent / 100)  # of the sets similar to this one
    return (
        hits.groupBy("id", "n")
        .agg(F.count_distinct("token").alias("shared"))
        .filter(F.col("shared") >= F.floor(smallest / 20) + 1)
        .select("id")
    )


def ordered_sets(hits: DataFrame, percent: int) -> DataFrame:
    """Per set its repeated ``tokens``, those in its prefix in the second order (``rare``) and in the
    third (``other``), and how common its tokens are (``central``).

    Unrepeated tokens are the rarest: they come first in both prefixes and match nothing."""
    tie = F.xxhash64("token", F.lit(2)).alias("by")
    entry = F.struct("df", tie, "token")
    coarse = F.struct(
        F.floor(F.log2("df")).alias("rare"), F.xxhash64("token", F.lit(3)).alias("by"), "token"
    )
    own = hits.groupBy("id", "n").agg(
        F.collect_set(entry).alias("second"),
        F.collect_set(coarse).alias("third"),
        F.avg("df").alias("central"),
    )
    take = (F.size("second") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")

    def prefix(column: str) -> Column:
        first = F.slice(F.sort_array(column), F.lit(1), F.col("take"))
        return F.transform(first, lambda t: t["token"])

    return own.withColumn("take", take).filter("take > 0").select(
        F.col("id").alias("rep"),
        F.col("n").cast("long"),
        "central",
        F.transform("second", lambda t: t["token"]).alias("tokens"),
        prefix("second").alias("rare"),
        prefix("third").alias("other"),
    )


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def verified(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those that pass the third order too and whose sets are similar."""
    for side in ("a", "b"):
        there = own.select(*[F.col(c).alias(f"{c}_{side}") for c in ("rep", "n", "tokens", "other")])
        pairs = pairs.join(there.withColumnRenamed(f"rep_{side}", side), side)
    same = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.col("n_a") + F.col("n_b") - same
    passed = F.arrays_overlap("other_a", "other_b") & (same * 100 >= union * percent)
    return pairs.filter(passed).select("a", "b")


def _common(lists: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many values each two of the sets share."""
    size = len(lists)
    values, number, counts = np.unique(
        np.concatenate(lists), return_inverse=True, return_counts=True
    )
    row = np.repeat(np.arange(size), [len(x) for x in lists])
    shared = counts[number] > 1
    place = (np.cumsum(counts > 1) - 1)[number[shared]]
    row, out = row[shared], np.zeros((size, size), dtype=np.float32)
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    for first in range(0, int((counts > 1).sum()), columns):
        a, b = np.searchsorted(place, [first, first + columns])
        holds = np.zeros((size, columns), dtype=np.float32)
        holds[row[a:b], place[a:b] - first] = 1
        out += holds @ holds.T
    return out


def _compare_block(rows: pd.DataFrame, percent: int) -> pd.DataFrame | None:
    """Links between a block's documents of different components, or between two blocks'."""
    if len(rows) < 2:
        return None
    n, component = rows["n"].to_numpy(), rows["component"].to_numpy()
    low, high = np.minimum.outer(n, n), np.maximum.outer(n, n)
    maybe = (component[:, None] != component[None, :]) & (low * 100 >= high * percent)
    if rows["left"].iat[0] != rows["right"].iat[0]:
        block = rows["block"].to_numpy()
        maybe &= block[:, None] != block[None, :]
    for column in ("rare", "other"):
        if maybe.any():
            maybe &= _common(list(rows[column])) > 0
    if not maybe.any():
        return None
    some = maybe.any(axis=1)
    rows, n, maybe = rows[some], n[some], maybe[np.ix_(some, some)]
    same = _common(list(rows["tokens"])).astype(np.int64)
    linked = maybe & (same * 100 >= (np.add.outer(n, n) - same) * percent)
    reps = rows["rep"].to_numpy()
    out = pd.DataFrame({"a": reps, "b": local_roots(linked, reps)})
    return out[out["a"] != out["b"]]


def _compare_sorted(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by pair of blocks; a pair has at most some hundred rows."""
    rest: pd.DataFrame | None = None

    def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, part in rows.groupby(["left", "right"], sort=False):
            out = _compare_block(part, percent)
            if out is not None and len(out):
                yield out

    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        pair = rows[["left", "right"]].to_numpy()
        last = int((pair == pair[-1]).all(axis=1).argmax())
        yield from found(rows.iloc[:last])
        rest = rows.iloc[last:]
    if rest is not None:
        yield from found(rest)


def across(own: DataFrame, families: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Links between documents of one family and different components, stored.

    A component of LARGE or more documents has blocks of its own, which are not compared with each
    other; the documents of smaller ones share blocks."""
    placed = (
        own.select("rep")
        .join(families.withColumnRenamed("component", "family"), own["rep"] == families["node"])
        .drop("node")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    placed = tables.stage(placed, "jaccard-families")
    sizes = placed.groupBy("family", "component").agg(F.count("*").alias("size"))
    several = sizes.groupBy("family").agg(F.count("*").alias("parts")).filter("parts > 1")
    owner = F.when(F.col("size") >= LARGE, F.col("component"))
    sizes = sizes.join(several.select("family"), "family").withColumn("owner", owner)
    groups = sizes.groupBy("family", "owner").agg(
        F.sum("size").alias("total"), F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks")
    )
    groups = tables.stage(groups, "jaccard-blocks")
    numbered = groups.select(
        "family", "owner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at")
    ).withColumn("block", F.xxhash64("family", F.coalesce("owner", F.lit(-1)), "at"))
    one = numbered.select("family", F.col("owner").alias("p"), F.col("block").alias("left"))
    two = numbered.select("family", F.col("owner").alias("q"), F.col("block").alias("right"))
    # Blocks of a family, not documents: BLOCK squared times fewer than its pairs.
    pairs = one.join(two, "family").filter(
        "left <= right and (p is null or q is null or p <> q)"
    ).select("left", "right")
    sides = pairs.select("left", "right", F.col("left").alias("block")).unionAll(
        pairs.filter("left <> right").select("left", "right", F.col("right").alias("block"))
    )
    member = (
        placed.join(sizes.select("family", "component", "owner"), ["family", "component"])
        .join(groups.select("family", F.col("owner").alias("_o"), "blocks"), "family")
        .filter(F.col("owner").eqNullSafe(F.col("_o")))
        .withColumn("at", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("block", F.xxhash64("family", F.coalesce("owner", F.lit(-1)), "at"))
        .select("rep", "component", "block")
    )
    rows = (
        member.join(own.select("rep", "n", "tokens", "rare", "other"), "rep")
        .join(sides, "block")
        .select("left", "right", "block", "rep", "n", "component", "rare", "other", "tokens")
    )
    spread = tables.shuffle_partitions(own.sparkSession)
    compared = rows.repartition(spread, "left", "right").sortWithinPartitions("left", "right").mapInPandas(
        lambda batches: _compare_sorted(batches, percent), "a long, b long"
    )
    more = tables.stage(compared, "jaccard-links")
    tables.release(placed)
    tables.release(groups)
    return more


def links(docs: DataFrame, rows: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Representatives of equal sets (sign, rep, copies), and a set of links between them that joins
    all that similar pairs join. Deletes ``rows``, the staged set rows."""
    known = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    reps = tables.stage(
        known.groupBy("sign").agg(
            F.min("doc_id").alias("rep"), F.min("id").alias("id"), F.count("*").alias("copies")
        ),
        "jaccard-reps",
    )
    left = tables.stage(
        survivors(repeated_tokens(known), percent).join(reps, "id").select("rep", "sign"),
        "jaccard-survivors",
    )
    tables.release(rows)

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in tables.parts_of(batches, BATCH):
            found = [shingles(t, width) for t in batch["text"]]
            same = np.array(
                [
                    xxhash.xxh3_128_digest(x.tobytes()) == s
                    for x, s in zip(found, batch["sign"], strict=True)
                ],
                dtype=bool,
            )
            sets = {"id": batch["doc_id"], "n": [len(x) for x in found]} | _apart(found)
            yield pd.DataFrame(sets)[same]

    texts = docs.select(F.col("doc_id").cast("long"), "text").join(
        left.withColumnRenamed("rep", "doc_id"), "doc_id"
    )
    whole = tables.stage(
        texts.mapInPandas(tokens, "id long, n long, cold array<long>, hot array<long>"),
        "jaccard-whole",
    )
    own = tables.stage(ordered_sets(repeated_tokens(whole), percent), "jaccard-ordered")
    tables.release(whole)
    tables.release(left)
    posts = own.select("rep", "n", "central", F.explode("rare").alias("token"))
    lead = F.max(F.struct("central", (-F.col("rep")).alias("first"), "n")).alias("lead")
    star = (
        posts.join(posts.groupBy("token").agg(lead), "token")
        .select(
            F.col("rep").alias("a"),
            (-F.col("lead.first")).alias("b"),
            _sizes_fit("n", "lead.n", percent).alias("fits"),
        )
        .filter("a <> b")
        .distinct()
    )
    star = tables.stage(star, "jaccard-star")
    near = tables.stage(
        verified(star.filter("fits").select("a", "b"), own, percent), "jaccard-links"
    )
    more = across(own, components(star.select("a", "b")), components(near), percent)
    tables.release(star)
    tables.release(own)
    return reps, near.unionAll(more)


def near_documents(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of (doc_id, text).

    A null or blank text has an empty set and links with nothing; a null doc_id is never linked and
    its component is null; rows with equal text are copies; other columns are ignored."""
    whole = set_rows(docs, width, percent)
    # Without the tokens, which are needed no more once the survivors are known.
    rows = tables.stage(whole.select("doc_id", "n", "sign"), "jaccard-rows")
    reps, found = links(docs, whole, width, percent)
    parts = components(found)
    copied = (
        reps.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select("sign", F.coalesce("component", "rep").alias("component_id"), "copies", "component")
        .filter("copies > 1 or component is not null")
        .select("sign", "component_id")
    )
    linked = rows.select("doc_id", F.col("n").alias("n_shingles"), "sign").withColumn(
        "sign", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("sign"))
    )
    return linked.join(copied, "sign", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_documents(tables.read_table(spark, folder, "documents"))


QUERIES = {"op6_ngram_jaccard": op6_ngram_jaccard}
ORACLES = {
    "op6_ngram_jaccard": r"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        starts AS (
            SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS p
            FROM texts WHERE len(ws) > 0),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS s FROM starts),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b
            ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c >= 75 * (x.n + y.n - c)),
        reached AS (
            SELECT doc_id, doc_id AS root FROM documents
            UNION SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.doc_id),
        roots AS (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id)
        SELECT roots.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
        FROM roots LEFT JOIN sizes ON sizes.doc_id = roots.doc_id
    """
}
