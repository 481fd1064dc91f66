"""Near-duplicate embeddings by lattice hashing.

A table projects a unit vector at random onto two blocks of eight numbers and decodes each to the nearest
point of the E8 lattice, the densest packing in eight dimensions; the pair of points is the
vector's cell. Besides its own cell a vector is put in the next nearest ones, found among the 240
neighbours of each point, so vectors either side of a cell's wall still meet. Several tables are
probed. Vectors that meet are compared by cosine, in blocks where a cell is full.

Equal vectors are folded first and only counted. A linked pair is credited once, in the least
cell the two share; a cell gives counts and a spanning star, never its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.llm import tables
from forgemeter.llm.components import components, local_roots

COSINE = 0.98
TABLES = 8
PROBES = 4
SCALE = 1.2
SEED = 20240611
BLOCK = 512


def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: (+-1, +-1, 0 ..) in any places, and (+-1/2, ..) with an even
    number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)


NEIGHBOURS = _neighbours()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: where the sum is odd, the coordinate rounded
    farthest goes the other way."""
    near = np.rint(x)
    gap = x - near
    worst = np.abs(gap).argmax(axis=1)
    rows = np.arange(len(x))
    odd = near.sum(axis=1) % 2 != 0
    near[rows[odd], worst[odd]] += np.where(gap[rows, worst] >= 0, 1.0, -1.0)[odd]
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the nearer of the even integer points and those shifted by a half."""
    whole = _nearest_even(x)
    half = _nearest_even(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(nearer[:, None], half, whole)


def nearest_points(x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest point and the next nearest of its neighbours, with squared distances."""
    first = decode(x)
    gap = x - first
    base = (gap**2).sum(axis=1)
    # |gap - v|^2 = |gap|^2 - 2 gap.v + 2, as every neighbour has squared length 2.
    distance = base[:, None] - 2 * gap @ NEIGHBOURS.T + 2
    order = np.argsort(distance, axis=1, kind="stable")[:, : count - 1]
    points = np.concatenate([first[:, None, :], first[:, None, :] + NEIGHBOURS[order]], axis=1)
    near = np.concatenate([base[:, None], np.take_along_axis(distance, order, axis=1)], axis=1)
    return points, near


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cells(
    unit: np.ndarray, labels: np.ndarray, n_tables: int = TABLES, probes: int = PROBES,
    scale: float = SCALE,
) -> np.ndarray:
    """Cell keys of unit vectors, ``n_tables * probes`` each: the ``probes`` pairs of points with
    the least joint distance, table by table."""
    rng = np.random.default_rng(SEED)
    side = 4
    pairs = np.array(list(itertools.product(range(side), repeat=2)))
    out = []
    for t in range(n_tables):
        keys, near = [], []
        for _ in range(2):
            directions = rng.standard_normal((unit.shape[1], 8)) / scale
            shift = rng.uniform(0, 1, 8)
            points, d = nearest_points(unit @ directions + shift, side)
            twice = np.rint(2 * points).astype(np.int64).astype(np.uint64)
            h = np.full(points.shape[:2], t + 1, dtype=np.uint64)
            for k in range(8):
                h = _mix(h ^ twice[:, :, k]) + np.uint64(0x9E3779B97F4A7C15)
            keys.append(h)
            near.append(d)
        joint = near[0][:, pairs[:, 0]] + near[1][:, pairs[:, 1]]
        best = np.argsort(joint, axis=1, kind="stable")[:, :probes]
        a = np.take_along_axis(keys[0], pairs[best, 0], axis=1)
        b = np.take_along_axis(keys[1], pairs[best, 1], axis=1)
        label = _mix(labels.astype(np.int64).astype(np.uint64))[:, None]
        out.append(_mix(_mix(a) ^ (b + np.uint64(t))) ^ label)
    return np.concatenate(out, axis=1).view(np.int64)


_ROW = "key long, low int, high int, block int, rep long, n long, vector binary, cells binary"


def _compare(rows: pd.DataFrame, cosine: float) -> pd.DataFrame | None:
    """Links inside one cell, or between two blocks of a full one: per vector how many, weighted by
    copies, and the least vector it hangs together with here."""
    if len(rows) < 2:
        return None
    key, low, high = (int(rows[c].iat[0]) for c in ("key", "low", "high"))
    unit = np.vstack([np.frombuffer(v) for v in rows["vector"]])
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    if low != high:
        block = rows["block"].to_numpy()
        linked &= block[:, None] != block[None, :]
    if not linked.any():
        return None
    own = np.vstack([np.frombuffer(c, dtype=np.int64) for c in rows["cells"]])
    lesser, number = np.unique(own[own < key], return_inverse=True)
    if len(lesser):
        holds = np.zeros((len(rows), len(lesser)), dtype=np.float32)
        holds[np.nonzero(own < key)[0], number] = 1
        holds = holds[:, holds.sum(axis=0) > 1]
        linked &= holds @ holds.T == 0
    some = linked.any(axis=1)
    if not some.any():
        return None
    reps, copies = rows["rep"].to_numpy(), rows["n"].to_numpy()
    least = local_roots(linked, reps)
    return pd.DataFrame({"rep": reps, "linked": linked @ copies, "root": least})[some]


def _compare_sorted(batches: Iterator[pd.DataFrame], cosine: float) -> Iterator[pd.DataFrame]:
    """Rows sorted by cell and block pair: a group ends where the next begins."""
    rest: pd.DataFrame | None = None
    group = ["key", "low", "high"]

    def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        values = rows[group].to_numpy()
        edges = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        bounds = [0, *edges.tolist(), len(rows)]
        out = [_compare(rows.iloc[a:b], cosine) for a, b in zip(bounds, bounds[1:]) if b - a > 1]
        out = [x for x in out if x is not None]
        if out:
            yield pd.concat(out)

    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        values = rows[group].to_numpy()
        last = (values == values[-1]).all(axis=1).argmax()
        yield from found(rows.iloc[:last])
        rest = rows.iloc[last:]
    if rest is not None:
        yield from found(rest)


def near_embeddings(
    vectors: DataFrame,
    cosine: float = COSINE,
    n_tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding, label).

    Vectors with an equal label and a cosine of at least ``cosine`` link. Null, zero or non-finite
    vectors, null labels and null ids link with nothing and are their own component; vectors of
    different lengths do not compare; repeated rows are copies of each other. Labels of any type are
    compared as they are."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
        & F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))
    )
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        x.cast("array<double>").alias("embedding"),
        "label",
    ).withColumn("usable", usable)
    valid = rows.filter("usable").drop("usable")
    reps = tables.stage(
        valid.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
        .withColumn("mark", F.xxhash64("label")),
        "lattice-vectors",
    )

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            widths = batch["embedding"].map(len)
            for width, part in batch.groupby(widths, sort=True):
                unit = np.vstack(part["embedding"].to_numpy()).astype(float)
                unit /= np.abs(unit).max(axis=1, keepdims=True)
                unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
                labels = part["mark"].to_numpy() * 1_000_003 + int(width)
                found = np.sort(cells(unit, labels, n_tables, probes, scale), axis=1)
                yield pd.DataFrame(
                    {
                        "rep": part["rep"].to_numpy(),
                        "n": part["n"].to_numpy(),
                        "vector": [u.tobytes() for u in unit],
                        "cells": [c.tobytes() for c in found],
                        "keys": [np.unique(c) for c in found],
                    }
                )

    schema = "rep long, n long, vector binary, cells binary, keys array<long>"
    spread = reps.repartition(tables.shuffle_partitions(vectors.sparkSession), "rep")
    points = tables.stage(spread.mapInPandas(placed, schema), "lattice-cells")
    visits = points.select("rep", F.explode("keys").alias("key"))
    full = visits.groupBy("key").agg(F.count("*").alias("visits")).filter("visits > 1")
    blocks = F.ceil(F.col("visits") / block).cast("int")
    met = visits.join(full, "key").withColumn("blocks", blocks)
    met = met.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "key",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "rep",
    )
    data = met.join(points.drop("keys"), "rep").select(*[f.split()[0] for f in _ROW.split(", ")])
    links = tables.stage(
        data.repartition(tables.shuffle_partitions(vectors.sparkSession), "key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "rep")
        .mapInPandas(
            lambda batches: _compare_sorted(batches, cosine), "rep long, linked long, root long"
        ),
        "lattice-links",
    )
    linked = links.groupBy("rep").agg(F.sum("linked").alias("linked"))
    parts = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    groups = (
        reps.select("label", "embedding", "rep", "n")
        .join(linked, "rep", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .filter("n > 1 or linked is not null")
        .select(
            "label",
            "embedding",
            (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    alone = (F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = valid.join(groups, ["label", "embedding"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    everything = found.unionAll(rows.filter(~F.col("usable")).select("vec_id", *alone))
    return everything.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_embeddings(tables.read_table(spark, folder, "embeddings"))


QUERIES = {"op2_embeddings": op2_embeddings}
ORACLES = {
    "op2_embeddings": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
        reached AS (
            SELECT vec_id, vec_id AS root FROM embeddings
            UNION SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.vec_id),
        roots AS (SELECT vec_id, min(root) AS component_id FROM reached GROUP BY vec_id),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT roots.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id,
            roots.vec_id = component_id AS kept
        FROM roots LEFT JOIN counts ON counts.vec_id = roots.vec_id
    """
}
