"""Keyed result tables as an append-only changelog: the last committed write of a key wins.

Layout of one table below its root, and of what all its tables share::

    <root>/<table>/pending/N-*/part-*.parquet        batch N while it is written
    <root>/<table>/log/batch_id=N/part-*.parquet     what batch N wrote, once committed
    <root>/<table>/runs/L.A.B/part-*.parquet         the last write of each key in batches A to B (level L)
    <root>/<table>/base/upto=N/part-*.parquet        all keys as of batch N (compaction)
    <root>/<table>/leases/N.<expiry>.*               readers as of batch N that vacuum waits for
    <root>/claims/<query>/taken/N                    numbers given out, each once
    <root>/claims/<query>/of/<generation>.<batch>.N  the number of a query's micro-batch

Executors write a batch below ``pending``; one rename then commits it. So neither readers nor a
stream over the log ever see a half-written batch, and a folder without its ``_SUCCESS`` marker does not
count either. A generation is one checkpoint of a query. Its micro-batches begin with 0 again, but
here each gets the next number free in its query's tables, and keeps it when it is replayed: a new checkpoint over
old tables goes on after them. A batch committed already is not written again, so a replay adds nothing to the
stream of changes. Runs are made of so many neighbouring batches, or runs of the level below, and are for
readers only: a read takes the widest runs, the batches that no run has, and the base before them.
The file system must rename a folder at once, as HDFS does; an object store without
that needs a layer which has it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from forgemeter import schemas
from forgemeter.functions.cells import window_key_literal
from forgemeter.sources import storage


@dataclass(frozen=True)
class KeyedTable:
    """``replace``: each batch holds the whole table. Otherwise a batch holds changed keys.
    ``hashed``: the base is split by a hash of the key, for reads of a few keys."""

    name: str
    key: str
    stored: StructType
    shown: StructType
    replace: bool = False
    hashed: bool = False


REPO = KeyedTable("repo_stats", "repo_name", schemas.REPO_LOG, schemas.REPO_STATS, hashed=True)
ACTOR = KeyedTable("actor_stats", "actor_login", schemas.ACTOR_STATS, schemas.ACTOR_STATS)
LANGUAGE = KeyedTable(
    "language_stats", "language", schemas.LANGUAGE_STATS, schemas.LANGUAGE_STATS, replace=True
)
NEW_REPOS = KeyedTable(
    "new_repos_per_window", "row_key", schemas.WINDOW_COUNT, schemas.WINDOW_COUNT
)
PUSH_SPEED = KeyedTable(
    "push_speed_per_window", "row_key", schemas.WINDOW_COUNT, schemas.WINDOW_COUNT
)
PANES = KeyedTable("pane_states", "row_key", schemas.PANE_STATES, schemas.PANE_STATES)
RESULT_TABLES = {t.name: t for t in (NEW_REPOS, PUSH_SPEED, REPO, ACTOR, LANGUAGE)}


def _log(root: str, table: KeyedTable) -> str:
    return f"{root}/{table.name}/log"


def _base(root: str, table: KeyedTable) -> str:
    return f"{root}/{table.name}/base"


def committed_batches(spark: SparkSession, root: str, table: KeyedTable) -> list[int]:
    return storage.committed(spark, _log(root, table), "batch_id=")


def known_batches(spark: SparkSession, root: str, table: KeyedTable) -> list[int]:
    """Batches that are known to have been written: those in the log, and the last one of each run and base."""
    merged = {run.last for run in runs(spark, root, table)}
    return sorted({*committed_batches(spark, root, table), *merged, *_bases(spark, root, table)})


@dataclass(frozen=True, order=True)
class Run:
    """What the batches ``first`` to ``last`` wrote, the last write of each key, as one folder."""

    first: int
    last: int
    level: int

    @property
    def name(self) -> str:
        return f"{self.level}.{self.first}.{self.last}"

    def holds(self, first: int, last: int) -> bool:
        return self.first <= first and last <= self.last


def _runs_folder(root: str, table: KeyedTable) -> str:
    return f"{root}/{table.name}/runs"


def runs(spark: SparkSession, root: str, table: KeyedTable) -> list[Run]:
    found = [name.split(".") for name in storage.names(spark, f"{_runs_folder(root, table)}/*.*.*")]
    return sorted(Run(int(first), int(last), int(level)) for level, first, last in found)


def _sole_runs(spark: SparkSession, root: str, table: KeyedTable) -> list[Run]:
    """Runs whose batches ``vacuum`` has taken out of the log, or is about to."""
    folder = _runs_folder(root, table)
    return [r for r in runs(spark, root, table) if storage.exists(spark, f"{folder}/{r.name}/_sole")]


def log_is_whole(spark: SparkSession, root: str, table: KeyedTable, after: int) -> bool:
    """Whether the log still has each batch after this one that no base hides."""
    return all(run.last <= after for run in _sole_runs(spark, root, table))


def _bases(spark: SparkSession, root: str, table: KeyedTable) -> list[int]:
    return storage.committed(spark, _base(root, table), "upto=")


def last_batch(spark: SparkSession, root: str, table: KeyedTable) -> int | None:
    """The newest committed batch, counting those already folded into a run or base."""
    return max(known_batches(spark, root, table), default=None)


def next_batch(spark: SparkSession, root: str) -> int:
    """The first id that is free in all result tables below a root."""
    last = [last_batch(spark, root, table) for table in RESULT_TABLES.values()]
    return max((n for n in last if n is not None), default=-1) + 1


# Numbers of so many batches back are remembered as taken; the tables remember the others.
CLAIMS_KEPT = 100


def claim(
    spark: SparkSession,
    root: str,
    generation: str,
    batch_id: int,
    first: int = 0,
    query: str = "all",
    tables: Sequence[KeyedTable] = tuple(RESULT_TABLES.values()),
) -> int:
    """The number of a generation's micro-batch in the tables that a query writes, at least ``first``.

    A replayed micro-batch gets the one it had; only a generation's last two can be replayed, so claims
    before them go. A new one gets a number that none of the tables and no other claim has, also if two
    generations ask at a time: whoever creates its file has it."""
    claims, key = f"{root}/claims/{query}", f"{generation}.{batch_id}."
    held = storage.names(spark, f"{claims}/of/{key}*")
    if held:
        return max(int(name.removeprefix(key)) for name in held)
    taken = [int(name) for name in storage.names(spark, f"{claims}/taken/*")]
    last = [last_batch(spark, root, table) for table in tables]
    number = max([first, *[n + 1 for n in taken], *[n + 1 for n in last if n is not None]])
    while not storage.create(spark, f"{claims}/taken/{number}"):
        number += 1
    storage.create(spark, f"{claims}/of/{key}{number}")
    for name in storage.names(spark, f"{claims}/of/{generation}.*"):
        if int(name.rsplit(".", 2)[1]) < batch_id - 1:
            storage.delete_folder(spark, f"{claims}/of/{name}")
    for n in taken:
        if n < number - CLAIMS_KEPT:
            storage.delete_folder(spark, f"{claims}/taken/{n}")
    return number


def prepare_batch(rows: DataFrame, root: str, table: KeyedTable, batch_id: int) -> str:
    """Write the rows of a batch where nobody reads them yet, sorted within each file so that key
    ranges skip row groups. Returns the folder, for ``commit_batch``."""
    pending = f"{root}/{table.name}/pending/{batch_id}-{uuid.uuid4().hex}"
    rows.select(*table.stored.names).sortWithinPartitions(table.key).write.parquet(pending)
    return pending


def _same_rows(one: DataFrame, other: DataFrame) -> bool:
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def commit_batch(
    spark: SparkSession, root: str, table: KeyedTable, batch_id: int, pending: str
) -> None:
    """Make a prepared batch part of the table. A batch that is there with the same rows stays as it
    is; other rows under its id replace it."""
    committed = f"{_log(root, table)}/batch_id={batch_id}"
    if storage.exists(spark, f"{committed}/_SUCCESS"):
        reader = spark.read.schema(table.stored)
        if _same_rows(reader.parquet(pending), reader.parquet(committed)):
            storage.delete_folder(spark, pending)
            return
    storage.delete_folder(spark, committed)
    storage.move_folder(spark, pending, committed)


def write_batch(rows: DataFrame, root: str, table: KeyedTable, batch_id: int) -> None:
    """Prepare and commit one batch.

    Writing a batch again is a replay. A batch before the newest base is none and readers would never
    see it, so it is refused, and so is one with the base's own id and rows that the base does not have, or
    other rows for a batch that a run has (runs leave out the newest, which can come again). A new
    run over old tables takes ids from ``next_batch`` or ``claim``.
    """
    spark = rows.sparkSession
    base = max(_bases(spark, root, table), default=-1)
    if batch_id < base:
        raise ValueError(f"{table.name}: batch {batch_id} lies before the base of batch {base}")
    pending = prepare_batch(rows, root, table, batch_id)
    if batch_id == base:
        again = spark.read.schema(table.stored).parquet(pending)
        held = read_latest(spark, root, table, base).select(*table.stored.names)
        replay = again.exceptAll(held).isEmpty()
        storage.delete_folder(spark, pending)
        if not replay:
            raise ValueError(f"{table.name}: batch {batch_id} is in the base with other rows")
        return
    if any(batch_id <= run.last for run in runs(spark, root, table)):
        committed = f"{_log(root, table)}/batch_id={batch_id}"
        reader = spark.read.schema(table.stored)
        replay = storage.exists(spark, f"{committed}/_SUCCESS") and _same_rows(
            reader.parquet(pending), reader.parquet(committed)
        )
        storage.delete_folder(spark, pending)
        if not replay:
            raise ValueError(f"{table.name}: batch {batch_id} lies before the end of a run")
        return
    commit_batch(spark, root, table, batch_id, pending)


def read_batch(
    spark: SparkSession, root: str, table: KeyedTable, batch_id: int, blank_key: bool = False
) -> DataFrame:
    """The rows one batch wrote: as shown, or all columns and keys with ``blank_key``."""
    path = f"{_log(root, table)}/batch_id={batch_id}"
    rows = spark.read.schema(table.stored).parquet(path)
    if blank_key:
        return rows
    return rows.where(F.col(table.key) != "").select(*table.shown.names)


# Keys of one part of a hashed base, and its parts at most.
KEYS_A_PART = 500_000
MOST_PARTS = 4_096


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _parts(spark: SparkSession, path: str) -> int:
    """Into how many parts a base is split; 1 for one that is not."""
    marks = storage.names(spark, f"{path}/_parts=*")
    return max((int(name.removeprefix("_parts=")) for name in marks), default=1)


def _read_base(
    spark: SparkSession, root: str, table: KeyedTable, base: int, keys: DataFrame | None = None
) -> DataFrame:
    """The rows of a base; with ``keys`` only the parts of a hashed one that these can be in. What
    reaches the driver is the numbers of the parts, at most MOST_PARTS."""
    path = f"{_base(root, table)}/upto={base}"
    parts = _parts(spark, path)
    if parts == 1 or keys is None:
        return spark.read.schema(table.stored).parquet(path).select(*table.stored.names)
    wanted = sorted(r[0] for r in keys.select(_part(table.key, parts)).distinct().collect())
    rows = spark.read.schema(StructType([*table.stored.fields, StructField("part", IntegerType())])).parquet(path)
    return rows.where(F.col("part").isin(wanted)).select(*table.stored.names)


def read_keys(
    spark: SparkSession, root: str, table: KeyedTable, keys: DataFrame, upto: int | None = None
) -> DataFrame:
    """``read_latest`` of some keys only: the log since the base, and the base's parts they are in."""
    return read_latest(spark, root, table, upto, keys).join(keys, table.key, "left_semi")


def read_latest(
    spark: SparkSession,
    root: str,
    table: KeyedTable,
    upto: int | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """All stored columns of every key as of batch ``upto`` (newest when not given). With ``keys``
    rows of others may be missing.

    A batch whose predecessors were folded into a later base and deleted cannot be read any
    more; that is an error, never a part of the table."""

    def seen(numbers: list[int]) -> list[int]:
        return [n for n in numbers if upto is None or n <= upto]

    all_bases = _bases(spark, root, table)
    base = max(seen(all_bases), default=None)
    logged = committed_batches(spark, root, table)
    if not _readable(upto, all_bases, logged, _sole_runs(spark, root, table)):
        raise ValueError(f"{table.name}: batch {upto} is older than the oldest base kept")
    batches = [n for n in seen(logged) if base is None or n > base]

    if table.replace:
        if batches:
            path = f"{_log(root, table)}/batch_id={batches[-1]}"
        elif base is not None:
            path = f"{_base(root, table)}/upto={base}"
        else:
            return spark.createDataFrame([], table.stored)
        return spark.read.schema(table.stored).parquet(path)

    kept = changed = None
    if base is not None:
        kept = _read_base(spark, root, table, base, keys)
    wide, single = _units(spark, root, table, batches, -1 if base is None else base, upto)
    if wide or single:
        changed = _newest(_read_units(spark, root, table, wide, single), table)
        changed = changed.select(*table.stored.names)
    if kept is not None and changed is not None:
        # The base has one row per key already. While the log is small its keys are
        # broadcast, so the base is neither shuffled nor sorted again.
        return kept.join(changed.select(table.key), table.key, "left_anti").unionByName(changed)
    if kept is not None or changed is not None:
        return kept if kept is not None else changed
    return spark.createDataFrame([], table.stored)


def _units(
    spark: SparkSession, root: str, table: KeyedTable, batches: list[int], base: int, upto: int | None
) -> tuple[list[Run], list[int]]:
    """Which runs and which single batches hold what came after a base: the widest runs first."""
    wide: list[Run] = []
    usable = [r for r in runs(spark, root, table) if r.last > base and (upto is None or r.last <= upto)]
    for run in sorted(usable, key=lambda r: (r.first - r.last, -r.level)):
        if not any(other.holds(run.first, run.last) for other in wide):
            wide.append(run)
    return wide, [n for n in batches if not any(r.holds(n, n) for r in wide)]


def _read_units(
    spark: SparkSession, root: str, table: KeyedTable, wide: list[Run], single: list[int]
) -> DataFrame:
    """The rows of runs and batches, with the batch of each."""
    schema, log, folder = _with_batch(table.stored), _log(root, table), _runs_folder(root, table)
    parts = []
    if wide:
        parts.append(spark.read.schema(schema).parquet(*[f"{folder}/{r.name}" for r in wide]))
    if single:
        paths = [f"{log}/batch_id={n}" for n in single]
        parts.append(spark.read.schema(schema).option("basePath", log).parquet(*paths))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _newest(rows: DataFrame, table: KeyedTable) -> DataFrame:
    """Each key's last write, with its batch."""
    values = [n for n in table.stored.names if n != table.key]
    last = F.max_by(F.struct(*values, "batch_id"), "batch_id").alias("cells")
    named = [F.col(f"cells.{v}").alias(v) for v in (*values, "batch_id")]
    return rows.groupBy(table.key).agg(last).select(table.key, *named)


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("batch_id", LongType())])


def readable_as_of(spark: SparkSession, root: str, table: KeyedTable, upto: int) -> bool:
    """Whether the table can still be read as of this batch: a base not after it is kept, or none was made
    that could have taken its log away."""
    bases, logged = _bases(spark, root, table), committed_batches(spark, root, table)
    return _readable(upto, bases, logged, _sole_runs(spark, root, table))


def _readable(upto: int | None, bases: list[int], logged: list[int], sole: list[Run]) -> bool:
    """Nothing up to this batch is only in a base or a run that goes on after it."""
    if upto is None:
        return True
    base = max((n for n in bases if n <= upto), default=None)
    lost = base is None and bases and not any(n <= min(bases) for n in [*logged, *[r.last for r in sole]])
    start = -1 if base is None else base
    return not lost and not any(max(r.first, start + 1) <= upto < r.last for r in sole)


def read_table(
    spark: SparkSession, root: str, table: KeyedTable, upto: int | None = None
) -> DataFrame:
    """The table as readers see it: a blank key is no row key, so it is not shown."""
    latest = read_latest(spark, root, table, upto)
    return latest.where(F.col(table.key) != "").select(*table.shown.names)


def read_prefix(spark: SparkSession, root: str, table: KeyedTable, rows: int) -> DataFrame:
    """The first rows in key order."""
    return read_table(spark, root, table).orderBy(table.key).limit(rows)


def read_since(spark: SparkSession, root: str, table: KeyedTable, since: int) -> DataFrame:
    """Windows that start after ``since`` (epoch ms); everything when it is 0.

    The condition is on the grouping key, so it goes below the latest-per-key step and
    into the Parquet scan.
    """
    windows = read_table(spark, root, table)
    if since == 0:
        return windows
    return windows.where(F.col(table.key) >= window_key_literal(since + 1))


def compact(spark: SparkSession, root: str, table: KeyedTable) -> int | None:
    """Fold everything committed so far into a new base. Readers may go on meanwhile."""
    newest = last_batch(spark, root, table)
    if newest is None or newest in _bases(spark, root, table):
        return newest
    rows, path = read_latest(spark, root, table, newest), f"{_base(root, table)}/upto={newest}"
    parts = 1
    if table.hashed:
        parts = min(MOST_PARTS, -(-rows.count() // KEYS_A_PART))
    if parts <= 1:
        rows.repartitionByRange(table.key).sortWithinPartitions(table.key).write.mode("overwrite").parquet(path)
        return newest
    split = rows.withColumn("part", _part(table.key, parts)).repartition(parts, "part")
    split.sortWithinPartitions("part", table.key).write.partitionBy("part").mode("overwrite").parquet(path)
    storage.create(spark, f"{path}/_parts={parts}")
    return newest


# So many folders of a level become one of the next. The newest batches stay apart: they can come again.
FAN = 8
REPLAYABLE = 2


def merge_runs(spark: SparkSession, root: str, table: KeyedTable, fan: int = FAN) -> list[Run]:
    """Merge neighbouring batches, and then runs of each level, ``fan`` at a time; returns the runs made.

    A key's last write in them stays, sorted into key ranges. So a row is rewritten once a level, and
    readers find at most ``fan - 1`` folders of each level: with the number of batches they grow by its
    logarithm. Nothing is deleted here. A table that is replaced as a whole has no runs.
    """
    made: list[Run] = []
    if table.replace or fan < 2:
        return made
    level = 0
    while True:
        base = max(_bases(spark, root, table), default=-1)
        there = runs(spark, root, table)
        if level == 0:
            logged = [n for n in committed_batches(spark, root, table) if n > base][:-REPLAYABLE]
            free = [Run(n, n, 0) for n in logged if not any(r.holds(n, n) for r in there)]
        else:
            free = [
                r for r in there
                if r.level == level and r.last > base
                and not any(o.level > level and o.holds(r.first, r.last) for o in there)
            ]
        if len(free) < fan:
            if not any(r.level > level for r in there):
                return made
            level += 1
            continue
        parts = sorted(free)[:fan]
        run = Run(parts[0].first, max(r.last for r in parts), level + 1)
        wide = [] if level == 0 else parts
        single = [r.first for r in parts] if level == 0 else []
        rows = _newest(_read_units(spark, root, table, wide, single), table)
        pending = f"{root}/{table.name}/pending/{run.last}-{uuid.uuid4().hex}"
        rows.repartitionByRange(table.key).sortWithinPartitions(table.key).write.parquet(pending)
        storage.move_folder(spark, pending, f"{_runs_folder(root, table)}/{run.name}")
        made.append(run)


def compact_when_due(
    spark: SparkSession, root: str, table: KeyedTable, every: int, fan: int = FAN
) -> None:
    """Merge what has become ``fan`` folders of a level, and fold all into a new base once so many
    batches have come since the last one. Nothing is deleted; ``vacuum`` does that, once the readers of
    changes have gone on."""
    if not every:
        return
    base = max(_bases(spark, root, table), default=-1)
    logged = [n for n in committed_batches(spark, root, table) if n > base]
    merged = [r for r in _sole_runs(spark, root, table) if r.last > base]
    apart = [n for n in logged if not any(r.holds(n, n) for r in merged)]
    widest = [r for r in merged if not any(o != r and o.holds(r.first, r.last) for o in merged)]
    if len(apart) + sum(r.last - max(r.first, base + 1) + 1 for r in widest) >= every:
        compact(spark, root, table)
    else:
        merge_runs(spark, root, table, fan)


@contextmanager
def lease(
    spark: SparkSession, root: str, table: KeyedTable, seconds: float = 3_600, upto: int | None = None
) -> Iterator[int | None]:
    """While it is held, for so long at most, ``vacuum`` keeps all that a read as of a batch needs. Gives
    the batch to read as of: the newest, unless ``upto`` names one."""
    batch = last_batch(spark, root, table) if upto is None else upto
    if batch is None:
        yield None
        return
    folder = f"{root}/{table.name}/leases"
    held = f"{folder}/{batch}.{int((time.time() + seconds) * 1000)}.{uuid.uuid4().hex}"
    storage.create(spark, held)
    try:
        yield batch
    finally:
        storage.delete_folder(spark, held)


def _leased(spark: SparkSession, root: str, table: KeyedTable) -> int | None:
    """The oldest batch under a lease; leases that have run out go."""
    folder, oldest = f"{root}/{table.name}/leases", None
    for name in storage.names(spark, f"{folder}/*"):
        batch, expiry, _ = name.split(".")
        if int(expiry) < time.time() * 1000:
            storage.delete_folder(spark, f"{folder}/{name}")
        else:
            oldest = int(batch) if oldest is None else min(oldest, int(batch))
    return oldest


def vacuum(spark: SparkSession, root: str, table: KeyedTable, keep_bases: int = 2) -> None:
    """Delete what no reader needs: old bases, batches and runs folded into the oldest base kept, and
    what a wider run has as well.

    Keeping the previous base lets readers that started on it finish; in the same way a run's parts go
    with the second ``vacuum`` that finds it. Readers of any length hold a ``lease``.
    """
    held = _leased(spark, root, table)
    bases = _bases(spark, root, table)
    oldest_kept = bases[-keep_bases] if len(bases) >= keep_bases else -1
    if held is not None:
        oldest_kept = max((n for n in bases if n <= min(held, oldest_kept)), default=-1)
    for n in bases:
        if n < oldest_kept:
            storage.delete_folder(spark, f"{_base(root, table)}/upto={n}")
    logged, there, folder = committed_batches(spark, root, table), runs(spark, root, table), _runs_folder(root, table)
    sole = _sole_runs(spark, root, table)
    for n in logged:
        if n <= oldest_kept or any(r.holds(n, n) for r in sole if held is None or r.first > held):
            storage.delete_folder(spark, f"{_log(root, table)}/batch_id={n}")
    for r in there:
        wider = [o for o in sole if o.level > r.level and o.holds(r.first, r.last)]
        if r.last <= oldest_kept or any(held is None or o.first > held for o in wider):
            storage.delete_folder(spark, f"{folder}/{r.name}")
        elif r not in sole and (held is None or r.first > held):
            storage.create(spark, f"{folder}/{r.name}/_sole")
    for name in storage.names(spark, f"{root}/{table.name}/pending/*"):
        if int(name.partition("-")[0]) < oldest_kept:  # left by a writer that failed
            storage.delete_folder(spark, f"{root}/{table.name}/pending/{name}")


def stream_changes(
    spark: SparkSession,
    root: str,
    table: KeyedTable,
    after: int = -1,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows of batches later than ``after`` as a stream, with their ``batch_id``: of committed batches
    only, and of each once."""
    reader = spark.readStream.schema(_with_batch(table.stored))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    folder = storage.ensure_folder(spark, _log(root, table))
    return reader.parquet(folder).where(F.col("batch_id") > after)


def snapshot_then_changes(
    spark: SparkSession, root: str, table: KeyedTable
) -> tuple[DataFrame, DataFrame]:
    """The current table, and the stream of exactly what is committed after it."""
    version = last_batch(spark, root, table)
    version = -1 if version is None else version
    snapshot = read_table(spark, root, table, upto=version)
    return snapshot, stream_changes(spark, root, table, after=version)
