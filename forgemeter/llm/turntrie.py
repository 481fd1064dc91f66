"""The prefix trie of conversations, by adaptive radix trees over turn ids.

A turn's id is 16 bytes, the start of the SHA-256 of its role and text, so a conversation is the
string of its turns' ids and equal prefixes are equal leading bytes. Conversations are sorted by
that string over the whole cluster, and by id among equal ones, so no first turn and no group of
copies is one task's. Each task takes its sorted rows in slices of at most SLICE conversations and
puts a slice into a radix tree with nodes of 4, 16, 48 or 256 children and compressed paths. A node
of the trie is where a path, or the inside of a compressed one, reaches a multiple of 16 bytes.

A trie node lies in several slices only if it is a prefix of a slice's first or last string. These,
at most two chains a slice, leave the task as partial rows; the others are whole. The partial rows
are added up by key, and sums over subtrees run along the chains: each node belongs to the first chain that
has it, and a chain gives each of its nodes the sum of what belongs to it from there down. So rows
grow with the chains' lengths, not with their square.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgemeter.llm import tables

ID_BYTES = 16
# A slice ends at so many conversations or bytes of ids, whichever comes first.
SLICE = 4_096
SLICE_BYTES = 8 << 20
OUT_ROWS = 20_000

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Node:
    """A radix-tree node: the path from its parent, and children by their path's first byte.

    Up to 4 or 16 children lie in sorted arrays, up to 48 in slots named by a table of 256 bytes, and more in a
    table of 256 children. A node takes the next layout when it is full."""

    __slots__ = (
        "path", "size", "keys", "kids", "ends", "words", "n", "least", "leaves", "saved", "ways", "up"
    )

    def __init__(self, path: bytes, words):
        self.path = path
        self.words = words
        self.size = 4
        self.keys: bytearray = bytearray()
        self.kids: list[Node | None] = []
        self.ends: list[int] = []

    def child(self, byte: int) -> Node | None:
        if self.size <= 16:
            at = bisect_left(self.keys, byte)
            return self.kids[at] if at < len(self.keys) and self.keys[at] == byte else None
        if self.size == 48:
            slot = self.keys[byte]
            return self.kids[slot - 1] if slot else None
        return self.kids[byte]

    def put(self, byte: int, node: Node) -> None:
        """Adds a child, or puts another in its place."""
        if self.size <= 16:
            at = bisect_left(self.keys, byte)
            if at < len(self.keys) and self.keys[at] == byte:
                self.kids[at] = node
                return
            if len(self.keys) == self.size:
                self._grow()
                self.put(byte, node)
                return
            self.keys.insert(at, byte)
            self.kids.insert(at, node)
        elif self.size == 48:
            slot = self.keys[byte]
            if slot:
                self.kids[slot - 1] = node
            elif len(self.kids) == 48:
                self._grow()
                self.kids[byte] = node
            else:
                self.kids.append(node)
                self.keys[byte] = len(self.kids)
        else:
            self.kids[byte] = node

    def _grow(self) -> None:
        if self.size == 4:
            self.size = 16
        elif self.size == 16:
            slots = bytearray(256)
            for slot, byte in enumerate(self.keys, 1):
                slots[byte] = slot
            self.keys, self.size = slots, 48
        else:
            whole: list[Node | None] = [None] * 256
            for byte, slot in enumerate(self.keys):
                if slot:
                    whole[byte] = self.kids[slot - 1]
            self.keys, self.kids, self.size = bytearray(), whole, 256

    def children(self) -> list[Node]:
        if self.size == 48:
            return [self.kids[slot - 1] for slot in self.keys if slot]
        return [kid for kid in self.kids if kid is not None]


def insert(root: Node, path: bytes, conv_id: int, words) -> None:
    node, at = root, 0
    while at < len(path):
        below = node.child(path[at])
        if below is None:
            leaf = Node(path[at:], words)
            leaf.ends.append(conv_id)
            node.put(path[at], leaf)
            return
        if path.startswith(below.path, at):
            at += len(below.path)
            node = below
            continue
        same = 0
        while at + same < len(path) and below.path[same] == path[at + same]:
            same += 1
        middle = Node(below.path[:same], below.words)
        node.put(path[at], middle)
        below.path = below.path[same:]
        middle.put(below.path[0], below)
        node, at = middle, at + same
    node.ends.append(conv_id)


def _chain_ids(path: bytes) -> list[bytes]:
    """A 128-bit key for each turn-aligned prefix."""
    running = xxhash.xxh3_128()
    keys = [running.digest()]
    for at in range(0, len(path), ID_BYTES):
        running.update(path[at : at + ID_BYTES])
        keys.append(running.digest())
    return keys


def _shared(a: bytes, b: bytes, start: int) -> int:
    """How far b agrees with a from ``start`` on, a's end at most."""
    part = b[: len(a) - start]
    if a.startswith(part, start):
        return start + len(part)
    at = 0
    while a[start + at] == part[at]:
        at += 1
    return start + at


WHOLE, OPEN, CHAIN, ENDS = 0, 1, 2, 3
COLUMNS = (
    "kind", "slice", "side", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
    "saved_tokens", "ends_sha256", "key", "parent", "words", "ids",
)
SCHEMA = (
    "kind int, slice long, side int, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, key binary, parent binary, "
    "words long, ids string"
)


def _joined(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def slice_rows(rows: list[tuple[int, bytes, list[int]]], number: int) -> Iterator[tuple]:
    """The trie nodes of one sorted slice of (conv_id, path, words): whole ones, and partial ones of
    its first and last path."""
    root = Node(b"", [])
    for conv_id, path, words in rows:
        insert(root, path, conv_id, words)
    first, last = rows[0][1], rows[-1][1]
    first_ids, last_ids = _chain_ids(first), _chain_ids(last)

    # Top down: depth in bytes, agreement with the first and last path, and ``up``, the node above whose
    # own path holds the nearest trie node.
    order: list[tuple[Node, int, int, int, int]] = []
    todo = [(root, -1, 0, 0, 0)]
    while todo:
        item = todo.pop()
        order.append(item)
        node, above, depth, on_first, on_last = item
        crosses = depth // ID_BYTES > (above // ID_BYTES if above >= 0 else -1)
        for kid in node.children():
            kid.up = node if crosses else node.up
            a = _shared(first, kid.path, depth) if on_first == depth else on_first
            b = _shared(last, kid.path, depth) if on_last == depth else on_last
            todo.append((kid, depth, depth + len(kid.path), a, b))

    # Bottom up: members, and below each node what is no chain node's; ``ways`` are the children that it
    # adds to the trie node above it.
    stats: dict[int, list[tuple[int, int, int, int, bool]]] = {}
    for node, above, depth, on_first, on_last in reversed(order):
        kids = node.children()
        n = len(node.ends) + sum(kid.n for kid in kids)
        least = min([kid.least for kid in kids] + node.ends[:1])
        children = sum(kid.ways for kid in kids)
        leaves, saved = sum(kid.leaves for kid in kids), sum(kid.saved for kid in kids)
        held = []
        lowest = above // ID_BYTES if above >= 0 else -1
        for turn in range(depth // ID_BYTES, lowest, -1):
            chained = turn * ID_BYTES <= max(on_first, on_last)
            if not chained:
                leaves = leaves or 1
                saved += (n - 1) * node.words[turn - 1]
            held.append((turn, children, leaves, saved, chained))
            children = 0 if chained else 1
        stats[id(node)] = held
        node.n, node.least, node.leaves, node.saved = n, least, leaves, saved
        node.ways = children

    # Top down again: the rows, each with its parent.
    for node, over, depth, on_first, on_last in order:
        for turn, children, leaves, saved, chained in stats[id(node)]:
            ends = node.ends if turn * ID_BYTES == depth else []
            word_count = node.words[turn - 1] if turn else 0
            if chained:
                sides = [s for s, on in ((0, on_first), (1, on_last)) if turn * ID_BYTES <= on]
                for side in sides:
                    keys = (first_ids, last_ids)[side]
                    mine = side == sides[0]
                    yield (
                        CHAIN, number, side, node.least, turn, None, node.n * mine, children * mine,
                        leaves * mine, saved * mine, None, keys[turn], keys[turn - 1] if turn else None,
                        word_count, None,
                    )
                if ends:
                    keys = (first_ids, last_ids)[sides[0]]
                    yield (
                        ENDS, number, 0, ends[0], turn, None, 0, 0, 0, 0, None, keys[turn], None, 0, _joined(ends)
                    )
                continue
            sha = hashlib.sha256(_joined(ends).encode()).hexdigest() if ends else EMPTY_SHA
            above = (turn - 1) * ID_BYTES
            if above <= max(on_first, on_last):
                key = (first_ids if above <= on_first else last_ids)[turn - 1]
                yield (
                    OPEN, number, 0, node.least, turn, None, node.n, children, leaves, saved, sha, None, key, 0, None
                )
            else:
                # On one path the trie nodes have the same members.
                holder = node if above > over else node.up
                yield (
                    WHOLE, number, 0, node.least, turn, holder.least, node.n, children, leaves, saved, sha, None, None, 0, None,
                )


def _slices(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    task = TaskContext.get().partitionId() << 32
    out: list[tuple] = []
    held: list[tuple[int, bytes, list[int]]] = []
    size = number = 0

    def frame() -> pd.DataFrame:
        rows = pd.DataFrame(out, columns=list(COLUMNS))
        rows["parent_conv_id"] = rows["parent_conv_id"].astype("Int64")
        return rows

    for batch in batches:
        for row in zip(batch["conv_id"].tolist(), batch["path"], batch["words"]):
            held.append(row)
            size += len(row[1])
            if len(held) >= most or size >= SLICE_BYTES:
                out.extend(slice_rows(held, task + number))
                held, size, number = [], 0, number + 1
            if len(out) >= OUT_ROWS:
                yield frame()
                out.clear()
    if held:
        out.extend(slice_rows(held, task + number))
    if out:
        yield frame()


def turn_id(role: Column, text: Column) -> Column:
    """The first 16 bytes, in hex, of the SHA-256 of a turn; the role's length keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * ID_BYTES)


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, ids (hex), words of each conversation in turn order; null turns first, equal ones by their id.

    A row without conv_id belongs to no conversation. Texts do not leave their row: a conversation is
    one row of some 30 bytes a turn, however many copies of it there are."""
    text = F.col("text").cast("string")
    one = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        F.struct(
            "turn",
            turn_id(F.col("role").cast("string"), text).alias("id"),
            F.size(tables.words(text)).cast("long").alias("words"),
        ).alias("t"),
    )
    own = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return own.select(
        "conv_id",
        F.transform("ts", lambda t: t["id"]).alias("ids"),
        F.transform("ts", lambda t: t["words"]).alias("words"),
    )


def shared_openings(own: DataFrame, family: int = 20, most: int = 3) -> DataFrame:
    """The conversations rebuilt: each begins with the first h turns of its family's first member and goes
    on with its own turns after its first h; h is the crc32 of its decimal id, modulo ``most`` + 1."""
    heads = own.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"),
        F.slice("ids", 1, most).alias("head_ids"),
        F.slice("words", 1, most).alias("head_words"),
    )
    cut = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    )

    def spliced(head: str, rest: str, kind: str) -> Column:
        opening = F.slice(F.coalesce(head, F.array().cast(kind)), F.lit(1), F.col("h"))
        return F.concat(opening, F.slice(rest, F.col("h") + 1, F.size(rest)))

    return cut.join(heads, "base", "left").select(
        "conv_id",
        spliced("head_ids", "ids", "array<string>").alias("ids"),
        spliced("head_words", "words", "array<bigint>").alias("words"),
    )


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts of lists of ids, sorted by key and first id, to one hash a key; only its state is held."""
    key, state = None, None
    for batch in batches:
        done = []
        for mine, ids in zip(batch["key"], batch["ids"]):
            if mine == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = mine, hashlib.sha256()
            state.update(ids.encode())
        yield pd.DataFrame(done, columns=["key", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends_sha256"])


def trie(convs: DataFrame, most: int = SLICE) -> DataFrame:
    """The nodes of the prefix trie of (conv_id, ids, words): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. No conversations have no nodes, not even a root.
    A slice has at most ``most`` conversations."""
    spark = convs.sparkSession
    paths = tables.stage(
        convs.select("conv_id", F.unhex(F.array_join("ids", "")).alias("path"), "words"), "trie-paths"
    )
    spread = tables.shuffle_partitions(spark)
    ordered = paths.repartitionByRange(spread, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    built = tables.stage(ordered.mapInPandas(lambda rows: _slices(rows, most), SCHEMA), "trie-nodes")

    chain = built.filter(F.col("kind") == CHAIN)
    owner = F.min(F.struct("slice", "side")).alias("owner")
    merged = chain.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        owner,
    )
    merged = tables.stage(merged, "trie-chain")
    chained_kids = merged.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(
        F.count("*").alias("more")
    )
    top = merged.join(chained_kids, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))
    )
    # What each node adds to its subtrees, at the first chain that has it, summed from the chain's end up.
    adds = top.select(
        "key", "owner",
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saving"),
    )
    mine = F.struct("slice", "side") == F.col("owner")
    below = Window.partitionBy("slice", "side").orderBy(F.desc("depth"))
    sums = (
        chain.select("slice", "side", "depth", "key")
        .join(adds, "key")
        .select(
            "key",
            F.sum(F.when(mine, F.col("leaf")).otherwise(0)).over(below).alias("leaf"),
            F.sum(F.when(mine, F.col("saving")).otherwise(0)).over(below).alias("saving"),
        )
        .groupBy("key")
        .agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))
    )
    ends = (
        built.filter(F.col("kind") == ENDS)
        .select("key", "conv_id", "ids")
        .repartition(spread, "key")
        .sortWithinPartitions("key", "conv_id")
        .select("key", "ids")
        .mapInPandas(_digests, "key binary, ends_sha256 string")
    )
    names = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    shown = (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
    chained = (
        top.join(sums, "key")
        .join(ends, "key", "left")
        .join(names, "parent", "left")
        .withColumn("n_leaves", F.col("n_leaves") + F.col("leaf"))
        .withColumn("saved_tokens", F.col("saved_tokens") + F.col("saving"))
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
        .select(*shown)
    )
    # A node below a chain gets its parent's name by slice, so the key of no parent is larger than a slice.
    local = chain.select("slice", F.col("key").alias("parent")).distinct().join(names, "parent")
    opened = (
        built.filter(F.col("kind") == OPEN)
        .drop("parent_conv_id")
        .join(local, ["slice", "parent"])
        .select(*shown)
    )
    return built.filter(F.col("kind") == WHOLE).select(*shown).unionAll(opened).unionAll(chained)


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    own = tables.stage(conversations(tables.read_table(spark, folder, "conversations")), "trie-turns")
    return trie(shared_openings(own))


QUERIES = {"op12_conversation_trie": op12_conversation_trie}
ORACLES = {
    "op12_conversation_trie": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        named AS (
            SELECT conv_id, turn, substr(sha256(strlen(role)::VARCHAR || ':' || role || text), 1, 32) AS id,
                len(list_filter(regexp_split_to_array(text, '[ 	-
]+'), lambda x: x <> '')) AS words
            FROM turns),
        own AS (
            SELECT conv_id, list({'id': id, 'words': words} ORDER BY turn NULLS FIRST, id) AS ts
            FROM named GROUP BY conv_id),
        hashed AS (
            SELECT conv_id, ts, xor(list_reduce(
                list_prepend(4294967295::BIGINT,
                    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                    lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 4 AS h
            FROM own),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.ts, [])[1:h], c.ts[h + 1:]) AS ts
            FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
        steps AS (
            SELECT conv_id, d, len(ts) = d AS ends, CASE WHEN d > 0 THEN ts[d].words ELSE 0 END AS words,
                array_to_string(list_transform(ts[1:d], lambda x: x.id), '') AS key
            FROM rebuilt, unnest(generate_series(0, len(ts))) u(d)),
        nodes AS (
            SELECT key, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                any_value(words) AS words,
                coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
            FROM steps GROUP BY key),
        kids AS (
            SELECT substr(key, 1, length(key) - 32) AS key, count(*) AS n_children
            FROM nodes WHERE depth > 0 GROUP BY 1),
        whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (key)),
        pairs AS (
            SELECT DISTINCT a.key AS top, b.key FROM steps a JOIN steps b ON a.conv_id = b.conv_id AND a.d <= b.d),
        sums AS (
            SELECT top AS key, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
            FROM pairs JOIN whole USING (key) GROUP BY top)
        SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children,
            n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(w.ids) AS ends_sha256
        FROM whole w JOIN sums USING (key)
        LEFT JOIN whole p ON w.depth > 0 AND p.key = substr(w.key, 1, length(w.key) - 32)
    """
}
