"""The conversation trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from forgemeter.llm import turntrie
from forgemeter.llm.tables import WORD


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            raw = f"{len(role.encode())}:{role}{text}".encode()
            place = (turn is not None, turn or 0, hashlib.sha256(raw).hexdigest()[:32])
            turns[c].append((place, (role, text)))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in turns.items()}
    nodes = defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c - 20 * int(c / 20))
        rebuilt = tuple(own.get(base, [])[:h] + ts[h:])
        for d in range(len(rebuilt) + 1):
            nodes[rebuilt[:d]].append((c, d == len(rebuilt)))
    out = set()
    for seq, members in nodes.items():
        below = [s for s in nodes if s[: len(seq)] == seq]
        kids = [s for s in below if len(s) == len(seq) + 1]
        leaves = sum(not any(len(t) == len(s) + 1 and t[: len(s)] == s for t in below) for s in below)
        saved = sum((len(nodes[s]) - 1) * len(WORD.findall(s[-1][1])) for s in below if s)
        ends = ",".join(map(str, sorted(c for c, last in members if last)))
        out.add((
            min(c for c, _ in members), len(seq), min(c for c, _ in nodes[seq[:-1]]) if seq else None, len(members),
            len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(5)
    rows = []
    for c in list(range(-25, 140)) + [10**12]:
        for turn in range(rng.randint(1, 6)):
            text = rng.choice(["hello there", "a b c", "", None, "long " * 50]) if turn < 3 else f"own words {rng.randint(0, 3)}"
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "bot", None]), text))
    rows += [r for r in rows[:40]]  # repeated rows
    rows += [(None, 0, "user", "of no conversation")]
    rows += [(c, t, "user", f"deep {t}") for c in (141, 142) for t in range(60 + c % 2)]
    return rows


@pytest.mark.parametrize("most", [3, 4096])
def test_trie_equals_brute_force(spark, talks, most):
    frame = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string")
    own = turntrie.conversations(frame.selectExpr("*", "1 words", "2 ids", "3 path"))
    got = [tuple(r) for r in turntrie.trie(turntrie.shared_openings(own), most).collect()]
    want = brute_trie(talks)
    assert len(got) == len(set(got)) == len(want) and set(got) == want


def test_trie_of_no_conversations(spark, talks):
    frame = spark.createDataFrame(talks[:1], "conv_id long, turn long, role string, text string").filter("false")
    assert turntrie.trie(turntrie.conversations(frame)).isEmpty()


def test_trie_of_turnless_conversations(spark):
    number = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    frame = spark.createDataFrame([(number, 0, "u", "t")], "conv_id long, turn long, role string, text string")
    rows = turntrie.trie(turntrie.shared_openings(turntrie.conversations(frame))).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves) for r in rows] == [(number, 0, 1, 0, 1)]


def test_nodes_grow_through_all_layouts():
    rng = random.Random(1)
    paths = {bytes([rng.randrange(256) for _ in range(16 * rng.randint(1, 3))]) for _ in range(800)}
    paths |= {bytes([7]) + bytes([i]) * 15 for i in range(40)}
    root = turntrie.Node(b"", [])
    for number, path in enumerate(sorted(paths)):
        turntrie.insert(root, path, number, [1] * (len(path) // 16))
    found, sizes, todo = [], set(), [(root, b"")]
    while todo:
        node, before = todo.pop()
        sizes.add(node.size)
        found += [before + node.path] * len(node.ends)
        todo += [(kid, before + node.path) for kid in node.children()]
        assert [k.path[0] for k in node.children()] == sorted(k.path[0] for k in node.children())
    assert sorted(found) == sorted(paths) and sizes >= {4, 48, 256}
