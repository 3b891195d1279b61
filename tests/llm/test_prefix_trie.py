import hashlib
import random
import zlib

import pytest

from tideline.llm import prefix_trie
from tideline.llm.prefix_trie import Node, insert

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    """The contract in plain Python over whole rebuilt conversations."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), tie, (role, text)))
    own = {c: [t for _, _, t in sorted(turns)] for c, turns in own.items()}
    members = {}
    ends = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))  # as SQL's %
        chain = tuple(own.get(base, [])[:h] + turns[h:])
        ends.setdefault(chain, []).append(c)
        for d in range(len(chain) + 1):
            members.setdefault(chain[:d], []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in members:
        words = len([w for w in node[-1][1].encode().split() if w]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(members[node]) - 1) * words
    nodes = [
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children.get(node, 0), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, m in members.items()
    ]
    return sorted(nodes, key=str)


def found(spark, rows):
    return sorted((tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def planted():
    """Conversations of few different turns, many alike, some short, with a long one, gaps in the ids and odd rows."""
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 150), 400, 407, -3, 10**12 + 7]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(rng.choices(["a", "b"], k=rng.randint(0, 2)))))
    rows += [(c, t, "user", "the same") for c in range(200, 290) for t in range(4)]
    rows += [(500, t, "user", f"turn {t}  with\twords") for t in range(300)]
    rows += [(501, None, None, None), (501, 0, "user", None), (501, None, "x", "y"), (502, 1, "user", "z"), (502, 1, "user", "z"), (None, 0, "user", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 8, 60])
def test_against_brute_force(spark, partitions):
    """Also where nearly every range holds a key or two, so that most nodes are put together from parts."""
    rows = planted()
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert found(spark, rows) == brute_force(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(spark, rows) == brute_force(rows)


def test_long_class_is_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 20)
    rows = [(c, 0, "user", "hello") for c in range(0, 4000, 4)]
    assert found(spark, rows) == brute_force(rows)


def test_empty_and_clashing_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "a")]) == []
    rows = [(1, 0, "user", "a b"), (2, 0, "user", "a b"), (2, 1, "user", "c " * 50_000)]
    named = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", depth long, key long, turns long")
    assert sorted((tuple(r) for r in prefix_trie.trie(named).collect()), key=str) == brute_force(rows)


def test_radix_tree_layouts():
    rng = random.Random(1)
    keys = {bytes(rng.choices(range(n), k=length)) for n in (2, 5, 40, 256) for length in range(1, 5) for _ in range(400)}
    root, kinds = Node(b""), set()
    for key in rng.sample(sorted(keys), len(keys)):
        insert(root, key, key)
    stack, seen = [(root, b"")], []
    while stack:
        node, key = stack.pop()
        key += node.path
        kinds.add(node.kind)
        if node.value is not None:
            assert node.value == key
            seen.append(key)
        assert len(node.bytes) == {4: len(node.children), 16: len(node.children), 48: 256, 256: 0}[node.kind]
        below = list(node.items())
        assert [b for b, _ in below] == sorted({b for b, _ in below}) and len(below) != 1 or node.value is not None or node is root
        for byte, child in below:
            assert node.child(byte) is child
            stack.append((child, key + bytes([byte])))
    assert sorted(seen) == sorted(keys) and kinds == {4, 16, 48, 256}
