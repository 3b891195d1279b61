"""The prefix trie of conversations, from adaptive radix trees over ranges of their keys.

A conversation's key is the chain of its turns' ids, each of ID_BYTES bytes. Keys are dealt to tasks in ranges of their
order; a task builds the tree of its range and gives its nodes. Only prefixes of a range's first or last key can occur
in other ranges, so those are given in parts, which one more tree, of at most two keys a range, puts together.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import if_small, written

#: A turn's id is the md5 of its role and text.
ID_BYTES = 16
#: Bytes of joined ids that are handed on at once.
PIECE_BYTES = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()


class Node:
    """A node of an adaptive radix tree: the bytes of its compressed path, its children, and the key that ends here.

    Up to 4 and up to 16 children lie in sorted byte strings beside a list, up to 48 behind a table of 256 places, more
    in a list of 256. A node grows to the next layout when it is full.
    """

    __slots__ = ("path", "kind", "bytes", "children", "value")

    def __init__(self, path: bytes):
        self.path, self.kind, self.bytes, self.children = path, 4, bytearray(), []
        self.value = None

    def child(self, byte: int) -> "Node | None":
        if self.kind <= 16:
            at = self.bytes.find(byte)
            return self.children[at] if at >= 0 else None
        if self.kind == 48:
            at = self.bytes[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def put(self, byte: int, child: "Node") -> None:
        """Adds a child, or replaces the one at its byte."""
        if self.kind == 256:
            self.children[byte] = child
            return
        if self.kind == 48:
            at = self.bytes[byte]
            if at:
                self.children[at - 1] = child
                return
        else:
            at = self.bytes.find(byte)
            if at >= 0:
                self.children[at] = child
                return
        if len(self.children) == self.kind:
            self._grow()
            self.put(byte, child)
        elif self.kind == 48:
            self.children.append(child)
            self.bytes[byte] = len(self.children)
        else:
            at = sum(b < byte for b in self.bytes)
            self.bytes.insert(at, byte)
            self.children.insert(at, child)

    def _grow(self) -> None:
        pairs = list(self.items())
        self.kind = {4: 16, 16: 48, 48: 256}[self.kind]
        if self.kind == 48:
            self.bytes = bytearray(256)
            for at, (byte, _) in enumerate(pairs):
                self.bytes[byte] = at + 1
        elif self.kind == 256:
            self.bytes, self.children = bytearray(), [None] * 256
            for byte, child in pairs:
                self.children[byte] = child

    def items(self) -> Iterator[tuple[int, "Node"]]:
        """Children by ascending byte."""
        if self.kind <= 16:
            yield from zip(self.bytes, self.children, strict=True)
        elif self.kind == 48:
            for byte, at in enumerate(self.bytes):
                if at:
                    yield byte, self.children[at - 1]
        else:
            for byte, child in enumerate(self.children):
                if child is not None:
                    yield byte, child


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def insert(root: Node, key: bytes, value: object) -> None:
    """Puts a key that is not in the tree yet; the root's path is empty."""
    node, above, byte = root, None, 0
    at = 0
    while True:
        same = _shared(node.path, key[at : at + len(node.path)])
        if same < len(node.path):
            # The compressed path ends early: what is left of it goes below a new node.
            split = Node(node.path[:same])
            split.put(node.path[same], node)
            node.path = node.path[same + 1 :]
            above.put(byte, split)
            node = split
        at += same
        if at == len(key):
            node.value = value
            return
        byte = key[at]
        below = node.child(byte)
        if below is None:
            leaf = Node(key[at + 1 :])
            leaf.value = value
            node.put(byte, leaf)
            return
        above, node, at = node, below, at + 1


class Part:
    """What a task knows of a node: the members of its own (in no node below that it gives as a part too), the least of
    them, the hash of those that end here, and children, leaves and saved tokens among the nodes it gives whole."""

    __slots__ = ("n", "least", "ends", "children", "leaves", "saved")

    def __init__(self, n: int = 0, least: int | None = None, ends: str | None = None, children: int = 0, leaves: int = 0, saved: int = 0):
        self.n, self.least, self.ends, self.children, self.leaves, self.saved = n, least, ends, children, leaves, saved

    def add(self, other: "Part") -> None:
        self.n += other.n
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends
        if other.least is not None:
            self.least = other.least if self.least is None else min(self.least, other.least)


class _Below:
    """What the nodes below a place of the tree come to: the topmost nodes there, and sums over all of them."""

    __slots__ = ("tops", "part", "words", "more")

    def __init__(self):
        self.tops: list[dict] = []
        self.part = Part()
        self.words: list[int] = []
        self.more: list[dict[int, Part]] = []

    def add(self, other: "_Below") -> None:
        self.tops += other.tops
        self.part.add(other.part)
        self.words = self.words or other.words
        self.more += other.more


def summarise(root: Node, edges: tuple[bytes, ...] = ()) -> tuple[list[dict], list[dict[int, Part]]]:
    """(nodes, parts): the trie nodes at the turn-aligned depths of the tree, and for each edge key the parts of its
    prefixes by depth, which are not among the nodes. A prefix of several edges is a part of the first of them. A node
    below such a prefix names it in `above`; without edges every node names its own there.

    A key's value is (words of its turns' texts, {depth: Part}).
    """
    nodes: list[dict] = []
    parts: list[dict[int, Part]] = [{} for _ in edges]
    stack: list[tuple[Node, bytes, bool]] = [(root, b"", False)]
    done: list[_Below] = []
    while stack:
        node, start, visited = stack.pop()
        key = start + node.path
        if not visited:
            stack.append((node, start, True))
            stack.extend((child, key + bytes([byte]), False) for byte, child in node.items())
            continue
        below = _Below()
        for _ in node.items():
            below.add(done.pop())
        if node.value is not None:
            words, own = node.value
            below.words = below.words or words
            below.more.append(dict(own))
        # The first byte of the key above is the parent's branch, so depths from there to the path's end are of this node.
        lowest = 0 if not start else (len(start) - 1) // ID_BYTES + 1
        for depth in range(len(key) // ID_BYTES, lowest - 1, -1):
            _emit(key[: depth * ID_BYTES], depth, below, nodes, edges, parts)
        done.append(below)
    return nodes, parts


def _emit(prefix: bytes, depth: int, below: _Below, nodes: list[dict], edges: tuple[bytes, ...], parts: list[dict[int, Part]]) -> None:
    part = below.part
    for own in below.more:
        if depth in own:
            part.add(own.pop(depth))
    below.more = [own for own in below.more if own]
    for at, edge in enumerate(edges):
        if edge.startswith(prefix):
            # Its other members, children and sums are known elsewhere, so it is given in parts and counts for nothing here.
            part.children = sum(1 for top in below.tops if top)
            for top in below.tops:
                if top:
                    top["above"] = prefix
            parts[at][depth] = part
            below.part, below.tops = Part(), [{}]
            return
    children = len(below.tops) + part.children
    words = below.words[depth - 1] if depth else 0
    saved = part.saved + (part.n - 1) * words
    leaves = part.leaves or 1
    node = {
        "conv_id": part.least, "depth": depth, "parent_conv_id": None, "n_convs": part.n, "n_children": children,
        "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": part.ends or NOTHING, "above": None if edges else prefix,
    }
    for top in below.tops:
        top["parent_conv_id"] = part.least
    nodes.append(node)
    below.tops = [node]
    below.part = Part(part.n, part.least, None, 0, leaves, saved)


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, (turn, id, words); null ids of conversations are left out.

    Turns are ordered by number, null first, and of equal numbers by id.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    pair = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    turn = F.struct(F.col("turn").alias("turn"), F.unhex(F.md5(pair.cast("binary"))).alias("id"), words.alias("words"))
    return (
        conversations.filter("conv_id IS NOT NULL")
        .select("conv_id", turn.alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )


def rebuilt(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, key, words): conversation c begins with the first h turns of conversation c - c % group, and goes on
    with its own after its first h, h being the crc32 of its number modulo `heads`."""
    turns = written(turn_ids(conversations), "trie-turns")
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    first = turns.filter(c % group == 0).select(c.alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    none = F.array().cast(turns.schema["turns"].dataType)
    own = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(none)
    mixed = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), own)
    joined = turns.withColumn("base", c - c % group).withColumn("h", h).join(first, "base", "left")
    return joined.select("conv_id", mixed.alias("t")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["id"])), "")).alias("key"),
        F.transform("t", lambda t: t["words"]).alias("words"),
    )


def _pieces(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, first, text) from rows in the order of (class, conv_id): the ids of a class joined, a piece at a time."""
    name, first, held, size = None, None, [], 0
    out: list[dict] = []
    kinds = pa.schema([("class", pa.string()), ("first", pa.int64()), ("text", pa.string())])

    def close() -> None:
        nonlocal held, size
        if held:
            out.append({"class": name, "first": first, "text": ",".join(held)})
            held, size = [], 0

    for batch in rows:
        for own, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if own != name or size > PIECE_BYTES:
                close()
                name, first = own, conv
            held.append(str(conv))
            size += len(held[-1]) + 1
        if len(out) > 1000:
            yield pa.RecordBatch.from_pylist(out, kinds)
            out = []
    close()
    yield pa.RecordBatch.from_pylist(out, kinds)


def _hashes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, ends) from pieces in order, read as a stream: what is held is the state of one hash."""
    name, state, out = None, None, []
    kinds = pa.schema([("class", pa.string()), ("ends", pa.string())])
    for batch in rows:
        for own, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if own == name:
                state.update(b"," + text.encode())
                continue
            if name is not None:
                out.append({"class": name, "ends": state.hexdigest()})
            name, state = own, hashlib.sha256(text.encode())
        if len(out) > 1000:
            yield pa.RecordBatch.from_pylist(out, kinds)
            out = []
    if name is not None:
        out.append({"class": name, "ends": state.hexdigest()})
    yield pa.RecordBatch.from_pylist(out, kinds)


_NODE = [
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("above", pa.string()),
]
_PART = pa.struct([
    ("depth", pa.int64()), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string()), ("children", pa.int64()),
    ("leaves", pa.int64()), ("saved", pa.int64()),
])
_KINDS = pa.schema([*_NODE, ("key", pa.binary()), ("words", pa.list_(pa.int32())), ("parts", pa.list_(_PART))])
_SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, above string, key binary, words array<int>, parts array<struct<depth: long, n: long, "
    "least: long, ends: string, children: long, leaves: long, saved: long>>"
)
COLUMNS = [name for name, _ in _NODE[:-1]]


def _named(nodes: list[dict]) -> list[dict]:
    for node in nodes:
        node["above"] = None if node["above"] is None else hashlib.md5(node["above"]).hexdigest()
    return nodes


def _range_nodes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a range of keys, and the parts of the prefixes of its first and last."""
    root, edges, words_of = Node(b""), [], {}
    for batch in rows:
        for row in batch.to_pylist():
            key = row["key"]
            edges = [edges[0] if edges else key, key]
            words_of = {k: words_of.get(k, row["words"]) for k in edges}
            own = Part(row["n"], row["least"], row["ends"])
            insert(root, key, (row["words"], {len(key) // ID_BYTES: own}))
    if not edges:
        return
    ends = tuple(dict.fromkeys(edges))
    nodes, parts = summarise(root, ends)
    _named(nodes)
    found = [
        {"key": key, "words": words_of[key], "parts": [{"depth": d, **{k: getattr(p, k) for k in Part.__slots__}} for d, p in own.items()]}
        for key, own in zip(ends, parts, strict=True)
    ]
    for start in range(0, len(nodes), 10_000):
        yield pa.RecordBatch.from_pylist(nodes[start : start + 10_000], _KINDS)
    yield pa.RecordBatch.from_pylist(found, _KINDS)


def _edge_nodes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the prefixes that ranges share, from their parts; `above` is the md5 of the prefix."""
    values: dict[bytes, tuple[list[int], dict[int, Part]]] = {}
    for batch in rows:
        for row in batch.to_pylist():
            _, own = values.setdefault(row["key"], (row["words"], {}))
            for p in row["parts"]:
                depth = p.pop("depth")
                own.setdefault(depth, Part()).add(Part(**p))
    root = Node(b"")
    for key, value in values.items():
        insert(root, key, value)
    if not values:
        return
    nodes, _ = summarise(root)
    yield pa.RecordBatch.from_pylist(_named(nodes), _KINDS)


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Rebuilt conversations with equal turns are one key from the start, so copies cost nothing further, and the hash of
    their ids is formed from joined pieces. Keys meet in ranges of their order, as large as the shuffle's partitions;
    a key that is the start of others ends at an inner node of the tree.

    A null role or text is empty, and a null turn comes first; turns of equal numbers are ordered by the md5 of role and
    text, repeated rows are repeated turns. Rows without a conv_id are left out. Very long texts count with all their
    words. Other columns are not read, whatever their names. An empty table has no conversation and gives no row.
    """
    chains = written(rebuilt(conversations).withColumn("class", F.md5("key")), "trie-chains")
    pieces = chains.select("class", "conv_id").repartitionByRange("class", "conv_id").sortWithinPartitions("class", "conv_id")
    pieces = pieces.mapInArrow(_pieces, "class string, first long, text string")
    ends = pieces.repartition("class").sortWithinPartitions("class", "first").mapInArrow(_hashes, "class string, ends string")
    classes = chains.groupBy("class").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("key").alias("key"), F.first("words").alias("words")
    )
    keys = classes.join(ends, "class").select("key", "words", "n", "least", "ends")
    made = written(keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_range_nodes, _SCHEMA), "trie-nodes")
    # At most two keys of each range: a summary bounded by the number of partitions, put together in one task.
    shared = written(made.filter("key IS NOT NULL").repartition(1).mapInArrow(_edge_nodes, _SCHEMA), "trie-edges")
    parents = if_small(shared.select("above", F.col("conv_id").alias("parent")))
    whole = made.filter("key IS NULL").join(parents, "above", "left")
    whole = whole.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent"))
    return whole.select(*COLUMNS).unionByName(shared.select(*COLUMNS))
