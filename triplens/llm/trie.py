"""Trie of conversation prefixes by union-find over sorted neighbours.

Conversations become sequences of turn digests, sorted over all partitions. Two neighbours are joined
by an edge that is as deep as their longest common prefix. Taking a partition's edges in descending depth,
union-find merges what they join; each merge makes the branching node at that depth, and the
component's nodes from there up to its own depth, which all have the same members, are given out.

What touches the edge of a partition may go on beyond it. Such an edge is kept, and the partition is
contracted to the components between its kept edges, at most two for each depth. The contracted forests of 64
partitions are merged in the next round as one, until one is left. A member of a contracted component
that waits for its parent's smallest id, or for its list of ended conversations, names the component by a
reference that the round which completes it resolves.

A conversation is one row of 16 bytes of digest and 8 bytes of length for each turn; texts are hashed
where they are read and not moved. Groups of equal conversations are one component a partition.

Defined results: rows with a null id take no part; a null role or text is empty; null turns come
first, rows of one turn go by the digest of (role, text), and repeated rows are turns of their own; a text of any
length is a digest; an empty table gives no rows, not even a root; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import stored, table

WIDTH = 16  # bytes of a turn's digest
FAN_IN = 64  # partitions whose contracted forests are merged as one
_ENDS_BYTES = 1 << 16  # of one piece of a list of ended conversations
_CHUNK = 4096  # rows of a batch that is given out


def turn_lists(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """(id, turns): each conversation's (digest, length) in the order of its turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The role's length parts it from the text.
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    each = turns.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col("turn").alias("turn"), digest.alias("digest"),
        F.length(text).cast("long").alias("length"),
    )
    own = each.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "length"))).alias("turns"))
    return own.select("id", F.expr("transform(turns, t -> struct(t.digest, t.length))").alias("turns"))


def with_shared_starts(lists: DataFrame, every: int, most: int, head: Column) -> DataFrame:
    """Each conversation with its first ``head`` turns replaced by those of the first one of its ``every``.

    ``head`` is an expression on ``id`` below ``most``; only that many turns of the replacing
    conversations are joined, ``every`` times each. An absent one leaves none.
    """
    leads = lists.where(F.col("id") % every == 0).select(F.col("id").alias("lead"), F.slice("turns", 1, most).alias("start"))
    own = lists.withColumn("lead", F.col("id") - F.col("id") % every).withColumn("head", head.cast("int"))
    joined = own.join(leads, "lead", "left")
    none = F.expr("slice(turns, 1, 0)")
    start = F.coalesce(F.when(F.col("head") > 0, F.expr("slice(start, 1, head)")), none)
    rest = F.expr("slice(turns, head + 1, greatest(size(turns) - head, 0))")
    return joined.select("id", F.concat(start, rest).alias("turns"))


def keyed(lists: DataFrame) -> DataFrame:
    """(id, key, lengths): ``key`` is the digests end to end; keys sort as the sequences do."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    return lists.select("id", key.alias("key"), F.transform("turns", lambda t: t["length"]).alias("lengths"))


def common_turns(one: bytes, two: bytes) -> int:
    """Turns of the longest common prefix of two keys."""
    shorter = min(len(one), len(two))
    a, b = np.frombuffer(one, np.uint8, shorter), np.frombuffer(two, np.uint8, shorter)
    differ = np.flatnonzero(a != b)
    return (int(differ[0]) if len(differ) else shorter) // WIDTH


class Component:
    """Members that agree up to ``depth``, the node there, and what waits for it."""

    __slots__ = ("depth", "id", "count", "children", "leaves", "saved", "lengths", "refs", "waiting", "ends", "ended", "open")

    def __init__(self, depth, id, count=1, children=0, leaves=0, saved=0, lengths=(), refs=(), ends=(), ended=False):
        self.depth, self.id, self.count, self.children = depth, id, count, children
        self.leaves, self.saved, self.lengths = leaves, saved, lengths
        self.refs, self.waiting = list(refs), []  # children given out by earlier rounds, and by this one
        self.ends = list(ends)  # ids of members that end at the node, ascending
        self.ended = ended  # whether such ids were given out under a reference
        self.open = [False, False]  # to the left and to the right

    def absorb(self, other: Component) -> None:
        """Add what is right of it, at the same depth: both are parts of one node."""
        self.id, self.count = min(self.id, other.id), self.count + other.count
        self.children, self.leaves, self.saved = self.children + other.children, self.leaves + other.leaves, self.saved + other.saved
        self.refs += other.refs
        self.waiting += other.waiting
        self.ends += other.ends
        self.ended = self.ended or other.ended
        self.open[1] = other.open[1]


class Forest:
    """The components of one partition in their order, and the depths of the edges between them."""

    def __init__(self, round: int, part: int, components: list[Component], depths: list[int], last: bool):
        self.prefix, self.made, self.last = f"{round}.{part}.", 0, last
        self.parts, self.depths = components, depths
        self.nodes: list[list] = []
        self.resolved: list[tuple] = []  # (reference, smallest id, depth)

    def contract(self) -> list[tuple[int | None, Component]]:
        """Merge in descending depth; (depth of the edge to the left, component) of what is left."""
        parts, root = self.parts, list(range(len(self.parts)))
        if not self.last:
            parts[0].open[0] = parts[-1].open[1] = True

        def find(at: int) -> int:
            while root[at] != at:
                root[at] = root[root[at]]
                at = root[at]
            return at

        # Edge k joins k and k + 1; a component's root is its first place, so k + 1 is one.
        for k in sorted(range(len(self.depths)), key=lambda k: -self.depths[k]):
            depth, a, b = self.depths[k], find(k), k + 1
            for at in (a, b):
                if parts[at].depth > depth and not any(parts[at].open):
                    parts[at] = self._lift(parts[at], depth)
            if parts[a].depth == parts[b].depth == depth:
                parts[a].absorb(parts[b])
                root[b] = a
            else:
                parts[a].open[1] = parts[b].open[0] = True
        if self.last:
            self._lift(parts[0], -1)
            return []
        left = [at for at in range(len(parts)) if root[at] == at]
        for at in left:
            if parts[at].waiting:
                parts[at].refs.append(self.reference())
                for node in parts[at].waiting:
                    self.nodes[node][3] = parts[at].refs[-1]
        return [(self.depths[at - 1] if at else None, parts[at]) for at in left]

    def reference(self) -> str:
        self.made += 1
        return f"{self.prefix}{self.made}"

    def _lift(self, child: Component, depth: int) -> Component:
        """Give out the nodes of a complete component above ``depth``, and go on as a part of the node there."""
        self.resolved += [(ref, child.id, child.depth) for ref in child.refs]
        for node in child.waiting:
            self.nodes[node][2] = child.id
        leaves, saved, children = child.leaves if child.children else 1, child.saved, child.children
        digest = None if child.ended else hashlib.sha256(",".join(map(str, child.ends)).encode()).hexdigest()
        for at in range(child.depth, depth, -1):
            saved += (child.count - 1) * int(child.lengths[at - 1]) if at else 0
            outer = child.id if at - 1 > depth else None
            self.nodes.append([child.id, at, outer, None, child.count, children, leaves, saved, digest])
            children, digest = 1, _EMPTY
        parent = Component(depth, child.id, child.count, 1, leaves, saved, child.lengths)
        if depth >= 0:
            parent.waiting = [len(self.nodes) - 1]
        return parent


_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ["conv_id", "depth", "parent_conv_id", "parent_ref", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_KINDS = (
    "kind string, part long, place long, edge int, depth int, conv_id long, parent_conv_id long, parent_ref string, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ref string, ended boolean, ids string, "
    "lengths array<long>, refs array<string>, first_key binary, last_key binary"
)
_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "binary": pa.binary()}
_FIELDS = [(name, _TYPES[kind]) for name, kind in (field.split(" ") for field in _KINDS.split(", "))]


def _batches(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    for begin in range(0, len(rows), _CHUNK):
        some = rows[begin : begin + _CHUNK]
        yield pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in some], kind) for name, kind in _FIELDS], [n for n, _ in _FIELDS])


def _given(forest: Forest, part: int, left: list, first_key: bytes, last_key: bytes) -> Iterator[pa.RecordBatch]:
    """Nodes, resolved references, contracted components, and the ended ids these hold."""
    yield from _batches([dict(zip(_NODE, node), kind="node") for node in forest.nodes])
    yield from _batches([{"kind": "ref", "ref": ref, "conv_id": key, "depth": depth} for ref, key, depth in forest.resolved])
    rows = []
    for place, (edge, component) in enumerate(left):
        if component.ends:
            component.refs.append(forest.reference())
            component.ended = True
            rows += [
                {"kind": "ends", "ref": component.refs[-1], "place": number, "ids": ids}
                for number, ids in enumerate(_pieces(component.ends))
            ]
        rows.append({
            "kind": "open", "part": part, "place": place, "edge": edge, "depth": component.depth, "conv_id": component.id,
            "n_convs": component.count, "n_children": component.children, "n_leaves": component.leaves,
            "saved_tokens": component.saved, "ended": component.ended, "refs": component.refs,
            "lengths": [int(n) for n in component.lengths[: component.depth]],
            "first_key": first_key if place == 0 else None, "last_key": last_key if place == len(left) - 1 else None,
        })
    yield from _batches(rows)


def _pieces(ids: list[int]) -> Iterator[str]:
    """The ids comma-joined, in pieces of bounded size."""
    each = _ENDS_BYTES // 21
    for begin in range(0, len(ids), each):
        yield ",".join(map(str, ids[begin : begin + each]))


def _first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (id, key, lengths): equal keys are one component, neighbours have an edge."""
    part, components, depths, first, last = TaskContext.get().partitionId(), [], [], None, None
    for batch in batches:
        for key, own, lengths in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist(), batch.column("lengths")):
            if own == last:
                same = components[-1]
                same.id, same.count = min(same.id, key), same.count + 1
                same.ends.append(key)
                continue
            if last is None:
                first = own
            else:
                depths.append(common_turns(last, own))
            components.append(Component(len(own) // WIDTH, key, lengths=lengths.values.to_numpy(), ends=[key]))
            last = own
    if components:
        forest = Forest(0, part, components, depths, False)
        yield from _given(forest, part, forest.contract(), first, last)


def _next_round(number: int, final: bool):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contracted components in order, those of one new part after the other."""
        part, components, depths, first, last = None, [], [], None, None

        def closed() -> Iterator[pa.RecordBatch]:
            if components:
                forest = Forest(number, part, components, depths, final)
                yield from _given(forest, part, forest.contract(), first, last)

        for batch in batches:
            for row in batch.to_pylist():
                if row["into"] != part:
                    yield from closed()
                    part, components, depths, first, last = row["into"], [], [], None, None
                if components:
                    depths.append(row["edge"] if row["edge"] is not None else common_turns(last, row["first_key"]))
                else:
                    first = row["first_key"]
                components.append(Component(
                    row["depth"], row["conv_id"], row["n_convs"], row["n_children"], row["n_leaves"], row["saved_tokens"],
                    row["lengths"], row["refs"], ended=row["ended"],
                ))
                last = row["last_key"] if row["last_key"] is not None else last
        yield from closed()

    return merge


def _streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, depth, ids): one digest a node, over its pieces as they pass."""
    node, digest = None, None
    done: list[tuple] = []
    for batch in batches:
        for conv, depth, ids in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "depth", "ids")]):
            if (conv, depth) != node:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (conv, depth), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _digest_batch(done)
        done = []
    if node:
        yield _digest_batch([(*node, digest.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())], ["conv_id", "depth", "sha"]
    )


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (id, key, lengths), as ``keyed`` gives them.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    """
    ordered = sequences.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    rounds = [stored(ordered.mapInArrow(_first_round, _KINDS), "forests")]
    while True:
        left = rounds[-1].where("kind = 'open'")
        parts = left.agg(F.max("part")).first()[0]
        if parts is None:
            break
        final = parts < FAN_IN
        into = F.floor(F.col("part") / FAN_IN).cast("long")
        grouped = left.withColumn("into", into).repartition("into").sortWithinPartitions("into", "part", "place")
        rounds.append(stored(grouped.mapInArrow(_next_round(len(rounds), final), _KINDS), "forests"))
    every = rounds[0]
    for forests in rounds[1:]:
        every = every.unionByName(forests)
    nodes = every.where("kind = 'node'").select(*_NODE)
    # References are few, at most three for each depth and partition, and so are the nodes that wait for one.
    refs = every.where("kind = 'ref'").select("ref", F.col("conv_id").alias("node"), F.col("depth").alias("at"))
    parents = refs.select(F.col("ref").alias("parent_ref"), F.col("node").alias("parent"))
    pieces = every.where("kind = 'ends'").select("ref", "place", "ids").join(refs, "ref")
    # All pieces come from the first round; a node's follow the order of the partitions that their references name.
    pieces = pieces.select(
        F.col("node").alias("conv_id"), F.col("at").alias("depth"), F.split("ref", r"\.")[1].cast("long").alias("part"), "place", "ids"
    ).repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "part", "place")
    digests = pieces.select("conv_id", "depth", "ids").mapInArrow(_streamed_digests, "conv_id long, depth int, sha string")
    waiting = F.col("parent_ref").isNotNull() | F.col("ends_sha256").isNull()
    done = nodes.where(waiting).join(parents, "parent_ref", "left").join(digests, ["conv_id", "depth"], "left")
    done = done.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent")).withColumn("ends_sha256", F.coalesce("ends_sha256", "sha"))
    names = [name for name in _NODE if name != "parent_ref"]
    result = nodes.where(~waiting).select(*names).unionByName(done.select(*names))
    return result.withColumn("depth", F.col("depth").cast("long"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations start with up to five turns of the first one of their hundred."""
    lists = turn_lists(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("id").cast("string").cast("binary")) % 6
    return prefix_trie(keyed(with_shared_starts(lists, 100, 5, head)))


OP13_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
t2 AS (SELECT *, sha256(length(role)::VARCHAR || ':' || role || text)[:32] AS sym, length(text) AS len FROM t),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sym, len) AS pos FROM t2),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS lead,
             xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
                 lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
                 4294967295::BIGINT) % 6 AS h
      FROM o),
b AS (SELECT c.conv_id, 0 AS own, pos, sym, len FROM c JOIN o ON o.conv_id = lead AND pos <= h
      UNION ALL SELECT c.conv_id, 1, pos, sym, len FROM c JOIN o USING (conv_id) WHERE pos > h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, sym, len FROM b),
p AS (SELECT conv_id, depth, len, list(sym) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, [] FROM c),
n AS (SELECT conv_id AS member, depth, len, min(conv_id) OVER (PARTITION BY path) AS node,
             depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
g AS (SELECT node, depth, count(*) AS n_convs, any_value(len) AS len,
             coalesce(string_agg(member::VARCHAR, ',' ORDER BY member) FILTER (ends), '') AS ended FROM n GROUP BY ALL),
u AS (SELECT a.node, a.depth, any_value(b.node) AS parent FROM n a LEFT JOIN n b ON a.member = b.member AND b.depth = a.depth - 1 GROUP BY ALL),
k AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS children FROM u WHERE parent IS NOT NULL GROUP BY ALL),
x AS (SELECT g.*, parent, coalesce(children, 0) AS children FROM g JOIN u USING (node, depth) LEFT JOIN k USING (node, depth))
SELECT a.node AS conv_id, a.depth::BIGINT AS depth, any_value(a.parent) AS parent_conv_id, any_value(a.n_convs) AS n_convs,
       any_value(a.children) AS n_children, count(*) FILTER (d.children = 0) AS n_leaves,
       sum((d.n_convs - 1) * d.len)::BIGINT AS saved_tokens, any_value(sha256(a.ended)) AS ends_sha256
FROM x d JOIN n ON n.member = d.node AND n.depth <= d.depth JOIN x a ON a.node = n.node AND a.depth = n.depth
GROUP BY a.node, a.depth
"""
