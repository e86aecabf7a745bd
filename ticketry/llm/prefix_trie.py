"""The prefix trie of conversations, from adaptive radix trees over turn ids.

A turn's id has a fixed width: a hash of role and text, then the text's code points, big-endian. A
conversation's key is its ids end to end, so that conversations which begin alike have keys which do.
Equal keys become one row first. The keys are range-sorted, and each run of neighbours goes into
a radix tree (``radix``) of its own; of the tree's byte depths only those at the end of a turn are
nodes. A node that lies in several runs is a path at a run's edge: the runs' parts of it add up,
as every node, child and childless node is counted by the first run that has it alone.

A run is bounded in keys and bytes, so a task's memory doesn't depend on its share of the table. A
conversation's ids (16 bytes a turn) are one value; texts stay where they are.
"""

from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm.common import cut
from ticketry.llm.radix import RadixTree, common

#: Bytes of a turn id: hash, and code points of the text.
HASH, COUNT = 12, 4
WIDTH = HASH + COUNT
#: A run ends at so many keys or so many bytes of keys.
RUN_KEYS, RUN_BYTES = 4096, 1 << 23
#: Conversation ids that go into one piece of a list of ends: 2**12.
PIECE_BITS = 12


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and ``ids`` (array of turn ids, as hexadecimal digits) of each conversation.

    The order is that of ``turn``, null first; turns of one number stand in the order of their ids.
    Null roles and texts are empty. Rows without a conv_id belong to no conversation.
    """
    role = F.coalesce(conversations["role"], F.lit(""))
    text = F.coalesce(conversations["text"], F.lit(""))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    number = F.concat(
        F.left(F.md5(content), F.lit(2 * HASH)), F.lpad(F.lower(F.hex(F.length(text))), 2 * COUNT, "0")
    )
    turn = conversations["turn"].cast("long")
    return (
        conversations.where(conversations["conv_id"].isNotNull())
        .select(
            conversations["conv_id"].cast("long").alias("conv_id"),
            F.struct(turn.isNotNull().alias("known"), turn.alias("turn"), number.alias("id")).alias("turn"),
        )
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: t["id"]).alias("ids"))
    )


def with_openings(own: DataFrame, every: int, most: int) -> DataFrame:
    """Conversations rebuilt on the openings of others, as conv_id and ``ids``.

    Conversation c gets the first h turns of c - c % ``every`` (none if there is no such one), then its
    own turns after its first h; h is the crc32 of c's digits modulo ``most`` + 1. The remainder of a
    negative c is negative, as in SQL.
    """
    own = cut(own)
    openings = own.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("__from"), F.slice("ids", 1, most).alias("__opening")
    )
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1)).cast("int")
    opening = F.coalesce(F.slice("__opening", F.lit(1), h), F.array().cast("array<string>"))
    rest = F.slice("ids", h + 1, F.greatest(F.size("ids") - h, F.lit(0)))
    return own.join(
        openings, F.col("conv_id") - F.col("conv_id") % every == F.col("__from"), "left"
    ).select("conv_id", F.concat(opening, rest).alias("ids"))


def _ends(batches):
    """One row for each key from its pieces, which come sorted: ids are hashed as they pass."""
    key, n, least, digest = None, 0, None, None
    out: list[list] = [[] for _ in range(4)]

    def close():
        for column, value in zip(out, (key, n, least, digest.hexdigest())):
            column.append(value)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "n", "least", "ids"))
        for k, more, smallest, ids in zip(*columns):
            if digest is None or k != key:
                if digest is not None:
                    close()
                key, n, least, digest = k, more, smallest, hashlib.sha256(ids.encode())
            else:
                n += more
                least = min(least, smallest)
                digest.update(b"," + ids.encode())
        if out[0]:
            yield _key_batch(out)
            out = [[] for _ in range(4)]
    if digest is not None:
        close()
        yield _key_batch(out)


KEYS = "key binary, n long, least long, ends string"


def _key_batch(out):
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(out, kinds)], ["key", "n", "least", "ends"]
    )


def _shared(a: bytes | None, b: bytes | None) -> int:
    """Turns that two keys have in common; -1 (not even the root) if one is missing."""
    return -1 if a is None or b is None else common(a, b) // WIDTH


RUNS = (
    "part int, left int, right int, first binary, last binary, keys array<binary>, n array<long>,"
    " least array<long>, ends array<string>"
)


def _runs(batches):
    """Runs of a sorted partition, with the turns shared with the run before and the one behind.

    Where the neighbour lies in another partition, the edge key stands in place of that number.
    """
    kinds = [
        pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.binary()),
        pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()),
    ]
    names = [c.split()[0] for c in RUNS.split(", ")]
    part = TaskContext.get().partitionId()
    held: list[tuple] = []
    size, before = 0, None

    def run(behind):
        first, last = held[0][0], held[-1][0]
        row = (
            part, None if before is None else _shared(before, first),
            None if behind is None else _shared(last, behind),
            first if before is None else None, last if behind is None else None,
            *[list(c) for c in zip(*held)],
        )
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "least", "ends"))):
            if held and (len(held) >= RUN_KEYS or size + len(row[0]) > RUN_BYTES):
                yield run(row[0])
                before, held, size = held[-1][0], [], 0
            held.append(row)
            size += len(row[0])
    if held:
        yield run(None)


def _edges(batches):
    """part, and the turns its first and last keys share with the partitions beside it."""
    for batch in batches:
        part, before, first, last, behind = (
            batch.column(c).to_pylist() for c in ("part", "before", "first", "last", "behind")
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array([_shared(a, b) for a, b in zip(before, first)], pa.int32()),
                pa.array([_shared(a, b) for a, b in zip(last, behind)], pa.int32()),
            ],
            ["edge_of", "edge_left", "edge_right"],
        )


def _marks(key: bytes, depth: int) -> list[bytes]:
    """Names of the key's nodes down to ``depth``: digests of what leads to them."""
    digest, out = hashlib.md5(), []
    for d in range(depth + 1):
        if d:
            digest.update(key[(d - 1) * WIDTH : d * WIDTH])
        out.append(digest.copy().digest())
    return out


NO_ENDS = hashlib.sha256(b"").hexdigest()
NODES = (
    "mark binary, parent_mark binary, depth long, conv_id long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def tree_nodes(keys, n, least, ends, left: int, right: int) -> list[list]:
    """Columns of ``NODES`` for a run: ``left`` and ``right`` are turns shared with its neighbours.

    Nodes that other runs may hold too have a ``mark``; so do parents among them, whose conv_id
    isn't known here.
    """
    tree = RadixTree()
    for value in zip(keys, n, least, ends):
        tree.insert(value[0], value[1:])
    parents, depths, points, counts, smallest, finals = [-1], [0], [0], [0], [None], [NO_ENDS]
    # Nodes from top to bottom, children in the order of their labels; ``seen`` are the bytes of a
    # turn that the path above has begun.
    stack = [(tree.root, 0, b"")]
    while stack:
        node, above, seen = stack.pop()
        seen += node.path
        for at in range(WIDTH, len(seen) + 1, WIDTH):
            parents.append(above)
            depths.append(depths[above] + 1)
            points.append(struct.unpack(">I", seen[at - COUNT : at])[0])
            counts.append(0)
            smallest.append(None)
            finals.append(NO_ENDS)
            above = len(parents) - 1
        if node.value is not None:
            counts[above], smallest[above], finals[above] = node.value
        if node.children:
            seen = seen[len(seen) // WIDTH * WIDTH :]
            below = [(child, above, seen + bytes((label,))) for label, child in node.items()]
            stack.extend(reversed(below))
    size = len(parents)
    # The first key's path is the first nodes; the last key's goes up from the last node.
    at_left = _marks(keys[0], left)
    marks: dict[int, bytes] = dict(enumerate(at_left))
    names, at = _marks(keys[-1], right), size - 1
    open_end = depths[at] == right  # the next run goes on below the last key
    while at >= 0:
        if depths[at] <= right:
            marks[at] = names[depths[at]]
        at = parents[at]
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for i in range(size - 1, -1, -1):
        mine = i > left  # the run before has the others
        if mine and not children[i] and not (open_end and i == size - 1):
            leaves[i] = 1
        saved[i] += (counts[i] - mine) * points[i]
        above = parents[i]
        if above >= 0:
            children[above] += mine
            leaves[above] += leaves[i]
            saved[above] += saved[i]
            counts[above] += counts[i]
            if smallest[above] is None or smallest[i] < smallest[above]:
                smallest[above] = smallest[i]
    known = [p if p < 0 or p in marks else smallest[p] for p in parents]
    return [
        [marks.get(i) for i in range(size)], [marks.get(p) for p in parents], depths, smallest,
        [None if p < 0 or p in marks else k for p, k in zip(parents, known)], counts, children,
        leaves, saved, finals,
    ]


def _nodes(batches):
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]
    names = [c.split()[0] for c in NODES.split(", ")]
    for batch in batches:
        columns = [batch.column(c) for c in ("keys", "n", "least", "ends", "left", "right")]
        for row in zip(*columns):
            out = tree_nodes(*(x.as_py() for x in row))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of
    each node, for ``conversations`` with conv_id (one row each) and ``ids`` (see ``sequences``).

    A node is a distinct sequence of first turns; its members are the conversations that begin with it,
    and conv_id is the smallest. The root has every conversation, one without turns too. Of an empty
    table there is no node. ``saved_tokens`` sums (members - 1) times code points of the last text over
    the subtree; ``ends_sha256`` hashes the ids, ascending and comma-joined, of members that end here.
    """
    keys = conversations.select("conv_id", F.unhex(F.array_join("ids", "")).alias("key"))
    # Of a hot key, pieces are made where its rows are; one task hashes the pieces as they pass.
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = keys.groupBy("key", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.array_join(ids, ",").alias("ids")
    )
    distinct = pieces.repartition("key").sortWithinPartitions("key", "piece").mapInArrow(_ends, KEYS)
    runs = cut(distinct.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_runs, RUNS))
    # A row per partition.
    edges = runs.where("first IS NOT NULL OR last IS NOT NULL").groupBy("part").agg(
        F.max("first").alias("first"), F.max("last").alias("last")
    )
    line = Window.orderBy("part")
    edges = cut(
        edges.withColumns({"before": F.lag("last").over(line), "behind": F.lead("first").over(line)})
        .mapInArrow(_edges, "edge_of int, edge_left int, edge_right int")
    )
    nodes = cut(
        runs.join(edges, F.col("part") == F.col("edge_of")).select(
            "keys", "n", "least", "ends", F.coalesce("left", "edge_left").alias("left"),
            F.coalesce("right", "edge_right").alias("right"),
        ).mapInArrow(_nodes, NODES)
    )
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    # A path for each edge between runs: as a written table Spark knows how small it is.
    shared = cut(
        nodes.where("mark IS NOT NULL").groupBy("mark").agg(
            F.max("parent_mark").alias("parent_mark"), F.max("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"), *total,
            # A node's ends are in one run; elsewhere there are none.
            F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS))
            .alias("ends_sha256"),
        )
    )
    alone = nodes.where("mark IS NULL")
    result = (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    )
    above = shared.select(F.col("mark").alias("up"), F.col("conv_id").alias("up_conv_id"))
    below = alone.where("parent_mark IS NOT NULL").unionByName(
        shared.withColumn("parent_conv_id", F.lit(None).cast("long"))
    )
    hung = below.join(above, F.col("parent_mark") == F.col("up"), "left").withColumn(
        "parent_conv_id", F.col("up_conv_id")
    )
    return alone.where("parent_mark IS NULL").select(*result).unionByName(hung.select(*result))
