"""Prefix trie of conversations: which openings are shared, by how many, and what sharing them saves.

Turns are numbered by a dictionary, so a conversation is a list of numbers.  Distinct lists are sorted into range shards;
each shard builds a ternary search tree by inserting the median of its sorted lists first, then the medians of both halves,
which keeps the trees of siblings balanced, and one iterative traversal adds up members, leaves and savings from the
leaves to the root.

Neighbouring shards share only the path that the last list of one and the first list of the next have in common.  The lengths
of these paths, one number a shard, tell every shard which of its nodes are shared and in which shard each begins.  All sums
are additive once a shared node's own text is counted in its first shard alone (a node in two shards has children, so it is
no leaf), so boundary nodes merge by plain sums under the key (first shard, depth).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import stored
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

#: Members' ids that are put into one piece of text before hashing.
PIECE_IDS = 50_000
#: Ways in which a boundary node is copied, so that the children of the root do not meet in one task.
SALTS = 16
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def rebuilt(turns: DataFrame, head_turns: int = 6, group: int = 100) -> DataFrame:
    """(conv_id, ids, sizes) of every conversation, its first turns taken from the first conversation of its group.

    The first h = crc32(id as text) modulo ``head_turns`` turns of conversation ``c - c % group`` (c % group with the sign of
    c), then c's own after its first h.  ``ids`` are numbers of distinct (role, text), ``sizes`` code points of the text.
    """
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    plain = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    coded = plain.select("conv_id", "turn", F.unhex(digest).alias("digest"), F.length("text").alias("size"))
    coded = stored(coded, "trie-turns")
    sorted_digests = coded.select("digest").distinct().repartitionByRange("digest").sortWithinPartitions("digest")
    # numbers rise with the digests: partitions are ranges, and rows within them are sorted
    dictionary = stored(sorted_digests.withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")

    numbered = coded.join(dictionary.hint("merge"), "digest")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"), F.col("id"), F.col("size"))
    own = numbered.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    own = stored(own.select("conv_id", F.expr("transform(turns, t -> struct(t.id as id, t.size as size))").alias("turns")), "trie-lists")
    first = F.col("conv_id") - F.col("conv_id") % group
    heads = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, head_turns).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % head_turns).cast("int")
    both = own.withColumns({"first": first, "h": h}).join(heads, "first", "left")
    head = F.slice(F.coalesce("head", F.expr("slice(turns, 1, 0)")), F.lit(1), F.col("h"))
    tail = F.slice("turns", F.col("h") + 1, F.size("turns"))
    whole = both.select("conv_id", F.concat(head, tail).alias("turns"))
    return whole.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))


def prefix_trie(turns: DataFrame, head_turns: int = 6, group: int = 100, turns_per_shard: int = 100_000) -> DataFrame:
    """One row for every node of the trie of all rebuilt conversations.

    ``turns`` has conv_id, turn, role and text (other columns are left alone, whatever their names).  Turns go by
    ``turn``, nulls first, and equal numbers by the MD5 of role and text; repeated rows are turns of their own; a null role or text
    is empty; rows without ``conv_id`` belong to no conversation.  Results: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (of the subtree: for
    each node members less one times code points of its last text), ``ends_sha256`` (of the ids of the conversations that end
    here, ascending, with commas).  No conversations, no rows, not even a root.

    A conversation is one row of numbers, so the longest one bounds a task's memory besides ``turns_per_shard``.
    """
    convs = rebuilt(turns, head_turns, group)
    sig = F.unhex(F.md5(F.concat_ws(",", F.col("ids").cast("array<string>"))))
    convs = stored(convs.withColumn("sig", sig), "trie-conversations")
    lists = convs.groupBy("sig", "ids", "sizes").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
    total = convs.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-total // turns_per_shard))
    by_range = lists.repartitionByRange(shards, "ids").withColumn("shard", F.spark_partition_id())
    lists = stored(by_range, "trie-shards")

    nodes = stored(_shard_nodes(lists, *_boundaries(lists)), "trie-nodes")
    whole = nodes.where("first_shard is null").drop("first_shard")
    shared = nodes.where("first_shard is not null").groupBy("first_shard", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_shard").alias("parent_shard"), F.max("parent_conv_id").alias("parent_conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("sig").alias("sig"),
    )
    shared = stored(shared, "trie-boundary")
    rows = whole.unionByName(shared.drop("first_shard"))

    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS))
    parents = shared.select(
        F.col("first_shard").alias("parent_shard"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"),
    )
    open_rows = rows.where("parent_shard is not null").withColumn("salt", salt)
    closed = open_rows.join(parents, ["parent_shard", "depth", "salt"]).withColumn("parent_conv_id", F.col("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "sig"]
    rows = rows.where("parent_shard is null").select(columns).unionByName(closed.select(columns))

    ends = ends_sha256(convs.select("sig", "conv_id"))
    ended = rows.where("sig is not null").join(ends.hint("merge"), "sig")
    none = rows.where("sig is null").withColumn("ends_sha256", F.lit(NO_MEMBERS))
    return ended.unionByName(none, allowMissingColumns=True).select(*columns[:-1], "ends_sha256")


def _boundaries(lists: DataFrame) -> tuple[list[int], list[int], list[int]]:
    """Shards that have rows, in order; what the neighbouring lists of each two begin with alike; the same of each shard's
    first and last list."""
    ends = stored(lists.groupBy("shard").agg(F.min("ids").alias("low"), F.max("ids").alias("high")), "trie-ends")
    order = sorted(r[0] for r in ends.select("shard").collect())  # one number a shard
    pairs = ends.sparkSession.createDataFrame(
        list(zip(order, order[1:], strict=False)), "before int, after int"
    )
    left = ends.select(F.col("shard").alias("before"), F.col("high"))
    right = ends.select(F.col("shard").alias("after"), F.col("low"))
    # a shorter list is filled up with nulls; no difference at all gives 0, only where both lists are the same one
    same = F.expr("if(high = low, size(low), array_position(zip_with(high, low, (a, b) -> a <=> b), false) - 1)").cast("int")
    found = pairs.join(left, "before").join(right, "after").select("before", same.alias("common"))
    common, inside = (dict(tuple(r) for r in f.collect()) for f in (found, ends.select("shard", same)))  # two numbers a shard
    return order, [common[s] for s in order[:-1]], [inside[s] for s in order]


NODE = (
    "first_shard int, conv_id long, depth int, parent_shard int, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, sig binary"
)


def _shard_nodes(lists: DataFrame, order: list[int], common: list[int], inside: list[int]) -> DataFrame:
    """Nodes of every shard: whole rows, and parts of rows for the nodes that other shards share (``first_shard``)."""
    names = [f.strip().split(" ")[0] for f in NODE.split(",")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[f.strip().split(" ")[1]]) for n, f in zip(names, NODE.split(","), strict=True)])

    def build(table: pa.Table) -> pa.Table:
        rows = sorted(
            zip(*(table.column(c).to_pylist() for c in ("ids", "sizes", "n", "low", "sig")), strict=True), key=lambda r: r[0]
        )
        at = order.index(table.column("shard")[0].as_py())
        tree = Tree(rows)
        firsts = first_shards(at, order, common, inside)
        return pa.table(tree.nodes(order[at], firsts, common[at] if at < len(common) else -1), schema=schema)

    return lists.groupBy("shard").applyInArrow(build, NODE)


def first_shards(at: int, order: list[int], common: list[int], inside: list[int]) -> list[int]:
    """For each depth of the path shared with the shard before, the shard in which that node begins.

    A node goes on through a whole shard if that shard's first and last lists share it.
    """
    out, start = [], at
    for depth in range(common[at - 1] if at else -1, -1, -1):
        while start and common[start - 1] >= depth and (start == at or inside[start] >= depth):
            start -= 1
        out.append(order[start])
    return out[::-1]


class Tree:
    """Ternary search tree over sorted distinct lists of numbers; node 0 is the root of the trie."""

    def __init__(self, rows: list[tuple]) -> None:
        self.turn, self.lo, self.eq, self.hi = [-1], [0], [0], [0]
        self.size, self.depth, self.parent = [0], [0], [-1]
        self.n, self.low, self.sig = [0], [None], [None]
        self.first_path, self.last_path = [0], [0]
        todo = [(0, len(rows))]
        while todo:
            begin, end = todo.pop()
            if begin < end:
                middle = (begin + end) // 2
                path = self._insert(*rows[middle])
                self.first_path = path if middle == 0 else self.first_path
                self.last_path = path if middle == len(rows) - 1 else self.last_path
                todo += [(begin, middle), (middle + 1, end)]

    def _insert(self, ids: list[int], sizes: list[int], n: int, low: int, sig: bytes) -> list[int]:
        turn, lo, eq, hi = self.turn, self.lo, self.eq, self.hi
        at, path = 0, [0]
        for value, size in zip(ids, sizes, strict=True):
            link, place, node = eq, at, eq[at]
            while node and turn[node] != value:
                link = lo if value < turn[node] else hi
                place, node = node, link[node]
            if not node:
                node = len(turn)
                link[place] = node
                turn.append(value)
                lo.append(0)
                eq.append(0)
                hi.append(0)
                self.size.append(size)
                self.depth.append(self.depth[at] + 1)
                self.parent.append(at)
                self.n.append(0)
                self.low.append(None)
                self.sig.append(None)
            at = node
            path.append(at)
        self.n[at], self.low[at], self.sig[at] = n, low, sig
        return path

    def nodes(self, shard: int, firsts: list[int], after: int) -> list[list]:
        """Columns of NODE.  ``firsts``: first shards of the path shared with the shard before, ``after``: length of that shared
        with the next one (-1: none)."""
        count = len(self.turn)
        shared: list[int | None] = [None] * count
        for node in self.last_path[: after + 1]:
            shared[node] = shard
        for node, first in zip(self.first_path, firsts, strict=False):
            shared[node] = first
        own = [first is None or first == shard for first in shared]
        members, low = self.n[:], self.low[:]
        children, leaves, used, once = [0] * count, [0] * count, [0] * count, [0] * count
        # a traversal by an explicit stack lists every parent before its children; backwards, children add to their parents
        seen, stack = [], [0]
        while stack:
            node = stack.pop()
            seen.append(node)
            stack += [k for k in (self.lo[node], self.hi[node], self.eq[node]) if k]
        for node in reversed(seen):
            used[node] += members[node] * self.size[node]
            once[node] += self.size[node] if own[node] else 0
            if not self.eq[node] and shared[node] is None:
                leaves[node] = 1
            up = self.parent[node]
            if up >= 0:
                members[up] += members[node]
                low[up] = low[node] if low[up] is None else min(low[up], low[node])
                children[up] += own[node]
                leaves[up] += leaves[node]
                used[up] += used[node]
                once[up] += once[node]
        above = [None if p < 0 else shared[p] for p in self.parent]
        parents = [None if p < 0 or a is not None else low[p] for p, a in zip(self.parent, above, strict=True)]
        saved = [a - b for a, b in zip(used, once, strict=True)]
        return [shared, low, self.depth, above, parents, members, children, leaves, saved, self.sig]


def ends_sha256(members: DataFrame) -> DataFrame:
    """(sig, ends_sha256): SHA-256 over the ascending ids of each list's conversations, with commas.

    A hash runs through its text in order.  Ranges of (list, id) first turn their ids into long pieces of text in parallel; one
    list's pieces then pass through a hash one at a time, so no task holds the members of a list that very many share.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, ids, out = None, [], []
        for batch in batches:
            for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if s != sig or len(ids) >= PIECE_IDS:
                    if ids:
                        out.append((sig, ids[0], ",".join(map(str, ids))))
                    sig, ids = s, []
                ids.append(c)
            yield _batch(out, PIECES)
            out = []
        if ids:
            yield _batch([(sig, ids[0], ",".join(map(str, ids)))], PIECES)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, running = None, None
        for batch in batches:
            out = []
            for s, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if s == sig:
                    running.update(b",")
                else:
                    if running:
                        out.append((sig, running.hexdigest()))
                    sig, running = s, hashlib.sha256()
                running.update(text.encode())
            yield _batch(out, DIGESTS)
        if running:
            yield _batch([(sig, running.hexdigest())], DIGESTS)

    ranged = members.repartitionByRange("sig", "conv_id").sortWithinPartitions("sig", "conv_id")
    cut = ranged.mapInArrow(pieces, "sig binary, at long, piece string")
    return cut.repartition("sig").sortWithinPartitions("sig", "at").mapInArrow(digests, "sig binary, ends_sha256 string")


PIECES = pa.schema([("sig", pa.binary()), ("at", pa.int64()), ("piece", pa.string())])
DIGESTS = pa.schema([("sig", pa.binary()), ("ends_sha256", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def prefix_trie_sql(table: str) -> str:
    """The same rows in DuckDB's SQL, with 6 turns and groups of 100, for conversations of few turns."""
    return f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || t)) AS pos,
         md5(length(r) || ':' || r || t) AS tok, length(t) AS size
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM {table} WHERE conv_id IS NOT NULL)
),
convs AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
           lambda a, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
),
parts AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.tok, o.size FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.tok, o.size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
),
made AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(tok, '') OVER w AS path, size FROM parts
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
rooted AS (
  SELECT conv_id, depth, path, size FROM made UNION ALL SELECT conv_id, 0, '', 0 FROM convs
),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved FROM rooted GROUP BY path, depth
),
ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
  FROM (SELECT conv_id, max_by(path, depth) AS path FROM rooted GROUP BY conv_id) GROUP BY path
),
children AS (SELECT substring(path, 1, 32 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
above AS (
  SELECT substring(n.path, 1, 32 * a.d) AS path, sum(n.saved) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM nodes n LEFT JOIN children c ON c.path = n.path, unnest(range(0, n.depth + 1)) AS a(d) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, a.leaves AS n_leaves,
       CAST(a.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n JOIN above a ON a.path = n.path LEFT JOIN children c ON c.path = n.path LEFT JOIN ends e ON e.path = n.path
     LEFT JOIN nodes p ON n.depth > 0 AND p.path = substring(n.path, 1, 32 * (n.depth - 1))
"""
