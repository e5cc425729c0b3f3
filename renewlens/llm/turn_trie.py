"""Conversation prefix trie (operator 11).

Every turn (role, text) gets a fixed-width big-endian id of ``WIDTH`` bytes, a
conversation is the string of its ids, and the distinct strings are sorted
into ranges over the cluster. Each range is held in an adaptive radix tree
(node layouts of 4, 16, 48 and 256 children that grow as they fill, compressed
paths); only byte depths on a turn boundary emit a trie node.

A node whose conversations lie in several ranges is a prefix of keys on both
sides of a boundary. A range knows the last key before and the first key
behind it, so it knows which of its nodes those are and which were met first
in an earlier range; their counts are sums over ranges and are added up after.

Identical conversations are one key with a count, so a conversation that a
third of all rows repeat is one key too. The digest of the ids that end in a
node runs over ever so many of them as a stream of text chunks made in
parallel. A task holds the keys of its range, 16 bytes a turn: one
conversation is never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewlens.sources.store import stage

#: Bytes of a turn id (the head of a SHA-256).
WIDTH = 16
#: Ids that end in one node up to here are digested as one array.
FEW = 1024
_CHUNK = 4096
_WORD = r"[^\x20\x09-\x0D]+"
_NONE = hashlib.sha256(b"").hexdigest()

_RANGE_ROWS = (
    "conv_id long, depth long, parent_conv_id long, above binary, self binary, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


class Node:
    """An inner node or leaf; ``keys`` and ``kids`` change layout as they grow."""

    __slots__ = ("path", "size", "keys", "kids", "row")

    def __init__(self, path: bytes, row: int = -1):
        self.path = path  # bytes between the branching byte and this node
        self.size = 4
        self.keys: bytearray | None = bytearray()
        self.kids: list = []
        self.row = row  # the key that ends here

    def find(self, byte: int) -> Node | None:
        if self.size <= 16:
            at = self.keys.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.size == 48:
            at = self.keys[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> None:
        if self.size < 256 and len(self.kids) == self.size:
            self._grow()
        if self.size <= 16:
            at = sum(k < byte for k in self.keys)
            self.keys.insert(at, byte)
            self.kids.insert(at, kid)
        elif self.size == 48:
            self.kids.append(kid)
            self.keys[byte] = len(self.kids)
        else:
            self.kids[byte] = kid

    def swap(self, byte: int, kid: Node) -> None:
        if self.size <= 16:
            self.kids[self.keys.find(byte)] = kid
        elif self.size == 48:
            self.kids[self.keys[byte] - 1] = kid
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        if self.size == 4:
            self.size = 16
        elif self.size == 16:
            index = bytearray(256)
            for at, byte in enumerate(self.keys):
                index[byte] = at + 1
            self.keys, self.size = index, 48
        else:
            self.kids = [self.kids[at - 1] if at else None for at in self.keys]
            self.keys, self.size = None, 256

    def ordered(self) -> list[Node]:
        """Children by branching byte."""
        if self.size <= 16:
            return self.kids
        if self.size == 48:
            return [self.kids[at - 1] for at in self.keys if at]
        return [kid for kid in self.kids if kid is not None]


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo if a[lo : lo + 1] != b[lo : lo + 1] else hi


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, row: int) -> None:
        node, above, byte, at = self.root, None, 0, 0
        while True:
            m = shared(node.path, key[at : at + len(node.path)])
            if m < len(node.path):  # the path forks: a node goes in between
                fork = Node(node.path[:m])
                fork.put(node.path[m], node)
                node.path = node.path[m + 1 :]
                if above is None:
                    self.root = fork
                else:
                    above.swap(byte, fork)
                node = fork
            at += m
            if at == len(key):
                node.row = row
                return
            below = node.find(key[at])
            if below is None:
                node.put(key[at], Node(key[at + 1 :], row))
                return
            above, byte, node, at = node, key[at], below, at + 1


def range_nodes(keys: list[bytes], words: list[list[int]], counts: list[int], convs: list[int], ends: list[str],
                before: bytes | None, behind: bytes | None, width: int = WIDTH) -> dict[str, list]:
    """Columns of the trie nodes of one range of distinct sorted keys.

    ``before`` and ``behind`` are the neighbouring keys of other ranges. A node
    that they share has ``self`` set and counts of this range alone; a node
    under such a node has ``above`` set in place of its parent's conv_id.
    """
    tree = RadixTree()
    for row, key in enumerate(keys):
        tree.insert(key, row)
    last = len(keys) - 1
    # depths up to these are shared with the ranges before and behind
    left = -1 if before is None else shared(before, keys[0]) // width
    right = -1 if behind is None else shared(keys[last], behind) // width
    names = [c.split()[0] for c in _RANGE_ROWS.split(", ")]
    out: dict[str, list] = {c: [] for c in names}
    order, todo = [], [(tree.root, 0)]
    while todo:
        node, end = todo.pop()
        end += len(node.path)
        order.append((node, end))
        todo.extend((kid, end + 1) for kid in node.ordered())
    # per tree node: conversations, least id, leaves, saved, new top nodes, their rows, first and last key
    done: dict[int, tuple] = {}
    for node, end in reversed(order):
        n, least, leaves, saved, new, tops, low, high = 0, None, 0, 0, 0, [], last, 0
        kids = node.ordered()
        for kid in kids:
            a, b, c, d, e, f, g, h = done.pop(id(kid))
            n, leaves, saved, new = n + a, leaves + c, saved + d, new + e
            least = b if least is None else min(least, b)
            tops = f if not tops else tops + f if len(kids) < 3 else _more(tops, f)
            low, high = min(low, g), max(high, h)
        row = node.row
        if row >= 0:
            n += counts[row]
            least = convs[row] if least is None else min(least, convs[row])
            low, high = min(low, row), max(high, row)
            if not kids and not (row == last and behind is not None and right * width == len(keys[row])):
                leaves += 1
        begin = end - len(node.path) - (node is not tree.root)
        lowest = -1 if node is tree.root else begin // width
        for depth in range(end // width, lowest, -1):
            size = words[low][depth - 1] if depth else 0
            fresh = not (low == 0 and depth <= left)
            is_open = not fresh or (high == last and depth <= right)
            saved += size * (n - fresh)
            ender = row if row >= 0 and depth * width == end else -1
            at = len(out["depth"])
            name = hashlib.sha256(keys[low][: depth * width]).digest()[:WIDTH] if is_open else None
            for top in tops:
                if is_open:
                    out["above"][top] = name
                else:
                    out["parent_conv_id"][top] = least
            for c, v in zip(names, (least, depth, None, None, name, n, new, leaves, saved, ends[ender] if ender >= 0 else None), strict=True):
                out[c].append(v)
            new, tops = int(fresh), [at]
        done[id(node)] = (n, least, leaves, saved, new, tops, low, high)
    return out


def _more(tops: list[int], other: list[int]) -> list[int]:
    tops.extend(other)
    return tops


def turn_ids(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as structs of id
    (hexadecimal) and words. Null turn numbers come first, equal ones by role
    and id; null role or text is empty; rows without conv_id belong to no
    conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    tid = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    one = F.struct("turn", role.alias("role"), tid.alias("id"), F.regexp_count(text, F.lit(_WORD)).cast("int").alias("words"))
    t = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("t"))
    lists = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.expr("transform(t, x -> struct(x.id AS id, x.words AS words))").alias("turns"))


def rebuilt(convs: DataFrame, block: int = 20, longest: int = 3) -> DataFrame:
    """Conversation c with its first h turns replaced by those of c - c % block,
    h = crc32(c) % (longest + 1)."""
    h = (F.crc32(F.col("conv_id").cast("string")) % (longest + 1)).cast("int")
    heads = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, longest).alias("head"))
    own = convs.withColumns({"h": h, "base": F.expr(f"conv_id - conv_id % {block}")})
    joined = own.join(heads, "base", "left")
    turns = "concat(slice(coalesce(head, slice(turns, 1, 0)), 1, h), slice(turns, h + 1, size(turns)))"
    return joined.select("conv_id", F.expr(turns).alias("turns"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) as texts of up to _CHUNK ids of one key."""
    for batch in batches:
        keys, ids = batch.column("k").to_pylist(), batch.column("conv_id").to_pylist()
        rows, lo = [], 0
        for hi in range(1, len(ids) + 1):
            if hi == len(ids) or keys[hi] != keys[lo] or hi - lo == _CHUNK:
                rows.append({"k": keys[lo], "first": ids[lo], "part": ",".join(map(str, ids[lo:hi]))})
                lo = hi
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("k", pa.string()), ("first", pa.int64()), ("part", pa.string())]))


def _stream_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's chunks, which come in order."""
    schema = pa.schema([("k", pa.string()), ("ends", pa.string())])
    key, sha = None, None
    for batch in batches:
        found = []
        for k, part in zip(batch.column("k").to_pylist(), batch.column("part").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    found.append({"k": key, "ends": sha.hexdigest()})
                key, sha = k, hashlib.sha256(part.encode())
            else:
                sha.update(b"," + part.encode())
        yield pa.RecordBatch.from_pylist(found, schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"k": key, "ends": sha.hexdigest()}], schema)


def ends_digests(members: DataFrame, few: int = FEW) -> DataFrame:
    """(k, ends): SHA-256 of the ascending, comma-joined conv_ids of each k, of
    (k, conv_id, n) with n the number of k's members."""
    ids = "array_join(transform(sort_array(collect_list(conv_id)), x -> cast(x AS string)), ',')"
    small = members.where(F.col("n") <= few).groupBy("k").agg(F.sha2(F.expr(ids), 256).alias("ends"))
    large = (
        members.where(F.col("n") > few).select("k", "conv_id").repartitionByRange("k", "conv_id").sortWithinPartitions("k", "conv_id")
        .mapInArrow(_chunks, "k string, first long, part string")
        .repartition("k").sortWithinPartitions("k", "first").mapInArrow(_stream_sha, "k string, ends string")
    )
    return small.unionByName(large)


def _range_nodes(rows: pa.Table, bounds: pa.Table) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _RANGE_ROWS.split(", ")])
    if not rows.num_rows:
        return schema.empty_table()
    rows = rows.sort_by("key")
    out = range_nodes(*(rows.column(c).to_pylist() for c in ("key", "words", "n", "conv_id", "ends")),
                      bounds.column("before")[0].as_py(), bounds.column("behind")[0].as_py())
    return pa.table(out, schema)


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per trie node of (conv_id, turns) as ``turn_ids`` gives them.

    conv_id (the least member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves and saved_tokens of the subtree, ends_sha256.
    A conversation without turns ends at the root; an empty table has no node,
    not even a root.
    """
    key = F.expr("unhex(array_join(transform(turns, x -> x.id), ''))")
    seqs = stage(convs.select("conv_id", key.alias("key"), F.expr("transform(turns, x -> x.words)").alias("words")), "trie-keys")
    distinct = stage(seqs.groupBy("key", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")), "trie-distinct")
    many = distinct.where("n > 1").select(F.sha2("key", 256).alias("k"), "n")
    members = seqs.select(F.sha2("key", 256).alias("k"), "conv_id").join(many, "k")
    ends = ends_digests(members)
    single = F.sha2(F.col("conv_id").cast("string"), 256)
    named = distinct.withColumn("k", F.sha2("key", 256)).join(ends, "k", "left").withColumn("ends", F.coalesce("ends", single)).drop("k")
    ranged = stage(named.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "trie-ranges")
    # one row a range: its neighbours
    w = Window.orderBy("part")
    bounds = ranged.groupBy("part").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    bounds = bounds.select("part", F.lag("hi").over(w).alias("before"), F.lead("lo").over(w).alias("behind"))
    nodes = stage(ranged.groupBy("part").cogroup(bounds.groupBy("part")).applyInArrow(_range_nodes, _RANGE_ROWS), "trie-nodes")
    split = nodes.where("self is not null").groupBy("self").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.max("above").alias("above"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends_sha256").alias("ends_sha256"),
    )
    split = stage(split, "trie-split")
    names = split.select(F.col("self").alias("above"), F.col("conv_id").alias("parent"))
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = nodes.where("self is null and above is null").select(*cols)
    under = nodes.where("self is null and above is not null").select("above", *[c for c in cols if c != "parent_conv_id"])
    under = under.unionByName(split.drop("self")).join(names, "above", "left").withColumnRenamed("parent", "parent_conv_id").select(*cols)
    return whole.unionByName(under).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE)))


def op11_turn_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(stage(turn_ids(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "trie-turns")))


OP11_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
  SELECT conv_id, l, conv_id - conv_id % 20 AS base, flatten(list_transform(range(length(conv_id::VARCHAR)),
    lambda i: list_transform(range(8), lambda b: (ascii(substr(conv_id::VARCHAR, i + 1, 1)) >> b::INTEGER) & 1))) AS bits FROM own
), heads AS (
  SELECT conv_id, l, base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(bits, lambda x: x::BIGINT)),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 4 AS h FROM crc
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.l, [])[1:a.h], a.l[a.h + 1:]) AS l FROM heads a LEFT JOIN own b ON b.conv_id = a.base
), members AS (
  SELECT conv_id, len(l) AS len_l, d AS depth, l[1:d] AS path,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(l[d].t, '{_WORD}')) END AS words
  FROM rebuilt, unnest(range(len(l) + 1)) u(d)
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len_l = depth), '')) AS ends_sha256
  FROM members GROUP BY path, depth
), kids AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), full_nodes AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (path)
), sums AS (
  SELECT x.path[1:d] AS path, sum((x.n_children = 0)::INT) AS n_leaves, sum((x.n_convs - 1) * x.words) AS saved_tokens
  FROM full_nodes x, unnest(range(x.depth + 1)) u(d) GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (path) LEFT JOIN full_nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""
