"""Prefix trie of conversations by bursting: oversized containers split by the next turn, the others are sorted and swept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile.llm.common import saved, small

NOBODY = hashlib.sha256(b"").hexdigest()
#: Members whose ids share all but so many low bits are listed together.
RANGE_BITS = 12
KEY = 16  # bytes of a turn id and of a container key


def conversation_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, ids, bytes): per conversation the 16-byte ids of its turns, in order, and the UTF-8 bytes of their texts.

    Texts themselves are not shuffled. An id is a digest of role and text. Null turn numbers come
    first; equal ones go by id.
    """
    said = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")
    who = F.encode(F.coalesce(F.col(f"`{role}`"), F.lit("")), "UTF-8")
    framed = F.concat(F.encode(F.concat(F.length(who).cast("string"), F.lit(":")), "UTF-8"), who, said)
    id = F.substring(F.unhex(F.sha2(framed, 256)), 1, KEY)
    turns = rows.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").cast("long").alias("turn"), id.alias("id"), F.length(said).cast("long").alias("bytes")).alias("t"),
    ).where("conv_id is not null")
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select("conv_id", F.col("t.id").alias("ids"), F.col("t.bytes").alias("bytes"))


def rebuilt(turns: DataFrame, group: int, head: Column, most: int) -> DataFrame:
    """Conversations whose first `head` turns (at most `most`) are those of conversation id - id % group, followed by their own later turns."""
    base = turns.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("ids", 1, most).alias("base_ids"), F.slice("bytes", 1, most).alias("base_bytes"))
    joined = turns.withColumn("h", head).join(base, F.col("conv_id") - F.col("conv_id") % group == F.col("base"), "left")

    def both(first: str, own: str, empty: str) -> Column:
        start = F.slice(F.coalesce(first, F.array().cast(empty)), F.lit(1), F.col("h"))
        rest = F.slice(own, F.col("h") + 1, F.greatest(F.size(own) - F.col("h"), F.lit(0)))
        return F.concat(start, rest)

    return joined.select("conv_id", both("base_ids", "ids", "array<binary>").alias("ids"), both("base_bytes", "bytes", "array<bigint>").alias("bytes"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key from its sorted lists of members: smallest one, number, digest of all joined by commas."""
    key, least, n, digest = None, 0, 0, None
    for b in batches:
        out: list[tuple] = []
        for k, low, count, listed in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
            if k != key:
                if key is not None:
                    out.append((key, least, n, digest.hexdigest()))
                key, least, n, digest = k, low, 0, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(listed.encode())
            n += count
        yield _batch(out, MEMBERS)
    if key is not None:
        yield _batch([(key, least, n, digest.hexdigest())], MEMBERS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


MEMBERS = pa.schema([("key", pa.binary()), ("conv", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])


def sequences(conversations: DataFrame) -> DataFrame:
    """Every distinct sequence of turns once: (conv, n, ends, ids, bytes) with its smallest member, their number and their digest.

    Members are listed per range of ids first, so that a sequence with very many members is a row per
    range when it meets in one task, which streams them through the digest.
    """
    keyed = saved(conversations.withColumn("key", F.unhex(F.sha2(F.concat_ws("", F.transform("ids", F.hex)), 256))))
    listed = keyed.groupBy("key", F.shiftright("conv_id", RANGE_BITS).alias("range")).agg(F.array_sort(F.collect_list("conv_id")).alias("c"))
    listed = listed.select("key", "range", F.col("c")[0].alias("low"), F.size("c").cast("long").alias("count"), F.concat_ws(",", F.transform("c", lambda c: c.cast("string"))).alias("listed"))
    listed = listed.repartition("key").sortWithinPartitions("key", "range")
    named = listed.mapInArrow(_members, "key binary, conv long, n long, ends string")
    return named.join(keyed.select("conv_id", "ids", "bytes"), F.col("conv") == F.col("conv_id")).select("conv", "n", "ends", "ids", "bytes")


class _Node:
    """A node on the path that is being swept; its finished children wait until its smallest member is known."""

    __slots__ = ("depth", "bytes", "conv", "n", "ends", "leaves", "saved", "children")

    def __init__(self, depth: int, bytes: int) -> None:
        self.depth, self.bytes, self.conv, self.n, self.ends, self.leaves, self.saved, self.children = depth, bytes, None, 0, NOBODY, 0, 0, []

    def finish(self) -> list:
        """conv, depth, parent's conv, n_convs, n_children, n_leaves, saved tokens, digest, bytes of the last text."""
        if not self.children:
            self.leaves = 1
        self.saved += (self.n - 1) * self.bytes
        return [self.conv, self.depth, None, self.n, len(self.children), self.leaves, self.saved, self.ends]

    def take(self, child: _Node, out: list) -> None:
        """child is complete: its counts count here, its own children can go."""
        row = child.finish()
        for grandchild in child.children:
            grandchild[2] = child.conv
            out.append((*grandchild, None))
        self.children.append(row)
        self.join(child.conv, child.n)
        self.leaves += child.leaves
        self.saved += child.saved

    def join(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.n += n


SWEPT = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("path", pa.binary()),
])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of containers whose sequences come sorted. The head of a container has `path`, the keys of the burst heads above it."""
    head, stack, at, top, out = None, [], [], None, []

    def close(depth: int) -> None:
        while len(stack) > depth + 1:
            child = stack.pop()
            stack[-1].take(child, out)
        del at[depth:]

    def finish() -> None:
        close(0)
        row = stack[0].finish()
        for child in stack[0].children:
            child[2] = stack[0].conv
            out.append((*child, None))
        row[2] = top[0]
        out.append((*row, top[1]))

    for b in batches:
        columns = [b.column(i).to_pylist() for i in range(9)]
        for key, path, depth, parent, conv, n, ends, ids, lengths in zip(*columns):
            if key != head:
                if head is not None:
                    finish()
                head, top, at = key, (parent, path), []
                stack = [_Node(depth, lengths[depth - 1] if depth else 0)]
            own = ids[depth:]
            common = 0
            for x, y in zip(own, at):
                if x != y:
                    break
                common += 1
            close(common)
            for i in range(common, len(own)):
                at.append(own[i])
                stack.append(_Node(depth + i + 1, lengths[depth + i]))
            stack[-1].ends = ends
            stack[-1].join(conv, n)
        yield _batch(out, SWEPT)
        out.clear()
    if head is not None:
        finish()
    yield _batch(out, SWEPT)


def trie_nodes(conversations: DataFrame, max_turns: int = 50_000, few: int = 16) -> DataFrame:
    """The nodes of the trie over (conv_id, ids, bytes): every distinct sequence of first turns.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, (members - 1) * bytes of the last text), ends_sha256.

    Suffix containers hang under trie heads and lie in shards by the key of their head. At first one
    container, under the root, holds all distinct sequences. A container with more than `max_turns`
    turns in more than `few` sequences bursts: its head becomes a node, and its sequences move on to
    containers one turn deeper, by the id of that turn. The rest are sorted within their shard and
    swept: the path to the last sequence is a stack, and what a new sequence no longer shares is
    complete. Sums over the subtrees of burst heads come from the heads of the containers below
    them, each of which names all burst heads above it.
    """
    columns = ["head", "path", "depth", "parent", "conv", "n", "ends", "ids", "bytes"]
    pool = saved(sequences(conversations).select(
        F.lit(b"\0" * KEY).alias("head"), F.lit(b"").alias("path"), F.lit(0).alias("depth"), F.lit(None).cast("long").alias("parent"), "conv", "n", "ends", "ids", "bytes",
    ))
    settled, burst, depth = [], [], 0
    while True:
        sizes = pool.groupBy("head").agg(
            F.sum(F.size("ids") - F.col("depth")).alias("turns"), F.count("*").alias("sequences"), F.min("conv").alias("least"), F.sum("n").alias("n_convs"),
            F.max(F.when(F.size("ids") == F.col("depth"), F.col("ends"))).alias("own"), F.max("path").alias("above"), F.max("parent").alias("parent_conv_id"),
            F.max(F.get("bytes", F.col("depth") - 1)).alias("last"),
        )
        big = saved(sizes.where((F.col("turns") > max_turns) & (F.col("sequences") > few)).withColumnRenamed("head", "big"))
        n = big.count()
        if not n:
            settled.append(pool.select(columns))
            break
        heads = small(big.select("big", "least"), 3 * n)
        settled.append(pool.join(small(big.select("big"), n), F.col("head") == F.col("big"), "left_anti").select(columns))
        burst.append(big.select(
            "least", F.lit(depth).cast("long").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("own", F.lit(NOBODY)).alias("ends"),
            (F.coalesce("last", F.lit(0)) * (F.col("n_convs") - 1)).alias("saved"), "big", "above",
        ))
        moving = pool.join(heads, F.col("head") == F.col("big")).where(F.size("ids") > F.col("depth"))
        key = F.substring(F.unhex(F.sha2(F.concat("head", F.get("ids", F.col("depth"))), 256)), 1, KEY)
        pool = saved(moving.select(
            key.alias("head"), F.concat("path", "head").alias("path"), (F.col("depth") + 1).alias("depth"), F.col("least").alias("parent"), "conv", "n", "ends", "ids", "bytes",
        ))
        depth += 1
    shards = reduce(DataFrame.union, settled).repartition("head").sortWithinPartitions("head", "ids")
    kinds = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, path binary"
    swept = shards.mapInArrow(_sweep, kinds)
    if not burst:
        return swept.drop("path")
    swept = saved(swept)
    heads = reduce(DataFrame.union, burst)
    below = swept.where("path is not null").select("path", "n_leaves", "saved_tokens").union(heads.select("above", F.lit(0).cast("long"), "saved"))

    def key_at(i: Column) -> Column:
        return F.substring("path", i * KEY + 1, F.lit(KEY))

    count = (F.length("path") / KEY).cast("int")
    above = F.transform(F.sequence(F.lit(1), count), lambda i: F.struct(key_at(i - 1).alias("key"), (i == count).alias("child")))
    named = below.where(count > 0).select(F.explode(above).alias("a"), "n_leaves", "saved_tokens")
    totals = named.groupBy("a.key").agg(F.count_if("a.child").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
    inner = heads.join(totals, F.col("big") == F.col("key"))
    return swept.drop("path").union(inner.select("least", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved") + F.col("below"), "ends"))


def crc32_remainder(number: str, modulus: int) -> Column:
    """The unsigned CRC-32 of the decimal digits of a column, modulo `modulus`."""
    return F.crc32(F.col(number).cast("string").cast("binary")) % modulus


def prefix_trie(
    rows: DataFrame, group: int = 5, most: int = 8, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", max_turns: int = 50_000, few: int = 16,
) -> DataFrame:
    """The prefix trie of conversations of which each starts with up to `most` turns of the first one of its group.

    Conversation c takes the first crc32(c) % (most + 1) turns from conversation c - c % group (none
    where that is absent) and goes on with its own turns after as many. See `trie_nodes` for what
    is returned and how.

    Null roles and texts are empty; null turn numbers come first, equal ones go by a digest of role
    and text; repeated rows are turns of their own; rows without a conversation id are left out; a
    conversation that loses all its turns is a member of the root. An empty table gives no rows;
    other columns are not read. A conversation is one row of 24 bytes a turn.
    """
    own = conversation_turns(rows, conv, turn, role, text)
    return trie_nodes(rebuilt(saved(own), group, crc32_remainder("conv_id", most + 1).cast("int"), most), max_turns, few)
