"""Exact duplicates with Patricia tries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile.llm.common import in_small_batches


class Trie:
    """A compressed radix trie over byte strings; a terminal node holds [smallest id, number of strings, content hash]."""

    def __init__(self) -> None:
        self.root: dict[int, list] = {}  # first byte -> [label, children, terminal]
        self.held = 0

    def insert(self, text: bytes, owner: int | None, copies: int, key: int) -> None:
        children, at, size = self.root, 0, len(text)
        node = None
        while True:
            if node is not None and at == size:
                self._own(node, owner, copies, key)
                return
            first = text[at] if at < size else -1  # the empty string has a node of its own
            node = children.get(first)
            if node is None:
                children[first] = [text[at:], {}, [owner, copies, key]]
                self.held += size - at + 300
                return
            label = node[0]
            if not text.startswith(label, at):
                self._split(node, text, at)
            at += len(node[0])
            children = node[1]

    def _split(self, node: list, text: bytes, at: int) -> None:
        label = node[0]
        low, high = 1, min(len(label), len(text) - at)  # the first byte agrees; find the common length by halves
        while low < high:
            middle = (low + high + 1) // 2
            if text.startswith(label[:middle], at):
                low = middle
            else:
                high = middle - 1
        below = [label[low:], node[1], node[2]]
        node[0], node[1], node[2] = label[:low], {label[low]: below}, None
        self.held += 300

    @staticmethod
    def _own(node: list, owner: int | None, copies: int, key: int) -> None:
        if node[2] is None:
            node[2] = [owner, copies, key]
            return
        old = node[2]
        if owner is not None and (old[0] is None or owner < old[0]):
            old[0] = owner
        old[1] += copies

    def terminals(self) -> Iterator[tuple]:
        stack = [(b"", node) for node in self.root.values()]
        while stack:
            before, (label, children, owner) = stack.pop()
            text = before + label
            if owner is not None:
                yield text, *owner
            stack.extend((text, child) for child in children.values())

    def subtrees(self) -> Iterator[Trie]:
        """One trie per child of the root, so that a full trie can leave memory subtree by subtree."""
        for first in list(self.root):
            part = Trie()
            part.root = {first: self.root.pop(first)}
            yield part
        self.held = 0


TRIE = pa.schema([("size", pa.int32()), ("hash", pa.int64()), ("text", pa.binary()), ("owner", pa.int64()), ("copies", pa.int64())])
BATCH_BYTES = 8 << 20


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded bytes; every row starts with its size."""
    held, some = 0, []
    for row in rows:
        some.append(row)
        held += row[0] + 100
        if held > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)
            held, some = 0, []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)


def _insert_all(batches: Iterator[pa.RecordBatch], max_bytes: int, whole_keys: bool) -> Iterator[tuple]:
    """Insert rows (size, hash, text, owner, copies). A full trie is emptied subtree by subtree; with whole_keys only between two keys, so no text is split."""
    trie, before = Trie(), None

    def empty() -> Iterator[tuple]:
        for part in trie.subtrees():
            for text, owner, copies, key in part.terminals():
                yield len(text), key, text, owner, copies

    for batch in batches:
        for size, key, text, owner, copies in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if trie.held > max_bytes and not (whole_keys and before == (size, key)):
                yield from empty()
            trie.insert(text, owner, copies, key)
            before = (size, key)
    yield from empty()


def text_owners(texts: DataFrame, max_trie_bytes: int = 64 << 20) -> DataFrame:
    """The smallest id and the number of rows of every distinct byte string.

    texts: (id long, text binary without nulls). Each task first inserts its own rows in a trie, so
    a text that many rows share leaves a task once. Length and content hash then decide where a text
    goes; there the full byte strings meet in a trie. Rows arrive ordered by (length, hash), so a trie
    that is full can be emptied, subtree by subtree, whenever a key has ended: memory is bounded by
    max_trie_bytes and the distinct texts under one (length, hash).
    """
    fields = [F.length("text").alias("size"), F.xxhash64("text").alias("hash"), "text"]
    rows = texts.select(*fields, F.col("id").alias("owner"), F.lit(1).cast("long").alias("copies"))
    schema = "size int, hash long, text binary, owner long, copies long"
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_insert_all(batches, max_trie_bytes, False), TRIE)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_insert_all(batches, max_trie_bytes, True), TRIE)

    dealt = rows.mapInArrow(first, schema).repartition(n, "size", "hash").sortWithinPartitions("size", "hash")
    return dealt.mapInArrow(last, schema)


def one_space(text: Column) -> Column:
    """Null counts as empty; every run of white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Which row of equal texts stays.

    Texts are equal when identical after `one_space`; null is empty. Returns per row: doc_id, keep_id
    (smallest id of the group), group_size, kept (the id is keep_id), text_sha256 (lowercase hex of the
    normalised text). Rows without an id stay only if no row of the group has one. Rows that repeat
    the id and the text of the row that stays are all marked as kept. An empty table gives no rows;
    other columns of any name are not read.
    """
    mine = in_small_batches(docs).select(F.col(f"`{id}`").cast("long").alias("id"), F.encode(one_space(F.col(f"`{text}`")), "UTF-8").alias("text"))
    owners = text_owners(mine).where("copies > 1").select(F.sha2("text", 256).alias("digest"), "owner", "copies")
    rows = mine.select("id", F.sha2("text", 256).alias("text_sha256"))
    joined = rows.join(owners, F.col("text_sha256") == F.col("digest"), "left")
    keep = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("owner"))
    return joined.select(
        F.col("id").alias("doc_id"), keep.alias("keep_id"), F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )
