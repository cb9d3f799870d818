"""Repeated byte strings by suffix sorting over a difference cover, in slices of the strings."""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.llm import textbytes as T
from tableprofile.llm.common import in_small_batches, lists, saved, small, values

U = np.uint64
LENGTH = 100  # bytes of a string that counts
GRAM = 36  # bytes of the window hashes that find where repeats can be
SPAN = LENGTH - GRAM + 1
SLICE = 1_000_000  # bytes that are sorted together, about
PLACES = 500  # of a mark in one part, about
WIDEST = 256  # starts of one record
CUT = 4  # one of so many changes of the smallest hash ends a block, some 130 bytes apart


def _extremes(x: np.ndarray, of: np.ufunc, fill: int) -> np.ndarray:
    """The smallest or largest of every SPAN neighbours."""
    padded = np.full(-(-len(x) // SPAN) * SPAN, fill, U)
    padded[: len(x)] = x
    rows = padded.reshape(-1, SPAN)
    ahead = of.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = of.accumulate(rows, axis=1).ravel()
    return of(ahead[: len(x) - SPAN + 1], behind[SPAN - 1 : len(x)])


def window_minima(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all GRAM-byte strings, and for every start of a LENGTH-byte string the smallest one inside it."""
    total = T.sums(data)
    hashes = T.mix((total[GRAM:] - total[:-GRAM]) * T.powers(len(data))[1][: len(data) - GRAM + 1])
    return hashes, _extremes(hashes, np.minimum, np.iinfo(U).max)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every text cut in blocks of starts where its bytes say so: equal bytes are cut at equal places.

    digest: of the bytes of all strings that start in the block. marks, places: the smallest hashes
    inside these strings and where they are; a place at a cut is given for both blocks.
    """
    names = ["id", "start", "end", "digest", "marks", "places"]
    for b in batches:
        ids, starts, ends, digests, marks, places = [], [], [], [], [], []
        for id, data in zip(b.column(0).to_pylist(), values(b.column(1))):
            hashes, least = window_minima(data)
            n = len(least)
            cut = np.flatnonzero(least[1:] != least[:-1]) + 1
            cut = np.concatenate([[0], cut[T.draw(least[cut], 5) % U(CUT) == 0], [n]])
            framed = np.zeros(n + 2 * (SPAN - 1), U)
            framed[SPAN - 1 : SPAN - 1 + n] = least
            place = np.flatnonzero(_extremes(framed, np.maximum, 0) == hashes)
            low, high = np.searchsorted(place, cut[:-1]), np.searchsorted(place, cut[1:] + SPAN - 1)
            for first, end, i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), low, high):
                ids.append(id)
                starts.append(first)
                ends.append(end)
                digests.append(hashlib.blake2b(data[first : end + LENGTH - 1], digest_size=16).digest())
                marks.append(hashes[place[i:j]].view(np.int64))
                places.append(place[i:j])
            if len(ids) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(digests, pa.binary()), lists(marks, pa.int64()), lists(places, pa.int32())], names=names)
                ids, starts, ends, digests, marks, places = [], [], [], [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(digests, pa.binary()), lists(marks, pa.int64()), lists(places, pa.int32())], names=names)


def _spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the ranges; what is beyond n does not count."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, np.minimum(starts, n), 1)
    np.add.at(change, np.minimum(ends, n), -1)
    return np.cumsum(change)[:n] > 0


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The items of each list; a null has none."""
    for x in column:
        yield x.values.to_numpy() if x.is_valid else np.zeros(0, np.int64)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings that may repeat, by the smallest window hash inside them.

    A record holds neighbouring starts whose strings have the same smallest hash, its mark, and the
    bytes of these strings. Where a mark has many places, `part` spreads its records at random.
    """
    names = ["mark", "part", "parts", "id", "start", "n", "bytes"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 7, types)], names=names)

    rows = []
    for b in batches:
        known = zip(b.column(0).to_pylist(), *map(_lists, b.columns[2:6]))
        for data, (id, marks, parts, starts, ends) in zip(values(b.column(1)), known):
            if not len(marks):
                continue
            least = window_minima(data)[1].view(np.int64)
            order = np.argsort(marks)
            marks, parts = marks[order], parts[order]
            at = np.minimum(np.searchsorted(marks, least), len(marks) - 1)
            wanted = (marks[at] == least) & ~_covered(len(least), starts, ends)
            edge = np.flatnonzero((wanted[1:] != wanted[:-1]) | (least[1:] != least[:-1])) + 1
            firsts = np.concatenate([[0], edge])
            ends = np.concatenate([edge, [len(least)]])
            for k in np.flatnonzero(wanted[firsts]):
                mark, p = int(least[firsts[k]]), int(parts[at[firsts[k]]])
                for first in range(int(firsts[k]), int(ends[k]), WIDEST):
                    n = min(WIDEST, int(ends[k]) - first)
                    piece = data[first : first + n + LENGTH - 1].tobytes()
                    part = hash((id, first, zlib.crc32(piece))) % p if p > 1 else 0
                    rows.append((mark, part, p, id, first, n, piece))
            if len(rows) > 10_000:
                yield batch(rows)
                rows = []
    yield batch(rows)


def _named(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, int]:
    """The number of each triple (a, b, c) in sorted order from 1 on, equal ones once, and how many there are."""
    if max(int(x.max(initial=0)) for x in (a, b, c)) >= 1 << 21:
        a, b = np.unique(a << 32 | b, return_inverse=True)[1], np.int64(0)
        key = a << 32 | c
    else:
        key = a << 42 | b << 21 | c
    unique, name = np.unique(key, return_inverse=True)
    return name + 1, len(unique)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The starts of all suffixes of a text of numbers from 1 to 2 ** 31 - 1, in sorted order.

    The difference cover modulo 3: triples at the positions that are not a multiple of 3 are sorted
    and named; while names repeat, the order of the string of names is found in the same way. The
    suffixes at multiples of 3 follow from their first number and the rank after it, and are merged
    with the others by one or two numbers and the rank that comes next in both.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    padded = np.concatenate([text, np.zeros(3, np.int64)])
    # With n % 3 == 1 the end itself is a sampled position, so that the names of one residue end with a triple of their own.
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    names, kinds = _named(padded[sample], padded[sample + 1], padded[sample + 2])
    if kinds < len(sample):
        sample = sample[suffix_order(names)]
    else:
        sample = sample[np.argsort(names)]
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = np.arange(1, len(sample) + 1)
    sample = sample[sample < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.lexsort((rank[rest + 1], padded[rest]))]
    # Merge: how many sampled suffixes of each residue come before each of the others.
    ones, twos = sample[sample % 3 == 1], sample[sample % 3 == 2]
    name, _ = _named(*(np.concatenate([x, y]) for x, y in [(padded[ones], padded[rest]), (rank[ones + 1], rank[rest + 1]), (np.zeros(len(ones), np.int64), np.zeros(len(rest), np.int64))]))
    before = np.searchsorted(name[: len(ones)], name[len(ones) :])
    name, _ = _named(*(np.concatenate([x[twos], x[rest]]) for x in (padded, padded[1:], rank[2:])))
    before += np.searchsorted(name[: len(twos)], name[len(twos) :])
    out = np.empty(n, np.int64)
    place = np.arange(len(rest)) + before
    out[place] = rest
    free = np.ones(n, bool)
    free[place] = False
    out[free] = sample
    return out


def _compared(rows: list[tuple]) -> Iterator[tuple]:
    """(id, start, end, digest) of the records (parts, id, start, n, bytes) of one slice.

    Without a digest: a range of starts whose strings start earlier in the slice. With one: the
    first place in the slice of a string whose mark has further parts, by the digest of the string.
    """
    rows.sort(key=lambda row: row[1:3])
    seen: dict[bytes, tuple] = {}
    for _, id, start, n, piece in rows:  # of equal records the first one stays
        if piece not in seen:
            seen[piece] = (id, start)
        elif (id, start) > seen[piece]:
            yield id, start, start + n, None
    stay = [row for row in rows if seen.get(row[4]) == row[1:3]]
    stay = list({row[4]: row for row in stay}.values())
    ids, starts, counts = (np.array([row[i] for row in stay], np.int64) for i in (1, 2, 3))
    split = np.array([row[0] > 1 for row in stay], bool)
    data = np.frombuffer(b"\0".join(row[4] for row in stay) + bytes(8), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(row[4]) + 1 for row in stay])])
    text = data[: offsets[-1]].astype(np.int64) + len(stay) + 1
    text[offsets[1:] - 1] = np.arange(1, len(stay) + 1)  # a number of its own ends each record
    offsets = offsets[:-1]
    record = np.repeat(np.arange(len(stay)), counts)
    place = np.arange(len(record)) - np.repeat(np.cumsum(counts) - counts, counts)
    wanted = np.full(len(text), -1, np.int64)
    wanted[offsets[record] + place] = np.arange(len(record))
    order = suffix_order(text)
    order = order[wanted[order] >= 0]
    # Adjacent prefixes, eight bytes at a time.
    eight = np.ascontiguousarray(np.ndarray(len(data) - 7, "<u8", data, strides=(1,)))
    new = np.ones(len(order), bool)
    new[1:] = False
    for i in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        word = eight[order + i]
        new[1:] |= word[1:] != word[:-1]
    begin = np.flatnonzero(new)
    item = wanted[order]
    _, number = np.unique(ids, return_inverse=True)
    key = (number[record] << 32 | (starts[record] + place))[item]
    least = np.repeat(np.minimum.reduceat(key, begin), np.diff(np.append(begin, len(key))))
    later = np.zeros(len(text), bool)
    later[order[key > least]] = True
    for first, end in zip(*_spans(later)):
        r = np.searchsorted(offsets, first, "right") - 1
        start = int(starts[r] + first - offsets[r])
        yield int(ids[r]), start, start + int(end - first), None
    r = record[item]
    for at in np.flatnonzero((key == least) & split[r]).tolist():
        i = int(order[at])
        yield int(ids[r[at]]), int(starts[r[at]] + i - offsets[r[at]]), None, hashlib.blake2b(data[i : i + LENGTH], digest_size=16).digest()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What _compared says of records sorted by mark and part, in slices of whole parts of about SLICE bytes."""
    names, types = ["id", "start", "end", "digest"], [pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def told(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = _compared(rows)
        while some := list(itertools.islice(found, 20_000)):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*some), types)], names=names)

    rows, size, last = [], 0, None
    for b in batches:
        for mark, part, *row in zip(*(c.to_pylist() for c in b.columns)):
            if size > SLICE and (mark, part) != last:
                yield from told(rows)
                rows, size = [], 0
            last = mark, part
            rows.append(tuple(row))
            size += len(row[-1])
    if rows:
        yield from told(rows)


def repeated_starts(texts: DataFrame, places: int = PLACES) -> DataFrame:
    """(id, start, end): ranges of the starts of every 100-byte string that also starts earlier, at a smaller id or in the same text before.

    texts: (id long, text binary of at least 100 bytes), ids and texts distinct.

    Equal strings need one representative only. Texts are cut in blocks by their own bytes; of equal
    blocks the first one stays, and all starts of the others repeat. The first place of any string
    lies in a block that stays, so the strings of these blocks decide about all of their own.
    Where can those repeat? Equal strings contain the same smallest 36-byte hash, their mark. Only
    starts whose mark occurs at a second place go on; no repeat is lost, and most text is left out.
    Spark deals them by mark, so that equal strings meet in one slice, and each slice is sorted by
    its suffixes (`suffix_order`: sampled triples, recursion on names, merge of the others); suffixes
    with equal prefixes of 100 bytes are then neighbours, which are compared byte by byte.

    A mark with more than `places` places is dealt over several parts. Each part is sorted as before
    and sends the first place of each of its strings, by digest; Spark takes the first of all parts.
    """
    blocks = saved(texts.mapInArrow(_blocks, "id long, start int, end int, digest binary, marks array<long>, places array<int>"))
    first = blocks.groupBy("digest").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("n"))
    first = saved(first.where("n > 1").select("digest", "first"))
    first = small(first, 2 * first.count())  # 32 bytes a row
    placed = blocks.join(first, "digest", "left").withColumn("later", F.coalesce(F.struct("id", "start") > F.col("first"), F.lit(False)))
    later = saved(placed.where("later").select("id", "start", "end"))
    each = placed.where("not later").select("id", F.explode(F.arrays_zip("marks", "places")).alias("m")).select("id", F.col("m.marks").alias("mark"), F.col("m.places").alias("place"))
    again = each.groupBy("mark").agg((F.min("id") < F.max("id")).alias("ids"), (F.min("place") < F.max("place")).alias("places"), F.count("*").alias("n")).where("ids or places")
    again = saved(again.select("mark", F.ceil(F.col("n") / places).cast("int").alias("parts")))
    own = each.select("id", "mark").join(small(again), "mark").groupBy("id").agg(F.collect_set(F.struct("mark", "parts")).alias("own"))
    gone = later.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("gone"))
    known = own.join(gone, "id", "left").select("id", "own.mark", "own.parts", F.col("gone.start").alias("from"), F.col("gone.end").alias("to"))
    records = texts.join(known, "id").select("id", "text", "mark", "parts", "from", "to").mapInArrow(_records, "mark long, part int, parts int, id long, start int, n int, bytes binary")
    dealt = records.repartition("mark", "part").sortWithinPartitions("mark", "part").select("mark", "part", "parts", "id", "start", "n", "bytes")
    told = saved(dealt.mapInArrow(_slices, "id long, start int, end int, digest binary"))
    firsts = told.where("digest is not null").select("id", "start", "digest")
    least = saved(firsts.groupBy("digest").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    least = small(least, 2 * least.count())
    across = firsts.join(least, "digest").where(F.struct("id", "start") > F.col("first")).select("id", "start", (F.col("start") + 1).alias("end"))
    return later.union(told.where("digest is null").select("id", "start", "end")).union(across)


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What is left of every text without the bytes of 100-byte strings that also start earlier.

    Earlier: at a smaller id, or in the same document at an earlier start; judged on the texts as
    given. Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (lowercase
    hex of the remaining bytes). Null counts as empty; texts under 100 bytes lose nothing; of equal
    texts all but the one with the smallest id are removed whole; repeated rows are one document;
    different texts under one id are compared by start alone; rows without an id lose nothing and
    remove nothing. An empty table gives no rows; other columns are not read.
    """
    rows = in_small_batches(docs).select(F.col(f"`{id}`").cast("long").alias("id"), F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8").alias("text"))
    long = rows.where((F.length("text") >= LENGTH) & F.col("id").isNotNull())
    digest = F.unhex(F.sha2("text", 256))
    keyed = saved(long.select("id", digest.alias("key")).groupBy("id", "key").agg(F.count("*").alias("times")))
    first = keyed.groupBy(F.col("key").alias("k")).agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("k", "first")
    copies = saved(keyed.join(first, F.col("key") == F.col("k")).where("id <> first").select("id", "key"))
    copies = small(copies, 3 * copies.count())  # 40 bytes a row
    twice = saved(keyed.where("times > 1").select("id", "key").join(copies, ["id", "key"], "left_anti"))
    twice = small(twice, 3 * twice.count())
    # Only rows that are there more than once are shuffled to keep one of each.
    long = long.withColumn("key", digest).join(copies, ["id", "key"], "left_anti")
    once = long.join(twice, ["id", "key"], "left_anti").select("id", "text")
    single = once.union(long.join(twice, ["id", "key"]).dropDuplicates(["id", "key"]).select("id", "text"))
    starts = saved(repeated_starts(single).groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("found")))
    copied = copies.select("id", "key", F.lit(True).alias("copy"))
    joined = rows.withColumn("key", digest).join(copied, ["id", "key"], "left").join(starts, "id", "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            known = zip(b.column(2).to_pylist(), _lists(b.column(3)), _lists(b.column(4)))
            for data, (copy, starts, ends) in zip(values(b.column(1)), known):
                fit = starts + LENGTH <= len(data)
                mask = np.ones(len(data), bool) if copy else _covered(len(data), starts[fit], ends[fit] + LENGTH - 1)
                out.append((len(data), int(mask.sum()), len(_spans(mask)[0]), hashlib.sha256(data[~mask].tobytes()).hexdigest()))
            n, removed, spans, digests = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return joined.select("id", "text", "copy", F.col("found.start").alias("from"), F.col("found.end").alias("to")).mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
