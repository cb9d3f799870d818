"""Near duplicates: SuperMinHash signatures, banding, verification on whole sets, grouping."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile.llm import textbytes as T
from tableprofile.llm.common import components, in_small_batches, lists, saved, small, values

U = np.uint64


def signature(hashes: np.ndarray, k: int) -> np.ndarray:
    """SuperMinHash of a set of 64-bit hashes: k values whose agreement estimates the Jaccard similarity.

    Every element visits the k places in a random order of its own and brings to the place of its
    j-th visit a value in [j, j + 1). All elements take visit j together; once every place holds a
    value below j no later visit can lower one, and the rest is skipped.
    """
    best = np.full(k, np.iinfo(U).max, U)
    order = None
    each = np.arange(len(hashes))
    for j in range(k):
        if best.max() < U(j << 32):
            break
        r = T.draw(hashes, j)
        value = (r & U(0xFFFFFFFF)) | U(j << 32)
        at = j + (((r >> U(32)) * U(k - j)) >> U(32)).astype(np.int64)
        if j == 0:
            place = at
        else:
            if order is None:  # what the first visit would have swapped
                order = np.tile(np.arange(k, dtype=np.int16), (len(hashes), 1))
                order[each, first], order[:, 0] = 0, first
            place = order[each, at]
            order[each, at] = order[:, j]
            order[:, j] = place
        if j == 0:
            first = at
        np.minimum.at(best, place, value)
    return best


PARITIES = 1024


def parities(hashes: np.ndarray) -> np.ndarray:
    """For 1,024 groups of elements whether their number is odd, as 16 longs. Two sets differ in at least as many elements as their parities do."""
    odd = np.bincount((hashes >> U(54)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


SKETCH = pa.schema([
    ("id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("sig", pa.list_(pa.int32())), ("bands", pa.list_(pa.int64())),
    ("odd", pa.list_(pa.int64())),
])


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Per document: size and digest of the shingle set, signature, one hash per band of `rows` signature values, parities."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams = T.draw(np.arange(bands, dtype=U), 7)
        for batch in batches:
            n, keys, sigs, cuts, odd = [], [], [], [], []
            for data in values(batch.column(1)):
                found = T.shingles(data, words)
                n.append(len(found))
                odd.append(parities(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                if not len(found):
                    sigs.append(np.zeros(0, np.int32))
                    cuts.append(np.zeros(0, np.int64))
                    continue
                sig = T.mix(signature(found, bands * rows))
                sigs.append((sig & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32))
                band = streams.copy()
                for i in range(rows):
                    band = T.mix(band * U(0x9E3779B97F4A7C15) + sig[i::rows])
                cuts.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), lists(sigs, pa.int32()), lists(cuts, pa.int64()), lists(odd, pa.int64())],
                schema=SKETCH,
            )

    return docs.mapInArrow(sketch, "id long, n long, key binary, sig array<int>, bands array<long>, odd array<long>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [T.shingles(data, words).view(np.int64) for data in values(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), lists(found, pa.int64())], names=["id", "items"])

    return docs.mapInArrow(sets, "id long, items array<long>")


def _likely(pairs: DataFrame, sizes: DataFrame, percent: int, floor: int) -> DataFrame:
    """The pairs (a, b) that their sizes do not exclude and of which at least `floor` signature values agree."""
    a = sizes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    b = sizes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    near = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (agree >= floor)
    return saved(pairs.join(a, "a").join(b, "b").where(near).select("a", "b"))


def _linked(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    a, b = sets.select(F.col("id").alias("a"), F.col("items").alias("ia")), sets.select(F.col("id").alias("b"), F.col("items").alias("ib"))
    shared = F.size(F.array_intersect("ia", "ib"))
    return saved(likely.join(a, "a").join(b, "b").where(100 * shared >= percent * (F.size("ia") + F.size("ib") - shared)).select("a", "b"))


def _possible(percent: int) -> Column:
    """Whether (n, odd) and (pn, podd) can be similar enough: sets that are differ in few elements, so also in few parities."""
    differ = F.lit(0)
    for i in range(PARITIES // 64):
        differ = differ + F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("podd")[i]))
    return (100 * F.least("n", "pn") >= percent * F.greatest("n", "pn")) & ((100 + percent) * differ <= (100 - percent) * (F.col("n") + F.col("pn")))


def _live(placed: DataFrame) -> DataFrame:
    """Buckets that still hold several components."""
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("size"), F.min("c").alias("low"), F.max("c").alias("high"))
    return saved(sizes.where("low < high").select("bucket", "size"))


def _distinct_buckets(members: DataFrame) -> DataFrame:
    """(bucket, size, pivot) of the buckets with several members; of buckets with the same members, told by two 64-bit sums, one stays."""
    marks = [F.bit_xor(F.xxhash64("rep", F.lit(i))).alias(f"x{i}") for i in range(2)]
    shared = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("pivot"), *marks).where("size > 1")
    return saved(shared.groupBy("size", "pivot", "x0", "x1").agg(F.min("bucket").alias("bucket")).select("bucket", "size", "pivot"))


def near_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, rows: int = 4,
    miss: float = 1e-7, sigmas: float = 6.0,
) -> DataFrame:
    """Groups of texts linked by a similarity of their sets of word shingles of at least `percent` / 100.

    Words are runs without white space, A-Z in lower case; a text with fewer than `words` words is
    one shingle; null and wordless texts have an empty set and are linked with nothing. Returns per
    row: doc_id, n_shingles, component_id (smallest id reachable, itself included), kept (doc_id is
    component_id). Rows without an id are kept, linked with nothing. Repeated rows have equal sets
    and share a component; different texts under one id are linked through that id. An empty table gives no rows; other columns of any name are not read.

    Equal sets are one representative from the start. Candidates agree in a band of `rows` signature
    values; there are as many bands as it takes that a pair on the threshold is missed with a
    probability of at most `miss`. A candidate must also agree in as many signature values as the
    threshold makes likely, less `sigmas` standard deviations: at six, one pair on the threshold in
    10 ** 9 is lost by that. Buckets with the same members are one. No bucket is expanded into all pairs: each first compares
    its members with its smallest one, and what a round links is one component, never compared
    again. Buckets that still hold several components compare with 4, 64, ... members until every
    member has been compared or joined; the parities of the sets tell, without error, most pairs that
    cannot be similar enough before they are made. Every link counts only after an intersection of the
    whole sets.
    """
    texts = in_small_batches(docs).select(F.col(f"`{id}`").cast("long").alias("id"), F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8").alias("text"))
    bands = math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows)) if percent < 100 else 1
    drawn = saved(sketches(texts, words, bands, rows))
    full = drawn.where("n > 0 and id is not null")
    reps = saved(
        full.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.min_by(F.struct("n", "sig", "bands", "odd"), "id").alias("p"))
        .select("key", "rep", "copies", "p.*")
    )
    sizes = reps.select("rep", "n", "sig")
    members = reps.select("rep", F.explode("bands").alias("bucket"))
    buckets = saved(members.join(_distinct_buckets(members), "bucket"))
    k = bands * rows
    floor = max(1, int(k * percent / 100 - sigmas * (k * percent / 100 * (1 - percent / 100)) ** 0.5))

    def sets_of(ids: DataFrame) -> DataFrame:
        ids = saved(ids.distinct())
        return saved(shingle_sets(texts.join(small(ids), "id"), words))

    pairs = saved(buckets.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct())
    likely = _likely(pairs, sizes, percent, floor)
    links = _linked(likely, sets_of(likely.select(F.col("a").alias("id")).union(likely.select("b"))), percent)
    checked, take = pairs, 4
    pool = saved(buckets.where("size > 2").groupBy("rep").agg(F.collect_list("bucket").alias("buckets")))  # at most one bucket per band
    while True:
        joined = components(links)
        n_joined = joined.count()
        named = pool.join(small(joined, n_joined), F.col("rep") == F.col("id"), "left")
        placed = saved(named.select(F.explode("buckets").alias("bucket"), "rep", F.coalesce("component", "rep").alias("c")))
        live = _live(placed)
        most = live.agg(F.max("size")).first()[0]
        if most is None:
            break
        kept = placed.join(small(live), "bucket").groupBy("rep", "c").agg(F.collect_list(F.struct("bucket", "size")).alias("in"))
        kept = saved(kept.join(reps.select("rep", "n", "odd"), "rep"))  # one row a member, whatever the number of its buckets
        rest = kept.select("rep", "c", "n", "odd", F.explode("in").alias("in")).select("in.*", "rep", "c", "n", "odd")
        chance = F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) / F.lit(1 << 20)
        first = rest.where((chance < F.lit(take) / F.col("size")) | F.lit(take >= most))
        first = first.select("bucket", F.col("rep").alias("p"), F.col("c").alias("pc"), F.col("n").alias("pn"), F.col("odd").alias("podd"))
        new = first.join(rest.select("bucket", "rep", "c", "n", "odd"), "bucket").where((F.col("pc") != F.col("c")) & _possible(percent))
        new = new.select(F.least("p", "rep").alias("a"), F.greatest("p", "rep").alias("b")).distinct()
        new = saved(new.join(checked, ["a", "b"], "left_anti"))
        likely = _likely(new, sizes, percent, floor)
        links = saved(links.union(_linked(likely, sets_of(likely.select(F.col("a").alias("id")).union(likely.select("b"))), percent)))
        checked = saved(checked.union(new))
        if take >= most:
            joined = components(links)
            n_joined = joined.count()
            break
        pool, take = kept.select("rep", F.col("in.bucket").alias("buckets")), take * 16
    named = reps.join(small(joined, n_joined), F.col("rep") == F.col("id"), "left").select("key", F.coalesce("component", "rep").alias("component"), "rep", "copies")
    named = saved(named.where("copies > 1 or component <> rep").select(F.col("key").alias("k"), "component"))
    out = drawn.join(named, F.col("key") == F.col("k"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
    )
