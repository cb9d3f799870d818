"""Language identification with bit-sliced Bloom filters over letter trigrams."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tableprofile.llm import textbytes as T
from tableprofile.llm.common import in_small_batches, saved

U = np.uint64
HASHES = 4


@cache
def letters() -> np.ndarray:
    """Per code point whether it is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def trigrams(text: str) -> np.ndarray:
    """One number per letter of the whole text: the letter in lower case and its two neighbours, 0 for the edge of a word."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(letters()[points], points, 0)
    framed = np.zeros(len(points) + 2, U)
    framed[1:-1] = points
    at = np.flatnonzero(points) + 1
    return (framed[at - 1] << U(42)) | (framed[at] << U(21)) | framed[at + 1]


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over (lang, text); a task holds some 4 million letters of all languages, then counts those of the fullest one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: dict[str, list[np.ndarray]] = {}
        held: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            gram, n = np.unique(np.concatenate(pending.pop(lang)), return_counts=True)
            return pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(gram), pa.string()), "gram": gram.view(np.int64), "n": n.astype(np.int64)})

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = trigrams(text)
                pending.setdefault(lang, []).append(found)
                held[lang] = held.get(lang, 0) + len(found)
                if sum(held.values()) > 4_000_000:
                    fullest = max(held, key=held.get)
                    yield flush(fullest)
                    del held[fullest]
        for lang in list(pending):
            yield flush(lang)

    return docs.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """One row of cells for all languages: bit l of a word says that language l put a trigram into the cell."""

    def __init__(self, languages: list[str], cells: np.ndarray, part: int = 0, parts: int = 1) -> None:
        self.languages, self.cells, self.part, self.parts = languages, cells, part, parts
        n = len(cells)
        bits = [(cells[:, i // 64] >> U(i % 64)) & U(1) for i in range(len(languages))]
        self.false = np.array([(b.sum() / n) ** HASHES for b in bits])  # chance that a foreign trigram seems contained

    @staticmethod
    def part_of(grams: np.ndarray, parts: int) -> np.ndarray:
        return (T.draw(grams, 19) % U(parts)).astype(np.int64)

    @staticmethod
    def places(grams: np.ndarray, cells: int) -> list[np.ndarray]:
        return [(T.draw(grams, 11 + i) & U(cells - 1)).astype(np.int64) for i in range(HASHES)]

    def hits(self, text: str | None) -> tuple[int, np.ndarray]:
        """How many trigrams of the text belong to this part, and how many of them each language contains, without the expected false positives."""
        grams = trigrams(text or "")
        if self.parts > 1:
            grams = grams[self.part_of(grams, self.parts) == self.part]
        if not len(grams) or not self.languages:
            return len(grams), np.zeros(len(self.languages))
        masks = None
        for at in self.places(grams, len(self.cells)):
            found = self.cells[at]
            masks = found if masks is None else masks & found
        found = np.array([np.count_nonzero(masks[:, i // 64] & U(1 << (i % 64))) for i in range(len(self.languages))])
        return len(grams), (found - self.false * len(grams)) / np.maximum(1 - self.false, 1e-9)

    def judge(self, text: str | None) -> tuple[str, float]:
        return decided(self.languages, *self.hits(text))


def decided(languages: list[str], n: int, hits: np.ndarray) -> tuple[str, float]:
    """The language with most of the n trigrams, and its share of them; the first by name of equal ones."""
    if not n or not languages:
        return "und", 0.0
    shares = np.clip(hits / n, 0, 1)
    best = int(np.argmax(shares))
    return languages[best], float(shares[best])


def learn(docs: DataFrame, share: float = 0.3, max_cells: int = 1 << 22) -> Iterator[Filters]:
    """Filters from (lang, text) without nulls, in parts by a hash of the trigram.

    A language contains a trigram if its rate there is at least `share` of the highest rate in any
    language. All rows count. A part has 16 cells or more per pair of language and trigram, a power
    of two. Where max_cells words of 64 languages (32 MB) do not suffice there are more parts, made one
    after the other, so that false positives are as rare at every size. Without languages there is
    one empty part. The counts and the choice of trigrams are held on the executors' disks, without
    files in the shared folder, until the last part is made or the generator is closed.
    """
    counts = trigram_counts(docs).persist(StorageLevel.DISK_ONLY)
    try:
        yield from _parts(counts, share, max_cells)
    finally:
        counts.unpersist()


def _parts(counts: DataFrame, share: float, max_cells: int) -> Iterator[Filters]:
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = sorted(r[0] for r in totals.select("lang").collect())
    if not languages:
        yield Filters([], np.zeros((1, 1), U))
        return
    rates = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    best = rates.groupBy("gram").agg(F.collect_list(F.struct("lang", "rate")).alias("all"), F.max("rate").alias("best"))
    kept = best.select("gram", F.explode(F.filter("all", lambda x: x["rate"] >= share * F.col("best"))).alias("x")).select("gram", "x.lang")
    kept = kept.persist(StorageLevel.DISK_ONLY)
    try:
        yield from _made(kept, languages, max_cells)
    finally:
        kept.unpersist()


def _made(kept: DataFrame, languages: list[str], max_cells: int) -> Iterator[Filters]:
    words = -(-len(languages) // 64)
    wanted = max(1 << 12, 1 << int(16 * kept.count()).bit_length())
    cells = min(wanted, max(1 << 12, 1 << (max_cells // words).bit_length() - 1))
    parts = wanted // cells
    number = {lang: i for i, lang in enumerate(languages)}

    def place(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams = b.column(0).to_numpy().view(U)
            lang = np.array([number[x] for x in b.column(1).to_pylist()], np.int64)
            mine = Filters.part_of(grams, parts) == part
            grams, lang = grams[mine], lang[mine]
            at = np.concatenate(Filters.places(grams, cells))
            lang = np.tile(lang, HASHES)
            yield pa.RecordBatch.from_pydict({"cell": at, "word": lang // 64, "mask": (U(1) << (lang % 64).astype(U)).view(np.int64)})

    for part in range(parts):
        made = kept.mapInArrow(lambda b, p=part: place(b, p), "cell long, word long, mask long").groupBy("cell", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
        table = np.zeros((cells, words), U)
        table[made.column("cell").to_numpy(), made.column("word").to_numpy()] = made.column("mask").to_numpy().view(U)
        yield Filters(languages, table, part, parts)


def judged(filters: Filters, text: Column) -> Column:
    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([filters.judge(t) for t in texts], columns=["lang_pred", "score"])

    return judge(text)


def judged_in_parts(docs: DataFrame, text: str, parts: Iterator[Filters]) -> DataFrame:
    """docs with `language`: each part of the filters counts its trigrams of every distinct text in a pass of its own, then the counts are added."""
    spark = docs.sparkSession
    digest = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)
    texts = docs.select(digest.alias("key"), F.col(f"`{text}`").alias("text"))
    schema = "key string, part int, n long, hits array<double>"
    counts, languages = spark.createDataFrame([], schema), []
    for filters in parts:
        languages = filters.languages

        def count(batches: Iterator[pa.RecordBatch], filters: Filters = filters) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [filters.hits(t) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([filters.part] * len(found), pa.int32()), pa.array([n for n, _ in found], pa.int64()), pa.array([h.tolist() for _, h in found], pa.list_(pa.float64()))],
                    names=["key", "part", "n", "hits"],
                )

        counts = counts.union(saved(texts.mapInArrow(count, schema).groupBy("key", "part").agg(F.min("n").alias("n"), F.min("hits").alias("hits"))))

    @F.pandas_udf("lang_pred string, score double")
    def decide(n: pd.Series, hits: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decided(languages, m, np.sum([list(x) for x in h], axis=0)) for m, h in zip(n, hits)], columns=["lang_pred", "score"])

    by_text = counts.groupBy("key").agg(F.sum("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("part", "hits"))), lambda x: x["hits"]).alias("hits"))
    by_text = saved(by_text.select(F.col("key").alias("_key_of_text"), decide("n", "hits").alias("_judged")))
    rows = docs.join(by_text, digest == F.col("_key_of_text"), "left")
    return rows.withColumn("language", F.col("_judged")).drop("_key_of_text", "_judged")


def predicted(docs: DataFrame, learnable: Column, text: str = "text", lang: str = "lang", **settings) -> DataFrame:
    """docs with `language`: struct(lang_pred, score), learnt from the rows where `learnable` holds and text and language are there.

    `und` with score 0 where a text is null or has no letter, or nothing was learnt. Ties go to the
    first language by name. Repeated rows get equal results; an empty table gives no rows; a column
    already called language is replaced. Filters of one part judge the rows as they are read; with
    more parts every part reads the texts once.
    """
    rows = in_small_batches(docs).where(learnable & F.col(f"`{text}`").isNotNull() & F.col(f"`{lang}`").isNotNull())
    parts = learn(rows.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")), **settings)
    first = next(parts)
    if first.parts == 1:
        parts.close()
        return docs.withColumn("language", judged(first, F.col(f"`{text}`")))
    return judged_in_parts(docs, text, itertools.chain([first], parts))
