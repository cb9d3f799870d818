"""Quality rules: counts of symbols, lines and repeats, and the perplexity under a modified Kneser-Ney model of the own language."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.llm import textbytes as T
from tableprofile.llm.common import in_small_batches, saved, values

U = np.uint64
ORDER = 4
#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
#: Used where the counts of counts do not give discounts for n-grams seen once, twice and more often.
FALLBACK = (0.5, 1.0, 1.5)
#: Bits per symbol are compared in steps of 1 / STEPS.
STEPS = 1024
UNITS = 1 << 16

_symbol = np.zeros(256, bool)
_symbol[list(SYMBOLS)] = True
_fold = np.arange(1 << 16, dtype=U)
_fold[65:91] += U(32)  # A-Z
_fold[48:58] = U(48)  # digits
_fold[0] = U(0xFFFF)  # 0 stands for what lies before a text


def base_counts(data: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    start, end = T.words(data)
    n = len(start)
    white = T.WHITE[data]
    chars = int(np.count_nonzero(~white & ((data & 0xC0) != 0x80)))
    lines, dup = set(), 0
    for line in data.tobytes().split(b"\n"):
        if line in lines:
            dup += 1
        elif line.strip(b"\x20\x09\x0a\x0b\x0c\x0d"):
            lines.add(line)
    repeated = 0
    if n >= WINDOW:
        words = T.word_hashes(data, T.CODES)
        windows = np.zeros(n - WINDOW + 1, U)
        for i in range(WINDOW):
            windows = windows * U(0x9E3779B97F4A7C15) + words[i : n - WINDOW + 1 + i]
        ordered = np.sort(T.mix(windows))
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(again):
            found = np.flatnonzero(np.isin(T.mix(windows), again))
            covered = np.zeros(n, bool)
            for i in range(WINDOW):
                covered[found + i] = True
            repeated = int(covered.sum())
    return n, chars, int(_symbol[data].sum()), dup, repeated


def symbols(data: np.ndarray) -> np.ndarray:
    """The text as the model sees it: every word and one space behind it, as 16-bit numbers.

    A-Z in lower case, all digits alike, characters from U+FFFF on alike.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    white = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    keep = np.ones(len(points) + 1, bool)
    keep[:-1] = ~white
    after = keep.copy()
    keep[1:] |= after[:-1]
    keep[0] = len(points) > 0 and after[0]
    keep[-1] = len(points) > 0 and after[-2]
    out = np.full(len(points) + 1, 0x20, U)
    out[:-1] = np.where(white, U(0x20), _fold[np.minimum(points, 0xFFFF)])
    return out[keep]


def grams(text: np.ndarray) -> np.ndarray:
    """One 64-bit number per symbol: the symbol and the three before it, 0 before the text."""
    framed = np.zeros(len(text) + ORDER - 1, U)
    framed[ORDER - 1 :] = text
    out = framed[: len(text)].copy()
    for i in range(1, ORDER):
        out = (out << U(16)) | framed[i : len(text) + i]
    return out


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and where each begins."""
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    at = np.flatnonzero(first)
    return ordered[at], at


def gram_counts(docs: DataFrame, pending: int = 1 << 20, held: int = 1 << 21) -> DataFrame:
    """(lang, gram, n) over (lang, text binary): all texts, whole; a task merges its counts and sends them once, or each time it holds `held` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: dict[str, list[np.ndarray]] = {}
        merged: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting = 0

        def merge() -> None:
            for lang, parts in raw.items():
                ordered = np.sort(np.concatenate(parts))
                keys, at = _runs(ordered)
                n = np.diff(np.append(at, len(ordered)))
                if lang in merged:
                    keys, n = np.concatenate([merged[lang][0], keys]), np.concatenate([merged[lang][1], n])
                    order = np.argsort(keys, kind="stable")
                    keys, at = _runs(keys[order])
                    n = np.add.reduceat(n[order], at)
                merged[lang] = keys, n
            raw.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (keys, n) in merged.items():
                for at in range(0, len(keys), 100_000):
                    part = keys[at : at + 100_000]
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(part), pa.string()), "gram": part.view(np.int64), "n": n[at : at + 100_000]})
            merged.clear()

        for b in batches:
            for lang, data in zip(b.column(0).to_pylist(), values(b.column(1))):
                found = grams(symbols(data))
                if len(found):
                    raw.setdefault(lang, []).append(found)
                    waiting += len(found)
                if waiting > pending:
                    merge()
                    waiting = 0
                    if sum(len(k) for k, _ in merged.values()) > held:
                        yield from flush()
        merge()
        yield from flush()

    return docs.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("c"))


def _discounts(c: Column) -> Column:
    """Array of the three discounts of an order from how many of its n-grams have a count of 1, 2, 3 and 4."""
    n = [F.count_if(c == i).cast("double") for i in range(1, 5)]
    y = F.try_divide(n[0], n[0] + 2 * n[1])
    d = [i - (i + 1) * y * F.try_divide(n[i], n[i - 1]) for i in range(1, 4)]
    good = (n[0] > 0) & (n[1] > 0) & (n[2] > 0) & (n[3] > 0)
    for i in range(3):
        good &= (d[i] > 0) & (d[i] < i + 1)
    return F.when(good, F.array(*d)).otherwise(F.array(*map(F.lit, FALLBACK)))


def _mask(n: int) -> int:
    return (1 << (16 * n)) - 1


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, kind, gram, value) of the interpolated modified Kneser-Ney model of order 4 for every language.

    counts: (lang, gram, c) of the highest order. Lower orders count how many different symbols stand
    before an n-gram. kind 1 to 4: log2 probability of the last symbol of n-grams of that length;
    5, 6, 7: log2 of the share that a context of 1, 2, 3 symbols leaves to the lower order; 0: log2
    probability of a symbol that a language does not have.
    """
    tables = {ORDER: counts.select("lang", "gram", "c")}
    for n in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(_mask(n)) if n < ORDER else F.col("gram")
        tables[n] = saved(tables[n + 1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("c")))
    model, lower = [], None
    for n in range(1, ORDER + 1):
        # One row per language.
        discounts = saved(tables[n].groupBy("lang").agg(_discounts(F.col("c")).alias("d"), F.count("*").alias("v")))
        rows = tables[n].join(F.broadcast(discounts), "lang")
        # A context has at most 65,536 symbols behind it.
        w = Window.partitionBy("lang", F.shiftrightunsigned("gram", 16) if n > 1 else F.lit(0))
        d = F.get("d", F.least("c", F.lit(3)).cast("int") - 1)
        rows = rows.select(
            "lang", "gram", "v", ((F.col("c") - d) / F.sum("c").over(w)).alias("own"), (F.sum(d).over(w) / F.sum("c").over(w)).alias("left"),
        )
        if n == 1:
            rows = rows.withColumn("p", F.col("own") + F.col("left") / (F.col("v") + 1))
            first = rows.groupBy("lang").agg(F.max(F.col("left") / (F.col("v") + 1)).alias("p"))
            model.append(first.select("lang", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("gram"), F.log2("p").alias("value")))
        else:
            low = lower.select(F.col("lang").alias("l"), F.col("gram").alias("g"), F.col("p").alias("q"))
            rows = rows.join(low, (F.col("lang") == F.col("l")) & (F.col("gram").bitwiseAND(_mask(n - 1)) == F.col("g"))).withColumn("p", F.col("own") + F.col("left") * F.col("q"))
            context = F.shiftrightunsigned("gram", 16)
            model.append(rows.groupBy("lang", context.alias("gram")).agg(F.max("left").alias("left")).select("lang", F.lit(ORDER + n - 1).alias("kind"), "gram", F.log2("left").alias("value")))
        lower = saved(rows.select("lang", "gram", "p", "left"))
        model.append(lower.select("lang", F.lit(n).alias("kind"), "gram", F.log2("p").alias("value")))
    out = model[0]
    for more in model[1:]:
        out = out.unionByName(more)
    return out


def _unit(lang: Column, before: Column) -> Column:
    """One of 65,536 units by language and the symbol before the predicted one: all a prediction looks up lies in its unit."""
    return F.pmod(before * 40503 + F.crc32(F.encode(lang, "UTF-8")), F.lit(UNITS))


@dataclass(frozen=True)
class Model:
    """The part of a model for some units: per language sorted hashes of (kind, n-gram) with their values."""

    tables: dict[str, tuple[np.ndarray, np.ndarray]]
    part: int
    parts_of_units: np.ndarray

    @staticmethod
    def hashes(kind: int, keys: np.ndarray) -> np.ndarray:
        return T.draw(keys, 100 + kind)

    def value(self, table: tuple[np.ndarray, np.ndarray], kind: int, keys: np.ndarray) -> np.ndarray:
        """The values of n-grams, NaN where there are none."""
        wanted = self.hashes(kind, keys)
        at = np.minimum(np.searchsorted(table[0], wanted), len(table[0]) - 1)
        return np.where(table[0][at] == wanted, table[1][at], np.nan)

    def log2(self, lang: str, keys: np.ndarray) -> float:
        """Sum of log2 probabilities of the last symbols of n-grams of the highest order, as far as their units belong to this part."""
        table = self.tables.get(lang)
        if self.parts_of_units.max() > 0:
            unit = (((keys >> U(16)) & U(0xFFFF)) * U(40503) + U(zlib.crc32(lang.encode()))) % U(UNITS)
            keys = keys[self.parts_of_units[unit] == self.part]
        if table is None or not len(keys):
            return 0.0
        ordered = np.sort(keys)
        open_, at = _runs(ordered)
        times = np.diff(np.append(at, len(ordered)))
        total = 0.0
        for n in range(ORDER, 0, -1):
            open_ = open_ & U(_mask(n))
            found = self.value(table, n, open_)
            seen = ~np.isnan(found)
            total += float((found[seen] * times[seen]).sum())
            open_, times = open_[~seen], times[~seen]
            if not len(open_):
                return total
            if n > 1:  # a context that was never seen leaves all to the lower order
                total += float((np.nan_to_num(self.value(table, ORDER + n - 1, open_ >> U(16))) * times).sum())
        return total + float(self.value(table, 0, np.zeros(1, U))[0] * times.sum())


def model_parts(entries: DataFrame, max_entries: int) -> Iterator[Model]:
    """The model in parts of at most max_entries entries, as far as a single unit does not have more, one at a time.

    The number of entries per unit, at most 65,536 numbers, decides which units make up a part. What
    does not belong to a unit, a language's symbols, is in every part.
    """
    last = F.when(F.col("kind") > ORDER, F.col("gram")).otherwise(F.shiftrightunsigned("gram", 16)).bitwiseAND(0xFFFF)
    placed = saved(entries.withColumn("unit", F.when(F.col("kind") > 1, _unit(F.col("lang"), last))))
    sizes = np.zeros(UNITS, np.int64)
    for unit, n in placed.where("unit is not null").groupBy("unit").count().collect():
        sizes[unit] = n
    parts = np.zeros(UNITS, np.int64)
    part = held = 0
    for unit in np.flatnonzero(sizes):
        if held and held + sizes[unit] > max_entries:
            part, held = part + 1, 0
        parts[unit], held = part, held + sizes[unit]
    for i in range(part + 1):
        units = F.array(*[F.lit(int(p == i)) for p in parts]) if part else None
        mine = placed.where(F.col("unit").isNull() | (F.get(units, F.col("unit").cast("int")) == 1)) if part else placed
        rows = mine.select("lang", "kind", "gram", "value").toArrow()
        tables = {}
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        kind, gram, value = (rows.column(c).to_numpy() for c in ("kind", "gram", "value"))
        hashes = np.zeros(len(gram), U)
        for k in range(2 * ORDER):
            hashes[kind == k] = Model.hashes(k, gram[kind == k].view(U))
        for j, name in enumerate(names):
            h, v = hashes[lang == j], value[lang == j]
            order = np.argsort(h)
            tables[name] = h[order], v[order]
        yield Model(tables, i, parts)


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """Per row of (id, lang, text binary): counts of the base rules, symbols and the sum of log2 probabilities of this part of the model."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, n, total, digests = [], [], [], []
            for lang, data in zip(b.column(1).to_pylist(), values(b.column(2))):
                seen = symbols(data)
                found.append(base_counts(data) if model.part == 0 else (0,) * 5)
                n.append(len(seen))
                total.append(model.log2(lang, grams(seen)))
                digests.append(hashlib.blake2b(data.tobytes(), digest_size=16).digest())
            counts = zip(*found) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(digests, pa.binary()), *(pa.array(c, pa.int64()) for c in counts), pa.array(n, pa.int64()), pa.array(total, pa.float64())],
                names=["id", "lang", "digest", *COUNTS, "n_scored", "log2"],
            )

    return rows.mapInArrow(score, "id long, lang string, digest binary, " + ", ".join(f"{c} long" for c in COUNTS) + ", n_scored long, log2 double")


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _middle(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(l, name): the smallest value that at least half of the n rows of a language do not exceed; rows: (lang, value, n), one per step."""
    counted = rows.groupBy("lang", value).agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(value)
    placed = counted.withColumn("until", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    return placed.where(2 * F.col("until") >= F.col("all")).groupBy(F.col("lang").alias("l")).agg(F.min(value).alias(name))


def bands(scored: DataFrame, below: float, above: float, least: int) -> DataFrame:
    """(l, low, high): the band of steps of each language around its median, `below` and `above` median deviations wide, `least` steps at least.

    scored: (lang, step). Counts per step are all that is gathered: at most some 65,000 rows a language.
    """
    steps = saved(scored.groupBy("lang", "step").agg(F.count("*").alias("n")))
    middle = saved(_middle(steps, "step", "mid"))
    away = steps.join(F.broadcast(middle), F.col("lang") == F.col("l")).withColumn("away", F.abs(F.col("step") - F.col("mid")))
    spread = _middle(away.drop("l"), "away", "spread").withColumnRenamed("l", "k")
    return middle.join(spread, F.col("l") == F.col("k")).select(
        "l", (F.col("mid") - F.greatest(F.ceil(F.col("spread") * below), F.lit(least))).alias("low"), (F.col("mid") + F.greatest(F.ceil(F.col("spread") * above), F.lit(least))).alias("high"),
    )


def quality_rules(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", below: float = 12.0, above: float = 12.0, least: int = 512, max_entries: int = 1 << 21,
) -> DataFrame:
    """Counts and verdict of every document.

    Words are runs without white space. Returns doc_id, n_words, word_chars (code points in words),
    n_symbols, n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words in
    3-word windows found twice or more), base_failed (under 50 words, or more than half of the words
    in such windows), bits (per symbol, under the model of the document's language), kept.

    The model of each language is counted over all its documents. A document that passes the base
    rules is kept if its bits per symbol (log2 of its perplexity) lie in the band of its language:
    the median of those documents, `below` and `above` median deviations on either side, at least
    `least` / 1,024 bits.

    The model goes to the tasks in parts of bounded size, and the texts are read once per part; they
    are never shuffled. Documents without a language share one model. A null or empty text has no
    words and fails the base rules; repeated rows get equal results; rows without an id are judged
    like any other; an empty table gives no rows; other columns are not read.
    """
    rows = in_small_batches(docs).select(
        F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("lang"), F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8").alias("text"),
    )
    counts = saved(gram_counts(rows.select("lang", "text")))
    whole = None
    for model in model_parts(kneser_ney(counts), max_entries):
        part = saved(_scored(rows, model))
        if whole is None:
            whole = part
            continue
        more = part.groupBy(F.col("id").alias("i"), F.col("lang").alias("l"), F.col("digest").alias("d")).agg(F.max("log2").alias("more"))
        joined = whole.join(more, F.col("id").eqNullSafe(F.col("i")) & (F.col("lang") == F.col("l")) & (F.col("digest") == F.col("d")))
        whole = saved(joined.withColumn("log2", F.col("log2") + F.col("more")).drop("i", "l", "d", "more"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    bits = F.try_divide(-F.col("log2"), F.col("n_scored"))
    judged = whole.withColumn("base_failed", failed).withColumn("bits", bits).withColumn("step", F.floor(bits * STEPS))
    # One row per language.
    limits = saved(bands(judged.where("not base_failed").select("lang", "step"), below, above, least))
    kept = ~F.col("base_failed") & F.coalesce(F.col("step").between(F.col("low"), F.col("high")), F.lit(False))
    out = judged.join(F.broadcast(limits), F.col("lang") == F.col("l"), "left")
    return out.select(F.col("id").alias("doc_id"), *COUNTS, "base_failed", F.col("bits"), kept.alias("kept"))
