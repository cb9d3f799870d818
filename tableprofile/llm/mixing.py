"""Mixing sources to target weights: temperature, budgets and block permutations, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.llm.common import saved, small

WORD = r"[^\x20\x09-\x0D]+"
HALVINGS, PER_JOB = 32, 4
BLOCKS = 1024


def source_tokens(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(key, source, tokens): white-space separated words per source; a null source is a source of its own."""
    name = F.col(f"`{source}`").cast("string")
    words = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(_key(name).alias("key"), name.alias("source"), words.alias("w")).groupBy("key", "source").agg(F.sum("w").alias("tokens"))


def _key(name: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), name), F.lit("n"))


def find_exponent(stats: DataFrame, repetition: float | None = None, entropy: float | None = None, budget: float | None = None) -> float:
    """The exponent in 0 .. 1 of the token shares, found by bisection to 2 ** -32.

    With `repetition`: the smallest one (the flattest mixture) at which no source is repeated more
    often than that. With `entropy` (a share of the largest possible one, 0 .. 1): the largest one
    whose weights still reach that entropy. Each job over the sources tries the 15 points of four
    halvings at once; only the sums reach the driver.
    """
    some = stats.where("tokens > 0")
    n, total, least, most = some.agg(F.count("*"), F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    if not n or n == 1:
        return 1.0
    share = F.col("tokens") / F.lit(float(total))
    low, high = 0.0, 1.0

    def flat_enough(a: float, z: float, h: float) -> bool:
        """True if the exponent has to rise."""
        if repetition is not None:
            times = (most / least) ** (1 - a) if budget is None else budget / total / z * max((least / total) ** (a - 1), (most / total) ** (a - 1))
            return times > repetition
        return h / _log(n) >= entropy

    for _ in range(HALVINGS // PER_JOB):
        points = [low + (high - low) * i / 2**PER_JOB for i in range(1, 2**PER_JOB)]
        sums = some.agg(*[F.sum(F.pow(share, F.lit(a))) for a in points], *[F.sum(F.pow(share, F.lit(a)) * F.lit(a) * F.log(share)) for a in points]).first()
        left, right = 0, 2**PER_JOB
        while right - left > 1:
            middle = (left + right) // 2
            z, t = sums[middle - 1], sums[len(points) + middle - 1]
            if flat_enough(points[middle - 1], z, _log(z) - t / z):
                left = middle
            else:
                right = middle
        low, high = low + (high - low) * left / 2**PER_JOB, low + (high - low) * right / 2**PER_JOB
    return high if repetition is not None else low


def _log(x: float) -> float:
    import math

    return math.log(x)


def source_weights(stats: DataFrame, exponent: float, budget: float | None = None) -> DataFrame:
    """stats with share, weight, budget (tokens to draw), epochs (whole passes) and rest (tokens of the last, partial pass).

    Without a budget the mixture is the smallest that holds every source at least once. A source
    without tokens gets weight 0 and one pass.
    """
    some = stats.where("tokens > 0")
    total, most = some.agg(F.sum("tokens"), F.max("tokens")).first()
    z = some.agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(exponent)))).first()[0] or 1.0
    if budget is None:
        budget = float(total or 0) * z * ((most or 1) / (total or 1)) ** (1 - exponent)
    share = F.col("tokens") / F.lit(float(total or 1))
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent)) / F.lit(z)).otherwise(F.lit(0.0))
    out = stats.select("*", share.alias("share"), weight.alias("weight")).withColumn("budget", F.round(F.col("weight") * F.lit(float(budget))).cast("long"))
    passes = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens")).cast("long")).otherwise(F.lit(1).cast("long"))
    return out.withColumn("epochs", passes).withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(F.lit(0).cast("long")))


def _draw(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def mixture(
    docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", repetition: float | None = 1.5, entropy: float | None = None,
    budget: float | None = None, seed: int = 0,
) -> DataFrame:
    """The rows of docs, each as often as the mixture draws it, with `mix`: struct(n_tokens, weight, epoch, block, place).

    The rows of a source lie in 1,024 blocks by a digest of id and text. Every pass permutes the
    blocks of each source anew and the rows within a block: sorting by (epoch, place) gives the
    training order. Whole passes hold every row; of the last pass the blocks in permuted order are
    taken until the budget ends, of the block where it ends the parts (1,024 by another digest), and
    of that part single rows, so no step orders more than 1,024 blocks or a millionth of a source.
    A row is taken if the tokens up to and with it are within the budget.

    A null or wordless text has no tokens and costs nothing; a null source is a source of its own;
    repeated rows are drawn together; an empty table gives no rows. A column of docs called mix is replaced.
    """
    name, body = F.col(f"`{source}`").cast("string"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    stats = saved(source_tokens(docs, source, text))
    weights = saved(source_weights(stats, find_exponent(stats, repetition, entropy, budget), budget).drop("source"))
    digest = _draw(F.lit(str(seed)), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")), F.md5(body.cast("binary")))
    part = F.struct(
        _key(name).alias("key"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("n"), digest.alias("digest"),
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").bitwiseAND(BLOCKS - 1).cast("int").alias("block"),
        F.conv(F.substring(digest, 9, 8), 16, 10).cast("long").bitwiseAND(BLOCKS - 1).cast("int").alias("part"),
    )
    known = small(weights)
    slim = saved(docs.select(part.alias("m")).select("m.*").join(known.select("key", "epochs", "rest").where("rest > 0"), "key"))

    def cut(groups: DataFrame, inside: list[str], order: list[Column]) -> DataFrame:
        """Of (key, .., n, rest): how far the budget reaches, with `left` tokens for the unit where it ends; `whole` units fit."""
        w = Window.partitionBy(*inside).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return groups.withColumn("until", F.sum("n").over(w)).withColumn("whole", F.col("until") <= F.col("rest")).withColumn("left", F.col("rest") - F.col("until") + F.col("n"))

    def turn(*parts: Column) -> Column:
        return _draw(F.lit(str(seed)), F.col("epochs").cast("string"), *parts)

    ends = lambda units: units.where("not whole and left >= 0")
    blocks = saved(cut(slim.groupBy("key", "epochs", "rest", "block").agg(F.sum("n").alias("n")), ["key"], [turn("key", F.col("block").cast("string")), F.col("block")]))
    last = ends(blocks).select("key", "block", F.col("left").alias("r"))
    in_last = saved(slim.join(small(saved(last)), ["key", "block"]).drop("rest").withColumnRenamed("r", "rest"))
    parts = saved(cut(in_last.groupBy("key", "epochs", "rest", "block", "part").agg(F.sum("n").alias("n")), ["key", "block"], [turn("key", F.col("block").cast("string"), F.col("part").cast("string")), F.col("part")]))
    last_part = ends(parts).select("key", "block", "part", F.col("left").alias("r"))
    in_part = in_last.join(small(saved(last_part)), ["key", "block", "part"]).drop("rest").withColumnRenamed("r", "rest")
    rows = in_part.groupBy("key", "epochs", "rest", "block", "part", "digest").agg(F.sum("n").alias("n"))
    rows = cut(rows, ["key", "block", "part"], [turn("digest"), F.col("digest")])
    # What the partial pass takes: whole blocks, whole parts of the block where it ends, single rows of the last part.
    taken = saved(
        blocks.where("whole").select("key", "block", F.lit(-1).alias("part"), F.lit("").alias("digest"))
        .union(parts.where("whole").select("key", "block", "part", F.lit("")))
        .union(rows.where("whole").select("key", "block", "part", "digest"))
    )
    whole_blocks = small(saved(taken.where("part = -1").select("key", "block", F.lit(1).alias("in_block"))))
    some_parts = small(saved(taken.where("part >= 0 and digest = ''").select("key", "block", "part", F.lit(1).alias("in_part"))))
    some_rows = small(saved(taken.where("digest <> ''").select("key", "digest", F.lit(1).alias("in_row"))))
    out = docs.select(F.struct("*").alias("doc"), part.alias("m")).select("doc", "m.*").join(known.select("key", "weight", "epochs"), "key", "left")
    out = out.join(whole_blocks, ["key", "block"], "left").join(some_parts, ["key", "block", "part"], "left").join(some_rows, ["key", "digest"], "left")
    more = F.coalesce("in_block", "in_part", "in_row", F.lit(0))
    out = out.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") + more))).where(F.col("epoch") < F.col("epochs") + more)
    at = F.col("epoch").cast("string")
    place = F.concat(
        F.substring(_draw(F.lit(str(seed)), at, F.col("key"), F.col("block").cast("string")), 1, 16),
        F.substring(_draw(F.lit(str(seed)), at, F.col("key"), F.col("block").cast("string"), F.col("part").cast("string")), 1, 16),
        F.substring(_draw(F.lit(str(seed)), at, F.col("digest")), 1, 16),
    )
    mix = F.struct(F.col("n").alias("n_tokens"), "weight", F.col("epoch").cast("int").alias("epoch"), "block", place.alias("place"))
    return out.select("doc", mix.alias("mix")).select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c != "mix"], "mix")
