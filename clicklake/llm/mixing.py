"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, scaled by its quality weight. Documents of a source are taken in key
order until their sizes fill the source's budget; where the budget is larger than the source, whole epochs
come first and only the rest is drawn. No task sorts a whole source: keys are cut into cells, the sizes of the
cells are summed in order, and documents are ordered within their cell only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import words
from clicklake.session import stored

MAX_EPOCHS = 3
_SOURCE = ["no_source", "source_name"]


def word_variety(text: Column) -> Column:
    """Quality weight of a text: the share of its words that differ, at least 0.05; 1 without words."""
    found = words(text)
    share = F.size(F.array_distinct(found)) / F.size(found)
    return F.when(F.size(found) == 0, F.lit(1.0)).otherwise(F.greatest(share, F.lit(0.05)))


def draw(doc_id: Column, text_digest: Column, copy: Column, seed: str) -> Column:
    """Uniform number in (0, 1] of a document: its id, its text and which of the rows with both it is. Reruns agree."""
    name = [F.coalesce(doc_id.cast("string"), F.lit("")), copy.cast("string"), text_digest, F.lit(seed)]
    digest = F.md5(F.concat_ws(":", *name).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1) / F.lit(float(2**52))


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``copy``: rows with one ``mark`` are numbered from 1, all others are 1.

    Rows that repeat are told apart by ``salt``, which must be stored with them: they are counted per salt, the
    counts summed over salts, and only rows of one salt numbered together, so no repeated row is one task's.
    """
    per_salt = rows.groupBy("mark", "salt").agg(F.count(F.lit(1)).alias("n"))
    repeated = per_salt.groupBy("mark").agg(F.sum("n").alias("all")).where("all > 1").select("mark")
    before = F.sum("n").over(Window.partitionBy("mark").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_salt.join(repeated, "mark", "left_semi").select("mark", "salt", F.coalesce(before, F.lit(0)).alias("offset"))
    offsets = stored(offsets, "mix-copies")
    once = rows.join(offsets.select("mark").distinct(), "mark", "left_anti").withColumn("copy", F.lit(1).cast("long"))
    place = F.row_number().over(Window.partitionBy("mark", "salt").orderBy(F.lit(0)))
    again = rows.join(offsets, ["mark", "salt"]).withColumn("copy", F.col("offset") + place).drop("offset")
    return once.unionByName(again)


def targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to one row per source with ``source_size``.

    Sources in code point order, null last, weigh ``weights``, repeating, and share the size of all. A target
    stops at ``max_epochs`` times its source; the excess goes to the others by weight until none is above.
    The result is a level times the weight below the cap, and sources reach their cap in the order of cap
    per weight, so one ordered pass over the sources finds the level.
    """
    by_name = Window.orderBy(*_SOURCE)
    by_cap = Window.orderBy("cap_per_weight", *_SOURCE)
    earlier, later = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cycle = F.array(*map(F.lit, weights))
    ranked = totals.withColumns({
        "weight": F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")),
        "cap": F.col("source_size") * max_epochs,
    }).withColumn("cap_per_weight", F.col("cap") / F.col("weight"))
    levelled = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
        / F.sum("weight").over(later),
    )
    fits = F.when(F.col("level") <= F.col("cap_per_weight"), F.struct("cap_per_weight", *_SOURCE, "level"))
    level = F.coalesce(F.min(fits).over(everything)["level"], F.lit(0.0))
    return levelled.select(
        *_SOURCE, "source_size", F.least(level * F.col("weight"), F.col("cap").cast("double")).alias("target")
    )


def weight_quantiles(sized: DataFrame) -> tuple[int, list[float]]:
    """Number of rows, and 16 quantiles of their weights: all that reaches the driver."""
    spots = F.array(*[F.lit((2 * k + 1) / 32) for k in range(16)])
    n_rows, quantiles = sized.agg(F.count(F.lit(1)), F.percentile_approx("weight", spots)).first()
    return n_rows, quantiles or []


def cell_of(n_rows: int, quantiles: list[float], rows_per_cell: int) -> Column:
    """Cell of a key: a rising function of it that deals rows about evenly.

    A key above t has the probability of the mean of exp(-weight * t) over the documents; quantiles of the
    weights stand for them.
    """
    if not n_rows:
        return F.lit(0).cast("long")
    above = sum((F.exp(-F.col("key") * w) for w in quantiles), F.lit(0.0)) / len(quantiles)
    n_cells = max(1, math.ceil(n_rows / rows_per_cell))
    return F.least(F.floor((1 - above) * n_cells), F.lit(n_cells - 1)).cast("long")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    seed: str = "mix",
    quality: Column | None = None,
    rows_per_cell: int = 2_000,
    carry: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``size`` counts words; null and empty texts have none, are drawn like others and take nothing. ``copies``
    is how often the mix repeats the document, at most three times; ``taken`` is ``copies`` times ``size``.
    The document that crosses the budget is taken if that brings the source nearer to its target. ``quality``
    is a positive weight per document (default: variety of its words); null weighs 1. A null source is a source
    of its own. Every row is a document with a key of its own: rows without an id differ by their text, and rows that
    repeat by their number; equal keys fall back on id and size, after which rows no longer differ. An empty table gives no rows; further columns are not looked at, and ``carry`` returns
    the whole document as ``row``.
    """
    whole = [F.struct(*docs.columns).alias("row")] if carry else []
    weight = F.coalesce(word_variety(F.col("text")) if quality is None else quality, F.lit(1.0))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_name"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest"),
        weight.alias("weight"),
        (F.monotonically_increasing_id() % 1024).alias("salt"),
        *whole,
    )
    sized = sized.withColumn("mark", F.xxhash64("doc_id", F.col("doc_id").isNull(), *_SOURCE, "digest"))
    sized = stored(sized, "mix-sizes")
    n_rows, quantiles = weight_quantiles(sized)
    sized = numbered(sized)
    sized = sized.withColumn("key", -F.log(draw(F.col("doc_id"), F.col("digest"), F.col("copy"), seed)) / F.col("weight"))
    sized = sized.withColumn("cell", cell_of(n_rows, quantiles, rows_per_cell))

    budgets = targets(sized.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size")), weights)
    in_order = Window.partitionBy(*_SOURCE).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = sized.groupBy(*_SOURCE, "cell").agg(F.sum("size").alias("cell_size"))
    cells = cells.withColumn("before", F.coalesce(F.sum("cell_size").over(in_order), F.lit(0))).drop("cell_size")
    cells = cells.join(budgets, _SOURCE)

    within = Window.partitionBy(*_SOURCE, "cell").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
    through = F.col("before") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    placed = sized.join(cells, [*_SOURCE, "cell"]).withColumns({"through": through, "epochs": epochs.cast("long")})
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    drawn = (2 * F.col("through") - F.col("size") <= 2 * rest) & (rest > 0)
    copies = F.col("epochs") + drawn.cast("long")
    return placed.select(
        "doc_id",
        F.when(~F.col("no_source"), F.col("source_name")).alias("source"),
        "size", "source_size", "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        *(["row"] if carry else []),
    )


def repeated(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix") -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with their own columns."""
    taken = mix(docs, weights, seed, carry=True).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
