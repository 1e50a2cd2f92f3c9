"""Quality rules as a short-circuit cascade.

Each rule's cost and the share it rejects are measured on a bounded sample; rules then run in the order of
rejections per cost inside one CASE, which evaluates no further rule for a document once one has rejected it.
The order changes what is computed, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import BLANKS, words

# The characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a boolean column; null counts as not rejected."""

    name: str
    rejects: Column

    def fires(self) -> Column:
        return F.coalesce(self.rejects, F.lit(False))


def with_stats(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and the base figures of every whole text: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Windows of three words are compared by a 64-bit hash within their text. If all differ, nothing repeats;
    else equal windows become neighbours in a sorted array, and the words they cover are summed as the
    distances between consecutive repeated windows, three at most. Each step is a projection of its own, as a
    lambda would work an expression out anew for every element.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text")).select("doc_id", "text", words(F.col("text")).alias("_w"))
    n = F.size("_w")
    spelt = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = base.select("doc_id", "text", "_w", spelt.alias("_lines"))
    hashes = F.transform(
        "_w",
        lambda word, i: F.xxhash64(word, F.get("_w", i + 1), F.get("_w", i + 2)),
    )
    base = base.select(
        "doc_id", "text",
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.slice(hashes, 1, F.greatest(n - 2, F.lit(0)))).otherwise(F.array().cast("array<long>")).alias("_h"),
    )
    base = base.withColumn("_plain", F.size(F.array_distinct("_h")) == F.size("_h"))
    pairs = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    base = base.withColumn("_s", F.when(~F.col("_plain"), pairs))
    same = lambda x, k: F.coalesce(x["h"] == F.get("_s", k + 1)["h"], F.lit(False)) | (
        (k > 0) & (x["h"] == F.get("_s", F.greatest(k - 1, F.lit(0)))["h"])
    )
    base = base.withColumn("_at", F.array_sort(F.transform(F.filter("_s", same), lambda x: x["i"])))
    gaps = F.transform("_at", lambda p, k: F.least(F.coalesce(F.get("_at", k + 1) - p, F.lit(3)), F.lit(3)))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)
    return base.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_h", "_plain", "_s", "_at")


def base_rules(min_words: int = 50, repeat_percent: int = 50) -> list[Rule]:
    """Rules on the figures of ``with_stats`` that define ``base_failed``."""
    return [
        Rule("few_words", F.col("n_words") < min_words),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")),
    ]


def further_rules(
    symbol_percent: int = 10, dup_line_percent: int = 30, max_word_chars: int = 40, shout_percent: int = 60, letter_percent: int = 50
) -> list[Rule]:
    """Rules of the method's own verdict: symbols per word, repeated lines, word length, capitals, letters."""
    chars = F.col("word_chars")
    letters = F.regexp_count("text", F.lit(r"\p{L}"))
    capitals = F.regexp_count("text", F.lit(r"\p{Lu}"))
    return [
        Rule("symbols", 100 * F.col("n_symbols") > symbol_percent * F.col("n_words")),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > dup_line_percent * F.col("n_lines")),
        Rule("long_words", chars > max_word_chars * F.col("n_words")),
        Rule("capitals", 100 * capitals > shout_percent * letters),
        Rule("few_letters", 100 * letters < letter_percent * chars),
    ]


def hash_sample(docs: DataFrame, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` rows of the whole table, drawn by a hash of id and text; twice that at most."""
    share = 2.0 * sample_rows / max(1, docs.count())
    draw = F.xxhash64("doc_id", "text") / F.lit(2.0**64) + 0.5
    # A limit ends in one task; the rows are dealt out again, as measuring them is more work than reading them.
    tasks = docs.sparkSession.sparkContext.defaultParallelism
    return docs.select("doc_id", "text").where(draw < share).limit(2 * sample_rows).repartition(tasks)


def measured_order(rows: DataFrame, rules: list[Rule], repeats: int = 3) -> list[Rule]:
    """Rules by rejections per second of their own work on the sampled ``rows``, best first.

    Each rule is evaluated ``repeats`` times on every row within one job, and the time of the same job without a
    rule is taken off, so what is left is the rule and not the scheduling.
    """
    sample = rows.cache()
    total = sample.count()
    copies = sample.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def seconds(fires: Column) -> tuple[float, int]:
        start = time.perf_counter()
        hit = copies.agg(F.count_if(fires), F.sum("_copy")).first()[0]
        return time.perf_counter() - start, hit

    rates = []
    if total:
        seconds(F.lit(False))
        empty = min(seconds(F.col("_copy") < 0)[0] for _ in range(2))
        for rule in rules:
            took, hit = seconds(rule.fires())
            rates.append((hit / (total * repeats)) / max(took - empty, 1e-6))
    sample.unpersist()
    return [rules[k] for k in sorted(range(len(rules)), key=lambda k: (-rates[k] if rates else 0, k))]


def verdict(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null where none does."""
    if not rules:
        return F.lit(None).cast("string")
    head, *rest = rules
    return reduce(lambda chain, r: chain.when(r.fires(), F.lit(r.name)), rest, F.when(head.fires(), F.lit(head.name)))


def cascade(docs: DataFrame, sample_rows: int = 2_000, rules: list[Rule] | None = None) -> DataFrame:
    """One row per document: ``doc_id``, the base figures, ``base_failed, rejected_by, kept``.

    A null or empty text has no words and fails the base. The base rules stand first, so that ``base_failed``
    costs nothing more; the others follow in the measured order. Rows that repeat are judged alike; an empty
    table gives no rows; further columns are not looked at.
    """
    stats = with_stats(docs)
    first = base_rules()
    failed = reduce(lambda a, b: a | b, [r.fires() for r in first])
    others = measured_order(with_stats(hash_sample(docs, sample_rows)), rules or further_rules())
    judged = stats.withColumns({"base_failed": failed, "rejected_by": verdict([*first, *others])})
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by",
        F.col("rejected_by").isNull().alias("kept"),
    )
