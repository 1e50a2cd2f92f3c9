"""Chat formatting in budgeted windows.

Prefix sums of turn tokens cut a conversation into spans of whole turns. Every window holds the system turn,
a limited history of the span before it and its own span; the loss mask covers the assistant turns of its own
span only, so each target counts once however often windows repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake.session import stored

# A conversation by two columns that are never null, so that plain joins find the one without an id as well.
_CONV = ["no_conv", "conv"]

# Marks of the template, and what follows < or [ in the control strings that texts may not hold.
OPEN, MIDDLE, CLOSE = "<s>", "<|>", "</s>"
_TAILS = r"(/?s>|\|>|/?<?/?SYS>>|/?INST\])"
_PLAIN, _ESCAPED = rf"([<\[])(\\*){_TAILS}", rf"([<\[])\\(\\*){_TAILS}"


def escape(text: Column) -> Column:
    """Control strings get a backslash after their first character; those that have some already, one more."""
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The text before ``escape``."""
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def count_tokens(text: Column) -> Column:
    """Estimate by runs of letters or digits and single other signs."""
    return F.regexp_count(text, F.lit(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"))


def _render(turns: Column) -> Column:
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), ""
    )


def _earlier(order: str, *within: str):
    """Window over what is earlier in the conversation (in a block of it)."""
    return Window.partitionBy(*_CONV, *within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _before(column: str | Column, order: str, *within: str) -> Column:
    return F.coalesce(F.sum(column).over(_earlier(order, *within)), F.lit(0))


def _dealt(turns: DataFrame) -> DataFrame:
    """Turns in ranges, numbered: ``at`` has the range in its upper bits (``block``) and the place there in the lower 33."""
    ordered = ["no_conv", "conv", "turn", "role", "text"]
    dealt = turns.repartitionByRange(*ordered).sortWithinPartitions(*ordered).withColumn("at", F.monotonically_increasing_id())
    # Storing it fixes the numbers.
    return stored(dealt.drop("turn"), "chat-turns").withColumn("block", F.shiftright("at", 33))


def _homes(dealt: DataFrame, step: int, history: int) -> DataFrame:
    """Per conversation and block in which spans of it begin (``home``): ``before`` tokens and ``windows_before`` it,
    ``begins`` (the first turn that does not belong to an earlier home), ``next_home`` and ``tail`` (the first turn of the
    history it repeats). No text is read.
    """
    turns = dealt.select(*_CONV, "block", "at", "tokens")
    sums = turns.groupBy(*_CONV, "block").agg(F.sum("tokens").alias("sum"))
    sums = sums.select(*_CONV, "block", _before("sum", "block").alias("offset"))
    turns = turns.withColumn("inside", _before("tokens", "at", "block")).join(sums, [*_CONV, "block"])
    turns = turns.withColumn("start", F.col("offset") + F.col("inside")).withColumn("span", F.floor(F.col("start") / step))
    end = F.max(F.col("start") + F.col("tokens")).over(Window.partitionBy(*_CONV, "span"))
    spans = turns.withColumn("end", end).groupBy(*_CONV, "span").agg(
        F.min("at").alias("begins"), F.min("start").alias("start"),
        F.min(F.when(F.col("end") - F.col("start") <= history, F.col("at"))).alias("tail"),
    )
    homes = spans.groupBy(*_CONV, F.shiftright("begins", 33).alias("home")).agg(
        F.min("begins").alias("begins"), F.min("start").alias("before"), F.count(F.lit(1)).alias("n"), F.max_by("tail", "span").alias("tail"),
    )
    following = F.lead("home").over(Window.partitionBy(*_CONV).orderBy("home"))
    return stored(homes.withColumns({"windows_before": _before("n", "home"), "next_home": following}), "chat-homes")


def _sent_home(dealt: DataFrame, homes: DataFrame) -> DataFrame:
    """Turns with their ``home``, and once more (``own`` 0) those that the next home repeats as history."""
    pairs = dealt.groupBy(*_CONV, "block").agg(F.min("at").alias("least"), F.max("at").alias("most"))
    pairs = pairs.join(homes.select(*_CONV, F.col("home").alias("block"), F.col("home"), "begins"), [*_CONV, "block"], "left")
    pairs = pairs.withColumn("earlier_home", F.last("home", ignorenulls=True).over(_earlier("block")))
    # Only the first conversation of a range can come from an earlier one, only the last can go on: a row per range.
    moved = pairs.where("begins IS NULL OR begins > least").select("block", F.coalesce("begins", F.col("most") + 1).alias("until"), "earlier_home")
    repeated = homes.where("next_home IS NOT NULL").select("home", "tail", "next_home")
    home = F.when(F.col("at") < F.col("until"), F.col("earlier_home")).otherwise(F.col("block"))
    turns = dealt.join(F.broadcast(moved), "block", "left").withColumn("home", home).join(F.broadcast(repeated), "home", "left")
    own = F.struct("home", F.lit(1).alias("own"))
    again = F.struct(F.col("next_home").alias("home"), F.lit(0).alias("own"))
    places = F.when(F.col("at") >= F.col("tail"), F.array(own, again)).otherwise(F.array(own))
    return turns.select("conv_id", *_CONV, "role", "text", "tokens", "at", F.inline(places))


def windows(conversations: DataFrame, budget: int = 1024, history: int = 256) -> DataFrame:
    """One row per window: ``conv_id, window, n_repeated, formatted, loss_spans``.

    ``window`` numbers the windows of a conversation from 0, ``n_repeated`` turns at its front repeat earlier
    ones, ``loss_spans`` are (start, length) in code points of ``formatted``, from 0. A span begins in its own
    multiple of ``budget - history`` tokens; its last turn may go past it, and a turn is never cut. History
    turns fit ``history`` tokens. A conversation's first turn is repeated if its role is system.

    Turns are ordered by number, null first, ties by role and text; repeated rows are turns of their own, and lie in
    one range. Null texts and roles count as empty, a null conv_id is a conversation of its own. An empty table gives
    no rows; further columns are not looked at.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be smaller than the budget")
    step = budget - history
    turns = conversations.select(
        "conv_id", "turn",
        F.col("conv_id").isNull().alias("no_conv"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        escape(F.coalesce("role", F.lit(""))).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
        (count_tokens(F.coalesce("text", F.lit(""))) + 4).cast("long").alias("tokens"),
    )
    dealt = _dealt(turns)
    homes = _homes(dealt, step, history)
    opening = F.struct("at", "role", F.when(F.col("role") == "system", F.col("text")).alias("text"))
    first = dealt.groupBy(*_CONV).agg(F.min_by(opening, "at").alias("first_turn"))
    homes_with_first = homes.select(*_CONV, "home", "before", "windows_before").join(first, _CONV)
    rows = _sent_home(dealt, homes).join(homes_with_first, [*_CONV, "home"])
    # History comes first in the order of turns, counts nothing, and so falls to the first span of its home.
    start = F.col("before") + _before(F.col("tokens") * F.col("own"), "at", "home")
    rows = rows.withColumn("start", start).withColumn("span", F.floor(F.col("start") / step))
    turn = F.struct("at", "own", "start", "role", "text")
    spans = rows.groupBy("conv_id", *_CONV, "home", "span").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"), F.first("first_turn").alias("first_turn"),
        F.first("windows_before").alias("windows_before"),
    )
    spans = spans.withColumns({
        "own": F.filter("turns", lambda t: t["own"] == 1), "sent": F.filter("turns", lambda t: t["own"] == 0),
    })
    in_home = Window.partitionBy(*_CONV, "home").orderBy("span")
    spans = spans.select(
        "conv_id", "own", "sent", "first_turn",
        (F.col("windows_before") + F.row_number().over(in_home) - 1).alias("window"), F.lag("own").over(in_home).alias("prior"),
    )
    system = F.col("first_turn")["role"] == "system"
    near = F.filter("prior", lambda t: F.col("own")[0]["start"] - t["start"] <= history)
    recent = F.filter(F.coalesce(near, "sent"), lambda t: ~(system & (t["at"] == F.col("first_turn")["at"])))
    said = lambda turns: F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    repeats_first = (F.col("window") > 0) & system
    again = F.concat(said(F.when(repeats_first, F.array("first_turn")).otherwise(F.slice(F.array("first_turn"), 1, 0))), said(recent))
    spans = spans.withColumn("again", again).select("conv_id", "window", "again", said("own").alias("own"))
    spans = spans.withColumn("front", _render(F.col("again")))
    # Place of each own text: marks and roles before it, summed in one fold over the turns.
    fixed, tail = len(OPEN) + len(MIDDLE), len(CLOSE)
    sizes = F.transform(
        "own", lambda t: F.struct((F.length(t["role"]) + fixed).alias("head"), F.length(t["text"]).alias("body"))
    )
    spans = spans.withColumn("sizes", sizes)
    at = F.aggregate(
        "sizes",
        F.struct(F.length("front").alias("end"), F.array().cast("array<int>").alias("starts")),
        lambda acc, s: F.struct(
            (acc["end"] + s["head"] + s["body"] + tail).alias("end"),
            F.concat(acc["starts"], F.array(acc["end"] + s["head"])).alias("starts"),
        ),
    )["starts"]
    spans = spans.withColumn("starts", at)
    spots = F.transform(
        "own",
        lambda t, i: F.struct(
            t["role"].alias("role"), F.get("starts", i).alias("start"), F.length(t["text"]).alias("length")
        ),
    )
    targets = F.filter(spots, lambda x: x["role"] == "assistant")
    return spans.select(
        "conv_id", "window",
        F.size("again").alias("n_repeated"),
        F.concat("front", _render(F.col("own"))).alias("formatted"),
        F.transform(targets, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Turns of a formatted window, in order, as (role, text) before escaping."""
    pieces = F.slice(F.split(formatted, OPEN), 2, F.size(F.split(formatted, OPEN)))
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(p, MIDDLE, 1)).alias("role"),
            unescape(p.substr(F.instr(p, MIDDLE) + len(MIDDLE), F.length(p) - F.instr(p, MIDDLE) - len(MIDDLE) + 1 - len(CLOSE))).alias("text"),
        ),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the windows alone: turns, loss text and sizes."""
    per_window = formatted.select("conv_id", "window", "n_repeated", "formatted", "loss_spans", read_turns(F.col("formatted")).alias("turns"))
    per_window = per_window.withColumn("turns", F.slice("turns", F.col("n_repeated") + 1, F.size("turns")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(
        F.transform("loss_spans", lambda s: unescape(F.col("formatted").substr(s["start"] + 1, s["length"]))), ""
    )
    parts = per_window.select(
        "conv_id", F.size("turns").alias("n"), F.length("formatted").alias("chars"),
        F.struct("window", said.alias("said"), loss.alias("loss")).alias("part"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list("part")).alias("parts")
    )
    joined = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    whole = whole.select("conv_id", "n_turns", "formatted_chars", joined("said").alias("said"), joined("loss").alias("loss"))
    return whole.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
