"""Cumulative snapshots of conversations collapsed, and what is left rendered. DataFrame functions only.

A log that stores a conversation after every turn holds each of its prefixes as a conversation of its own. Every turn gets a
fingerprint of the turns up to and with it (two 64-bit hashes of position, role and text, exclusive-or over the prefix). A
conversation whose last fingerprint is that of an inner turn of a longer one is a snapshot of it and goes by an anti-join;
of equal ones that with the smallest id stays. The others are maximal, and rendered.

Running values over a conversation are taken in two steps, within runs of ``RUN`` turn numbers and over the runs, so that a
conversation with a large share of all rows is spread over tasks; for the same reason a conversation whose rendering is
longer than ``PART_CHARS`` is rendered in several parts, cut between turns.

Defined cases: rows that repeat id, turn, role and text are one; different rows under one turn number follow each other by
role and text; null and empty texts are turns without text, and different; a null role renders as "unknown"; rows with a
null id are one conversation, a null turn comes first; an empty table gives an empty result; extra columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import cut

RUN = 1024
PART_CHARS = 1 << 20
BEGIN, END = "<|im_start|>", "<|im_end|>\n"

_ORDER = ("turn", "role", "text")


def _running(turns: DataFrame, **values: tuple) -> DataFrame:
    """``turns`` with running aggregates, the row's own value with them: name=(aggregate function, column, value of none).

    They are taken within runs first; what the runs before sum up to is then combined with it, by the same function.
    """
    order = Window.partitionBy("conv", "run").orderBy(*[F.col(c).asc_nulls_first() for c in _ORDER])
    df = turns.withColumns({k: agg(v).over(order.rowsBetween(Window.unboundedPreceding, 0)) for k, (agg, v, _) in values.items()})
    runs = turns.groupBy("conv", "run").agg(*[agg(v).alias(f"__{k}") for k, (agg, v, _) in values.items()])
    before = Window.partitionBy("conv").orderBy(F.col("run").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("conv").alias("__conv"), F.col("run").alias("__run"), *[F.coalesce(agg(f"__{k}").over(before), F.lit(none)).alias(f"__{k}") for k, (agg, _, none) in values.items()])
    df = df.join(runs, F.col("conv").eqNullSafe(F.col("__conv")) & F.col("run").eqNullSafe(F.col("__run")))
    whole = {k: (F.col(k) + F.col(f"__{k}")) if agg is F.sum else F.col(k).bitwiseXOR(F.col(f"__{k}")) for k, (agg, _, _) in values.items()}
    return df.withColumns(whole).drop("__conv", "__run", *[f"__{k}" for k in values])


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), F.coalesce(role, F.lit("unknown")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(END))


def fingerprints(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, run, place, a, b, chars): each turn's place from 1, its prefix's hashes, rendered characters."""
    turns = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")).distinct()
    turns = cut(turns.withColumn("run", F.floor(F.col("turn") / RUN)))
    turns = _running(turns, place=(F.sum, F.lit(1), 0))
    parts = [F.col("place"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    turns = cut(turns.withColumn("own_a", F.xxhash64(*parts)).withColumn("own_b", F.xxhash64(F.lit("second"), *reversed(parts))))
    size = F.length(rendered(F.col("role"), F.col("text"))).cast("long")
    return cut(_running(turns, a=(F.bit_xor, F.col("own_a"), 0), b=(F.bit_xor, F.col("own_b"), 0), chars=(F.sum, size, 0)).drop("own_a", "own_b"))


def collapse(turns: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies, kept) for every conversation of :func:`fingerprints`."""
    last = turns.groupBy("conv").agg(F.max(F.struct("place", "a", "b")).alias("last")).select("conv", F.col("last.place").alias("n_turns"), F.col("last.a").alias("a"), F.col("last.b").alias("b"))
    last = cut(last)
    whole = last.groupBy("n_turns", "a", "b").agg(F.min("conv").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    ends = last.select(F.col("conv").alias("of"), "n_turns")
    inner = turns.select("conv", "place", "a", "b").join(ends, F.col("conv").eqNullSafe(F.col("of"))).filter(F.col("place") < F.col("n_turns"))
    inner = inner.select(F.col("place").alias("p"), F.col("a").alias("x"), F.col("b").alias("y")).distinct()
    snapshot = (F.col("n_turns") == F.col("p")) & (F.col("a") == F.col("x")) & (F.col("b") == F.col("y"))
    maximal = whole.join(inner, snapshot, "left_anti").select(F.lit(True).alias("kept"), "first", "n_turns", "a", "b", "n_copies")
    copies = whole.select(F.col("n_turns").alias("p"), F.col("a").alias("x"), F.col("b").alias("y"), "n_copies")
    rows = last.join(copies, snapshot).select("conv", "n_turns", "n_copies")
    best = maximal.select(F.col("first").alias("of"), "kept").withColumn("found", F.lit(True))
    return rows.join(best, F.col("conv").eqNullSafe(F.col("of")), "left").select("conv", "n_turns", "n_copies", F.coalesce("kept", F.lit(False)).alias("kept"))


def render(conversations: DataFrame, **columns: str) -> DataFrame:
    """(conv, n_turns, n_copies, part, text): the maximal conversations, each in one part unless it is very long."""
    turns = fingerprints(conversations, **columns)
    kept = collapse(turns).filter("kept").select(F.col("conv").alias("of"), "n_turns", "n_copies")
    own = rendered(F.col("role"), F.col("text"))
    rows = turns.join(kept, F.col("conv").eqNullSafe(F.col("of"))).withColumn("part", F.floor((F.col("chars") - F.length(own)) / PART_CHARS)).withColumn("line", own)
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "")
    return rows.groupBy("conv", "n_turns", "n_copies", "part").agg(told.alias("text"))
