"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Every source gets a target size. Within a source, documents differ in how often they are wanted: the rate of a document is in
proportion to its measure, the binary digits of its number of words (so that one of 10,000 words is wanted about twice as
often as one of 100), ``max_copies`` at most, and such that the rates times the sizes make up the target. The whole part of
the rate is the document's certain copies; the fraction that is left is its inclusion probability in one more sample, of a
fixed size in words. Documents are ranked by their random odds divided by their inclusion odds, and are taken in that order
as long as they fit into what is missing. Those that do not fit are passed over ``PASSES`` times, so a source misses its
target by less than a small document, as long as it has small documents enough.

No source is ever sorted as a whole: ranks are cut into buckets, sizes are summed by bucket, and only the one bucket in
which a target is reached is ordered. What comes of it is two numbers a source and pass, by which each row is judged where
it is: no text is shuffled.

Defined cases: null or empty text has size 0, is in no sample and gets its certain copies; a null id draws its number from
the text; a null source is a source of its own, ranked last; rows that repeat id and text draw the same number and are taken
alike; repeated ids with different texts draw different ones; an empty table gives an empty result. No row is lost: the plan
has as many as ``docs``. Extra columns of ``docs`` are not used by :func:`plan` and are kept by :func:`mix`. Sources are put
in order in one task, a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import WORD, cut, own_names

BUCKETS = 4096
PASSES = 4
MAX_COPIES = 3
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size): one row a source.

    Sources by code point, null last, weigh ``weights`` in turn and share the whole size; no target goes over
    ``max_copies`` times its source's size. In the order of size/weight the capped sources are a prefix, so the level is
    found by running sums and no iteration.
    """
    by = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by) - 1) % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("cap", (F.lit(max_copies) * F.col("source_size")).cast("double"))
    rank = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = rank.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # a source is under its cap if the level that holds with all before it capped, itself and the rest not, keeps it there
    sources = sources.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(everything)["level"]
    return sources.select("source", "source_size", F.when(F.col("free"), level * F.col("weight")).otherwise(F.col("cap")).alias("target"))


def _drawn(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``docs`` with ``__source``, ``__size``, ``__bits`` (the measure) and ``__u``: a hash of id and text in (0, 1), so reruns agree, and SQL elsewhere."""
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))))
    u = (F.conv(F.substring(key, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(2**48))
    rows = docs.withColumns({"__source": F.col(source_col), "__size": word_count(F.col(text_col)), "__u": u})
    return rows.withColumn("__bits", F.length(F.bin("__size")))


def _same_source(column: str) -> Column:
    return F.col("__source").eqNullSafe(F.col(column))


def _rates(rows: DataFrame, goals: DataFrame, max_copies: int) -> DataFrame:
    """(of, bits, source_size, target, whole, fraction): for each source and measure the certain copies and the inclusion probability."""
    classes = rows.groupBy("__source", F.col("__bits").alias("bits")).agg(F.sum("__size").alias("words"))
    classes = classes.join(goals.withColumnRenamed("source", "of"), _same_source("of")).drop("__source")
    larger = Window.partitionBy("of").orderBy(F.col("bits").desc())
    before = F.coalesce(F.sum("words").over(larger.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("bits") * F.col("words")).over(larger.rowsBetween(0, Window.unboundedFollowing)).cast("double")
    # the rate of one bit if classes with more bits are at max_copies, and this and those with fewer are not
    classes = classes.withColumn("rate", F.when(rest > 0, (F.col("target") - F.lit(max_copies) * before) / rest))
    free = F.when(F.col("rate") * F.col("bits") <= max_copies, F.struct("bits", "rate"))
    rate = F.max(free).over(Window.partitionBy("of"))["rate"]
    copies = F.coalesce(F.least(F.lit(float(max_copies)), rate * F.col("bits")), F.lit(float(max_copies)))
    classes = classes.withColumn("copies", F.when(F.col("source_size") > 0, copies).otherwise(F.lit(0.0)))
    return classes.select("of", "bits", "words", "source_size", "target", F.floor("copies").alias("whole"), (F.col("copies") - F.floor("copies")).alias("fraction"))


def _with_odds(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` with their rates, and ``__odds``: random odds over inclusion odds, null where there is nothing to draw."""
    rates = rates.drop("words").withColumnsRenamed({c: f"__{c}" for c in ("of", "source_size", "target", "whole", "fraction")}).withColumnRenamed("bits", "__of_bits")
    rows = rows.join(rates, _same_source("__of") & (F.col("__bits") == F.col("__of_bits"))).drop("__of", "__of_bits", "__bits")
    odds = (F.col("__u") / (F.lit(1.0) - F.col("__u"))) / (F.col("__fraction") / (F.lit(1.0) - F.col("__fraction")))
    return rows.withColumn("__odds", F.when((F.col("__fraction") > 0) & (F.col("__size") > 0), odds))


def _one_pass(units: DataFrame, gaps: DataFrame) -> DataFrame:
    """(of, gap, until, left): for each source with ``gap`` words missing, the odds at which the first unit does not fit, and what is missing then.

    until is null if all units fit.
    """
    # q/(1+q) lies in (0, 1) and keeps the order
    units = units.withColumn("bucket", F.floor(F.col("odds") / (F.lit(1.0) + F.col("odds")) * BUCKETS).cast("int"))
    running = Window.partitionBy("source").orderBy("bucket")
    sums = units.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    sums = sums.withColumn("before", F.sum("size").over(running) - F.col("size"))
    sums = sums.join(gaps, F.col("source").eqNullSafe(F.col("of"))).drop("source")
    # buckets under the gap are taken as a whole: only that which reaches it is put in order
    under = F.col("before") + F.col("size") <= F.col("gap")
    at = sums.groupBy("of", "gap").agg(F.coalesce(F.sum(F.when(under, F.col("size"))), F.lit(0)).alias("taken"), F.min(F.when(~under, F.col("bucket"))).alias("at"))
    at = cut(at)
    split = units.join(at.filter("at IS NOT NULL"), F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at")))
    order = Window.partitionBy("of").orderBy("odds").rowsBetween(Window.unboundedPreceding, 0)
    split = split.withColumn("fits", F.col("taken") + F.sum("size").over(order) <= F.col("gap"))
    split = split.groupBy(F.col("of").alias("own")).agg(F.min(F.when(~F.col("fits"), F.col("odds"))).alias("until"), F.coalesce(F.sum(F.when(F.col("fits"), F.col("size"))), F.lit(0)).alias("more"))
    at = at.join(split, F.col("of").eqNullSafe(F.col("own")), "left")
    return cut(at.select("of", "gap", "until", (F.col("gap") - F.col("taken") - F.coalesce("more", F.lit(0))).alias("left")))


def _passes(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """(of, passes): for each source the passes in order, array<struct<n, above, until, most>>: rows of odds over above and under until are taken, up to most words."""
    odds = _with_odds(rows, rates).filter("__odds IS NOT NULL")
    units = cut(odds.groupBy(F.col("__source").alias("source"), F.col("__odds").alias("odds")).agg(F.sum("__size").alias("size"), F.max("__size").alias("one")))
    whole = F.sum(F.col("words") * F.col("whole"))
    gaps = rates.groupBy("of").agg((F.first("target") - whole).alias("gap"))
    found, above = [], F.lit(0.0)
    for n in range(PASSES):
        done = _one_pass(units, gaps)
        limit = F.col("gap") if n else F.lit(None)
        found.append(done.join(gaps.select(F.col("of").alias("own"), above.alias("above")), F.col("of").eqNullSafe(F.col("own"))).select("of", F.lit(n).alias("n"), "above", "until", limit.cast("double").alias("most")))
        gaps = done.filter("until IS NOT NULL").select("of", F.col("left").alias("gap"), F.col("until").alias("above"))
        above = F.col("above")
        if n + 1 < PASSES:
            rest = units.join(gaps, F.col("source").eqNullSafe(F.col("of")))
            units = cut(rest.filter((F.col("odds") > F.col("above")) & (F.col("one") <= F.col("gap"))).select("source", "odds", "size", "one"))
            gaps = gaps.select("of", "gap", "above")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return cut(every.groupBy("of").agg(F.collect_list(F.struct("n", "above", "until", "most")).alias("passes")))


def _copied(rows: DataFrame, rates: DataFrame, passes: DataFrame) -> DataFrame:
    """``rows`` with ``__copies``."""
    rows = _with_odds(rows, rates).join(passes.withColumnsRenamed({"of": "__of", "passes": "__passes"}), _same_source("__of"), "left").drop("__of")
    inside = lambda x: (F.col("__odds") > x["above"]) & (F.col("__odds") < F.coalesce(x["until"], F.lit(float("inf")))) & (F.col("__size") <= F.coalesce(x["most"], F.lit(float("inf"))))
    taken = F.coalesce(F.col("__odds").isNotNull() & F.exists("__passes", inside), F.lit(False))
    return rows.withColumn("__copies", (F.col("__whole") + taken.cast("int")).cast("int")).drop("__passes")


def _settled(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], max_copies: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    drawn = _drawn(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")), "id", "text", "source")
    # a few bytes a document, and the text is read and cut into words only once
    rows = cut(drawn.drop("text", "source"))
    goals = cut(targets(rows.select(F.col("__source").alias("source"), F.col("__size").alias("size")), weights, max_copies))
    rates = cut(_rates(rows, goals, max_copies))
    return rows, rates, _passes(rows, rates)


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(id, source, size, source_size, target, copies): how often the mix takes each row of ``docs``."""
    rows = _copied(*_settled(docs, id_col, text_col, source_col, weights, max_copies))
    return rows.select("id", *[F.col(f"__{c}").alias(c) for c in ("source", "size", "source_size", "target", "copies")])


@own_names
def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The rows of ``docs`` in the mix, each as many times as :func:`plan` says; all columns are kept."""
    _, rates, passes = _settled(docs, id_col, text_col, source_col, weights, max_copies)
    rows = _copied(_drawn(docs, id_col, text_col, source_col), rates, passes).filter("__copies > 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*[F.col(c) for c in docs.columns])
