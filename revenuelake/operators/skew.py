"""Joins, quantiles and numbering that hold up when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revenuelake.session import materialize

HEAVY_SHARE = 1000  # a key is heavy when it holds more than one thousandth of the rows
DEFAULT_MARGINS = (0.05, 0.005, 0.0005)
LAST_VALUES = 1 << 17  # distinct values of a group that one task may sort
NARROWING = 32  # ranges in each further round


def _salt_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _with_salt(big: DataFrame, spread: Sequence[str], salts: int) -> DataFrame:
    return big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))


def _per_salt(small: DataFrame, salts: int) -> DataFrame:
    return small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Join rows to per-group figures when there are few groups and some are very large.

    ``small`` (one row per group) is repeated once per salt and ``big`` takes its salt from a hash of
    ``spread``, so a group is shared by ``salts`` tasks (by default as many as there are shuffle
    partitions) without any assumption about its size. When ``small`` turns out to be tiny, adaptive
    execution still changes the join to a broadcast.
    """
    salts = salts or _salt_count(big)
    return _with_salt(big, spread, salts).join(_per_salt(small, salts), [*on, "_salt"], how).drop("_salt")


def _above_share(counts: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Keys with more than one thousandth of the total weight; there can be fewer than a thousand."""
    total = counts.agg(F.sum(weight).alias("_total"))  # one row
    return (
        counts.crossJoin(F.broadcast(total)).filter(F.col(weight) * HEAVY_SHARE > F.col("_total")).select(*keys)
    )


def heavy_keys(weights: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Heavy keys from known row counts (``weights`` has one row per key)."""
    return _above_share(weights, keys, weight)


def heavy_keys_in_sample(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Heavy keys of about a thousandth of the rows, chosen by the hash of their id.

    The choice depends on the data alone, so every use of the result sees the same keys. A heavy key the
    sample misses is only joined the ordinary way.
    """
    sample = df.filter(F.pmod(F.xxhash64(row_id), F.lit(1024)) == 0)
    counts = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _above_share(counts, keys, "_n")


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    heavy: DataFrame,
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Join to a side with one row per key, keeping heavy keys out of the shuffle.

    ``heavy`` holds fewer than a thousand keys, and ``right`` has one row for each, so the rows of heavy
    keys are joined by broadcast where they lie. All other rows are shuffled, none of their keys being
    large. Every row takes exactly one of the two ways. NULL keys match each other if ``null_safe``.
    """

    def matches(df: DataFrame, other: DataFrame, kind: str) -> DataFrame:
        if not null_safe:
            return df.join(other, list(keys), kind)
        renamed = other.withColumnsRenamed({k: f"_r_{k}" for k in keys})
        same = [df[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
        return df.join(renamed, same, kind).drop(*[f"_r_{k}" for k in keys])

    few = F.broadcast(heavy)
    few_right = F.broadcast(matches(right, few, "left_semi"))
    ordinary = matches(matches(left, few, "left_anti"), right, how)
    return matches(matches(left, few, "left_semi"), few_right, how).unionByName(ordinary)


def _beside(figures: DataFrame, rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Figures of the group next to each row; a large group is shared by several tasks."""
    if by:
        return salted_join(rows, figures, by, [value])
    return rows.crossJoin(F.broadcast(figures))  # one row: figures of the only group


def _holding_ranges(rows: DataFrame, groups: DataFrame, by: Sequence[str], value: str, cuts: int) -> DataFrame:
    """Per group, the values between which the wanted ranks lie, and these ranks counted from there.

    ``groups`` holds approximate cut points and the ranks. Exact counts of the ranges between the cut points say which
    ranges are kept: the approximation decides how much is kept, never the result.
    """
    above = [(F.col("_cuts")[i] < F.col(value)).cast("int") for i in range(cuts)]
    placed = _beside(groups.select(*by, "_cuts"), rows, by, value).withColumn("_range", sum(above[1:], above[0]))
    counts = placed.groupBy(*by, "_range").agg(F.sum("_n").alias("_in"))  # at most one more than there are cuts
    running = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_end", F.sum("_in").over(running)).withColumn("_start", F.col("_end") - F.col("_in"))
    known = counts.join(groups, list(by)) if by else counts.crossJoin(F.broadcast(groups))

    def holding(rank: str, what: str) -> Column:
        return F.max(F.when((F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end")), F.col(what)))

    found = known.groupBy(*by).agg(
        holding("_low", "_range").alias("_from"), holding("_high", "_range").alias("_to"), holding("_low", "_start").alias("_skipped"),
        *[F.first(c).alias(c) for c in ("_low", "_high", "_share", "_cuts")],
    )
    # The two ranks are neighbours, so no other row lies between their ranges.
    return found.select(
        *by,
        F.get("_cuts", F.col("_from") - 1).alias("_over"),
        F.get("_cuts", F.col("_to")).alias("_upto"),
        (F.col("_low") - F.col("_skipped")).alias("_low"),
        (F.col("_high") - F.col("_skipped")).alias("_high"),
        "_share",
    )


def exact_quantile(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    q: float,
    out: str = "threshold",
    margins: Sequence[float] = DEFAULT_MARGINS,
    weight: str | None = None,
    last_values: int = LAST_VALUES,
) -> DataFrame:
    """Exact quantile with linear interpolation per group, by repeated counting on narrowing ranges.

    As long as a group has more than ``last_values`` rows, the range of values around the wanted ranks is found by
    counting and the rows outside it are left out, where they lie; what is left is counted by value. The first range
    is about a thousandth of a group (``margins``), each further one about a sixteenth of the values. Only the last values are
    sorted. So no task sorts a share of the data, whatever the size of a group, the number of its distinct values
    or the copies of one value. ``weight`` names a column with the number of times that a row counts.
    """
    if last_values < 2:
        raise ValueError("two neighbouring values may be needed")
    by = list(by)
    rows = df.filter(F.col(value).isNotNull()).select(*by, value, (F.col(weight) if weight else F.lit(1)).cast("long").alias("_n"))
    even = {i / NARROWING for i in range(1, NARROWING)}
    cuts = {min(max(q + side * m, 0.0), 1.0) for m in margins for side in (-1, 1)}
    if weight:  # the cut points are those of single rows, so the wanted ranks may lie anywhere
        cuts |= even
    position = F.lit(q) * (F.sum("_n") - 1)
    ranks = [F.floor(position).alias("_low"), F.ceil(position).alias("_high"), (position - F.floor(position)).alias("_share")]
    kept = None
    while True:
        sized = rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("_rows"), F.percentile_approx(value, sorted(cuts), 10_000).alias("_cuts"), *([] if kept else ranks)
        )
        if kept:
            sized = sized.join(kept, by) if by else sized.crossJoin(F.broadcast(kept))
        groups = materialize(sized, "quantile-groups")
        if (groups.agg(F.max("_rows")).first()[0] or 0) <= last_values:
            break
        kept = materialize(_holding_ranges(rows, groups, by, value, len(cuts)), "quantile-ranges")
        over, upto = F.col("_over"), F.col("_upto")
        inside = (over.isNull() | (F.col(value) > over)) & (upto.isNull() | (F.col(value) <= upto))
        rows = _beside(kept.select(*by, "_over", "_upto"), rows, by, value).filter(inside)
        rows = materialize(rows.groupBy(*by, value).agg(F.sum("_n").alias("_n")), "quantile-values")
        kept, cuts = kept.select(*by, "_low", "_high", "_share"), even

    within = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)  # at most last_values rows
    ended = rows.withColumn("_end", F.sum("_n").over(within))
    placed = ended.join(groups, by) if by else ended.crossJoin(F.broadcast(groups))
    number = F.col(value).cast("double")

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_end") - F.col("_n") <= F.col(rank)) & (F.col(rank) < F.col("_end")), number))

    picked = placed.groupBy(*by).agg(at("_low").alias("_first"), at("_high").alias("_second"), F.first("_share").alias("_between"))
    return picked.select(*by, (F.col("_first") + (F.col("_second") - F.col("_first")) * F.col("_between")).alias(out))


def global_row_number(df: DataFrame, order: Sequence[Column], out: str, partitions: int | None = None) -> DataFrame:
    """Consecutive numbers in a total order, without a window over one partition.

    Rows are range-partitioned and sorted; each row's generated id holds its partition and its place in
    it. Writing the rows fixes both, and the counts of earlier partitions are added. The input is written
    first, because choosing the ranges reads it once more.
    """
    stored = materialize(df, "unranked")
    ranged = stored.repartitionByRange(partitions, *order) if partitions else stored.repartitionByRange(*order)
    ordered = materialize(
        ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "ranked"
    )
    bits = 33  # monotonically_increasing_id keeps the row's place in the low 33 bits
    part = F.shiftright("_id", bits)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.col("_id").bitwiseAND(F.lit((1 << bits) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # at most one row per partition
        .withColumn(out, F.col("_before") + place + 1)
        .drop("_part", "_before", "_id")
    )
