"""Feature preparation: splits, encoding, scaling, balancing, selection."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalar import stable_bucket
from millrace.operators.neighbours import nearest_neighbours
from millrace.operators.ordered import BLOCK, HOME, ORDINAL, _blocks, join_on, with_ordinal
from millrace.session import pin


# Classes that every task may hold.
HELD_CLASSES = 100_000


def _join_classes(df: DataFrame, classes: DataFrame, label: str) -> DataFrame:
    """Add what is known of each class. Rows stay where they are: a shuffle by class would
    leave all of them to as many tasks as there are classes. ``classes`` is small and pinned."""
    few = len(classes.select(label).take(HELD_CLASSES + 1)) <= HELD_CLASSES
    return join_on(df, F.broadcast(classes) if few else classes, [label], "inner")


# --- splits ---------------------------------------------------------------------


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], shares: dict[str, float], seed: int = 42, name: str = "split"
) -> DataFrame:
    """Assign each row to a named split with exact shares within every class.

    Rows are ordered by a digest of their key, so a row's place does not depend
    on partitions or on the run. The last split takes what rounding leaves.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # Only keys are numbered; wide columns are written once and never sorted.
    salted = pin(df.withColumn("_h", stable_bucket([F.lit(str(seed)), *keys], 1 << 30)).withColumn("_at", F.monotonically_increasing_id()))
    order = ["_h", *keys, "_at"]
    numbered = with_ordinal(salted.select(*dict.fromkeys([label, *order])), order, [label])
    sizes = pin(salted.groupBy(label).agg(F.count("*").alias("_size")))
    placed = _join_classes(numbered, sizes, label)
    names, upto, ends = list(shares), 0.0, []
    for i, split in enumerate(names[:-1]):
        upto += shares[split]
        inside = F.col(ORDINAL) <= F.round(F.col("_size") * F.lit(round(upto, 12)))
        ends.append(F.max(F.when(inside, F.struct(*order))).alias(f"_end{i}"))
    if not ends:
        return salted.withColumn(name, F.lit(names[-1])).select(*df.columns, name)
    marked = _join_classes(salted, pin(placed.groupBy(label).agg(*ends)), label)
    out = F.lit(names[-1])
    for i in reversed(range(len(ends))):
        out = F.when(F.struct(*order) <= F.col(f"_end{i}"), names[i]).otherwise(out)
    return marked.withColumn(name, out).select(*df.columns, name)


def folds(df: DataFrame, key: Sequence[str], k: int = 5, name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from a digest of the key."""
    return df.withColumn(name, stable_bucket(key, k).cast("int"))


# --- encoding -------------------------------------------------------------------


def label_encode(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Code 0..k-1 by alphabetical order of the values as text; NULL reads ``nan``."""
    for column in columns:
        value = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
        codes = with_ordinal(df.select(value.alias("_v")).distinct(), ["_v"], name="_o").select(
            "_v", (F.col("_o") - 1).alias(f"{column}{suffix}")
        )
        df = df.withColumn("_v", value).join(codes, "_v").drop("_v")
    return df


def one_hot(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """A 0/1 column ``<column>_<value>`` per given value; for values not known before see ``one_hot_vector``."""
    return df.withColumns(
        {f"{column}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in values}
    )


def one_hot_vector(df: DataFrame, column: str, name: str = "one_hot") -> DataFrame:
    """One sparse 0/1 vector as a struct of ``size`` and ``index``, for any number of values.

    The index is the value's place in ascending order; NULL has none.
    """
    codes = label_encode(df.filter(F.col(column).isNotNull()).select(column).distinct(), [column])
    size = codes.agg(F.count("*")).scalar()
    coded = df.join(codes.select(column, F.col(f"{column}_code").alias("_index")), column, "left")
    return coded.withColumn(name, F.struct(size.alias("size"), F.col("_index").alias("index"))).drop("_index")


# --- scaling --------------------------------------------------------------------


def zscore(df: DataFrame, columns: Sequence[str], population: bool = True, suffix: str = "") -> DataFrame:
    """Centre and scale by the standard deviation; a constant column gives NULL."""
    std = F.stddev_pop if population else F.stddev
    fields = [F.struct(F.avg(c).alias("m"), std(c).alias("s")).alias(c) for c in columns]
    stats = df.agg(F.struct(*fields).alias("s")).scalar()
    return df.withColumns({f"{c}{suffix}": F.try_divide(F.col(c) - stats[c]["m"], stats[c]["s"]) for c in columns})


def minmax(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Scale to 0..1; a constant column gives NULL."""
    fields = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]
    stats = df.agg(F.struct(*fields).alias("s")).scalar()
    return df.withColumns(
        {f"{c}{suffix}": F.try_divide(F.col(c) - stats[c]["lo"], stats[c]["hi"] - stats[c]["lo"]) for c in columns}
    )


# --- class balance ----------------------------------------------------------------


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight rows so that every class counts the same in total."""
    counts = pin(df.groupBy(label).agg(F.count("*").alias("_n")))
    whole = counts.agg(F.struct(F.sum("_n").alias("n"), F.count("*").alias("k")).alias("s")).scalar()
    weights = counts.select(label, (whole["n"] / (whole["k"] * F.col("_n"))).alias(name))
    return _join_classes(df, weights, label)


def oversample(
    df: DataFrame, label: str, features: Sequence[str], key: str, neighbours: int = 5, seed: int = 42
) -> DataFrame:
    """Add rows between neighbours until every class is as large as the largest.

    Neighbours of a row are the rows next to it along random directions, within
    its class: sorting along a direction is linear in the rows, where comparing
    all rows of a class is not. Added rows have a NULL key and ``synthetic``.
    """
    features = list(features)
    rng = random.Random(seed)
    # Every direction reads the rows twice.
    df = pin(df.select(label, key, *features))
    scaled = zscore(df.select(label, key, *features), features, suffix="_z")
    pairs = None
    for i in range(neighbours):
        along = sum((F.coalesce(F.col(f"{c}_z"), F.lit(0.0)) * rng.gauss(0, 1) for c in features), F.lit(0.0))
        numbered = with_ordinal(scaled.withColumn("_along", along), ["_along", key], [label])
        frame = Window.partitionBy(label, BLOCK).orderBy(ORDINAL)
        shifted = _blocks(numbered, 1).withColumn("_other", F.lag(F.struct(*features)).over(frame))
        found = shifted.filter((F.col(BLOCK) == F.col(HOME)) & F.col("_other").isNotNull())
        part = found.select(label, key, *features, "_other", F.lit(i).alias("_dir"))
        pairs = part if pairs is None else pairs.union(part)
    return _with_rows_between(df, pairs, label, features, key, seed)


def oversample_near(
    df: DataFrame, label: str, features: Sequence[str], key: str, neighbours: int = 5, seed: int = 42,
    alone: str = "refuse",
) -> DataFrame:
    """Add rows between near rows of one class until every class is as large as the largest.

    The ``neighbours`` nearest rows of each row, by standardised features, are found by hashing
    (``nearest_neighbours``); every added row lies between a row and one of them. A class of a
    single row has no neighbour: ``alone`` says whether that is refused or the row is copied. Equal rows
    are neighbours, so a class of one repeated row is filled with it. Added rows have a NULL key and ``synthetic``.
    """
    if alone not in ("refuse", "copy"):
        raise ValueError("alone is 'refuse' or 'copy'")
    features = list(features)
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    top = sizes.agg(F.max("_n")).first()[0] or 0
    single = pin(sizes.where((F.col("_n") == 1) & (F.lit(top) > 1)))
    if alone == "refuse":
        names = [repr(r[0]) for r in single.take(5)]
        if names:
            raise ValueError(f"classes of a single row: {', '.join(names)}")
    # Only classes that grow need neighbours.
    growing = join_on(df, sizes.where(F.col("_n") < top).select(label), [label], "inner")
    scaled = zscore(growing.select(label, key, *features), features, suffix="_z")
    near = nearest_neighbours(scaled, key, [f"{c}_z" for c in features], neighbours, by=[label], seed=seed)
    other = growing.select(F.col(key).alias("neighbour"), F.struct(*features).alias("_other"))
    pairs = (
        growing.select(label, key, *features).join(near.select(key, "neighbour", (F.col("rank") - 1).alias("_dir")), key)
        .join(other, "neighbour").select(label, key, *features, "_other", "_dir")
    )
    copied = join_on(growing, single.select(label), [label], "inner")
    pairs = pairs.unionByName(copied.select(label, key, *features, F.struct(*features).alias("_other"), F.lit(0).alias("_dir")))
    return _with_rows_between(df, pin(pairs), label, features, key, seed)


def _with_rows_between(
    df: DataFrame, pairs: DataFrame, label: str, features: Sequence[str], key: str, seed: int
) -> DataFrame:
    """The rows, and as many more between the pairs as every class lacks."""
    sizes = pin(df.groupBy(label).agg(F.count("*").alias("_n")))
    top = sizes.agg(F.max("_n")).scalar()
    # Each neighbour pair of a class of n rows gives this many rows or one more.
    missing = sizes.select(label, F.col("_n"), (top - F.col("_n")).alias("_missing")).filter("_missing > 0")
    ranked = with_ordinal(pairs, [stable_bucket([F.lit(str(seed)), key, "_dir"], 1 << 30), key, "_dir"], [label], "_rank")
    totals = pairs.groupBy(label).agg(F.count("*").alias("_pairs"))
    lacking = pin(join_on(missing, totals, [label], "inner"))
    sized = _join_classes(ranked, lacking, label)
    each = F.floor(F.col("_missing") / F.col("_pairs")) + F.when(
        F.col("_rank") <= F.col("_missing") % F.col("_pairs"), 1
    ).otherwise(0)
    copies = sized.withColumn("_times", each).filter("_times > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))
    )
    share = stable_bucket([F.lit(str(seed)), key, "_dir", "_copy"], 1_000_000) / 1_000_000
    new = copies.select(
        label, F.lit(None).cast(df.schema[key].dataType).alias(key),
        *[(F.col(c) + (F.col("_other")[c] - F.col(c)) * share).cast("double").alias(c) for c in features],
        F.lit(True).alias("synthetic"),
    )
    own = df.select(label, key, *[F.col(c).cast("double") for c in features], F.lit(False).alias("synthetic"))
    return own.unionByName(new)


# --- selection -----------------------------------------------------------------------


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """F statistic of each feature between the classes."""
    per_class = df.groupBy(label).agg(
        *[
            F.struct(
                F.count(c).alias("n"), F.avg(c).cast("double").alias("m"), F.var_pop(c).alias("v"), F.lit(c).alias("feature")
            ).alias(c)
            for c in features
        ]
    )
    rows = per_class.select(F.explode(F.array(*features)).alias("r")).select("r.*").filter("n > 0")
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("m")) / total
    within = F.sum(F.col("n") * F.col("v"))
    spread = F.sum(F.col("n") * F.col("m") * F.col("m")) - total * mean * mean
    f_value = F.try_divide(spread / (F.count("*") - 1), within / (total - F.count("*")))
    return rows.groupBy("feature").agg(f_value.alias("f_value"))


def select_k_best(df: DataFrame, features: Sequence[str], label: str, k: int = 20) -> DataFrame:
    """The ``k`` features with the largest F."""
    return anova_f(df, features, label).orderBy(F.desc_nulls_last("f_value"), "feature").limit(k)
