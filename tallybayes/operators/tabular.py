"""Tabular features for categorical Naive Bayes.

An instance with M attributes becomes M features ``(attr, value)``, with
``attr`` the attribute's position and every value a string.  Continuous
attributes are first cut into ``n_bins`` equal-width bins over the train
range: ``k = int((v - lo) / (hi - lo) * n_bins)`` clamped to [0, n_bins-1]
(0 when hi <= lo), value ``'bin<k>'``; test values outside the train range
are clamped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.operators.ranking import range_rank
from tallybayes.operators.model import MARKER
from tallybayes.operators.scoring import ROW, model_join


@dataclass
class TabularSpec:
    id_cols: list[str]
    attrs: list[str]                      # attribute order defines ``attr``
    continuous: list[str] = field(default_factory=list)
    label_col: str = "label"
    n_bins: int = 5

    def attr_index(self, name: str) -> int:
        return self.attrs.index(name)


def column_minmax(train: DataFrame, spec: TabularSpec) -> DataFrame:
    """``(attr, name, lo, hi)`` of each continuous attribute: one pass."""
    if not spec.continuous:
        return train.sparkSession.createDataFrame([], "attr bigint, name string, lo double, hi double")
    aggs = []
    for c in spec.continuous:
        aggs += [F.min(F.col(c).cast("double")).alias(f"lo_{c}"),
                 F.max(F.col(c).cast("double")).alias(f"hi_{c}")]
    wide = train.agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(spec.attr_index(c)).cast("bigint").alias("attr"), F.lit(c).alias("name"),
                 F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi"))
        for c in spec.continuous])
    return wide.select(F.inline(entries))


def minmax_values(train: DataFrame, spec: TabularSpec) -> dict[str, tuple[float, float]]:
    """Train bounds as plain numbers (2 per continuous attribute)."""
    rows = column_minmax(train, spec).collect()
    return {r["name"]: (r["lo"], r["hi"]) for r in rows}


def bin_value(v: Column, lo: Column, hi: Column, n_bins: int) -> Column:
    """Equal-width bin label; a missing value (NULL or NaN) has no bin: the job fails."""
    return bin_name(bin_index(v, lo, hi, n_bins))


def bin_name(k: Column) -> Column:
    return F.concat(F.lit("bin"), k.cast("string"))


def bin_index(v: Column, lo: Column, hi: Column, n_bins: int) -> Column:
    """Equal-width bin number; the clamp happens in double before the cast."""
    num = v.cast("double")
    missing = num.isNull() | F.isnan(num)
    x = (num - lo) / (hi - lo) * F.lit(n_bins)
    k = F.when(hi <= lo, F.lit(0)).otherwise(
        F.least(F.greatest(x, F.lit(0.0)), F.lit(float(n_bins - 1))).cast("int"))
    return F.when(missing, F.raise_error(F.lit("a continuous attribute has a NULL or NaN value")).cast("int")).otherwise(k)


#: Distinct bounds that an attribute can have when any one fold is held out.
BOUNDS_CLASSES = 3


def held_out_bounds(rows: DataFrame, spec: TabularSpec, fold_col: str = "fold") -> DataFrame:
    """``(attr, lo, hi, h1, h2)`` per continuous attribute: its bounds classes over folds held out.

    Leaving out a fold moves a bound only if that fold has the extreme value.  So with ``h1`` the fold of
    the least and ``h2`` that of the greatest value, class 0 of the arrays ``lo`` and ``hi`` holds for all other
    folds, class 1 for ``h1`` and class 2 for ``h2`` (if it is another one).
    """
    per_fold = raw_features(rows, spec, [fold_col], attrs=spec.continuous).groupBy("attr", fold_col).agg(
        F.min("num").alias("lo"), F.max("num").alias("hi"))
    folds = per_fold.groupBy("attr").agg(
        F.sort_array(F.collect_list(F.struct("lo", F.col(fold_col).alias("h")))).alias("_lo"),
        F.sort_array(F.collect_list(F.struct("hi", F.col(fold_col).alias("h"))), asc=False).alias("_hi"))

    def at(side: str, i: int, name: str) -> Column:
        return F.get(side, F.lit(i))[name]

    one = at("_lo", 0, "h") == at("_hi", 0, "h")
    lo, hi = at("_lo", 0, "lo"), at("_hi", 0, "hi")
    return folds.select("attr", F.array(lo, at("_lo", 1, "lo"), lo).alias("lo"),
                        F.array(hi, F.when(one, at("_hi", 1, "hi")).otherwise(hi), at("_hi", 1, "hi")).alias("hi"),
                        at("_lo", 0, "h").alias("h1"), at("_hi", 0, "h").alias("h2"))


def bounds_class(fold: Column) -> Column:
    """The bounds class of ``held_out_bounds`` rows when ``fold`` is held out; 0 without bounds."""
    return F.when(fold == F.col("h1"), 1).when(fold == F.col("h2"), 2).otherwise(0)


def discretize(df: DataFrame, spec: TabularSpec,
               bounds: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Replace each continuous attribute by its bin label.

    ``bounds[name] = (lo, hi)`` as columns: literals for one model, or
    expressions of a fold column for per-fold bounds.
    """
    cont = set(spec.continuous)
    return df.select(*[
        bin_value(F.col(c), bounds[c][0], bounds[c][1], spec.n_bins).alias(c) if c in cont
        else F.col(c) for c in df.columns])


def literal_bounds(values: dict[str, tuple[float, float]]) -> dict[str, tuple[Column, Column]]:
    return {c: (F.lit(float(lo)), F.lit(float(hi))) for c, (lo, hi) in values.items()}


def tabular_features(df: DataFrame, spec: TabularSpec, keep: Sequence[str] = (), markers: bool = False) -> DataFrame:
    """Wide -> long: ``(ids…, keep…, attr, value)``, one row per attribute, and with ``markers`` one
    of attribute -1 without a value per instance."""
    entries = [F.struct(F.lit(i).cast("bigint").alias("attr"), F.col(c).cast("string").alias("value"))
               for i, c in enumerate(spec.attrs)]
    if markers:
        entries.append(F.struct(F.lit(MARKER).cast("bigint").alias("attr"), F.lit(None).cast("string").alias("value")))
    return df.select(*spec.id_cols, *keep, F.inline(F.array(*entries)))


def row_hash(spec: TabularSpec) -> Column:
    """Tells instances that share their ids apart by their values."""
    return F.xxhash64(*[F.col(c) for c in spec.attrs]).alias(ROW)


def feature_vocabulary(feats: DataFrame) -> DataFrame:
    """``(attr, value, cnt, idx)``: distinct train features ordered by attribute,
    then value, with their rows; the same value in two attributes stays two features."""
    distinct = feats.groupBy("attr", "value").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = range_rank(distinct, ["attr", "value"], rank_col="_r")
    return ranked.withColumn("idx", F.col("_r") - 1).drop("_r")


def attribute_domains(feats: DataFrame) -> DataFrame:
    """``(attr, n_values)``: distinct train values per attribute (D_i); NULL is no value."""
    return feats.filter(F.col("value").isNotNull()).select("attr", "value").distinct().groupBy("attr") \
        .agg(F.count(F.lit(1)).alias("n_values"))


def tabular_vectorize(feats: DataFrame, vocab: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """``(ids…, attr, idx)``: features unseen in train are skipped (only that
    attribute of the instance is dropped).  Few keys hold all rows, so each is dealt over slots
    (``model_join``)."""
    return model_join(feats, vocab, ["attr", "value"], id_cols, weight="cnt").select(*id_cols, "attr", "idx")


def raw_features(df: DataFrame, spec: TabularSpec, keep: Sequence[str] = (), markers: bool = False,
                 attrs: Sequence[str] | None = None) -> DataFrame:
    """Unbinned long form ``(ids…, keep…, attr, num, cat)``: ``num`` holds
    continuous values, ``cat`` categorical ones (as strings); markers as in ``tabular_features``.
    ``attrs``: only these attributes."""
    cont = set(spec.continuous)

    def entry(i: int, num: Column | None, cat: Column | None) -> Column:
        return F.struct(F.lit(i).cast("bigint").alias("attr"),
                        (F.lit(None) if num is None else num).cast("double").alias("num"),
                        (F.lit(None) if cat is None else cat).cast("string").alias("cat"))

    entries = [entry(spec.attr_index(c), F.col(c) if c in cont else None, None if c in cont else F.col(c))
               for c in (spec.attrs if attrs is None else attrs)]
    if markers:
        entries.append(entry(MARKER, None, None))
    return df.select(*spec.id_cols, *keep, F.inline(F.array(*entries)))


def long_minmax(raw: DataFrame, spec: TabularSpec, group: Sequence[str] = ()) -> DataFrame:
    """``(group…, attr, lo, hi)`` over the continuous attributes of raw features."""
    cont_idx = [i for i, c in enumerate(spec.attrs) if c in set(spec.continuous)]
    return raw.filter(F.col("attr").isin(cont_idx)).groupBy(*group, "attr").agg(
        F.min("num").alias("lo"), F.max("num").alias("hi"))


def bin_features(raw: DataFrame, bounds: DataFrame, spec: TabularSpec,
                 keys: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Long features ``(ids…, keep…, attr, value)``: continuous values binned
    with ``bounds`` (``keys…, attr, lo, hi``), categorical values as they are.

    ``bounds`` has one row per (keys…, continuous attribute) — e.g. folds x
    attributes — so it is broadcast: its size is fixed by the schema, not the data.
    One bin expression on columns serves any number of attributes.
    """
    cont_idx = [i for i, c in enumerate(spec.attrs) if c in set(spec.continuous)]
    j = raw.join(F.broadcast(bounds), [*keys, "attr"], "left") if cont_idx else \
        raw.withColumn("lo", F.lit(None).cast("double")).withColumn("hi", F.lit(None).cast("double"))
    value = F.when(F.col("attr").isin(cont_idx),
                   bin_value(F.col("num"), F.col("lo"), F.col("hi"), spec.n_bins)) \
        .otherwise(F.col("cat"))
    return j.select(*spec.id_cols, *keep, "attr", value.alias("value"))
