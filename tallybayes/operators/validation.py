"""Model-selection plans: replication study and cross-validation.

Model tables have one row per term or feature whatever the number of folds or factors: a class's
counts are arrays over them, and a fold's model is the total less the fold's slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.functions.logmath import fixed_log
from tallybayes.functions.text import bag_rows, token_marks, tokens
from tallybayes.operators import scoring
from tallybayes.operators.model import MARKER, MultinomialModel, best_of_known, class_list, local_frame, materialize

# Classes times folds up to which a term's counts are a column each.
CELLS = 64


def replication_study(model: MultinomialModel, test: DataFrame, id_cols: Sequence[str],
                      factors: Sequence[int], text_col: str = "text",
                      label_col: str = "label") -> DataFrame:
    """Accuracy when the training data is replicated ``f`` times, for each f.

    Replicating multiplies every count by f while alpha stays fixed, so the
    smoothing fades.  No row is copied: the model is re-derived from the
    counts for each factor, a term's row holds an array over the factors for each class that saw it,
    and every factor is scored in the same pass, with a sum per factor and no column per class.  Replicating
    the test side too leaves accuracy unchanged, so it only scales n_test.
    Output ``(factor, n_train, n_test, accuracy)``.
    """
    a, v = F.lit(float(model.alpha)), F.lit(float(model.vocab_size))
    spark = test.sparkSession
    totals = local_frame(spark, [(i, int(r["n_tokens"])) for i, r in enumerate(model.class_rows)], "label_idx int, n bigint")
    rows = totals.select("label_idx", *[fixed_log(model.law.default(F.lit(int(f)) * F.col("n"), v, a)).alias(f"f{i}")
                                        for i, f in enumerate(factors)]).orderBy("label_idx").collect()
    priors = [r["prior_q"] for r in model.class_rows]
    defaults = [[r[f"f{i}"] for r in rows] for i in range(len(factors))]
    n_tokens = scoring.literal_array([int(r["n_tokens"]) for r in model.class_rows], "bigint")

    def delta(x: Column, i: int) -> Column:
        at = (x["label_idx"] + 1).cast("int")
        f = F.lit(int(factors[i]))
        p = model.law.likelihood(f * model.law.count(x["cnt"], x["df_c"]), f * F.element_at(n_tokens, at), v, a)
        return fixed_log(p) - F.element_at(scoring.literal_array(defaults[i], "bigint"), at)

    table = model.terms.filter(F.col("df") >= model.min_df).select("term", "df", F.transform("seen", lambda x: F.struct(
        x["label_idx"].alias("label_idx"), F.array(*[delta(x, i) for i in range(len(factors))]).alias("delta"))).alias("e"))
    docs = test.withColumn("label", F.col(label_col).cast("string"))
    bags, carried = model.bags(docs, id_cols, text_col, ["label"])
    joined = model.joined(bags, carried, table, 32 + 8 * len(factors))
    entries = scoring.entry_rows(joined, F.col("term").isNull(), carried, F.col("e").isNotNull(),
                                 [lambda x, i=i: F.get(x["delta"], F.lit(i)) for i in range(len(factors))])
    sums = scoring.entry_sums(entries, carried, len(factors))
    hits = sums.select(F.inline(F.array(*[F.struct(
        F.lit(int(f)).alias("factor"),
        (scoring.best_label(scoring.argmax_sparse(sums, priors, defaults[i], f"s{i}"), model.labels) == F.col("label"))
        .cast("bigint").alias("hit")) for i, f in enumerate(factors)])))
    n_train = F.lit(int(model.n_docs))
    return hits.groupBy("factor").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("hit").alias("_hits")
    ).select(
        F.col("factor").cast("bigint").alias("factor"),
        (F.col("factor") * n_train).cast("bigint").alias("n_train"),
        (F.col("factor") * F.col("_n")).cast("bigint").alias("n_test"),
        (F.col("_hits").cast("double") / F.col("_n")).alias("accuracy"))


def _slots(value: Column, k: int, fold: str = "fold") -> Column:
    """The aggregate of ``value`` as an array over the folds 0..k-1."""
    return F.array(*[F.coalesce(F.sum(F.when(F.col(fold) == f, value)), F.lit(0).cast("bigint")) for f in range(k)])


def _less_own(slots: str) -> Column:
    """What is left of a total without each fold."""
    total = F.aggregate(slots, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return F.transform(slots, lambda x: total - x)


def _summed(name: str, k: int) -> Column:
    """Sum of arrays over the folds, place by place."""
    return F.array(*[F.coalesce(F.sum(F.get(name, F.lit(f))), F.lit(0).cast("bigint")) for f in range(k)])


class _Folds:
    """Constants by fold and class, as arrays of one literal each."""

    def __init__(self, k: int, n_classes: int):
        self.k, self.n = k, n_classes

    def of(self, values: Sequence, kind: str, idx: Column | int, fold: Column | None = None) -> Column:
        fold = F.col("fold") if fold is None else fold
        idx = F.lit(idx) if isinstance(idx, int) else idx
        return F.element_at(scoring.literal_array(list(values), kind), (fold * self.n + idx + 1).cast("int"))

    def rows(self, values: Sequence, kind: str) -> Column:
        """The classes' values in a row's fold, as an array."""
        return F.slice(scoring.literal_array(list(values), kind), F.col("fold") * self.n + 1, self.n)


def _fold_counts(spark, counted: Sequence, k: int, labels: Sequence[str] | None) -> tuple[list[str], list[int]]:
    """Class list and the training rows of each (fold held out, class), from ``(fold, label, n)`` rows."""
    found: dict = {}
    for r in counted:
        found.setdefault(r["label"], [0] * k)[r["fold"]] += int(r["n"])
    label_list = class_list(found, labels)
    zero = [0] * k
    return label_list, [sum(found.get(l, zero)) - found.get(l, zero)[f] for f in range(k) for l in label_list]


def _fold_stats(spark, n_rows: Sequence[int], n_classes: int, more: dict[str, tuple[Sequence, str]], columns: dict) -> list:
    """One row per (fold, class) with its prior and ``columns``, in that order (k x C rows)."""
    names, kinds = list(more), [more[m][1] for m in more]
    local = local_frame(spark, [(i, i // n_classes, n, sum(n_rows[i // n_classes * n_classes:(i // n_classes + 1) * n_classes]),
                                 *[more[m][0][i] for m in names]) for i, n in enumerate(n_rows)],
                        "i int, fold int, n_rows bigint, n_all bigint" + "".join(f", {m} {t}" for m, t in zip(names, kinds)))
    prior = F.when(F.col("n_all") > 0, F.col("n_rows").cast("double") / F.col("n_all"))
    return local.withColumn("prior_q", fixed_log(prior)).select("i", "prior_q", *[c.alias(n) for n, c in columns.items()]) \
        .orderBy("i").collect()


def cross_validate_multinomial(docs: DataFrame, id_cols: Sequence[str], k: int,
                               fold_col: str = "fold", label_col: str = "label",
                               text_col: str = "text", alpha: float = 1.0, min_df: int = 1,
                               labels: Sequence[str] | None = None,
                               materialize_as: str = "cache", strategy: str = "auto") -> DataFrame:
    """k-fold cross-validation of the multinomial model in one plan.

    The corpus is counted once by (class, term) with a slot per fold, and kept with one row per
    term: the training counts of the model that holds out fold f are the total less
    that fold's slot (likewise document frequencies, so each fold keeps its own
    vocabulary, V and totals).  Every document is scored once, by the model that did not see it, with its
    fold's place in the term's arrays.
    Output ``(ids…, fold, label, prediction, score)``.
    """
    spark = docs.sparkSession
    a = F.lit(float(alpha))
    d = docs.select(*id_cols, F.col(fold_col).cast("int").alias("fold"), F.col(label_col).cast("string").alias("label"),
                    text_col, F.xxhash64(F.col(text_col)).alias(scoring.ROW))
    label_list, n_rows = _fold_counts(spark, d.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect(), k, labels)
    c_n, at = len(label_list), _Folds(k, len(label_list))
    if strategy == "auto":
        strategy = "wide" if c_n <= scoring.WIDE_CLASSES else "sparse"
    if strategy == "wide" and min_df <= 1 and 0 < c_n * k <= CELLS:
        return _cross_validate_cells(d, id_cols, k, text_col, float(alpha), label_list, n_rows, materialize_as)
    index = local_frame(spark, [(l, i) for i, l in enumerate(label_list)], "label string, label_idx int")
    counted = bag_rows(d, text_col, ["fold", "label"]).groupBy("label", "term").agg(
        _slots(F.col("tf"), k).alias("c"), _slots(F.lit(1).cast("bigint"), k).alias("n"))
    # (term, df, left: documents that each fold's model has, seen: each class's counts by fold held out)
    terms = materialize(counted.join(index, "label").select("term", "label_idx", _less_own("c").alias("c"), "n")
                        .groupBy("term").agg(_summed("n", k).alias("n"), F.collect_list(F.struct("label_idx", "c")).alias("seen"))
                        .select("term", F.aggregate("n", F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("df"),
                                _less_own("n").alias("left"), "seen"), materialize_as, "cv-terms")
    known = terms.select("term", "df", F.transform("left", lambda x: x >= max(min_df, 1)).alias("known"), "seen")
    ones = F.transform("known", lambda x: x.cast("bigint"))
    size = F.octet_length("term").cast("bigint")
    parts = known.select(F.inline(F.concat(
        F.array(F.struct(F.lit(-1).alias("label_idx"), ones.alias("c"), size.alias("b"))),
        F.transform("seen", lambda x: F.struct(x["label_idx"].alias("label_idx"), F.zip_with(
            x["c"], "known", lambda c, y: F.when(y, c).otherwise(0)).alias("c"), F.lit(0).cast("bigint").alias("b"))))))
    sums = {r["label_idx"]: r for r in parts.groupBy("label_idx").agg(
        _summed("c", k).alias("c"), F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).collect()}
    v = list(sums[-1]["c"]) if -1 in sums else [0] * k
    n_tokens = [int(sums[c]["c"][f]) if c in sums else 0 for f in range(k) for c in range(c_n)]
    v_of = [int(v[f]) for f in range(k) for _ in range(c_n)]
    stats = _fold_stats(spark, n_rows, c_n, {"t": (n_tokens, "bigint"), "v": (v_of, "bigint")},
                        {"default_q": fixed_log(a / (F.col("t") + a * F.col("v")))})
    priors, defaults = [r["prior_q"] for r in stats], [r["default_q"] for r in stats]

    def delta(cnt: Column, idx: Column, fold: Column) -> Column:
        p = (cnt + a) / (at.of(n_tokens, "bigint", idx, fold) + a * at.of(v_of, "bigint", idx, fold))
        return F.when(cnt > 0, fixed_log(p) - at.of(defaults, "bigint", idx, fold)).otherwise(F.lit(0).cast("bigint"))

    entries = known.select("term", "df", "known", F.transform("seen", lambda x: F.struct(
        x["label_idx"].alias("label_idx"), F.transform(x["c"], lambda c, f: delta(c, x["label_idx"], f)).alias("delta"))).alias("e"))
    n_terms, n_bytes = (int(sums[-1]["n"]), int(sums[-1]["b"])) if -1 in sums else (0, 0)
    carried = [*id_cols, scoring.ROW, "fold", "label"]
    bags = bag_rows(d, text_col, carried, markers=True)
    mine = F.coalesce(F.get("known", F.col("fold")), F.lit(False))
    marker = F.col("term").isNull()
    keep = [*id_cols, "fold", "label"]

    def joined(table: DataFrame, overhead: int) -> DataFrame:
        return scoring.model_join(bags, table, ["term"], carried, n_bytes + n_terms * (64 + k + c_n * (overhead + 8 * k)),
                                  weight="df", n_keys=n_terms, how="left")

    if strategy == "wide":
        # the classes' arrays laid end to end, 0 for a class that never saw the term
        none = F.array_repeat(F.lit(0).cast("bigint"), k)
        flat = entries.select("term", "df", "known", F.map_from_entries("e").alias("_e")).select(
            "term", "df", "known", F.flatten(F.transform(F.sequence(F.lit(0), F.lit(max(c_n, 1) - 1)), lambda c: F.coalesce(
                F.try_element_at("_e", c), none))).alias("d"))
        sums_w = scoring.wide_sums(joined(flat, 0), marker, carried, [F.get("d", F.lit(c * k) + F.col("fold")) for c in range(c_n)], mine)
        scored = scoring.wide_scores(sums_w, carried, [at.of(priors, "bigint", c) for c in range(c_n)],
                                     [at.of(defaults, "bigint", c) for c in range(c_n)])
        return scoring.finish(scored, scoring.argmax_struct([F.col(f"_q{c}") for c in range(c_n)]), label_list, keep)
    rows = scoring.entry_rows(joined(entries, 32), marker, carried, mine, [lambda x: F.get(x["delta"], F.col("fold"))])
    sums_s = scoring.entry_sums(rows, carried)
    best = scoring.argmax_arrays(at.rows(priors, "bigint"), at.rows(defaults, "bigint"))
    return scoring.finish(sums_s, best, label_list, keep)


def _cross_validate_cells(d: DataFrame, id_cols: Sequence[str], k: int, text_col: str, alpha: float,
                          labels: Sequence[str], n_rows: Sequence[int], materialize_as: str) -> DataFrame:
    """``cross_validate_multinomial`` for few folds and classes, without a least document frequency.

    A term is known to a fold's model if the other folds hold it at all, so tokens are counted as they come, without
    a bag per document; a term's counts are one number per class and fold, class by class. Terms of one
    fold alone count for V and the totals, but no document scores by them: they are left out of the joined table.
    """
    spark, c_n = d.sparkSession, len(labels)
    at = _Folds(k, c_n)
    index = local_frame(spark, [(l, i) for i, l in enumerate(labels)], "label string, label_idx int")
    own = [f"n{f}" for f in range(k)]
    counted = d.select("fold", "label", F.explode(tokens(text_col)).alias("term")).groupBy("label", "term").agg(
        *[F.count(F.when(F.col("fold") == f, 1)).alias(n) for f, n in enumerate(own)]).join(F.broadcast(index), "label")
    cells = [(c, f, f"c{c}_{f}") for c in range(c_n) for f in range(k)]
    zero = F.lit(0).cast("bigint")

    def plus(names: Sequence[str]) -> Column:
        return sum((F.col(n) for n in names[1:]), F.col(names[0]))

    by_fold = [plus([n for _, g, n in cells if g == f]) for f in range(k)]
    in_cells = counted.groupBy("term").agg(*[
        F.coalesce(F.sum(F.when(F.col("label_idx") == c, F.col(own[f]))), zero).alias(n) for c, f, n in cells])
    terms = materialize(in_cells.select("*", plus([n for _, _, n in cells]).alias("cnt")).select(
        "*", (F.greatest(zero, *by_fold) < F.col("cnt")).alias("shared")), materialize_as, "cv-cells")
    summed = terms.select("*", *[plus([n for b, _, n in cells if b == c]).alias(f"t{c}") for c in range(c_n)])
    left, shared = [F.col("cnt") - n for n in by_fold], F.col("shared")
    size = F.octet_length("term").cast("bigint")
    found = summed.agg(
        *[F.coalesce(F.sum(F.col(f"t{c}") - F.col(n)), zero).alias(n) for c, _, n in cells],
        *[F.count(F.when(left[f] > 0, 1)).alias(f"v{f}") for f in range(k)],
        F.count(F.when(shared, 1)).alias("n"), F.coalesce(F.sum(F.when(shared, size)), zero).alias("b")).first()
    n_tokens = [int(found[f"c{c}_{f}"]) for f in range(k) for c in range(c_n)]
    v_of = [int(found[f"v{f}"]) for f in range(k) for _ in range(c_n)]
    a = F.lit(alpha)
    stats = _fold_stats(spark, n_rows, c_n, {"t": (n_tokens, "bigint"), "v": (v_of, "bigint")},
                        {"default_q": fixed_log(a / (F.col("t") + a * F.col("v")))})
    priors, defaults = [r["prior_q"] for r in stats], [r["default_q"] for r in stats]

    def delta(c: int, f: int, name: str) -> Column:
        i, cnt = f * c_n + c, F.col(f"t{c}") - F.col(name)
        total = F.lit(n_tokens[i]).cast("bigint") + a * F.lit(v_of[i]).cast("bigint")
        return F.when(cnt > 0, fixed_log((cnt + a) / total) - F.lit(defaults[i]).cast("bigint")).otherwise(zero)

    n_terms = int(found["n"])
    table = summed.filter(shared).select("term", "cnt", F.array(*[delta(*x) for x in cells]).alias("d"))
    carried = [*id_cols, scoring.ROW, "fold", "label"]
    sums = scoring.wide_join_sums(
        lambda: token_marks(d, text_col, carried), lambda: bag_rows(d, text_col, carried, markers=True), table, "term", carried,
        int(found["b"]) + n_terms * (64 + 8 * len(cells)), "cnt", n_terms,
        [F.get("d", F.lit(c * k) + F.col("fold")) for c in range(c_n)], F.col("d").isNotNull())
    scored = scoring.wide_scores(sums, carried, [at.of(priors, "bigint", c) for c in range(c_n)],
                                 [at.of(defaults, "bigint", c) for c in range(c_n)])
    return scoring.finish(scored, scoring.argmax_struct([F.col(f"_q{c}") for c in range(c_n)]), labels, [*id_cols, "fold", "label"])


def cross_validate_categorical(rows: DataFrame, spec, k: int, fold_col: str = "fold",
                               alpha: float = 1.0, labels: Sequence[str] | None = None,
                               materialize_as: str = "cache", strategy: str = "auto") -> DataFrame:
    """k-fold cross-validation of the categorical model in one plan.

    Bin bounds depend on the held-out fold (train-only min/max), but an attribute has at most three
    distinct ones (``held_out_bounds``).  So a value is counted once with its bin in each of them,
    a categorical value once as it is, and the model that holds out fold f has the total less
    that fold's slot, for counts and for domain sizes.
    Classes use the global label set; a class absent from a training fold
    gets prior -inf.  Rows that share their ids are told apart by their values.
    Output ``(ids…, fold, label, prediction, score)``.
    """
    from tallybayes.operators.tabular import (
        BOUNDS_CLASSES, bin_index, bin_name, bounds_class, held_out_bounds, raw_features, row_hash)

    spark = rows.sparkSession
    a = F.lit(float(alpha))
    r = rows.select(*spec.id_cols, F.col(fold_col).cast("int").alias("fold"),
                    F.col(spec.label_col).cast("string").alias("label"), *spec.attrs, row_hash(spec))
    raw = raw_features(r, spec, keep=["fold", "label", scoring.ROW], markers=True)
    # one row per continuous attribute, whatever the data; computed once for both passes
    found = held_out_bounds(r, spec).collect() if spec.continuous else []
    bounds = local_frame(spark, [tuple(x) for x in found], "attr bigint, lo array<double>, hi array<double>, h1 int, h2 int")
    values = raw.join(F.broadcast(bounds), "attr", "left").withColumn("cls", bounds_class(F.col("fold")))
    numeric, marker = F.col("h1").isNotNull(), F.col("attr") == MARKER
    classes = range(BOUNDS_CLASSES)
    bins = [F.when(numeric, bin_index(F.col("num"), F.get("lo", F.lit(i)), F.get("hi", F.lit(i)), spec.n_bins)).alias(f"b{i}")
            for i in classes]
    # folds x classes x attributes x bins, and the categorical values: what the task's rows collapse to
    cells = materialize(values.filter(marker | numeric | F.col("cat").isNotNull()).select("fold", "label", "attr", "cat", *bins)
                        .groupBy("fold", "label", "attr", "cat", *[f"b{i}" for i in classes]).agg(F.count(F.lit(1)).alias("n")),
                        materialize_as, "cv-cat-cells")
    label_list, n_rows = _fold_counts(spark, cells.filter(marker).select("fold", "label", "n").collect(), k, labels)
    c_n, at = len(label_list), _Folds(k, len(label_list))
    index = local_frame(spark, [(l, i) for i, l in enumerate(label_list)], "label string, label_idx int")
    binned = F.array(*[F.struct(F.lit(i).alias("cls"), bin_name(F.col(f"b{i}")).alias("value")) for i in classes])
    by_class = cells.filter(~marker).join(index, "label").select("fold", "label_idx", "attr", "n", F.inline(
        F.when(F.col("b0").isNotNull(), binned).otherwise(F.array(F.struct(F.lit(0).alias("cls"), F.col("cat").alias("value"))))))
    features = materialize(
        by_class.groupBy("attr", "cls", "value", "label_idx").agg(_slots(F.col("n"), k).alias("own"))
        .groupBy("attr", "cls", "value").agg(_summed("own", k).alias("all"), F.collect_list(F.struct(
            "label_idx", _less_own("own").alias("c"))).alias("seen"))
        .select("attr", "cls", "value", F.aggregate("all", F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("cnt"),
                _less_own("all").alias("left"), "seen"), materialize_as, "cv-cat-features")
    # values that each fold's model has, by attribute and bounds class: three rows an attribute at most
    sized = features.select("attr", "cls", F.transform("left", lambda x: (x > 0).cast("bigint")).alias("has"),
                            F.octet_length("value").cast("bigint").alias("b")) \
        .groupBy("attr", "cls").agg(_summed("has", k).alias("sizes"), F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"))
    held = {(x["attr"], x["cls"]): x for x in sized.collect()}
    cls_of = {x["attr"]: (x["h1"], x["h2"]) for x in found}
    attrs = sorted({attr for attr, _ in held})
    # each attribute's domain in each fold's model, with the fold's bounds; for each (attribute, fold)
    domains = []
    for attr in attrs:
        h1, h2 = cls_of.get(attr, (None, None))
        domains += [int(held[(attr, 1 if f == h1 else 2 if f == h2 else 0)]["sizes"][f]) for f in range(k)]
    place = F.array_position(scoring.literal_array(attrs, "bigint"), F.col("attr")).cast("int") - 1

    def domain(i: Column, fold: Column) -> Column:
        return F.element_at(scoring.literal_array([float(x) for x in domains], "double"), (i * k + fold + 1).cast("int"))

    def ll(cnt: Column, idx: Column, fold: Column) -> Column:
        return fixed_log((cnt + a) / (at.of([float(x) for x in n_rows], "double", idx, fold) + a * domain(F.col("_place"), fold)))

    whole = F.lit(0).cast("bigint") if not domains else F.aggregate(
        F.transform(F.sequence(F.lit(0), F.lit(len(attrs) - 1)), lambda i: domain(i, F.col("fold"))), F.lit(0).cast("bigint"),
        lambda acc, x: acc + fixed_log(a / (F.col("n_rows") + a * x)))
    stats = _fold_stats(spark, n_rows, c_n, {}, {"whole_q": F.col("prior_q") + whole})
    priors = [x["prior_q"] for x in stats]
    entries = features.withColumn("_place", place)
    test = values.select(*spec.id_cols, "fold", "label", scoring.ROW, "attr", "cls", F.when(numeric, bin_name(bin_index(
        F.col("num"), F.get("lo", F.col("cls")), F.get("hi", F.col("cls")), spec.n_bins))).otherwise(F.col("cat")).alias("value"),
        F.lit(1).cast("bigint").alias("tf"))
    carried = [*spec.id_cols, "fold", "label", scoring.ROW]
    mine = F.coalesce(F.get("left", F.col("fold")) > 0, F.lit(False))
    keep = [*spec.id_cols, "fold", "label"]
    table_bytes = sum(int(x["b"]) + int(x["n"]) * (96 + 8 * k + c_n * (24 + 8 * k)) for x in held.values())

    def joined(table: DataFrame) -> DataFrame:
        return scoring.model_join(test, table, ["attr", "cls", "value"], carried, table_bytes, weight="cnt",
                                  n_keys=sum(int(x["n"]) for x in held.values()), how="left")

    if strategy == "auto":
        strategy = "wide" if c_n <= scoring.WIDE_CLASSES else "sparse"
    if strategy == "wide":
        none = F.array_repeat(F.lit(0).cast("bigint"), k)
        flat = entries.select("attr", "cls", "value", "cnt", "left", "_place", F.map_from_entries("seen").alias("_e")).select(
            "attr", "cls", "value", "cnt", "left", F.flatten(F.transform(
                F.sequence(F.lit(0), F.lit(max(c_n, 1) - 1)), lambda c: F.transform(
                    F.coalesce(F.try_element_at("_e", c), none), lambda n, f: ll(n, c, f)))).alias("d"))
        sums = scoring.wide_sums(joined(flat), marker, carried, [F.get("d", F.lit(c * k) + F.col("fold")) for c in range(c_n)], mine)
        scored = scoring.wide_scores(sums, carried, [at.of(priors, "bigint", c) for c in range(c_n)], [F.lit(0).cast("bigint")] * c_n)
        return scoring.finish(scored, scoring.argmax_struct([F.col(f"_q{c}") for c in range(c_n)]), label_list, keep)
    sparse = entries.select("attr", "cls", "value", "cnt", "left", F.transform("seen", lambda x: F.struct(
        x["label_idx"].alias("label_idx"), F.transform(x["c"], lambda n, f: ll(n, x["label_idx"], f) - ll(
            F.lit(0), x["label_idx"], f)).alias("delta"))).alias("e"))
    parts = scoring.entry_rows(joined(sparse), marker, carried, mine, [lambda x: F.get(x["delta"], F.col("fold"))],
                               also=[F.when(mine, F.col("attr")).alias("_known")])
    sums = scoring.entry_sums(parts, carried, gathered="_known")
    best = best_of_known(at.rows([x["whole_q"] for x in stats], "bigint"), attrs, lambda i: domain(i, F.col("fold")),
                         lambda c: at.of([float(x) for x in n_rows], "double", c), alpha)
    return scoring.finish(sums, best, label_list, keep)


def fold_accuracy(pred: DataFrame, weight: str | None = None) -> DataFrame:
    """``(fold, n, n_correct, accuracy)`` per fold (``weight``: count column
    of pre-aggregated confusion counts)."""
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    return pred.groupBy(F.col("fold").cast("bigint").alias("fold")).agg(
        F.sum(w).alias("n"),
        F.coalesce(F.sum(F.when(F.col("label") == F.col("prediction"), w)), F.lit(0))
        .cast("bigint").alias("n_correct"),
    ).withColumn("accuracy", F.col("n_correct").cast("double") / F.col("n"))


def mean_std(per_fold: DataFrame, value: str = "accuracy") -> DataFrame:
    """One row ``(folds, mean, std)``; population std, 0 for a single value."""
    return per_fold.agg(F.count(F.lit(1)).alias("folds"), F.avg(value).alias("mean"),
                        F.coalesce(F.stddev_pop(value), F.lit(0.0)).alias("std"))
