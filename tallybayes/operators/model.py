"""Naive Bayes models kept as DataFrames.

Multinomial (text):
    log P(c)   = ln(N_c / N)                                  (-inf if N_c = 0)
    log P(w|c) = ln((count_{w,c} + alpha) / (total_c + alpha * V))
    default_c  = ln(alpha / (total_c + alpha * V))            (count 0)

Categorical (tabular, feature = (attribute, value)):
    log P(a_i = v | c) = ln((count + alpha) / (N_c + alpha * D_i))
    default_{c,i} = ln(alpha / (N_c + alpha * D_i))           (count 0)

A ``Law`` replaces the text model's formulas.  Counts are distributed aggregates; only the
per-class summary (one row per class) is brought to the driver, the way a fitted estimator holds its
class list.  The rest stays in one table with a row per term (or feature), whose array holds the classes
that saw it: neither table nor plan has a column per class.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.functions.logmath import LOG_SCALE, fixed_log, safe_ln
from tallybayes.functions.text import bag_rows, counted_tokens, token_marks
from tallybayes.operators import scoring
from tallybayes.session import scratch_dir


def materialize(df: DataFrame, how: str, name: str) -> DataFrame:
    """``cache`` (default), ``checkpoint`` (write under the shared checkpoint
    dir and read back: cuts lineage, survives executor loss) or ``none``."""
    if how == "none":
        return df
    if how == "checkpoint":
        path = scratch_dir(df.sparkSession, name)
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    return df.persist()


def local_frame(spark: SparkSession, rows: Sequence, schema) -> DataFrame:
    """A driver-built table (one row per class or fold x class).

    One JSON literal, expanded by ``inline``: the plan is as small for many
    rows as for few, and the planner sees a small table and broadcasts it,
    unlike an RDD-backed frame.
    """
    from pyspark.sql.types import _parse_datatype_string

    st = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    data = json.dumps([dict(zip(st.names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(
        F.lit(data), f"array<{st.simpleString()}>", {"mode": "FAILFAST"})))


@dataclass(frozen=True)
class Law:
    """A text model's formulas as column expressions.

    ``prior(n_c, n, classes)``, ``likelihood(count, total_c, v, alpha)`` and ``default(total_c, v, alpha)`` give
    probabilities; a seen term's likelihood is never under the default.  ``count`` is what training counts
    of a term in a class, from its occurrences and documents; ``weight`` what one document's
    occurrences count when it is scored.
    """

    name: str
    prior: Callable = lambda n_c, n, classes: n_c.cast("double") / n
    likelihood: Callable = lambda count, total, v, alpha: (count + alpha) / (total + alpha * v)
    default: Callable = lambda total, v, alpha: alpha / (total + alpha * v)
    count: Callable = lambda occurrences, documents: occurrences
    weight: Callable = lambda tf: tf


MULTINOMIAL = Law("multinomial")
#: Presence instead of frequency: a term counts once a document, in training and in scoring.
BINARY = Law("binary", count=lambda occurrences, documents: documents, weight=lambda tf: F.least(tf, F.lit(1).cast("bigint")))
LAWS = {law.name: law for law in (MULTINOMIAL, BINARY)}


@dataclass
class MultinomialModel:
    alpha: float
    min_df: int
    labels: list[str]
    vocab_size: int
    n_docs: int
    class_stats: DataFrame      # label, label_idx, n_docs, n_tokens, log_prior, log_default, prior_q, default_q
    class_rows: list = field(repr=False)
    terms: DataFrame = field(repr=False)        # term, df, seen: array<struct<label_idx, cnt, df_c>> (all train terms)
    vocab_bytes: int | None = None              # total UTF-8 bytes of the vocabulary terms
    salt: int | None = None                     # salt buckets for the shuffle join (None: default)
    total_df: int | None = None                 # sum of document frequencies
    law: Law = MULTINOMIAL
    materialize_as: str = "none"
    _tables: dict = field(default_factory=dict, repr=False)

    @property
    def n_classes(self) -> int:
        return len(self.labels)

    @property
    def counts(self) -> DataFrame:
        """``(label, term, cnt, df_c)`` of all train terms."""
        rows = self.terms.select("term", F.inline("seen")).withColumn("label", self._of_class(self.labels, "string"))
        return rows.select("label", "term", "cnt", "df_c")

    @property
    def vocab(self) -> DataFrame:
        """``(term, df)`` of terms in at least ``min_df`` documents."""
        return self.terms.filter(F.col("df") >= self.min_df).select("term", "df")

    @property
    def term_stats(self) -> DataFrame:
        """``(label, label_idx, term, cnt, df_c, log_likelihood, ll_q, delta)`` of the vocabulary."""
        rows = self.terms.filter(F.col("df") >= self.min_df).select("term", F.inline("seen"))
        p = self._likelihood(F.col("cnt"), F.col("df_c"), F.col("label_idx"))
        return rows.withColumn("label", self._of_class(self.labels, "string")).withColumn("_p", p).select(
            "label", "label_idx", "term", "cnt", "df_c", safe_ln(F.col("_p")).alias("log_likelihood"),
            fixed_log(F.col("_p")).alias("ll_q"),
            (fixed_log(F.col("_p")) - self._of_class(self._column("default_q"), "bigint")).alias("delta"))

    def _column(self, name: str) -> list:
        return [r[name] for r in self.class_rows]

    def _of_class(self, values: Sequence, kind: str, idx: Column | str = "label_idx") -> Column:
        """A class constant of the class ``idx``, from one array literal."""
        idx = F.col(idx) if isinstance(idx, str) else idx
        return F.element_at(scoring.literal_array(values, kind), (idx + 1).cast("int"))

    def _likelihood(self, cnt: Column, df_c: Column, idx: Column) -> Column:
        return self.law.likelihood(self.law.count(cnt, df_c), self._of_class(self._column("n_tokens"), "bigint", idx),
                                   F.lit(float(self.vocab_size)), F.lit(float(self.alpha)))

    def table_bytes(self, bytes_per_class: int = 8) -> int | None:
        """Upper estimate of a scoring table: exact V, C and term bytes."""
        if self.vocab_bytes is None:
            return None
        return int(self.vocab_bytes + self.vocab_size * (64 + bytes_per_class * self.n_classes))

    def priors(self) -> list[Column]:
        return [F.lit(q).cast("bigint") for q in self._column("prior_q")]

    def defaults(self) -> list[Column]:
        return [F.lit(q).cast("bigint") for q in self._column("default_q")]

    def constants(self) -> tuple[list, list]:
        return self._column("prior_q"), self._column("default_q")

    def _kept(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A scoring table, made once for all later calls."""
        if name not in self._tables:
            self._tables[name] = materialize(make(), self.materialize_as, f"nb-{name}")
        return self._tables[name]

    def release(self) -> None:
        """Drop the model's cached tables; they are computed anew if it is used again."""
        for df in (self.terms, *self._tables.values()):
            df.unpersist()

    def entry_table(self) -> DataFrame:
        """Sparse model: ``(term, df, e)`` with the array of ``(label_idx, delta)`` of the classes that saw it."""
        return self._kept("entries", lambda: self.terms.filter(F.col("df") >= self.min_df).select("term", "df", F.transform(
            "seen", lambda x: F.struct(x["label_idx"].alias("label_idx"), (
                fixed_log(self._likelihood(x["cnt"], x["df_c"], x["label_idx"]))
                - self._of_class(self._column("default_q"), "bigint", x["label_idx"])).alias("delta"))).alias("e")))

    def term_table(self) -> DataFrame:
        """Wide model: ``(term, df, d)`` with an array of every class's delta, 0 if unseen."""
        return self._kept("deltas", lambda: dense_entries(self.entry_table(), self.n_classes))

    def bags(self, docs: DataFrame, id_cols: Sequence[str], text_col: str, keep: Sequence[str],
             words_col: str | None = None) -> tuple[DataFrame, list[str]]:
        """Weighted bags with marker rows, and their columns; ``ROW`` tells rows of one id apart by their text."""
        cols = [*id_cols, *[k for k in keep if k not in id_cols]]
        carried = [*cols, scoring.ROW]
        rows = self._rows(docs, carried, words_col or text_col)
        bags = bag_rows(rows, "_text", carried, markers=True, words=F.col("_text") if words_col else None)
        return bags.withColumn("tf", self.law.weight(F.col("tf"))), carried

    def joined(self, bags: DataFrame, carried: Sequence[str], table: DataFrame, bytes_per_class: int = 8) -> DataFrame:
        return scoring.model_join(bags, table, ["term"], carried, self.table_bytes(bytes_per_class), self.salt,
                                  weight="df", n_keys=self.vocab_size, how="left", total=self.total_df)

    def known_terms(self, docs: DataFrame, id_cols: Sequence[str], text_col: str, keep: Sequence[str]) -> DataFrame:
        """``(ids…, keep…, ROW, tf, d or e, _m)``: the known terms of every text and a marker a text, unsummed:
        what a stream can do without a state.  ``term_scores`` sums them."""
        bags, carried = self.bags(docs, id_cols, text_col, keep)
        if self.law.weight is MULTINOMIAL.weight:
            bags = token_marks(self._rows(docs, carried, text_col), "_text", carried)
        table = self.term_table() if self._wide() else self.entry_table()
        return scoring.known_rows(bags, table, "term", carried, self.table_bytes(8 if self._wide() else 32),
                                  "df", self.vocab_size, self.salt, self.total_df)

    def term_scores(self, known: DataFrame, cols: Sequence[str]) -> DataFrame:
        """``(cols…, prediction, score)`` of ``known_terms`` rows."""
        carried = [*cols, scoring.ROW]
        if not self._wide():
            entries = scoring.entry_rows(known, F.col("_m"), carried, F.col("e").isNotNull())
            sums = scoring.entry_sums(entries, carried)
            return scoring.finish(sums, scoring.argmax_sparse(sums, *self.constants()), self.labels, cols)
        deltas = [F.get("d", F.lit(c)) for c in range(self.n_classes)]
        sums = scoring.wide_sums(known, F.col("_m"), carried, deltas, F.col("d").isNotNull())
        scored = scoring.wide_scores(sums, carried, self.priors(), self.defaults())
        return scoring.finish(scored, scoring.argmax_struct([F.col(f"_q{c}") for c in range(self.n_classes)]), self.labels, cols)

    def _wide(self) -> bool:
        return 0 < self.n_classes <= scoring.WIDE_CLASSES

    @staticmethod
    def _rows(docs: DataFrame, carried: Sequence[str], text_col: str) -> DataFrame:
        """``(carried…, _text)``; ``ROW`` tells rows of one id apart by their text."""
        return docs.select(*carried[:-1], F.xxhash64(F.col(text_col)).alias(scoring.ROW), F.col(text_col).alias("_text"))

    def class_scores(self, docs: DataFrame, id_cols: Sequence[str], text_col: str = "text",
                     keep: Sequence[str] = (), words_col: str | None = None) -> DataFrame:
        """``(ids…, keep…, _q0.._q{C-1})`` fixed-point class scores (wide strategy)."""
        bags, carried = self.bags(docs, id_cols, text_col, keep, words_col)
        deltas, known = [F.get("d", F.lit(c)) for c in range(self.n_classes)], F.col("d").isNotNull()
        if self.law.weight is not MULTINOMIAL.weight or docs.isStreaming:
            sums = scoring.wide_sums(self.joined(bags, carried, self.term_table()), F.col("term").isNull(), carried, deltas, known)
        else:
            rows = self._rows(docs, carried, words_col or text_col)
            sums = scoring.wide_join_sums(
                lambda: token_marks(rows, "_text", carried, F.col("_text") if words_col else None), lambda: bags, self.term_table(), "term", carried,
                self.table_bytes(), "df", self.vocab_size, deltas, known, self.salt, self.total_df)
        return scoring.wide_scores(sums, carried, self.priors(), self.defaults()).drop(scoring.ROW)

    def sparse_sums(self, docs: DataFrame, id_cols: Sequence[str], text_col: str = "text",
                    keep: Sequence[str] = (), words_col: str | None = None) -> DataFrame:
        """``(ids…, keep…, _len, _sums)``: known tokens and the sums of the classes that saw them."""
        bags, carried = self.bags(docs, id_cols, text_col, keep, words_col)
        joined = self.joined(bags, carried, self.entry_table(), 32)
        entries = scoring.entry_rows(joined, F.col("term").isNull(), carried, F.col("e").isNotNull())
        return scoring.entry_sums(entries, carried).drop(scoring.ROW)

    def transform(self, docs: DataFrame, id_cols: Sequence[str], text_col: str = "text",
                  keep: Sequence[str] = (), strategy: str = "auto", words_col: str | None = None) -> DataFrame:
        """``(ids…, keep…, prediction, score)`` for every input row.

        ``strategy``: ``wide``, ``sparse`` or ``auto`` (wide for up to ``WIDE_CLASSES`` classes); results are
        the same.  ``words_col``: arrays of the terms that the model was trained on, in place of texts.
        """
        keep_all = [*id_cols, *[k for k in keep if k not in id_cols]]
        if strategy == "auto":
            strategy = "wide" if self.n_classes <= scoring.WIDE_CLASSES else "sparse"
        if strategy == "sparse":
            sums = self.sparse_sums(docs, id_cols, text_col, keep, words_col)
            return scoring.finish(sums, scoring.argmax_sparse(sums, *self.constants()), self.labels, keep_all)
        scored = self.class_scores(docs, id_cols, text_col, keep, words_col)
        best = scoring.argmax_struct([F.col(f"_q{c}") for c in range(self.n_classes)])
        return scoring.finish(scored, best, self.labels, keep_all)

    def long_scores(self, docs: DataFrame, id_cols: Sequence[str], text_col: str = "text",
                    keep: Sequence[str] = ()) -> DataFrame:
        """``(ids…, keep…, class, score)``: every class for every row."""
        extra = [k for k in keep if k not in id_cols]
        sums = self.sparse_sums(docs, id_cols, text_col, keep)
        priors, defaults = self.constants()
        p, d = scoring.literal_array(priors, "bigint"), scoring.literal_array(defaults, "bigint")
        rows = sums.select(*id_cols, *extra, "_len", F.map_from_entries("_sums").alias("_sums"),
                           F.posexplode(scoring.literal_array(self.labels, "string")).alias("_c", "class"))
        q = F.element_at(p, F.col("_c") + 1) + F.col("_len") * F.element_at(d, F.col("_c") + 1) \
            + F.coalesce(F.try_element_at("_sums", F.col("_c")), F.lit(0).cast("bigint"))
        if not self.vocab_size:  # no token is known and no default score defined
            q = F.element_at(p, F.col("_c") + 1)
        return rows.select(*id_cols, *extra, "class", F.coalesce(
            q.cast("double") / F.lit(float(LOG_SCALE)), F.lit(float("-inf"))).alias("score"))

    def save(self, path: str) -> None:
        self.class_stats.write.mode("overwrite").parquet(f"{path}/class_stats")
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        local_frame(self.terms.sparkSession, [(float(self.alpha), int(self.min_df), self.law.name)],
                    "alpha double, min_df int, law string").write.mode("overwrite").parquet(f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str, law: Law | None = None) -> "MultinomialModel":
        """A saved model; ``law`` is needed if it isn't one of ``LAWS``."""
        params = spark.read.parquet(f"{path}/params").first()
        if law is None and params["law"] not in LAWS:
            raise ValueError(f"the model was trained by the law {params['law']!r}: give it as law=")
        cs = spark.read.parquet(f"{path}/class_stats")
        rows = cs.orderBy("label_idx").collect()
        terms = spark.read.parquet(f"{path}/terms")
        v = _vocabulary_size(terms.filter(F.col("df") >= params["min_df"])).first()
        return cls(alpha=params["alpha"], min_df=params["min_df"], labels=[r["label"] for r in rows],
                   vocab_size=int(v["v"]), vocab_bytes=int(v["vb"]), total_df=int(v["tdf"]), n_docs=sum(r["n_docs"] for r in rows),
                   class_stats=cs, class_rows=rows, terms=terms, law=law or LAWS[params["law"]])


def dense_entries(entries: DataFrame, n: int) -> DataFrame:
    """Model rows whose ``e`` of ``(label_idx, delta)`` becomes ``d``: an array over ``n`` classes, 0 if unseen."""
    kept = [c for c in entries.columns if c != "e"]
    return entries.select(*kept, F.map_from_entries("e").alias("_e")).select(*kept, F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda c: F.coalesce(F.try_element_at("_e", c), F.lit(0).cast("bigint"))).alias("d")) \
        if n else entries.select(*kept, F.array().cast("array<bigint>").alias("d"))


def _term_bytes(vocab: DataFrame) -> Column:
    return (F.octet_length("term") if vocab.schema["term"].dataType.simpleString() == "string" else F.lit(8)).cast("bigint")


def _vocabulary_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum(_term_bytes(vocab)), F.lit(0)).alias("vb"),
                     F.coalesce(F.sum("df"), F.lit(0)).alias("tdf"))


def class_term_counts(train: DataFrame, label_col: str = "label", text_col: str = "text",
                      words_col: str | None = None) -> DataFrame:
    """``(label, term, cnt, df_c)``: occurrences and documents per (class, term).

    One partially aggregated shuffle keyed by (class, term): a hot term contributes one row per map
    task, not per token. Texts' tokens are summed as they come, without a sorted bag per document.
    """
    rows = train.withColumn("label", F.col(label_col).cast("string"))
    counted = counted_tokens(rows, text_col, ["label"], F.col(words_col) if words_col else None)
    return counted.groupBy("label", "term").agg(F.sum("tf").alias("cnt"), F.sum("df").alias("df_c"))


def class_list(found: dict, labels: Sequence[str] | None) -> list[str]:
    if None in found:
        raise ValueError("training rows without a label: filter or label them first")
    return sorted({str(l) for l in labels}) if labels is not None else sorted(found)


def fit_multinomial(train: DataFrame, label_col: str = "label", text_col: str = "text",
                    alpha: float = 1.0, min_df: int = 1, labels: Sequence[str] | None = None,
                    materialize_as: str = "cache", law: Law = MULTINOMIAL,
                    words_col: str | None = None) -> MultinomialModel:
    """Train on rows ``(label_col, text_col)``; vocabulary from train only.

    ``words_col``: an array column of terms (vocabulary indices, say) to train on in place of texts.
    """
    if alpha <= 0:
        raise ValueError("alpha must be > 0")
    spark = train.sparkSession
    # reads the label column alone; one row per class
    found = {r["label"]: int(r["n"]) for r in train.groupBy(F.col(label_col).cast("string").alias("label"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    label_list = class_list(found, labels)
    n_docs = sum(found.values())
    index = local_frame(spark, [(l, i) for i, l in enumerate(label_list)], "label string, label_idx int")
    counted = class_term_counts(train, label_col, text_col, words_col).join(index, "label")
    terms = materialize(counted.groupBy("term").agg(
        F.sum("df_c").alias("df"), F.collect_list(F.struct("label_idx", "cnt", "df_c")).alias("seen")), materialize_as, "nb-terms")
    # one pass over the kept table: V, term bytes and the classes' totals
    kept = terms.filter(F.col("df") >= min_df)
    parts = kept.select(F.inline(F.concat(
        F.array(F.struct(F.lit(-1).alias("label_idx"), F.lit(1).cast("bigint").alias("n"),
                         _term_bytes(kept).alias("b"), F.col("df").alias("df"))),
        F.transform("seen", lambda x: F.struct(
            x["label_idx"].alias("label_idx"), law.count(x["cnt"], x["df_c"]).cast("bigint").alias("n"),
            F.lit(0).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("df"))))))
    sums = {r["label_idx"]: r for r in parts.groupBy("label_idx").agg(*[F.sum(c).alias(c) for c in ("n", "b", "df")]).collect()}
    v, vb, tdf = (int(sums[-1][c]) for c in ("n", "b", "df")) if -1 in sums else (0, 0, 0)
    local = local_frame(spark, [(l, i, found.get(l, 0), int(sums[i]["n"]) if i in sums else 0)
                                for i, l in enumerate(label_list)],
                        "label string, label_idx int, n_docs bigint, n_tokens bigint")
    prior = law.prior(F.col("n_docs"), F.lit(n_docs), len(label_list))
    default = law.default(F.col("n_tokens"), F.lit(float(v)), F.lit(float(alpha)))
    stats = local.withColumn("log_prior", safe_ln(prior)).withColumn("prior_q", fixed_log(prior)) \
        .withColumn("log_default", safe_ln(default)).withColumn("default_q", fixed_log(default))
    rows = stats.collect()  # one-row range: a single tiny task
    return MultinomialModel(alpha=alpha, min_df=min_df, labels=label_list, vocab_size=v, n_docs=n_docs,
                            class_stats=local_frame(spark, [tuple(r) for r in rows], stats.schema), class_rows=rows,
                            terms=terms, vocab_bytes=vb, total_df=tdf, law=law,
                            materialize_as="cache" if materialize_as == "cache" else "none")


# ---------------------------------------------------------------------------
# Categorical
# ---------------------------------------------------------------------------
#: Attribute of the marker that every instance brings among its features.
MARKER = -1


@dataclass
class CategoricalModel:
    alpha: float
    labels: list[str]
    class_stats: DataFrame          # label, label_idx, n_rows, log_prior, log_default, prior_q
    class_rows: list = field(repr=False)
    features: DataFrame = field(repr=False)    # attr, value, n_values, cnt, seen: array<struct<label_idx, cnt>>
    attrs: dict = field(repr=False)            # attribute -> number of its values (D_i)
    table_bytes: int | None = None             # upper estimate of the feature table
    n_features: int | None = None
    salt: int | None = None

    @property
    def n_classes(self) -> int:
        return len(self.labels)

    @property
    def domains(self) -> DataFrame:
        return local_frame(self.features.sparkSession, list(self.attrs.items()), "attr bigint, n_values bigint")

    def _of_class(self, values: Sequence, kind: str, idx: Column) -> Column:
        return F.element_at(scoring.literal_array(values, kind), (idx + 1).cast("int"))

    def _likelihood(self, cnt: Column, idx: Column, n_values: Column) -> Column:
        a = F.lit(float(self.alpha))
        return (cnt + a) / (self._of_class([float(r["n_rows"]) for r in self.class_rows], "double", idx) + a * n_values)

    def log_likelihood(self) -> DataFrame:
        """Dense ``(label, attr, value, cnt, log_likelihood)`` over classes x features."""
        rows = self.features.select("attr", "value", "n_values", F.map_from_entries("seen").alias("_seen"),
                                    F.posexplode(scoring.literal_array(self.labels, "string")).alias("_c", "label")) \
            .withColumn("cnt", F.coalesce(F.try_element_at("_seen", F.col("_c")), F.lit(0).cast("bigint")))
        return rows.select("label", "attr", "value", "cnt", safe_ln(
            self._likelihood(F.col("cnt"), F.col("_c"), F.col("n_values"))).alias("log_likelihood"))

    def entry_table(self) -> DataFrame:
        """Sparse model: ``(attr, value, cnt, e)``, ``e`` the ``(label_idx, delta)`` over the attribute's default of the classes that saw it."""
        return self.features.select("attr", "value", "cnt", F.transform("seen", lambda x: F.struct(
            x["label_idx"].alias("label_idx"), (
                fixed_log(self._likelihood(x["cnt"], x["label_idx"], F.col("n_values")))
                - fixed_log(self._likelihood(F.lit(0), x["label_idx"], F.col("n_values")))).alias("delta"))).alias("e"))

    def feature_table(self) -> DataFrame:
        """Wide model: ``(attr, value, cnt, d)`` with an array of every class's log likelihood."""
        rows = self.features.select("attr", "value", "cnt", "n_values", F.map_from_entries("seen").alias("_seen"))
        return rows.select("attr", "value", "cnt", F.transform(F.sequence(F.lit(0), F.lit(self.n_classes - 1)), lambda c: fixed_log(
            self._likelihood(F.coalesce(F.try_element_at("_seen", c), F.lit(0).cast("bigint")), c, F.col("n_values")))).alias("d"))

    def transform(self, feats: DataFrame, rows: DataFrame | None = None, id_cols: Sequence[str] = (),
                  keep: Sequence[str] = (), strategy: str = "auto") -> DataFrame:
        """Score long features ``(ids…, keep…, attr, value)`` that hold a marker per instance
        (``tabular_features(markers=True)``); unseen values are skipped.  Rows that share their ids are told
        apart if the features carry ``scoring.ROW``; without it they fail.

        ``rows``: one row per instance with ``ids…`` and ``keep…``, for features without markers.
        ``strategy``: as for text.
        """
        carried = [*id_cols, *[k for k in keep if k not in id_cols and k in feats.columns]]
        late = [k for k in keep if k not in carried]
        if scoring.ROW in feats.columns:
            carried.append(scoring.ROW)
        tagged = feats.select(*carried, "attr", "value")
        if rows is not None:
            own = rows.select(*id_cols, *[k for k in carried if k not in id_cols], F.lit(MARKER).cast("bigint").alias("attr"),
                              F.lit(None).cast("string").alias("value"), *late)
            tagged = tagged.withColumns({k: F.lit(None).cast(rows.schema[k].dataType) for k in late}).union(own)
        elif late:
            raise ValueError(f"the features don't carry {late}")
        bags = tagged.withColumn("tf", F.lit(1).cast("bigint"))
        marker = F.col("attr") == MARKER
        if strategy == "auto":
            strategy = "wide" if self.n_classes <= scoring.WIDE_CLASSES else "sparse"
        keep_all = [*id_cols, *[k for k in keep if k not in id_cols]]

        def joined(table: DataFrame) -> DataFrame:
            return scoring.model_join(bags, table, ["attr", "value"], carried, self.table_bytes, self.salt,
                                      weight="cnt", n_keys=self.n_features, how="left")

        if strategy == "wide":
            sums = scoring.wide_sums(joined(self.feature_table()), marker, carried, [F.get("d", F.lit(c)) for c in range(self.n_classes)],
                                     F.col("d").isNotNull(), late)
            scored = scoring.wide_scores(sums, [*carried, *late], [F.lit(r["prior_q"]).cast("bigint") for r in self.class_rows],
                                         [F.lit(0).cast("bigint")] * self.n_classes)
            return scoring.finish(scored, scoring.argmax_struct([F.col(f"_q{c}") for c in range(self.n_classes)]), self.labels, keep_all)
        known = F.col("e").isNotNull()
        entries = scoring.entry_rows(joined(self.entry_table()), marker, carried, known, also=[
            *late, F.when(known, F.col("attr")).alias("_known")])
        sums = scoring.entry_sums(entries, carried, late=late, gathered="_known")
        return scoring.finish(sums, self._best_sparse(), self.labels, keep_all)

    def _best_sparse(self) -> Column:
        n_rows = scoring.literal_array([float(r["n_rows"]) for r in self.class_rows], "double")
        sizes = scoring.literal_array([float(d) for d in self.attrs.values()], "double")
        return best_of_known(scoring.literal_array([r["whole_q"] for r in self.class_rows], "bigint"), list(self.attrs),
                             lambda i: F.element_at(sizes, i + 1), lambda c: F.element_at(n_rows, (c + 1).cast("int")), self.alpha)


def best_of_known(whole: Column, attrs: Sequence[int], size_of: Callable[[Column], Column],
                  rows_of: Callable[[Column], Column], alpha: float) -> Column:
    """Best class of ``entry_sums`` rows of tabular features: constants, and the sums of the classes seen.

    ``whole``: each class's prior and its defaults of all ``attrs``; a row without some of them (``_known`` has
    the others) takes their defaults off, from the attribute's domain ``size_of`` and the class's
    ``rows_of``.
    """
    a = F.lit(float(alpha))
    missing = F.filter(F.transform(scoring.literal_array(list(attrs), "bigint"), lambda x, i: F.when(
        ~F.array_contains("_known", x), size_of(i).cast("double"))), lambda d: d.isNotNull())

    def base(idx: Column) -> Column:
        return F.element_at(whole, (idx + 1).cast("int")) - F.aggregate(
            missing, F.lit(0).cast("bigint"), lambda acc, d: acc + fixed_log(a / (rows_of(idx) + a * d)))

    every = F.array_max(F.transform(whole, lambda q, i: scoring.candidate(q, i)))
    unseen = F.when(F.size(F.array_distinct("_known")) == len(attrs), every).otherwise(
        F.array_max(F.transform(whole, lambda _, i: scoring.candidate(base(i), i))))
    seen = F.array_max(F.transform("_sums", lambda x: scoring.candidate(base(x["label_idx"]) + x["s0"], x["label_idx"])))
    return F.greatest(unseen, F.coalesce(seen, unseen))


def fit_categorical(feats: DataFrame, rows: DataFrame | None = None, alpha: float = 1.0,
                    labels: Sequence[str] | None = None, materialize_as: str = "cache"
                    ) -> CategoricalModel:
    """Train on long features ``(label, attr, value)`` with a marker per instance, or on features without
    and instance rows ``(label)`` (one per instance, for N_c).  NULL is no value."""
    if alpha <= 0:
        raise ValueError("alpha must be > 0")
    spark = feats.sparkSession
    feats = feats.select(F.col("label").cast("string").alias("label"), "attr", "value")
    if rows is not None:
        feats = feats.union(rows.select(F.col("label").cast("string"), F.lit(MARKER).cast("bigint"), F.lit(None).cast("string")))
    marker = F.col("attr") == MARKER
    counts = materialize(feats.filter(marker | F.col("value").isNotNull()).groupBy("label", "attr", "value")
                         .agg(F.count(F.lit(1)).alias("cnt")), materialize_as, "cat-counts")
    found = {r["label"]: int(r["cnt"]) for r in counts.filter(marker).select("label", "cnt").collect()}
    label_list = class_list(found, labels)
    n = sum(found.values())
    index = local_frame(spark, [(l, i) for i, l in enumerate(label_list)], "label string, label_idx int")
    features = counts.filter(~marker).join(index, "label").groupBy("attr", "value").agg(
        F.sum("cnt").alias("cnt"), F.collect_list(F.struct("label_idx", "cnt")).alias("seen"))
    # one row an attribute: the model's schema, as the class list is
    sizes = features.groupBy("attr").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("b")).orderBy("attr").collect()
    attrs = {int(r["attr"]): int(r["n"]) for r in sizes}
    domain = F.element_at(scoring.literal_array(list(attrs.values()), "bigint"),
                          F.array_position(scoring.literal_array(list(attrs), "bigint"), F.col("attr")).cast("int")) \
        if attrs else F.lit(0).cast("bigint")
    features = features.select("attr", "value", domain.alias("n_values"), "cnt", "seen")
    a = F.lit(float(alpha))
    local = local_frame(spark, [(l, i, found.get(l, 0)) for i, l in enumerate(label_list)], "label string, label_idx int, n_rows bigint")
    prior = F.col("n_rows").cast("double") / n if n else F.lit(0.0)
    whole = F.aggregate(scoring.literal_array([float(d) for d in attrs.values()], "double"), F.lit(0).cast("bigint"),
                        lambda acc, d: acc + fixed_log(a / (F.col("n_rows") + a * d)))
    stats = local.withColumn("log_prior", safe_ln(prior)).withColumn("prior_q", fixed_log(prior)) \
        .withColumn("log_default", safe_ln(a / (F.col("n_rows") + a))).withColumn("whole_q", F.col("prior_q") + whole)
    rows_c = stats.collect()
    n_features = sum(attrs.values())
    return CategoricalModel(
        alpha=alpha, labels=label_list, class_stats=local_frame(spark, [tuple(r) for r in rows_c], stats.schema).drop("whole_q"),
        class_rows=rows_c, features=features, attrs=attrs, n_features=n_features,
        table_bytes=sum(int(r["b"]) for r in sizes) + n_features * (80 + 24 * len(label_list)))


class NaiveBayes:
    """Estimator front end: ``NaiveBayes(law, alpha).fit(...)`` -> model.

    ``law`` picks the model builder (the pluggable part): ``multinomial`` or ``binary``, a ``Law``, or a
    callable that gives one (text rows ``label, text``); or ``categorical`` (long features
    ``label, attr, value`` with markers, or plus one row per instance for the class counts).
    """

    LAWS = (*LAWS, "categorical")

    def __init__(self, law: str | Law | Callable[[], Law] = "multinomial", alpha: float = 1.0, min_df: int = 1,
                 labels: Sequence[str] | None = None, materialize_as: str = "cache"):
        if callable(law) and not isinstance(law, Law):
            law = law()
        if not isinstance(law, Law) and law not in self.LAWS:
            raise ValueError(f"law must be a Law or one of {self.LAWS}")
        self.law, self.alpha, self.min_df = law, alpha, min_df
        self.labels, self.materialize_as = labels, materialize_as

    def fit(self, train: DataFrame, rows: DataFrame | None = None, label_col: str = "label",
            text_col: str = "text", words_col: str | None = None):
        if self.law != "categorical":
            law = self.law if isinstance(self.law, Law) else LAWS[self.law]
            return fit_multinomial(train, label_col, text_col, self.alpha, self.min_df,
                                   self.labels, self.materialize_as, law, words_col)
        return fit_categorical(train, rows, self.alpha, self.labels, self.materialize_as)
