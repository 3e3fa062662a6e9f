"""Scoring: join rows to a model kept as tables, sum per row, argmax.

``score(d, c) = prior_c + L_d * default_c + sum_{w in d} tf_w * delta_c(w)``
with ``delta_c(w) = ll_c(w) - default_c`` (zero where the class never saw w)
and ``L_d`` the in-vocabulary token count.  It equals the per-token sum of
the dense model but touches only the rows' own terms.

Two physical strategies:

* ``wide``: one model row per term holding an array of the classes' deltas; rows join once
  on the term and one aggregation per document adds C+1 sums.  For models
  of up to ``WIDE_CLASSES`` classes.
* ``sparse``: one model row per term holding the (class, delta) pairs that
  training saw; sums per (document, class seen) and then per document.  The
  best class without any seen term follows from ``L_d`` and the class constants
  alone, so neither the plan nor the rows grow with C.  It is also the
  independent second path the parity check compares against.

Every scored row brings a marker of its own among its terms (a NULL key), which the left join
keeps: rows without any known term keep their prior-only scores, rows without an id are
rows like others, nothing is joined back by id, and the input is scanned once.  Rows that share an id are
told apart by ``ROW`` where the caller has it (a hash of the text); exact
copies of a row give the same prediction once each.

Scores are fixed-point integers (see ``functions.logmath``); ties go to the
lowest class index, a class with prior -inf loses to any finite score, and a
row whose classes are all -inf gets class 0, as in the textbook argmax loop.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.functions.logmath import from_fixed

# Salt buckets of the shuffle join where the table has no weights (override per
# session with spark.tallybayes.saltBuckets).
DEFAULT_SALT_BUCKETS = 16

# Classes up to which one aggregation holds a sum per class.
WIDE_CLASSES = 32

# Column that tells rows of one id apart.
ROW = "_row"

# Bits of the filter of a table's keys: eight a key, at least and at most (2 MB).
FILTER_BITS = (1 << 16, 1 << 24)


def literal_array(values: Sequence, element: str) -> Column:
    """An array constant as one literal, however many values it has."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{element}>")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _class_score(prior: Column, default: Column, length: Column, delta_sum: Column) -> Column:
    base = F.when(length > 0, length * default).otherwise(_zero())
    return prior + base + F.coalesce(delta_sum, _zero())


def candidate(score: Column, idx: Column) -> Column:
    return F.struct(score.isNotNull().alias("ok"), F.coalesce(score, _zero()).alias("score"),
                    (-idx).cast("int").alias("neg_idx"))


def argmax_struct(scores: Sequence[Column]) -> Column:
    """Best of per-class fixed-point scores as ``struct(ok, score, neg_idx)``."""
    keys = [candidate(s, F.lit(c)) for c, s in enumerate(scores)]
    if len(keys) == 1:
        return keys[0]
    return F.greatest(*keys)


def best_label(best: Column, labels: Sequence[str]) -> Column:
    return F.element_at(literal_array([str(l) for l in labels], "string"), (1 - best["neg_idx"]).cast("int"))


def finish(scored: DataFrame, best: Column, labels: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return (
        scored.withColumn("_best", best)
        .select(*keep, best_label(F.col("_best"), labels).alias("prediction"),
                from_fixed(F.when(F.col("_best.ok"), F.col("_best.score"))).alias("score"))
    )


# Cap for broadcasting a model table whose size is known exactly from the
# fitted model (V, C, term bytes), unless spark.tallybayes.modelBroadcastBytes sets another one.
MODEL_BROADCAST_BYTES = 64 << 20
SPARK_BROADCAST_BYTES = 10 << 20


def broadcast_limit(spark) -> int:
    """Model-table broadcast cap: ``MODEL_BROADCAST_BYTES``, or autoBroadcastJoinThreshold where a
    session has lowered or further raised it; -1 in the latter disables it."""
    auto = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(SPARK_BROADCAST_BYTES))).lower()
    try:
        auto_b = int(auto.replace("b", ""))
    except ValueError:
        auto_b = SPARK_BROADCAST_BYTES
    if auto_b < 0:
        return -1
    cap = spark.conf.get("spark.tallybayes.modelBroadcastBytes", None)
    if cap is not None:
        return int(cap)
    return max(auto_b, MODEL_BROADCAST_BYTES) if auto_b >= SPARK_BROADCAST_BYTES else auto_b


# Keys that hold at least 1 / HOT_KEYS of a table's weight are "hot".
# There are at most HOT_KEYS of them; their list has two integers a key.
HOT_KEYS = 10_000


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in keys])


def maybe_known(table: DataFrame, keys: Sequence[str], n_keys: int) -> Column:
    """Whether a row's keys may be among the table's: a Bloom filter of one hash, as one array of words.

    It never rejects a known key.  It has eight bits a key and 2 MB at most, whatever the table.
    """
    bits = max(FILTER_BITS[0], min(FILTER_BITS[1], 1 << (8 * max(n_keys, 1) - 1).bit_length()))
    at = F.pmod(_key_hash(keys), F.lit(bits).cast("bigint"))
    words = table.select(F.shiftright(at, 6).alias("_w"), F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {bits}L) & 63 AS INT))").alias("_b")) \
        .groupBy("_w").agg(F.bit_or("_b").alias("_b"))
    dense = table.sparkSession.range(bits >> 6).join(words, F.col("id") == F.col("_w"), "left").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("id", F.coalesce("_b", _zero()).alias("b")))), lambda x: x["b"])).scalar()
    word = F.element_at(dense, (F.shiftright(at, 6) + 1).cast("int"))
    return F.bit_get(word, (at.bitwiseAND(F.lit(63).cast("bigint"))).cast("int")) == 1


def model_join(bags: DataFrame, table: DataFrame, key_cols: Sequence[str],
               id_cols: Sequence[str], table_bytes: int | None = None, salt: int | None = None,
               weight: str | None = None, n_keys: int | None = None, how: str = "inner",
               total: int | None = None) -> DataFrame:
    """Join row features to a table with one row per ``key_cols``.  NULL keys match nothing; a
    ``left`` join keeps them, and may keep or drop rows of other keys that the table hasn't.

    ``table_bytes`` is an upper estimate of the table from exact model sizes
    (V, C, key bytes).  Under the broadcast cap the table is broadcast, so rows
    are scored where they were read.

    Above it, or where the size is unknown, the table's own ``weight`` (a training frequency)
    tells which keys are hot: a key with at least 1 / HOT_KEYS of the total
    gets as many slots as its share fills shuffle partitions;
    its rows are dealt over the slots by row id and its table row is repeated
    once a slot.  The slots are looked up by key hash in a broadcast list of
    at most HOT_KEYS pairs of integers (160 kB).  Rows whose keys a Bloom filter of the table's (``n_keys``)
    doesn't know don't enter the shuffle, so an unknown hot key gathers nowhere; the scored rows
    are never counted beforehand.  Tables without weights and sessions that switch
    broadcasts off deal every key over ``salt`` slots.
    """
    spark = bags.sparkSession
    keys = list(key_cols)
    payload = [c for c in table.columns if c not in keys and c != weight]
    limit = broadcast_limit(spark)
    if table_bytes is not None and 0 < table_bytes <= limit:
        return bags.join(F.broadcast(table.select(*keys, *payload)), keys, how)
    row, one = F.xxhash64(*[F.col(c) for c in id_cols]), F.lit(1).cast("bigint")
    if weight is None or limit < 0:
        n = F.lit(salt or int(spark.conf.get("spark.tallybayes.saltBuckets", str(DEFAULT_SALT_BUCKETS)))).cast("bigint")
        dealt, slots = bags.withColumn("_slots", n), table.withColumn("_slots", n)
    else:
        total = table.select(F.sum(weight)).scalar() if total is None else F.lit(max(total, 1))
        parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
        hot = F.broadcast(table.filter(F.col(weight) * HOT_KEYS >= total).groupBy(_key_hash(keys).alias("_key")).agg(
            F.max(F.ceil(F.col(weight) * parts / total)).cast("bigint").alias("_slots")))
        if n_keys is not None:
            bags = bags.filter(F.col(keys[-1]).isNull() | maybe_known(table, keys, n_keys))
        dealt = bags \
            .withColumn("_key", _key_hash(keys)).join(hot, "_key", "left").drop("_key")
        slots = table.withColumn("_key", _key_hash(keys)).join(hot, "_key", "left").drop("_key")
    slot = F.pmod(row, F.coalesce("_slots", one))
    if how == "left":
        slot = F.when(F.col(keys[-1]).isNull(), row).otherwise(slot)
    dealt = dealt.withColumn("_slot", slot).drop("_slots")
    slots = slots.withColumn("_slot", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.coalesce("_slots", one) - 1))).select(*keys, "_slot", *payload)
    return dealt.join(slots, [*keys, "_slot"], how).drop("_slot")


def _checked(per_row: DataFrame, by_row: bool) -> DataFrame:
    """Rows of an aggregation with ``_m`` markers: exact copies come back once each; without
    ``ROW`` two rows of one id can't be told apart and the job fails."""
    if by_row:
        return per_row.filter(F.col("_m") > 0).withColumn(
            "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_m")))).drop("_copy")
    return per_row.filter(F.when(F.col("_m") > 1, F.raise_error(F.lit("two scored rows share an id")).cast("boolean"))
                          .otherwise(F.col("_m") == 1))


def wide_sums(joined: DataFrame, marker: Column, carried: Sequence[str], deltas: Sequence[Column],
              known: Column, late: Sequence[str] = ()) -> DataFrame:
    """``(carried…, late…, _len, _s0.._s{n-1})`` per scored row, from model-joined rows with markers.

    ``known``: whether a row's key is in the model; ``deltas``: a sum for each; ``late``: columns
    that markers alone have.
    """
    sums = joined.groupBy(*carried).agg(
        F.coalesce(F.sum(F.when(known, F.col("tf"))), _zero()).alias("_len"), F.sum(marker.cast("bigint")).alias("_m"),
        *[F.first(c, ignorenulls=True).alias(c) for c in late],
        *[F.sum(F.when(known, F.col("tf") * d)).alias(f"_s{i}") for i, d in enumerate(deltas)])
    return _shares(sums, [*carried, *late], len(deltas), ROW in carried)


def _shares(sums: DataFrame, kept: Sequence[str], n: int, by_row: bool | None = None) -> DataFrame:
    """Each copy's part of ``n`` sums over all copies of a row."""
    return _checked(sums, ROW in kept if by_row is None else by_row).select(*kept, F.expr("_len div _m").alias("_len"), *[
        F.expr(f"_s{i} div _m").alias(f"_s{i}") for i in range(n)])


def frequent_keys(table: DataFrame, weight: str, n_keys: int, table_bytes: int, limit: int) -> int | None:
    """Least power of two whose keys of at least that weight fit in ``limit`` bytes; None if there are none.

    One row per power of two is brought to the driver.
    """
    power = F.floor(F.log2(F.greatest(F.col(weight), F.lit(1).cast("bigint")).cast("double"))).cast("int")
    room, least = limit * max(n_keys, 1) // max(table_bytes, 1), None
    counted = {r["_p"]: int(r["n"]) for r in table.groupBy(power.alias("_p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    for p in sorted(counted, reverse=True):
        room -= counted[p]
        if room < 0:
            break
        least = p
    return None if least is None else 1 << least


def known_rows(rows: DataFrame, table: DataFrame, key: str, carried: Sequence[str], table_bytes: int | None,
               weight: str, n_keys: int, salt: int | None = None, total: int | None = None) -> DataFrame:
    """``(carried…, tf, payload…, _m)``: the rows whose key the table has, with its other columns, and the markers
    (``_m``); nothing is summed, so ``rows`` may be a stream.

    Where the table is above the broadcast cap, its most frequent keys are broadcast and their rows stay in the task that
    read them; only rows of the others enter the shuffle join.
    """
    payload = [c for c in table.columns if c not in (key, weight)]
    out = [*carried, "tf", *payload, F.col(key).isNull().alias("_m")]
    limit = broadcast_limit(table.sparkSession)
    least = None
    if table_bytes is not None and 0 < limit < table_bytes and salt is None:
        least = frequent_keys(table, weight, n_keys, table_bytes, limit)
    if least is None:
        joined = model_join(rows, table, [key], carried, table_bytes, salt, weight=weight, n_keys=n_keys, how="left", total=total)
        return joined.filter(F.col(key).isNull() | F.col(payload[0]).isNotNull()).select(out)
    frequent = table.filter(F.col(weight) >= least).select(key, *payload, F.lit(True).alias("_frequent"))
    rest = table.filter(F.col(weight) < least)
    found = rows.join(F.broadcast(frequent), key, "left")
    others = found.filter(F.col("_frequent").isNull() & F.col(key).isNotNull()).select(rows.columns)
    joined = model_join(others, rest, [key], carried, table_bytes, weight=weight, n_keys=n_keys, total=total)
    return found.filter(F.col("_frequent") | F.col(key).isNull()).select(out).unionByName(joined.select(out))


def frequent_first(bags: DataFrame, table: DataFrame, key: str, carried: Sequence[str], table_bytes: int,
                   weight: str, n_keys: int, least: int, deltas: Sequence[Column], known: Column) -> DataFrame:
    """``wide_sums`` of rows with markers for a table above the broadcast cap.

    Keys of weight ``least`` or more are broadcast, and their rows are summed in the task that read them. Only the
    others, summed by row and key, enter the shuffle join with the rest of the table: the few frequent keys hold
    most of a text's tokens. ``bags`` may hold a row per token.
    """
    payload = [c for c in table.columns if c not in (key, weight)]
    frequent = table.filter(F.col(weight) >= least).select(key, *payload, F.lit(True).alias("_frequent"))
    rest = table.filter(F.col(weight) < least)
    found = bags.join(F.broadcast(frequent), key, "left")
    found = found.filter(F.col("_frequent") | F.col(key).isNull() | maybe_known(rest, [key], n_keys))
    n, rare = len(deltas), F.when(F.col("_frequent").isNull(), F.col(key))
    first = found.withColumn("_rare", rare).groupBy(*carried, "_rare").agg(
        F.sum(F.when(known, F.col("tf"))).alias("_n"), F.sum(F.col(key).isNull().cast("bigint")).alias("_k"), F.sum("tf").alias("tf"),
        *[F.sum(F.when(known, F.col("tf") * d)).alias(f"_d{i}") for i, d in enumerate(deltas)]).withColumnRenamed("_rare", key)
    joined = model_join(first, rest, [key], carried, table_bytes, weight=weight, how="left")
    own = F.col(key).isNull()
    sums = joined.groupBy(*carried).agg(
        F.coalesce(F.sum(F.when(own, F.col("_n")).when(known, F.col("tf"))), _zero()).alias("_len"),
        F.sum(F.when(own, F.col("_k")).otherwise(_zero())).alias("_m"),
        *[F.sum(F.when(own, F.col(f"_d{i}")).when(known, F.col("tf") * d)).alias(f"_s{i}") for i, d in enumerate(deltas)])
    return _shares(sums, carried, n)


def wide_join_sums(tokens: Callable[[], DataFrame], bags: Callable[[], DataFrame], table: DataFrame, key: str,
                   carried: Sequence[str], table_bytes: int | None, weight: str, n_keys: int, deltas: Sequence[Column],
                   known: Column, salt: int | None = None, total: int | None = None) -> DataFrame:
    """``wide_sums`` of the rows joined to ``table``: by ``tokens`` (a row per token) where the table, or its
    frequent keys, are broadcast, else by ``bags`` through ``model_join``."""
    marker = F.col(key).isNull()
    limit = broadcast_limit(table.sparkSession)
    if table_bytes is not None and limit > 0 and salt is None:
        if table_bytes <= limit:
            joined = model_join(tokens(), table, [key], carried, table_bytes, weight=weight, how="left")
            return wide_sums(joined, marker, carried, deltas, known)
        least, rows = frequent_keys(table, weight, n_keys, table_bytes, limit), tokens()
        if least is not None and not rows.isStreaming:
            return frequent_first(rows, table, key, carried, table_bytes, weight, n_keys, least, deltas, known)
    joined = model_join(bags(), table, [key], carried, table_bytes, salt, weight=weight, n_keys=n_keys, how="left", total=total)
    return wide_sums(joined, marker, carried, deltas, known)


def wide_scores(sums: DataFrame, carried: Sequence[str], priors: Sequence[Column], defaults: Sequence[Column]) -> DataFrame:
    """Per-row class scores ``_q0.._q{C-1}`` (bigint, NULL = -inf) of ``wide_sums`` rows."""
    return sums.select(*carried, *[
        _class_score(p, d, F.col("_len"), F.col(f"_s{c}")).alias(f"_q{c}") for c, (p, d) in enumerate(zip(priors, defaults))])


def entry_rows(joined: DataFrame, marker: Column, carried: Sequence[str], known: Column,
               values: Sequence[Callable[[Column], Column]] = (), also: Sequence[Column | str] = ()) -> DataFrame:
    """``(carried…, label_idx, s0.., _m)``: a row per model-joined row and class that saw its key, and one
    with ``label_idx`` -1 that holds the known tokens (in ``s0``) and the marker.

    ``joined`` has ``e``: an array of ``(label_idx, delta)``, or of structs of which ``values`` take
    the numbers to sum.
    """
    n = max(1, len(values))
    own = F.struct(F.lit(-1).alias("label_idx"), F.when(known, F.col("tf")).otherwise(_zero()).alias("s0"),
                   *[_zero().alias(f"s{i}") for i in range(1, n)], marker.cast("bigint").alias("_m"))

    def entry(x: Column) -> Column:
        parts = [v(x) for v in values] if values else [x["delta"]]
        return F.struct(x["label_idx"].cast("int").alias("label_idx"),
                        *[(F.col("tf") * p).alias(f"s{i}") for i, p in enumerate(parts)], _zero().alias("_m"))

    return joined.select(*carried, *also, F.inline(F.concat(F.array(own), F.when(known, F.transform("e", entry)).otherwise(
        F.array().cast(f"array<struct<label_idx:int,{','.join(f's{i}:bigint' for i in range(n))},_m:bigint>>")))))


def entry_sums(entries: DataFrame, carried: Sequence[str], n: int = 1, late: Sequence[str] = (),
               gathered: str | None = None) -> DataFrame:
    """``(carried…, late…, _len, _sums)`` per scored row: known tokens and an array of
    ``(label_idx, s0..)`` of the classes that saw any of them, from ``entry_rows``.

    ``late``: columns that markers alone have; ``gathered``: a column whose different values are kept as an array.
    """
    names = [f"s{i}" for i in range(n)]
    firsts = [F.first(c, ignorenulls=True).alias(c) for c in late]
    sets, flat = [], []
    if gathered:
        sets, flat = [F.collect_set(gathered).alias(gathered)], [F.flatten(F.collect_list(gathered)).alias(gathered)]
    per_class = entries.groupBy(*carried, "label_idx").agg(
        *[F.sum(s).alias(s) for s in names], F.sum("_m").alias("_m"), *firsts, *sets)
    per_row = per_class.groupBy(*carried).agg(
        F.sum("_m").alias("_m"), *firsts, *flat, F.sum(F.when(F.col("label_idx") < 0, F.col("s0"))).alias("_len"),
        F.collect_list(F.when(F.col("label_idx") >= 0, F.struct("label_idx", *names))).alias("_sums"))
    shares = ", ".join(f"x.{s} div _m AS {s}" for s in names)
    more = [*late, *([gathered] if gathered else [])]
    return _checked(per_row, ROW in carried).select(*carried, *more, F.expr("_len div _m").alias("_len"), F.expr(
        f"transform(_sums, x -> struct(x.label_idx AS label_idx, {shares}))").alias("_sums"))


def argmax_sparse(sums: DataFrame, priors: Sequence, defaults: Sequence, field: str = "s0") -> Column:
    """Best class of ``entry_sums`` rows as ``struct(ok, score, neg_idx)``.

    A seen class scores at least what its constants alone give (its deltas
    are not negative), so the best over all classes' constants and over the seen classes' sums is
    the best of all.
    """
    return argmax_arrays(literal_array(priors, "bigint"), literal_array(defaults, "bigint"), field)


def argmax_arrays(p: Column, d: Column, field: str = "s0") -> Column:
    """``argmax_sparse`` with the classes' priors and defaults as array columns."""
    length = F.col("_len")

    def score(idx: Column, s: Column) -> Column:
        at = (idx + 1).cast("int")
        return _class_score(F.element_at(p, at), F.element_at(d, at), length, s)

    base = F.array_max(F.transform(p, lambda _, i: candidate(score(i, _zero()), i)))
    seen = F.array_max(F.transform("_sums", lambda x: candidate(score(x["label_idx"], x[field]), x["label_idx"])))
    return F.greatest(base, F.coalesce(seen, base))
