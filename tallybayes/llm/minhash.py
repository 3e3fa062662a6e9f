"""Near-duplicate groups by SuperMinHash, banding, verification and components.

SuperMinHash (Ertl, 2017): each element visits the signature's slots in an
order of its own (a Fisher-Yates permutation) and brings at its j-th visit a
value in [j, j+1).  The ranks of one element are thus spread over the slots,
which lowers the variance, and a set stops once no slot holds a value above
the next rank.  numpy runs one rank of all sets of a block at a time.

Steps, each a Spark job over the whole table:

1. one pass over the texts: set size, a 128-bit digest of the set and the bands;
2. rows with equal sets are one class, and its smallest id stands for it;
3. members of a band's bucket are compared with one hub, the member whose buckets hold
   most rows (an outlier with a small id shares few buckets); verified links merge components, and only members of a bucket that are in
   different components are compared further, with all members of other components that an exact
   bound leaves (``_rest``).  No pair of one component is ever listed;
4. every compared pair is verified on the whole sets.

Defined cases: a null, empty or word-less text has no shingles and is linked
with nothing.  Rows that share an id are one node and are linked if any of
their texts is.  A row without an id is never linked and is kept.  Extra columns
are ignored by ``near_duplicates`` and carried along by ``drop_near_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.llm import textnum
from tallybayes.llm.graph import connected_components
from tallybayes.llm.storage import fresh, save

ROWS, BANDS = 6, 40
#: Members of a family in one slot, and the parts in which a family's members are counted.
SLOT_ROWS, DEALS = 512, 64
_RANK = np.uint64(48)


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """One row of ``m`` values (rank << 48 | fraction) for each non-empty set."""
    n = np.array([len(s) for s in sets], np.int64)
    slots = np.full((len(sets), m), ~np.uint64(0), np.uint64)
    elems = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), n)
    perm = None
    for rank in range(m):
        draw = textnum.mix(elems + textnum.step(rank + 1))
        value = (np.uint64(rank) << _RANK) | (draw >> np.uint64(16))
        pick = (textnum.mix(draw ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32))
        k = rank + ((pick * np.uint64(m - rank)) >> np.uint64(32)).astype(np.int64)
        if rank == 0:
            slot = k
        else:
            if perm is None:
                perm = np.broadcast_to(np.arange(m, dtype=np.uint16), (len(elems), m)).copy()
                perm[line, first], perm[:, 0] = 0, first
            slot = perm[line, k].astype(np.int64)
            perm[line, k] = perm[:, rank]
        np.minimum.at(slots.reshape(-1), owner * m + slot, value)
        going = (slots.max(axis=1) >> _RANK) > rank
        stay = going[owner]
        if not stay.any():
            break
        if rank == 0:
            first = k[stay].astype(np.uint16)
        elif not stay.all():
            perm = perm[stay]
        if rank == 0 or not stay.all():
            elems, owner = elems[stay], owner[stay]
        line = np.arange(len(elems))
    return slots


def band_hashes(slots: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = slots.reshape(len(slots), bands, rows)
    acc = np.broadcast_to(np.arange(bands, dtype=np.uint64), part.shape[:2]).copy()
    for r in range(rows):
        acc = textnum.mix(acc * textnum._P + part[:, :, r])
    return acc.view(np.int64)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    offsets, data = textnum.text_buffers(batch.column(1))
    for lo, hi in textnum.blocks(offsets):
        h, ends = textnum.word_hashes(offsets, data, lo, hi)
        yield lo, textnum.shingles(h, ends, k)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int,
               bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(id, n, set_key, bands)`` of every row; the last two null without shingles."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, sets in _sets(batch, k):
                full = [i for i, s in enumerate(sets) if len(s)]
                made = dict(zip(full, band_hashes(
                    superminhash([sets[i] for i in full], bands * rows), bands, rows)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([made.get(i) for i in range(len(sets))], pa.list_(pa.int64())),
                ], ["id", "n", "set_key", "bands"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, n bigint, set_key binary, bands array<bigint>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """``(id, set_key, elems)`` of rows ``(id, text)`` that have shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, sets in _sets(batch, k):
                full = [i for i, s in enumerate(sets) if len(s)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array([lo + i for i in full], pa.int64())),
                    pa.array([_digest(sets[i]) for i in full], pa.binary()),
                    pa.array([sets[i].view(np.int64) for i in full], pa.list_(pa.int64())),
                ], ["id", "set_key", "elems"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, set_key binary, elems array<bigint>")


def _shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` with their sets ``ea``, ``eb`` and the ``shared`` elements' number."""
    return pairs.join(sets.select(F.col("node").alias("b"), F.col("elems").alias("eb")), "b") \
        .join(sets.select(F.col("node").alias("a"), F.col("elems").alias("ea")), "a") \
        .withColumn("shared", F.size(F.array_intersect("ea", "eb")))


def _linked(shared: Column, na: Column, nb: Column, percent: int) -> Column:
    return 100 * shared >= percent * (na + nb - shared)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar enough, judged on whole sets."""
    return _shared(pairs, sets).filter(
        _linked(F.col("shared"), F.size("ea"), F.size("eb"), percent)).select("a", "b")


def _relabel(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after merging those that ``links`` (a, b) connect."""
    at = lambda side: comps.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
    joined = links.join(at("a"), "a").join(at("b"), "b").select("ca", "cb")
    up = connected_components(joined, "ca", "cb").select(F.col("node").alias("comp"), F.col("comp").alias("up"))
    return save(comps.join(up, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "comps")


def _slotted(family: DataFrame) -> DataFrame:
    """Rows ``(fam, node, ..)`` with their family's number of ``slots``, one for each ``SLOT_ROWS``
    members, and their own ``slot``: a family of any size is dealt over tasks of bounded size."""
    dealt = family.withColumn("deal", F.pmod(F.xxhash64("node"), F.lit(DEALS)))
    counts = dealt.groupBy("fam", "deal").agg(F.count(F.lit(1)).alias("c"))
    slots = counts.groupBy("fam").agg(F.ceil(F.sum("c") / F.lit(SLOT_ROWS)).alias("slots"))
    return dealt.join(counts.join(slots, "fam").drop("c"), ["fam", "deal"]).drop("deal") \
        .withColumn("slot", F.pmod(F.xxhash64("node", F.lit(1)), F.col("slots")))


def _spread(table: DataFrame) -> DataFrame:
    """A row of a table by family, repeated in each ``slot`` of the family."""
    return table.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1))).drop("slots")


def _stars(parts: DataFrame, minors: DataFrame, sure: DataFrame) -> DataFrame:
    """Edges that connect what ``sure`` says: all members of a kind are similar to all minor
    members of another.  Each member is tied to one such minor, each minor to one such
    member and, for each two kinds, one to one: as many edges as rows, not as pairs."""
    kind, x_kind = ["n", "i", "u"], ["x_n", "x_i", "x_u"]
    to_minor = _spread(sure.groupBy("fam", "slots", *kind).agg(F.min("x_rep").alias("x_rep")))
    to_member = _spread(sure.groupBy("fam", "slots", *x_kind).agg(F.min("rep").alias("rep")))
    edges = sure.select("rep", "x_rep") \
        .union(parts.join(to_minor, ["fam", "slot", *kind]).select(F.struct("node", "comp"), "x_rep")) \
        .union(minors.join(to_member, ["fam", "slot", *x_kind]).select("rep", F.struct("x_node", "x_comp")))
    return edges.filter("rep.comp != x_rep.comp").select(F.col("rep.node").alias("node"), F.col("x_rep.node").alias("x_node"))


def _rest(placed: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Pairs ``(a, b)`` between components that still share a bucket: those that sizes prove, and a
    function that gives the other candidates between the components left after those.

    A bucket belongs to the family of its largest component.  A family has a
    reference set r (what half of its members have), and a member x the set
    D(x) of elements in which it differs from r.  Then
    |x & y| = |x & r| + |y & r| - |r| + |D(x) & D(y)|, so a similar pair needs
    |D(x) & D(y)| >= q, and q follows from sizes alone.  Only elements that several
    members' D have (u(x) of them) count, so first the few distinct size kinds of
    a family are compared (q <= min(u)).  Kinds with q <= 0 are similar in all their pairs,
    and star edges connect them (``_stars``); members of the other fitting kinds are
    joined on their u - q + 1 rarest such elements (prefix filter).  All
    bounds are exact, and no pair within a component is listed.
    """
    sizes = placed.groupBy("band", "hash", "comp").agg(F.count(F.lit(1)).alias("c"))
    major = sizes.groupBy("band", "hash").agg(F.max(F.struct("c", "comp")).alias("m")) \
        .select("band", "hash", F.col("m.comp").alias("fam"))
    family = _slotted(save(placed.join(major, ["band", "hash"]).select("fam", "node", "comp").distinct(), "family"))
    family = save(family.join(sets, "node"), "family_sets")
    half = family.groupBy("fam").agg(F.count(F.lit(1)).alias("c"), F.first("slots").alias("slots"))
    ref = family.select("fam", F.explode("elems").alias("e")).groupBy("fam", "e").agg(F.count(F.lit(1)).alias("df")) \
        .join(half, "fam").filter("2 * df >= c").groupBy("fam", "slots").agg(F.collect_list("e").alias("r"))
    parts = save(family.join(_spread(ref), ["fam", "slot"], "left")
                 .withColumn("r", F.coalesce("r", F.array().cast("array<bigint>"))).select(
        "fam", "slot", "slots", "node", "comp", (F.col("comp") != F.col("fam")).alias("minor"), F.size("elems").alias("n"),
        F.size(F.array_intersect("elems", "r")).alias("i"), F.size("r").alias("m"),
        F.concat(F.array_except("elems", "r"), F.array_except("r", "elems")).alias("diff")), "parts")
    marks = parts.select("fam", "node", F.explode("diff").alias("e"))
    marks = marks.join(marks.groupBy("fam", "e").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), ["fam", "e"])
    parts = parts.drop("diff").join(marks.groupBy("fam", "node").agg(F.count(F.lit(1)).alias("u")),
                                    ["fam", "node"], "left").fillna(0, ["u"])
    parts = save(parts, "kinds")
    x_side = [F.col(c).alias(f"x_{c}") for c in ("n", "i", "u")]
    q = F.ceil(F.lit(percent) * (F.col("n") + F.col("x_n")) / F.lit(100 + percent)) \
        - (F.col("i") + F.col("x_i") - F.col("m"))
    one = F.struct("node", "comp")
    kinds = parts.groupBy("fam", "slots", "n", "i", "u", "m").agg(
        F.max("minor").alias("minor"), F.min(one).alias("rep"), F.min(F.when(F.col("minor"), one)).alias("x_rep"))
    fits = save(kinds.drop("x_rep").join(kinds.filter("minor").select("fam", "x_rep", *x_side), "fam").withColumn("q", q)
                .filter(F.col("q") <= F.least("u", "x_u")).drop("minor", "m"), "fits")
    minors = parts.filter("minor").select("fam", "slot", F.col("node").alias("x_node"), F.col("comp").alias("x_comp"), *x_side)
    kind = ["n", "i", "u"]

    def rarest(side: DataFrame, kind: list[str]) -> DataFrame:
        """The elements ``e`` of the members' prefixes."""
        least = _spread(fits.filter("q > 0").groupBy("fam", "slots", *kind).agg(F.min("q").alias("q")))
        node, u = ("x_node", "x_u") if kind[0][0] == "x" else ("node", "u")
        at = F.row_number().over(Window.partitionBy("fam", node).orderBy("df", "e"))
        return side.join(least, ["fam", "slot", *kind]).join(marks.withColumnRenamed("node", node), ["fam", node]) \
            .withColumn("at", at).filter(F.col("at") <= F.col(u) - F.col("q") + 1).drop("at", "df", "q")

    def candidates(comps: DataFrame) -> DataFrame:
        now = lambda node, comp: comps.select(F.col("node").alias(node), F.col("comp").alias(comp))
        members = rarest(parts.drop("comp").join(now("node", "comp"), "node"), kind)
        others = rarest(minors.drop("x_comp").join(now("x_node", "x_comp"), "x_node"), [f"x_{c}" for c in kind])
        return ordered(members.join(others, ["fam", "e"]).filter(
            (F.col("comp") != F.col("x_comp")) & (q > 0) & (q <= F.least("u", "x_u"))))

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("node", "x_node").alias("a"), F.least("node", "x_node").alias("b")).distinct()

    return ordered(_stars(parts, minors, fits.filter("q <= 0"))), candidates


def _merge(comps: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components after the links among ``pairs``."""
    links = save(_verify(pairs, sets, percent), "links")
    return comps if links.isEmpty() else _relabel(comps, links)


def link_classes(classes: DataFrame, docs: DataFrame, k: int, percent: int,
                 hub_rounds: int = 1) -> DataFrame:
    """``(node, comp)`` for classes ``(node, n, set_key, bands)`` that share a bucket."""
    rows = classes.select("node", "n", F.posexplode("bands").alias("band", "hash"))
    shared = rows.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    members = rows.join(shared, ["band", "hash"])
    light = members.groupBy("node").agg((-F.sum("c")).alias("light"))
    members = save(members.drop("c").join(light, "node"), "members")
    nodes = members.select("node").distinct()
    comps = save(nodes.select("node", F.col("node").alias("comp")), "comps")
    wanted = classes.join(nodes, "node", "left_semi").select("node", "set_key")
    texts = docs.join(wanted.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    sets = save(shingle_sets(texts, k).dropDuplicates(["id", "set_key"])
                .join(wanted.withColumnRenamed("node", "id"), ["id", "set_key"])
                .select(F.col("id").alias("node"), "elems"), "sets")
    for done in range(hub_rounds + 1):
        placed = members.join(comps, "node")
        open_ = placed.groupBy("band", "hash").agg(
            F.min(F.struct("light", "node")).alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
            .filter("lo != hi").select("band", "hash", F.col("hub.node").alias("hub"))
        placed = save(placed.join(open_, ["band", "hash"]), "open")
        if done < hub_rounds:
            hubs = placed.filter("node = hub").select(
                "band", "hash", F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp"))
            pairs = placed.filter("node != hub").join(hubs, ["band", "hash"]).filter(
                (F.col("comp") != F.col("hub_comp"))
                & _linked(F.least("n", "hub_n"), F.col("n"), F.col("hub_n"), percent)) \
                .select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
            members = placed.filter("node != hub").select("band", "hash", "node", "n", "light")
        else:
            proven, candidates = _rest(placed, sets, percent)
            comps = _merge(comps, proven, sets, percent)
            pairs = candidates(comps)
        comps = _merge(comps, pairs, sets, percent)
    return comps


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)``, one row per input row."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sig = save(signatures(docs, id_col, text_col, k), "signatures")
    full = sig.filter(F.col("id").isNotNull() & F.col("set_key").isNotNull())
    classes = save(
        full.groupBy("set_key").agg(F.min(F.struct("id", "n", "bands")).alias("r"))
        .select("set_key", F.col("r.id").alias("node"), F.col("r.n").alias("n"), F.col("r.bands").alias("bands")),
        "classes")
    comps = link_classes(classes, src, k, percent)
    # rows without shingles get keys of their own (longer than a digest), not one null
    lone = F.concat(F.lit("no shingles "), F.coalesce(F.xxhash64("id").cast("string"), F.lit("")))
    rows = sig.select("id", "n", F.coalesce("set_key", F.encode(lone, "utf-8")).alias("set_key")) \
        .join(classes.select("set_key", "node"), "set_key", "left") \
        .join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node", "id"))
    rows = save(rows.select("id", "n", F.when(F.col("id").isNotNull(), F.col("comp")).alias("comp")), "rows")
    # ids that repeat with different texts join the components of their texts
    again = rows.filter(F.col("id").isNotNull()).groupBy("id").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("c"))
    more = rows.join(again.filter("c > 1 and lo != hi").select("id", "lo"), "id")
    if not more.isEmpty():
        up = connected_components(more, "comp", "lo").select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        rows = rows.join(up, "comp", "left").select("id", "n", F.coalesce("up", "comp").alias("comp"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                       F.col("comp").alias("component_id"), F.col("id").eqNullSafe(F.col("comp")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                         percent: int = 80) -> DataFrame:
    """The rows of ``docs`` but for those that are near copies of a kept row.

    Where ids are null or repeat, rows are told apart by id and text: one without an id is
    judged like any other (and stands last in its group), and rows that share an id are
    judged each for itself.  Rows equal in id and text are one.
    """
    node, key = fresh(docs, "node", "gone")
    own = F.col(id_col)
    odd = docs.groupBy(own.alias("id")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1 or id is null")
    if not odd.isEmpty():
        own = F.struct(F.col(id_col).isNull().alias("lone"), F.col(id_col).alias("id"),
                       F.xxhash64(F.col(text_col)).alias("text"))
    found = near_duplicates(docs.select(own.alias(node), F.col(text_col).alias("text")), node, "text", k, percent)
    return docs.join(found.filter(~F.col("kept")).select(F.col(node).alias(key)).distinct(), own == F.col(key), "left_anti")
