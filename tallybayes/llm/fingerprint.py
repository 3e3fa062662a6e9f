"""Document fingerprints: a homomorphic multiset hash of paragraphs (native).

A document is a multiset of paragraphs (lines; a longer line counts in pieces of
``WORDS`` words).  Each paragraph is hashed to a wide vector of ``LANES`` entries +1 or -1,
and the fingerprint is their sum, every lane modulo 2**16.  Sums don't depend on
the order of paragraphs, and adding or subtracting a paragraph's vector inserts or
deletes it.  Equal multisets have equal sums; the cosine of two sums estimates how
much two multisets have in common.

While summing, two lanes share one 64-bit word, 32 bits each, so a document may have
2**31 paragraphs; +1 or -1 is recovered as 2 * (set bits) - (number of paragraphs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.llm.storage import save

LANES, WORDS = 128, 4
_PAIR = (1 << 32) | 1


def paragraphs(text: Column) -> Column:
    """The pieces of a text; every character but line ends is in exactly one."""
    def pieces(line: Column) -> Column:
        return F.when(line == "", F.array(F.lit(""))).otherwise(
            F.regexp_extract_all(line, F.lit(rf"(?:[^ ]+ *| +){{1,{WORDS}}}"), F.lit(0)))

    return F.flatten(F.transform(F.split(text, "\n", -1), pieces))


def lane_sums(rows: DataFrame, keys: Sequence[str], part: str = "part") -> DataFrame:
    """``(keys…, lanes)``: the vector sums of ``keys``' paragraphs, one paragraph a row."""
    hashed = rows.select(*keys, *[F.xxhash64(F.col(part), F.lit(s)).alias(f"_h{s}") for s in range(LANES // 64)])
    sums = [F.sum(F.shiftrightunsigned(F.col(f"_h{s}"), k).bitwiseAND(F.lit(_PAIR))).alias(f"_w{s}_{k}")
            for s in range(LANES // 64) for k in range(32)]
    words = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *sums)
    lane = []
    for s in range(LANES // 64):
        for k in range(32):
            w = F.col(f"_w{s}_{k}")
            lane += [w.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(w, 32)]
    return words.select(*keys, F.array(*[(2 * x - F.col("_n")).cast("int") for x in lane]).alias("lanes"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The lanes of two documents together (or, with -1, of one without the other)."""
    return F.zip_with(a, b, lambda x, y: x + sign * y)


def digest(lanes: Column) -> Column:
    """The fingerprint as hex: four digits a lane, modulo 2**16."""
    return F.concat_ws("", F.transform(lanes, lambda v: F.lpad(F.lower(F.hex(v.bitwiseAND(F.lit(0xFFFF)))), 4, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two lane vectors within 0..1; 1 for equal ones."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("bigint") * q), F.lit(0).cast("bigint"), lambda s, v: s + v)

    size = F.sqrt(dot(a, a).cast("double")) * F.sqrt(dot(b, b).cast("double"))
    return F.when(a == b, 1.0).when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / size))).otherwise(0.0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_chars, fingerprint, lanes)``, one row per document.

    Rows that repeat id and text are one document and give one row.
    """
    keyed = _keyed(docs, id_col, text_col)
    parts = keyed.dropDuplicates(["k1", "k2"]).select("k1", "k2", "id", "n_chars", F.explode(paragraphs(F.col("text"))).alias("part"))
    return lane_sums(parts, ["k1", "k2", "id", "n_chars"]).select(
        F.col("id").alias(id_col), "n_chars", digest(F.col("lanes")).alias("fingerprint"), "lanes")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents with a key of id and text that is never null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        F.xxhash64("id", F.col("id").isNull(), "text").alias("k1"),
        F.xxhash64("text", "id", F.lit(1)).alias("k2"), "id", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def _sequence(keyed: DataFrame) -> DataFrame:
    """``(k1, k2, id, n_chars, copies, at, n)``: documents numbered by ascending id from 0.

    A range sort numbers rows within its tasks; one count per task gives the offsets.
    """
    rows = keyed.groupBy("k1", "k2").agg(F.first("id").alias("id"), F.first("n_chars").alias("n_chars"),
                                         F.count(F.lit(1)).alias("copies"))
    placed = save(rows.orderBy("id", "k1", "k2").withColumn("place", F.monotonically_increasing_id()), "sequence")
    placed = placed.withColumn("task", F.shiftright("place", 33)).withColumn("row", F.col("place").bitwiseAND((1 << 33) - 1))
    # a row per task of the sort: small whatever the table's size
    counts = [(r["task"], r["c"]) for r in placed.groupBy("task").agg(F.count(F.lit(1)).alias("c")).orderBy("task").collect()]
    offsets, total = {}, 0
    for task, c in counts:
        offsets[task], total = total, total + c
    spark = keyed.sparkSession
    table = spark.createDataFrame(list(offsets.items()), "task bigint, first bigint")
    return placed.join(F.broadcast(table), "task").select(
        "k1", "k2", "id", "n_chars", "copies", (F.col("first") + F.col("row")).alias("at"), F.lit(total).cast("bigint").alias("n"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of an edited one, and their likeness.

    The edited text replaces the last quarter (floor) of a text's code points by the
    first as many of the next document's text, by ascending id; after the last comes the
    first.  Null texts are empty; a null id comes before others; documents of one id
    follow each other in the order of a hash; rows that repeat id and text are one document,
    and its result row is repeated as often.  Extra columns are ignored.
    """
    keyed = _keyed(docs, id_col, text_col)
    order = save(_sequence(keyed), "order")
    # each document with the key and the wanted length of the one before it
    before = order.select(((F.col("at") + 1) % F.col("n")).alias("at"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                          F.floor(F.col("n_chars") / 4).cast("int").alias("wanted"))
    links = order.join(before, "at")
    # the one shuffle of whole texts: all uses below read the same exchange
    texts = keyed.select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
    placed = texts.join(links, ["k1", "k2"])
    heads = placed.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.substring("text", F.lit(1), F.col("wanted")).alias("head"))
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    edited = placed.join(heads, ["k1", "k2"]).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), kept), "head"))
    carried = ["k1", "k2", "id", "n_chars", "at", "n", "copies"]
    own = lane_sums(texts.select("k1", "k2", F.explode(paragraphs(F.col("text"))).alias("part")), ["k1", "k2"])
    new = lane_sums(edited.withColumn("sha", F.sha2("edited", 256)).select(
        *carried, "sha", F.explode(paragraphs(F.col("edited"))).alias("part")), [*carried, "sha"])
    both = save(own.join(new.withColumnRenamed("lanes", "edited_lanes"), ["k1", "k2"]), "lanes")
    following = both.select(((F.col("at") - 1 + F.col("n")) % F.col("n")).alias("at"), F.col("lanes").alias("next_lanes"))
    return both.join(following, "at").withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.col("id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"),
        digest(F.col("lanes")).alias("fingerprint"), digest(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"))
