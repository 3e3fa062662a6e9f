"""Ranked lexical search over posting lists with range-maximum tables.

Documents are indexed in shards of some ``SHARD_BYTES`` of text: a table with one row per shard and
term (documents and occurrences as packed integers) and one row per shard with its ids and lengths.
Within a shard documents are numbered by ascending id.

A query's best documents in a shard are found best first.  Every posting list has a sparse table of the
places of its greatest impacts, so the greatest impact of a list in any interval of documents is one
lookup, and the sum of a query's lists bounds the score of every document in the interval.
Intervals with the greatest bounds are taken first: each is split at the document with the greatest single
impact in it, that document is scored, and both sides are bounded anew.  It ends when no interval left can
hold a result.  Intervals are handled in batches, so the work is done in numpy.

The search runs twice over the lists of the queries' terms.  The first run stops after one
batch a shard; the k-th best of all documents that it scored is a lower limit of the k-th best
score.  The second run leaves out all intervals under that limit and is exact.

Only lists of terms in queries are shuffled.  A shard has one list a term, so no key of a join is hot,
and a task's group is one shard and one block of at most ``block_terms`` query terms.

Terms are told apart by a 64-bit hash of their bytes.  Defined cases: a null text has no terms; documents
without an id come last among equal scores; rows that share an id are documents of their own; queries are told apart by
id and text, and repeated ones count once; a query without terms, and one whose terms occur
nowhere, has no results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.llm import textnum
from tallybayes.llm.storage import save

#: Terms are runs of ASCII letters and digits and of all other characters beyond ASCII.
TERMS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)], np.uint8)
SHARD_BYTES, SHARD_DOCS = 1 << 24, 1 << 16
INDEX = ("shard bigint, term bigint, df bigint, docs binary, counts binary, ids array<bigint>, "
         "sizes array<bigint>, n_docs bigint, n_terms bigint")
NAMES = [f.split()[0] for f in INDEX.split(", ")]
FIRST_BATCH, LAST_BATCH = 16, 512


def _postings(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(term, row, occurrences)`` ordered by term, then row, of rows that are in order."""
    order = np.argsort(h, kind="stable")
    h, row = h[order], row[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.r_[at, len(h)])


def _packed(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """One binary cell per list from the lists laid end to end."""
    offsets = np.r_[0, np.cumsum(lengths * values.itemsize)].astype(np.int64)
    cells = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])
    return cells.cast(pa.binary())


class _Shard:
    """Postings of the documents read so far."""

    def __init__(self) -> None:
        self.parts, self.ids, self.sizes, self.bytes, self.rows = [], [], [], 0, 0

    def add(self, ids: pa.Array, h: np.ndarray, ends: np.ndarray, n_bytes: int) -> None:
        n = np.diff(ends)
        self.parts.append(_postings(h, np.repeat(np.arange(self.rows, self.rows + len(n)), n)))
        self.ids.append(ids)
        self.sizes.append(n)
        self.rows += len(n)
        self.bytes += n_bytes

    def close(self, shard: int) -> Iterator[pa.RecordBatch]:
        ids = pa.chunked_array(self.ids, pa.int64()).combine_chunks()
        sizes = np.concatenate(self.sizes).astype(np.int64)
        order = np.lexsort((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        term, row, n = (np.concatenate(c) for c in zip(*self.parts))
        row = place[row]
        # blocks are in order already if the ids are
        by = np.argsort(term, kind="stable") if (place[1:] > place[:-1]).all() else np.lexsort((row, term))
        term, row, n = term[by], row[by], n[by]
        start = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        df = np.diff(np.r_[start, len(term)])
        row = row.astype(np.uint16 if len(sizes) <= 1 << 16 else np.uint32)
        n = n.astype(np.uint16 if len(n) == 0 or n.max() < 1 << 16 else np.uint32)
        list_of = pa.list_(pa.int64())
        ids, sizes = ids.take(pa.array(order)), sizes[order]
        yield pa.RecordBatch.from_arrays([
            pa.array([shard]), pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.binary()),
            pa.array([None], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([sizes], list_of), pa.array([int((sizes > 0).sum())]), pa.array([int(sizes.sum())])], NAMES)
        for a in range(0, len(df), 50_000):
            b = min(a + 50_000, len(df))
            lo, hi = start[a], start[b] if b < len(df) else len(term)
            none = [pa.nulls(b - a, t) for t in (list_of, list_of, pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(b - a, shard)), pa.array(term[start[a:b]].view(np.int64)), pa.array(df[a:b]),
                _packed(row[lo:hi], df[a:b]), _packed(n[lo:hi], df[a:b]), *none], NAMES)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index table of all rows, written to the cluster's shared folder."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 24, _Shard()
        for batch in batches:
            offsets, data = textnum.text_buffers(batch.column(1))
            for lo, hi in textnum.blocks(offsets, min(textnum.BLOCK, shard_bytes)):
                h, ends = textnum.word_hashes(offsets, data, lo, hi, TERMS)
                shard.add(batch.column(0).slice(lo, hi - lo), h, ends, int(offsets[hi] - offsets[lo]))
                if shard.bytes >= shard_bytes or shard.rows >= SHARD_DOCS:
                    yield from shard.close(number)
                    number, shard = number + 1, _Shard()
        if shard.rows:
            yield from shard.close(number)

    return save(src.mapInArrow(run, INDEX), "search-index")


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(q, item, term, reps)`` of different queries; ``q`` is a hash of id and text."""
    src = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).distinct() \
        .select(F.xxhash64("item", F.col("item").isNull(), "text").alias("q"), "item", "text")
    kind = src.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = textnum.text_buffers(batch.column(2))
            for lo, hi in textnum.blocks(offsets):
                h, ends = textnum.word_hashes(offsets, data, lo, hi, TERMS)
                term, row, n = _postings(h, np.repeat(np.arange(lo, hi), np.diff(ends)))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at),
                                                  pa.array(term.view(np.int64)), pa.array(n)], ["q", "item", "term", "reps"])

    return src.mapInArrow(run, f"q bigint, item {kind}, term bigint, reps bigint")


class PostingLists:
    """A shard's lists laid end to end, with a sparse table of the places of greatest impacts."""

    def __init__(self, starts: np.ndarray, rows: np.ndarray, impacts: np.ndarray, n_docs: int):
        self.starts, self.rows, self.impacts, self.n_docs = starts, rows, impacts, n_docs
        lengths = np.diff(starts)
        self.keys = np.repeat(np.arange(len(lengths)) * n_docs, lengths) + rows
        best = np.arange(len(rows), dtype=np.int32)
        self.levels = [best]
        for k in range(int(lengths.max(initial=1)).bit_length() - 1):
            # an entry that reaches past its list's end is never looked up
            near, far = self.levels[-1][:-(1 << k)], self.levels[-1][1 << k:]
            best = self.levels[-1].copy()
            best[:len(near)] = np.where(impacts[far] > impacts[near], far, near)
            self.levels.append(best)

    def greatest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Places of the greatest impacts of ``lo..hi``; -1 where that is empty."""
        n = hi - lo
        found = np.full(lo.shape, -1, np.int64)
        level = np.frexp(n.astype(float))[1] - 1
        for k in np.unique(level[n > 0]):
            at = np.nonzero((level == k) & (n > 0))
            a, b = self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << int(k))]
            found[at] = np.where(self.impacts[b] > self.impacts[a], b, a)
        return found

    def search(self, lists: np.ndarray, weights: np.ndarray, k: int, least: int = 1,
               batches: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(documents, scores)`` of the best ``k`` with ``least`` score or more, best first, ties by number.

        ``batches`` ends the search early; then the documents scored so far are ranked.
        """
        first = np.zeros(1, np.int64)
        lo, hi = self.starts[lists][None], self.starts[lists + 1][None]
        heap = self._bounded(first, first + self.n_docs, lo, hi, weights)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        size, limit, last = FIRST_BATCH, least, self.n_docs
        while True:
            left, bound = heap[0], heap[4]
            alive = (bound > limit) | ((bound == limit) & (left <= last))
            heap = [x[alive] for x in heap]
            if not len(heap[0]) or batches == 0:
                break
            batches = None if batches is None else batches - 1
            if len(heap[0]) > size:
                cut = np.argpartition(-heap[4], size)
                taken, heap = [x[cut[:size]] for x in heap], [x[cut[size:]] for x in heap]
            else:
                taken, heap = heap, [x[:0] for x in heap]
            size = min(2 * size, LAST_BATCH)
            left, right, lo, hi, _, split = taken
            at = np.searchsorted(self.keys, lists[None] * self.n_docs + split[:, None])
            here = (at < hi) & (self.rows[np.minimum(at, len(self.rows) - 1)] == split[:, None])
            score = np.where(here, self.impacts[np.minimum(at, len(self.rows) - 1)] * weights, 0).sum(axis=1)
            docs, scores = np.r_[docs, split], np.r_[scores, score]
            best = np.lexsort((docs, -scores))[:k]
            best = best[scores[best] >= least]
            docs, scores = docs[best], scores[best]
            if len(docs) == k:
                limit, last = int(scores[-1]), int(docs[-1])
            sides = [self._bounded(left, split, lo, at, weights), self._bounded(split + 1, right, at + here, hi, weights)]
            heap = [np.concatenate(x) for x in zip(heap, *sides)]
        return docs, scores

    def _bounded(self, left: np.ndarray, right: np.ndarray, lo: np.ndarray, hi: np.ndarray, weights: np.ndarray) -> list:
        """Intervals ``left..right`` with their lists' ranges, bounds and documents to split at."""
        best = self.greatest(lo, hi)
        value = np.where(best >= 0, self.impacts[best] * weights, 0)
        top = np.take_along_axis(best, value.argmax(axis=1)[:, None], 1)[:, 0]
        bound = value.sum(axis=1)
        return [x[bound > 0] for x in (left, right, lo, hi, bound, self.rows[top])]


def _search_shards(lists: DataFrame, docs: DataFrame, uses: DataFrame, n_all: int, l_all: int, k: int, n_blocks: int,
                   batches: int | None) -> DataFrame:
    """``(block, q, doc_id, score)``: the best ``k`` documents of each shard and query."""
    spark = lists.sparkSession
    told = lists.join(uses, ["block", "term"]).select("shard", "block", "df", "docs", "counts", "w", "uses",
                                                      F.lit(None).cast("array<bigint>").alias("ids"),
                                                      F.lit(None).cast("array<bigint>").alias("sizes"))
    own = docs.select("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))).alias("block"),
                      *[F.lit(None).cast(told.schema[c].dataType).alias(c) for c in ("df", "docs", "counts", "w", "uses")],
                      "ids", "sizes")
    # as many tasks as the session's shuffles have: the rows are few against the work on them
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = key[1].as_py()
        head = table.filter(pc.is_valid(table["ids"]))
        rest = table.filter(pc.is_valid(table["df"]))
        found: list[tuple] = []
        if rest.num_rows and head.num_rows:
            sizes = head["sizes"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            m = 75 + 25 * sizes * n_all // l_all
            df = rest["df"].to_numpy()
            read = [(np.frombuffer(d, np.uint16 if len(d) == 2 * n else np.uint32),
                     np.frombuffer(c, np.uint16 if len(c) == 2 * n else np.uint32))
                    for d, c, n in zip(rest["docs"].to_pylist(), rest["counts"].to_pylist(), df.tolist())]
            rows = np.concatenate([r[0] for r in read]).astype(np.int64)
            tf = np.concatenate([r[1] for r in read]).astype(np.int64)
            index = PostingLists(np.r_[0, np.cumsum(df)], rows, 1_000_000_000 * tf // (1000 * tf + 12 * m[rows]), len(sizes))
            weight = rest["w"].to_numpy()
            queries: dict[int, tuple[list, list, int]] = {}
            for i, use in enumerate(rest["uses"].to_pylist()):
                for u in use:
                    lists_of, reps, _ = queries.setdefault(u["q"], ([], [], u["least"]))
                    lists_of.append(i)
                    reps.append(u["reps"])
            ids = head["ids"].combine_chunks().flatten()
            for q, (lists_of, reps, least) in queries.items():
                at = np.array(lists_of)
                best, scores = index.search(at, weight[at] * np.array(reps), k, max(least, 1), batches)
                if len(best):
                    found.append((q, ids.take(pa.array(best)), scores))
        n = [len(f[2]) for f in found]
        return pa.table({
            "block": pa.array(np.full(sum(n), block, np.int64)),
            "q": pa.array(np.repeat(np.array([f[0] for f in found], np.int64), n)),
            "doc_id": pa.chunked_array([f[1] for f in found], pa.int64()),
            "score": pa.array(np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64))})

    return told.union(own).repartition(parts, "shard", "block").groupBy("shard", "block") \
        .applyInArrow(run, "block bigint, q bigint, doc_id bigint, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", index: DataFrame | None = None,
                  block_terms: int = 200_000) -> DataFrame:
    """``(item_col, rank, id_col, score)``: each query's ``k`` best documents with a score above 0.

    ``index``: as ``build_index`` gives it, to be used again for other queries.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col) if index is None else index
    heads = index.filter(F.col("term").isNull())
    n_all, l_all = heads.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    asked = save(query_terms(items, item_col, item_text_col), "search-queries")
    n_blocks = max(1, -(-asked.count() // block_terms))
    asked = asked.withColumn("block", F.pmod("q", F.lit(n_blocks)).cast("bigint"))
    lists = save(index.filter(F.col("term").isNotNull()).join(asked.select("block", "term").distinct(), "term")
                 .select("shard", "block", "term", "df", "docs", "counts"), "search-lists")
    weights = lists.groupBy("block", "term").agg(F.sum("df").alias("df")).select("block", "term", F.floor(
        1000 * F.log(F.lit(2.0 * n_all + 2) / (2 * F.col("df") + 1))).cast("bigint").alias("w"))
    weights = save(weights, "search-weights")

    def uses(queries: DataFrame) -> DataFrame:
        by_term = queries.groupBy("block", "term").agg(F.collect_list(F.struct("q", "reps", "least")).alias("uses"))
        return by_term.join(weights, ["block", "term"])

    def best(found: DataFrame, order: list) -> DataFrame:
        by_query = Window.partitionBy("block", "q").orderBy(F.desc("score"), *order)
        return found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)

    args = (n_all, max(l_all, 1), k, n_blocks)
    trial = _search_shards(lists, heads, uses(asked.withColumn("least", F.lit(1).cast("bigint"))), *args, batches=1)
    limits = best(trial, []).filter(F.col("rank") == k).select("block", "q", F.col("score").alias("least"))
    limited = asked.join(limits, ["block", "q"], "left").withColumn("least", F.coalesce("least", F.lit(1).cast("bigint")))
    found = _search_shards(lists, heads, uses(limited), *args, batches=None)
    names = asked.select("block", "q", "item").distinct()
    return best(found, [F.asc_nulls_last("doc_id")]).join(names, ["block", "q"]).select(
        F.col("item").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
