"""Benchmark decontamination by greedy string tiling (Wise, 1993; Karp-Rabin seeds).

Documents are searched for the passages of a benchmark's items.  Words are
lower-cased runs of letters and digits.  An item and a document that share a
seed (``seed`` words in a row, found by hash) are tiled: the longest common
run of words that no tile covers yet becomes a tile, again and again, until no
run of ``seed`` words is left.  The share of the item's words under tiles decides, so a
passage whose parts were put in another order is caught as well.  An item
shorter than ``seed`` words must occur as a whole.

The benchmark is the query set: its items are read in blocks of at most
``block_words`` words (a longer item is a block of its own), each block is sent to
all tasks, and each task runs over its own documents, whole texts, with no shuffle.

Defined cases: null, empty or word-less texts and items match nothing; repeated
items and documents each give their own rows; a row without an id keeps its
null; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybayes.llm import textnum
from tallybayes.llm.storage import row_key, without_rows

SEED, COVERAGE = 5, 0.5
#: Only letters, digits and bytes over 127 make words.
LETTERS = np.where(textnum.WORD_PUNCT == 1, 1, 0).astype(np.uint8)
LETTERS[:32] = 0
LETTERS[127] = 0


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin fingerprints of all runs of ``n`` words."""
    acc = h[:len(h) - n + 1].copy()
    for j in range(1, n):
        acc = acc * textnum._P + h[j:len(h) - n + 1 + j]
    return textnum.mix(acc)


def tile(item: np.ndarray, doc: np.ndarray, seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(item start, doc start, length)`` of two word sequences.

    ``seeds``: all (i, j) where ``least`` words agree.  Each diagonal's seeds make
    maximal matches; the longest is taken first, and one that a tile has
    meanwhile cut is put back with its free parts.
    """
    import heapq

    heap = []
    for i, j in sorted(seeds, key=lambda s: (s[1] - s[0], s[0])):
        if heap and heap[-1][2] - heap[-1][1] == j - i and i <= heap[-1][1] - heap[-1][0] - least + 1:
            n, a, b = heap[-1]
            heap[-1] = (-(i + least - a), a, b)
        else:
            heap.append((-least, i, j))
    heapq.heapify(heap)
    in_item, in_doc, tiles = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    while heap:
        n, a, b = heapq.heappop(heap)
        taken = in_item[a:a - n] | in_doc[b:b - n]
        if not taken.any():
            in_item[a:a - n] = in_doc[b:b - n] = True
            tiles.append((a, b, -n))
            continue
        edges = np.flatnonzero(np.diff(np.r_[True, taken, True].astype(np.int8)))
        for lo, hi in zip(edges[::2], edges[1::2]):
            if hi - lo >= least:
                heapq.heappush(heap, (-int(hi - lo), a + int(lo), b + int(lo)))
    return tiles


def _word_lists(col: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    offsets, data = textnum.text_buffers(col)
    for lo, hi in textnum.blocks(offsets):
        h, ends = textnum.word_hashes(offsets, data, lo, hi, LETTERS)
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            yield lo + i, h[a:b]


def _hits(h: np.ndarray, grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], sizes: np.ndarray,
          coverage: float) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """The items whose seeds in the words ``h`` reach over ``coverage`` of them, each with its ``(i, j)``.

    Tiles cover only words that lie in a seed found, so an item whose found seeds together
    reach over fewer words is left out before its pairs are listed.  A phrase that many
    items share thus costs a count an item.
    """
    for n, (value, item, place) in grams.items():
        if len(h) < n:
            continue
        g = _runs(h, n)
        kinds, back = np.unique(g, return_inverse=True)
        left, right = np.searchsorted(value, kinds), np.searchsorted(value, kinds, side="right")
        lengths = right - left
        if not lengths.any():
            continue
        kind = np.repeat(np.arange(len(kinds)), lengths)
        entry = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + left[kind]
        order = np.lexsort((place[entry], item[entry]))
        own, at, kind = item[entry][order], place[entry][order], kind[order]
        gap = np.full(len(own), n)
        same = own[1:] == own[:-1]
        gap[:-1][same] = np.minimum(at[1:] - at[:-1], n)[same]
        starts = np.flatnonzero(np.r_[True, ~same])
        reach = np.add.reduceat(gap, starts)
        ends = np.r_[starts[1:], len(own)]
        enough = np.flatnonzero(reach >= coverage * sizes[own[starts]])
        if not len(enough):
            continue
        by_kind = np.argsort(back, kind="stable")
        first = np.searchsorted(back[by_kind], np.arange(len(kinds) + 1))
        for x in enough:
            yield int(own[starts[x]]), [(int(at[y]), int(j)) for y in range(starts[x], ends[x])
                                        for j in by_kind[first[kind[y]]:first[kind[y] + 1]]]


def _item_blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[object, np.ndarray]]]:
    block, words = [], 0
    for r in items.toLocalIterator():
        for _, h in _word_lists(pa.array([r["text"]], pa.string())):
            if len(h):
                if block and words + len(h) > block_words:
                    yield block
                    block, words = [], 0
                block.append((r["id"], h))
                words += len(h)
    if block:
        yield block


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", coverage: float = COVERAGE, seed: int = SEED,
                 block_words: int = 2_000_000) -> DataFrame:
    """``(id_col, item_col, item_words, covered_words, coverage, tiles)`` of each document
    and item whose tiles cover ``coverage`` of the item."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    queries = items.select(F.col(item_col).alias("id"), F.col(item_text).alias("text"))
    schema = (f"{id_col} {src.schema['id'].dataType.simpleString()}, {item_col} "
              f"{queries.schema['id'].dataType.simpleString()}, item_words bigint, covered_words bigint, "
              "coverage double, tiles array<struct<item_start:bigint,doc_start:bigint,length:bigint>>")

    def search(block: list[tuple[object, np.ndarray]]) -> DataFrame:
        grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({min(seed, len(h)) for _, h in block}):
            own = [(k, _runs(h, n)) for k, (_, h) in enumerate(block) if min(seed, len(h)) == n]
            value = np.concatenate([g for _, g in own])
            order = np.argsort(value, kind="stable")
            grams[n] = (value[order], np.concatenate([np.full(len(g), k) for k, g in own])[order],
                        np.concatenate([np.arange(len(g)) for _, g in own])[order])
        told = spark.sparkContext.broadcast((block, grams, np.array([len(h) for _, h in block])))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, grams, sizes = told.value
            for batch in batches:
                out = []
                for row, h in _word_lists(batch.column(1)):
                    for k, seeds in _hits(h, grams, sizes, coverage):
                        words = block[k][1]
                        tiles = tile(words, h, seeds, min(seed, len(words)))
                        covered = sum(t[2] for t in tiles)
                        if covered >= coverage * len(words):
                            out.append((row, block[k][0], len(words), covered, covered / len(words), tiles))
                if out:
                    rows, names, total, covered, share, tiles = zip(*out)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(rows)), pa.array(names), pa.array(total, pa.int64()),
                        pa.array(covered, pa.int64()), pa.array(share, pa.float64()),
                        pa.array([[dict(zip(("item_start", "doc_start", "length"), t)) for t in ts] for ts in tiles],
                                 pa.list_(pa.struct([("item_start", pa.int64()), ("doc_start", pa.int64()),
                                                     ("length", pa.int64())])))],
                        [id_col, item_col, "item_words", "covered_words", "coverage", "tiles"])

        return src.mapInArrow(run, schema)

    found = None
    for block in _item_blocks(queries, block_words):
        found = search(block) if found is None else found.union(search(block))
    return spark.createDataFrame([], schema) if found is None else found


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is covered; judged row by row, whatever their ids."""
    rows = docs.select(row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    return without_rows(docs, id_col, text_col, contaminated(rows, items, "row", "text").select("row"))
