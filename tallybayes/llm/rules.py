"""Quality rules by compression bands (zstandard).

A text is compressed whole and, from two chunks on, in chunks of ``CHUNK`` bytes.  The ratio of compressed to
plain bytes has a band that depends on the length compressed (``BANDS``): ratios below it mean
repetitive text, ratios above it text without the redundancy of language.  A document whose
own ratio is outside its band goes, and so does one with more than ``bad_share`` of its chunks
outside theirs (a repeated or random stretch in a long text hardly moves the whole ratio).

Before that, plain counts are taken over the whole text: words (runs of other than space and 0x09-0x0D, case kept),
their code points, symbols, repeated lines, and words in three-word windows that the text
holds twice or more.  Texts of under ``least_words`` words and those with more than half
of their words in repeated windows fail without regard to the bands.

Each task works on blocks of its own rows; nothing is shuffled.  Words and windows are compared by 64-bit
hashes within one text.  Defined cases: a null text counts as empty, has ratio 0 and fails; repeated rows are
judged one by one; a row without an id keeps its null; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybayes.llm import textnum

#: ``(least bytes, lowest ratio, highest ratio)``: short texts compress worse, and frame headers weigh more.
BANDS = ((0, 0.50, 2.00), (64, 0.45, 1.20), (128, 0.40, 1.00), (256, 0.36, 0.86), (512, 0.32, 0.78),
         (1024, 0.28, 0.72), (2048, 0.24, 0.67), (4096, 0.20, 0.63), (16384, 0.16, 0.61), (65536, 0.13, 0.60))
CHUNK = 4096
LEVEL = 3
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_BYTE = np.random.default_rng(31).integers(1, 2**64 - 1, 256, dtype=np.uint64)  # cases differ, unlike textnum's
SCHEMA = ("id {0}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "ratio double, n_chunks bigint, n_bad_chunks bigint, in_band boolean")


def outside(ratio: float, length: int, bands: Sequence[tuple] = BANDS) -> bool:
    """Whether a ratio is outside the band of texts of ``length`` bytes."""
    _, low, high = max(b for b in bands if b[0] <= length)
    return not low <= ratio <= high


def compression(text: bytes, press, chunk: int = CHUNK, bands: Sequence[tuple] = BANDS) -> tuple[float, int, int]:
    """``(ratio, chunks, chunks outside their band)`` of one text; the last chunk takes what is left over."""
    if not text:
        return 0.0, 0, 0
    whole = len(press(text)) / len(text)
    n = len(text) // chunk
    if n < 2:
        return whole, 0, 0
    bad = 0
    for i in range(n):
        part = text[i * chunk:(i + 1) * chunk if i < n - 1 else len(text)]
        bad += outside(len(press(part)) / len(part), len(part), bands)
    return whole, n, bad


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _words(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a buffer whose rows begin at ``rows``."""
    kind = textnum.WORDS[data] != 0
    first = kind.copy()
    first[1:] &= ~kind[:-1]
    rows = rows[rows < len(data)]
    first[rows] = kind[rows]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    ends = np.r_[starts, len(data)]
    at = np.arange(len(data)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, ends]))
    powers = np.cumprod(np.full(int(at.max()) + 1, textnum._P, np.uint64))
    return textnum.mix(np.add.reduceat(np.where(kind, _BYTE[data] * powers[at], np.uint64(0)), starts)), starts


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """One long text in pieces of some ``PIECE`` bytes, cut behind white space (a longer word stays whole)."""
    at = 0
    while at < len(data):
        cut = min(at + textnum.PIECE, len(data))
        while cut < len(data) and textnum.WORDS[data[cut - 1]]:
            ahead = np.flatnonzero(textnum.WORDS[data[cut:cut + textnum.PIECE]] == 0)
            cut = cut + int(ahead[0]) + 1 if len(ahead) else min(cut + textnum.PIECE, len(data))
        yield data[at:cut]
        at = cut


def word_counts(offsets: np.ndarray, data: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, ...]:
    """``(words, code points in words, symbols, words in repeated windows)`` of rows ``lo..hi``."""
    base = offsets[lo]
    rows, mine = offsets[lo:hi] - base, data[base:offsets[hi]]
    if hi - lo == 1 and len(mine) > textnum.PIECE:
        h = np.concatenate([_words(p, np.zeros(1, np.int64))[0] for p in _pieces(mine)])
        ends = np.array([0, len(h)])
    else:
        h, starts = _words(mine, rows)
        ends = np.r_[np.searchsorted(starts, rows), len(h)]
    edge = np.r_[rows, len(mine)]

    def per_row(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flag, dtype=np.int64)][at])

    chars = per_row((textnum.WORDS[mine] != 0) & ((mine & 0xC0) != 0x80), edge)
    symbols = per_row(SYMBOLS[mine], edge)
    inside = np.zeros(len(h), bool)
    row = np.repeat(np.arange(hi - lo), np.diff(ends))
    if len(h) >= 3:
        window = textnum.mix((h[:-2] * textnum._P + h[1:-1]) * textnum._P + h[2:])
        window = textnum.mix(window + (row[2:].astype(np.uint64) + np.uint64(1)) * textnum.GAMMA)
        at = np.flatnonzero(row[:-2] == row[2:])
        _, kind, n = np.unique(window[at], return_inverse=True, return_counts=True)
        twice = at[n[kind] > 1]
        for i in range(3):
            inside[twice + i] = True
    return np.diff(ends), chars, symbols, per_row(inside, ends)


def text_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50,
               bands: Sequence[tuple] = BANDS, chunk: int = CHUNK, bad_share: float = 0.25) -> DataFrame:
    """One row per input row: ``(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio,
    n_chunks, n_bad_chunks, in_band, base_failed, kept)``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress
        for batch in batches:
            offsets, data = textnum.text_buffers(batch.column(1))
            for lo, hi in textnum.blocks(offsets):
                words = word_counts(offsets, data, lo, hi)
                found = []
                for a, b in zip(offsets[lo:hi], offsets[lo + 1:hi + 1]):
                    text = data[a:b].tobytes()
                    ratio, n, bad = compression(text, press, chunk, bands)
                    found.append((repeated_lines(text), ratio, n, bad,
                                  not outside(ratio, len(text), bands) and bad <= bad_share * n))
                lines, ratio, n, bad, fine = zip(*found)
                columns = [*words[:3], np.array(lines, np.int64), words[3], np.array(ratio, float),
                           np.array(n, np.int64), np.array(bad, np.int64), np.array(fine, bool)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *map(pa.array, columns)], names)

    found = src.mapInArrow(run, SCHEMA.format(kind)).withColumn("base_failed", (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return found.withColumn("kept", ~F.col("base_failed") & F.col("in_band")).withColumnRenamed("id", id_col)
