"""Packing token sequences: best-fit decreasing with a segment tree.

Each task tokenizes its own split and packs it; nothing is shuffled, and a task
holds its split's ids (two bytes each for a vocabulary up to 65,536).  A document longer than a window
is first cut into full windows.  The rests are placed from the longest down, each
in the open window with the least room that fits, found in a segment tree over
the number of open windows by remaining room.

A window is padded to ``size`` unless its tokens are a power of two.  Windows
left with more room than ``slack`` are opened again: their pieces are laid end
to end and cut into full windows, and what is left at a task's end into windows of
powers of two, which aren't padded.

Defined cases: a null or empty text is the end id alone; repeated rows are packed
one by one; a row without an id keeps its null; extra columns are ignored;
``sequence_id`` is the task's number times 2**40 and the window's number.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = 0
# Fixed value: the pattern that byte-level BPE files of this kind split words by.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = ("id {0}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def fast_encoder(tokenizer_path: str):
    """The tokenizer's byte-level BPE for ``tiktoken``, or None for another kind.

    Both libraries give the same ids for such a file, tiktoken in a fifth of the time.
    """
    import json

    import tiktoken

    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if (model["type"], pre.get("type"), pre.get("add_prefix_space"), spec.get("normalizer")) != ("BPE", "ByteLevel", False, None) \
            or not pre.get("use_regex", True) or model.get("unk_token") or model.get("dropout"):
        return None
    # the printable stand-ins of bytes: printable Latin-1 stands for itself, the rest for 256, 257, ...
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*own}))}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
    # merges must be ranked as their results are numbered
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(made):
        return None
    return tiktoken.Encoding("from_file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


class Tokens:
    """Token ids as ``tokenizers`` gives them for a file (add_special_tokens=False).

    Each task compares the fast encoder's ids with those of ``tokenizers`` on its
    first texts, and uses ``tokenizers`` for all if they differ, for texts
    that have a very long run without a change of kind, and where there is no fast encoder.
    """

    def __init__(self, path: str, trial: int = 16):
        from tokenizers import Tokenizer

        self.slow, self.fast, self.trial = Tokenizer.from_file(path), fast_encoder(path), trial
        self.odd = re.compile(r"\s{1000}|\S{1000}")

    def ids(self, text: str) -> list[int]:
        if self.fast is None or self.odd.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        found = self.fast.encode(text, allowed_special="all")
        if self.trial:
            self.trial -= 1
            right = self.slow.encode(text, add_special_tokens=False).ids
            if right != found:
                self.fast = None
            return right
        return found


class RoomTree:
    """Number of open windows by remaining room 0..size, with the least room >= n in O(log size)."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at //= 2

    def tightest(self, n: int) -> int | None:
        at = n + self.leaves
        if self.count[at]:
            return n
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Windows as lists of indices into ``lengths`` (each 1..size)."""
    tree, open_, windows = RoomTree(size), [[] for _ in range(size + 1)], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = tree.tightest(lengths[i])
        if room is None:
            at, room = len(windows), size
            windows.append([])
        else:
            at = open_[room].pop()
            tree.add(room, -1)
        windows[at].append(i)
        open_[room - lengths[i]].append(at)
        tree.add(room - lengths[i], 1)
    return windows


def pack(n_tokens: list[int], size: int, slack: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows of pieces ``(document, start, length)`` for documents of ``n_tokens``."""
    rests = []
    for d, n in enumerate(n_tokens):
        for at in range(0, n - size + 1, size):
            yield [(d, at, size)]
        if n % size:
            rests.append((d, n - n % size, n % size))
    loose = []
    for window in best_fit_decreasing([r[2] for r in rests], size):
        pieces = [rests[i] for i in window]
        used = sum(p[2] for p in pieces)
        if size - used > slack and used & (used - 1):
            loose += pieces
        else:
            yield pieces
    room = sum(p[2] for p in loose)
    window, need = [], 0
    for d, start, length in loose:
        while length:
            if not need:
                need = size if room >= size else 1 << (room.bit_length() - 1)
                room -= need
            take = min(need, length)
            window.append((d, start, take))
            start, length, need = start + take, length - take, need - take
            if not need:
                yield window
                window = []


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   size: int = 1024, slack: int | None = None) -> DataFrame:
    """One row per piece: ``(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset)``."""
    slack = size // 64 if slack is None else slack
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = Tokens(tokenizer_path)
        small = tokens_of.slow.get_vocab_size() <= 1 << 16
        ids: list[np.ndarray] = []
        names, lengths = [], []
        for batch in batches:
            names.append(batch.column(0))
            for cell in batch.column(1):
                tokens = np.array([*tokens_of.ids(cell.as_py() or ""), END], np.uint16 if small else np.uint32)
                lengths.append(len(tokens))
                ids.append(tokens)
        own = TaskContext.get().partitionId() << 40
        names = pa.chunked_array(names, names[0].type).combine_chunks() if names else None
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            doc, start, length, crc, seq, offset = (np.array(c, np.int64) for c in zip(*rows))
            total = np.array(lengths, np.int64)[doc]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [names.take(pa.array(doc)), *(pa.array(c) for c in (start, length, crc, total, seq, offset))],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for w, window in enumerate(pack(lengths, size, slack)):
            offset = 0
            for d, start, length in window:
                crc = zlib.crc32(ids[d][start:start + length].astype("<u4").tobytes())
                rows.append((d, start, length, crc, own + w, offset))
                offset += length
            if len(rows) >= 10_000:
                yield flush()
        if rows:
            yield flush()

    return src.mapInArrow(run, SCHEMA.format(kind)).withColumnRenamed("id", id_col)
