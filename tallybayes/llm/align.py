"""Alignment of two tokenizers' tokens, each different text once.

Documents are shuffled by their full text and each different text is tokenized and aligned once, with
the number of its copies as weight.  Byte offsets where a token of both tokenizers ends cut
the text into groups; a link is a token of each whose byte ranges overlap.  With all ends of both
in order, every stretch between two neighbouring ends is one link, so a block of texts is aligned
as arrays.

How many documents hold an id pair linked is counted in chunks: a task lays the pairs of its texts
down in chunks of ``CHUNK`` pairs, each with a dictionary of its different pairs and the documents that hold
them, packed, next to the texts' measures.  Only the dictionaries are shuffled to sum the counts.  A
dictionary holds a pair once, so no pair is hot, and each chunk gets the corpus-wide counts of its
own dictionary back, from which its texts' sums follow.  Measures then join the documents by
the SHA-256 of the text; texts with many copies are dealt over slots.

Defined cases: a null or empty text, and one that either tokenizer doesn't give back byte for byte,
has no tokens and zeros; a row without an id keeps its null; repeated rows are documents of
their own and count as such; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybayes.llm import textnum
from tallybayes.llm.packing import fast_encoder
from tallybayes.llm.storage import save

CHUNK, CHUNK_TEXTS = 1 << 21, 1 << 14
#: Texts with at least 1 / HOT_TEXTS of all documents are dealt over slots; there are at most so many of them.
HOT_TEXTS = 10_000
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
CHUNKS = ("chunk bigint, keys array<binary>, copies array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
          "n_links array<bigint>, sha array<string>, ends array<bigint>, places binary, links binary, codes array<bigint>, docs array<bigint>")
CHUNK_NAMES = [f.split()[0] for f in CHUNKS.split(", ")]


class ByteTokens:
    """Ids of a byte-level BPE file, its special tokens being plain text; the fast encoder where it agrees."""

    def __init__(self, path: str, trial: int = 16):
        from tokenizers import Tokenizer

        self.slow, self.fast, self.trial = Tokenizer.from_file(path), fast_encoder(path), trial
        self.slow.encode_special_tokens = True
        self.odd = re.compile(r"\s{1000}|\S{1000}")
        # the printable stand-ins of bytes: printable Latin-1 stands for itself, the rest for 256, 257, ...
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*own}))}
        names = [self.slow.id_to_token(i) or "" for i in range(self.slow.get_vocab_size())]
        self.bytes = [bytes(byte_of[c] for c in n) if all(c in byte_of for c in n) else n.encode() for n in names]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> list[int]:
        if self.fast is None or self.odd.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        found = self.fast.encode_ordinary(text)
        if self.trial:
            self.trial -= 1
            right = self.slow.encode(text, add_special_tokens=False).ids
            if right != found:
                self.fast = None
            return right
        return found


class PieceTokens:
    """Ids of a sentencepiece model, which puts a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                      for i, n in enumerate(names)]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Aligns blocks of texts; built once a task from the tokenizers' paths."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokens(a_path), PieceTokens(b_path)
        self.n_b = len(self.b.bytes)
        self.a_len, self.b_len = (np.array([len(x) for x in t.bytes]) for t in (self.a, self.b))
        ids = [[b"%d" % i for i in range(len(t.bytes))] for t in (self.a, self.b)]
        self.words = [x + end for x, end in [*((x, b",") for x in ids[0]), *((x, b"|") for x in ids[0]),
                                             *((x, b",") for x in ids[1]), *((x, b";") for x in ids[1])]]

    def tokens(self, texts: list[str]) -> tuple[list, list, list[bytes], list[int]]:
        """Ids of both, the bytes of each text with its space, and the texts that both give back."""
        a, b = self.a.ids([" " + t for t in texts]), self.b.ids(texts)
        want = [b" " + t.encode() for t in texts]

        def joined(ids: list[int], table: list[bytes]) -> bytes:
            return b"".join(map(table.__getitem__, ids))

        fine = [i for i, w in enumerate(want) if w != b" " and joined(a[i], self.a.bytes) == w and joined(b[i], self.b.bytes) == w]
        return a, b, want, fine

    def block(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Measures of each text and, by text and in order, its id pairs with their links.

        ``rows``, ``codes``, ``links``: text, pair (A id times B's vocabulary, plus B id) and linked occurrences;
        ``groups``: each text's groups as bytes.
        """
        a, b, want, fine = self.tokens(texts)
        out = {k: np.zeros(len(texts), np.int64) for k in MEASURES[:4]} | {"groups": [b""] * len(texts)}
        if not fine:
            return out | {k: np.zeros(0, np.int64) for k in ("rows", "codes", "links")}
        n_a, n_b = np.array([len(a[i]) for i in fine]), np.array([len(b[i]) for i in fine])
        a, b = (np.concatenate([np.array(x[i], np.int64) for i in fine]) for x in (a, b))
        # texts end to end: their ends are ends of both
        end_a, end_b, end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b]), np.cumsum([len(want[i]) for i in fine])
        mark = np.zeros(int(end[-1]) + 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] += 2
        ends = np.flatnonzero(mark)
        kind = mark[ends]
        is_a, is_b = kind & 1, kind >> 1
        code = a[np.cumsum(is_a, dtype=np.int64) - is_a] * self.n_b + b[np.cumsum(is_b, dtype=np.int64) - is_b]
        n_links = np.diff(np.r_[0, np.searchsorted(ends, end, side="right")])
        row = np.repeat(np.array(fine), n_links)
        cut = ends[kind == 3]
        n_groups = np.diff(np.r_[0, np.searchsorted(cut, end, side="right")])
        for name, values in zip(MEASURES, (n_a, n_b, n_groups, n_links)):
            out[name][fine] = values
        order = np.lexsort((code, row))
        code, row = code[order], row[order]
        at = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])])
        out |= {"rows": row[at], "codes": code[at], "links": np.diff(np.r_[at, len(code)])}
        # each group's A ids, then its B ids, with the sign that follows each
        upto_a, upto_b = np.searchsorted(end_a, cut, side="right"), np.searchsorted(end_b, cut, side="right")
        per_a, per_b = np.diff(np.r_[0, upto_a]), np.diff(np.r_[0, upto_b])
        words = np.zeros(len(a) + len(b), np.int64)
        sign = a.copy()
        sign[upto_a - 1] += len(self.a_len)
        words[np.arange(len(a)) + np.repeat(upto_b - per_b, per_a)] = sign
        sign = b + 2 * len(self.a_len)
        sign[upto_b - 1] += len(self.b_len)
        words[np.arange(len(b)) + np.repeat(upto_a, per_b)] = sign
        written = list(map(self.words.__getitem__, words.tolist()))
        stop = np.cumsum(n_a + n_b).tolist()
        for i, lo, hi in zip(fine, [0, *stop], stop):
            out["groups"][i] = b"".join(written[lo:hi])[:-1]
        return out


def _pack(values: np.ndarray) -> bytes:
    """Integers from 0 in the fewest bytes each that hold all, compressed."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return zstandard.ZstdCompressor(level=1).compress(bytes([kind.itemsize]) + values.astype(kind).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    plain = zstandard.ZstdDecompressor().decompress(packed)
    return np.frombuffer(plain, np.dtype(f"u{plain[0]}"), offset=1).astype(np.int64)


class _Chunk:
    def __init__(self) -> None:
        self.blocks, self.keys, self.copies, self.sha, self.pairs = [], [], [], [], 0

    def add(self, keys: list[bytes], copies: list[int], found: dict) -> None:
        self.blocks.append((found, np.bincount(found["rows"], minlength=len(keys)), np.array(copies)[found["rows"]]))
        self.keys += keys
        self.copies += copies
        self.sha += [hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]]
        self.pairs += len(found["codes"])

    def close(self, number: int) -> pa.RecordBatch:
        joined = {k: np.concatenate([f[k] for f, _, _ in self.blocks]) for k in (*MEASURES[:4], "codes", "links")}
        size, weight = (np.concatenate([b[i] for b in self.blocks]) for i in (1, 2))
        codes, place = np.unique(joined["codes"], return_inverse=True)
        docs = np.zeros(len(codes), np.int64)
        np.add.at(docs, place, weight)
        ends = np.cumsum(size)
        step = np.diff(place, prepend=0)
        first = (ends - size)[size > 0]
        step[first] = place[first]  # a text's pairs are in order, so its steps are positive
        cells = [number, self.keys, self.copies, *(joined[k] for k in MEASURES[:4]), self.sha, ends, _pack(step),
                 _pack(joined["links"]), codes, docs]
        kinds = [pa.int64(), pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), pa.list_(pa.int64()),
                 pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], CHUNK_NAMES)


def aligned_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, groups)`` per row: groups of aligned ids in order, as ``array<struct<a, b>>``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            offsets, _ = textnum.text_buffers(batch.column(1))
            for lo, hi in textnum.blocks(offsets):
                found = aligner.block([t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(
                    [g.decode() for g in found["groups"]])], ["id", "written"])

    written = src.mapInArrow(run, f"id {kind}, written string")
    groups = F.transform(F.split("written", ";"), lambda g: F.struct(*[
        F.split(F.split_part(g, F.lit("|"), F.lit(i)), ",").cast("array<int>").alias(side) for i, side in ((1, "a"), (2, "b"))]))
    return written.select(F.col("id").alias(id_col), F.when(F.col("written") != "", groups).otherwise(
        F.array().cast("array<struct<a:array<int>,b:array<int>>>")).alias("groups"))


def text_chunks(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The different texts' measures and pairs in chunks, written to the cluster's shared folder."""
    texts = docs.filter(F.col(text_col) != "").groupBy(F.col(text_col).alias("text")).agg(F.count(F.lit(1)).alias("copies")) \
        .select(_text_key("text"), "copies", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number, open_ = Aligner(a_path, b_path), TaskContext.get().partitionId() << 32, _Chunk()
        for batch in batches:
            offsets, _ = textnum.text_buffers(batch.column(2))
            for lo, hi in textnum.blocks(offsets):
                keys, copies, own = (batch.column(i).slice(lo, hi - lo).to_pylist() for i in range(3))
                open_.add(keys, copies, aligner.block(own))
                if open_.pairs >= chunk or len(open_.keys) >= CHUNK_TEXTS:
                    yield open_.close(number)
                    number, open_ = number + 1, _Chunk()
        if open_.keys:
            yield open_.close(number)

    return save(texts.mapInArrow(run, CHUNKS), "align-chunks")


def pair_counts(chunks: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """``(code, a, b, n, best)``: documents that hold each id pair linked, and the most of any pair of its A id."""
    counts = chunks.select(F.inline(F.arrays_zip("codes", "docs"))).groupBy(F.col("codes").alias("code")).agg(F.sum("docs").alias("n")) \
        .withColumn("a", F.expr(f"code div {n_b}")).withColumn("b", F.col("code") % n_b)
    counts = save(counts, "align-counts")
    top = counts.groupBy("a").agg(F.max("n").alias("best"))
    # one row an id of A's vocabulary at most, whatever the corpus
    return counts.join(F.broadcast(top) if n_a <= 1_000_000 else top, "a").select("code", "a", "b", "n", "best")


def _text_key(text_col: str):
    return F.unhex(F.sha2(F.col(text_col), 256)).alias("key")


def _measured(chunk: pa.Table, known: pa.Table) -> pa.Table:
    """A chunk's texts with the sums over the corpus-wide counts of its dictionary."""
    order = np.argsort(known["place"].to_numpy())
    n, top = known["n"].to_numpy()[order], known["top"].to_numpy(zero_copy_only=False)[order]
    row = chunk.to_pylist()[0]
    ends = np.array(row["ends"], np.int64)
    size = np.diff(np.r_[0, ends])
    links = _unpack(row["links"])
    step = np.cumsum(_unpack(row["places"]))
    before = np.r_[0, step][ends - size]  # steps begin anew with each text
    place = step - np.repeat(before, size)

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(values)][np.r_[0, ends]])

    return pa.table({"key": pa.array(row["keys"], pa.binary()), **{k: pa.array(row[k], pa.int64()) for k in MEASURES[:4]},
                     "n_best": per_text(links * top[place]), "count_sum": per_text(links * n[place]), "sha": pa.array(row["sha"], pa.string())})


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per input row."""
    a, b = ByteTokens(a_path), PieceTokens(b_path)
    chunks = text_chunks(docs, a_path, b_path, text_col, chunk)
    counts = pair_counts(chunks, len(a.bytes), len(b.bytes))
    known = chunks.select(F.col("chunk").alias("of"), F.posexplode("codes").alias("place", "code")).join(counts, "code") \
        .select("of", "place", "n", (F.col("n") == F.col("best")).alias("top"))
    schema = "key binary, " + ", ".join(f"{m} bigint" for m in MEASURES) + ", sha string"
    measures = chunks.drop("codes", "docs", "copies").groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(_measured, schema)
    # copies of a text with a share of all documents go to as many slots as they fill shuffle partitions
    copies = chunks.select(F.inline(F.arrays_zip(F.col("keys").alias("key"), "copies")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = copies.select(F.sum("copies")).scalar()
    hot = F.broadcast(copies.filter(F.col("copies") * HOT_TEXTS >= total).select(
        "key", F.ceil(F.col("copies") * parts / total).cast("bigint").alias("slots")))
    one = F.lit(1).cast("bigint")
    rows = docs.select(F.col(id_col).alias("id"), F.when(F.col(text_col) != "", _text_key(text_col)).alias("key")) \
        .join(hot, "key", "left")
    # rows without tokens match nothing: they are dealt by id
    rows = rows.select("id", F.coalesce("key", F.encode(F.xxhash64("id").cast("string"), "utf-8")).alias("key"),
                       F.pmod(F.xxhash64("id"), F.coalesce("slots", one)).alias("slot"))
    measures = measures.join(hot, "key", "left").withColumn("slot", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.coalesce("slots", one) - 1)))
    zero = F.lit(0).cast("bigint")
    return rows.join(measures, ["key", "slot"], "left").select(
        F.col("id").alias(id_col), *[F.coalesce(m, zero).alias(m) for m in MEASURES], F.coalesce("sha", F.lit("")).alias("groups_sha256"))
