"""Concatenate and cut: all documents as one row of tokens, cut into sequences of one length.

Documents stand in order of doc_id, so sequences depend on the rows alone and not on how Spark partitioned them. The
first pass sorts by range, encodes, and stores each document's tokens with the number of tokens before it in its own
partition. The totals of the partitions, one number each, are summed up; with them the second pass knows every
document's place in the whole row and cuts it at fixed windows. Most windows lie within one partition's run and leave
the second pass whole; those that reach over its ends leave as boundary records, which meet by sequence number.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txflow.llm.bpe import byte_letters
from txflow.llm.common import of_worker, written

# Fixed value: how the vocabulary's kind cuts a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STORED = "part int, doc_id long, n int, before long, ids binary"
PIECE = "struct<doc_id: long, start: long, length: int, offset: int, doc_tokens: long>"
RECORDS = f"sequence_id long, offset int, length int, whole boolean, ids binary, pieces array<{PIECE}>"
HELD = 4 << 20


def public_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass(frozen=True)
class Packing:
    """Tokens of a sequence, the id that ends each document, and the tokenizer's file."""

    length: int = 1024
    end: int = 0
    path: str = ""

    @property
    def file(self) -> str:
        return self.path or public_path()


class Encoder:
    """Token ids as the tokenizers library gives them without special tokens of its own.

    A byte-level BPE whose ids rise with its merges, without normalizer, has the same ids by ranks, which tiktoken works
    out several times faster; strings of special tokens in a text are those tokens in both. Other files, and texts on
    which tiktoken gives up, are encoded by the tokenizers library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            text = source.read()
        told = json.loads(text)
        self.plain = Tokenizer.from_str(text)
        self.plain.no_truncation()
        self.plain.no_padding()
        self.size = self.plain.get_vocab_size()
        self.fast = self._by_ranks(told) if self._ranked(told) else None

    @staticmethod
    def _ranked(told: dict) -> bool:
        model, cut = told["model"], told.get("pre_tokenizer") or {}
        if told.get("normalizer") or model.get("type") != "BPE" or cut.get("type") != "ByteLevel":
            return False
        if cut.get("add_prefix_space") or not cut.get("use_regex", True) or model.get("ignore_merges"):
            return False
        if any(a[k] for a in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            return False
        vocab, pairs = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [vocab["".join(m)] for m in pairs]
        return len(byte_letters().values() - vocab.keys()) == 0 and made == sorted(made)

    @staticmethod
    def _by_ranks(told: dict) -> tiktoken.Encoding:
        special = {a["content"]: a["id"] for a in told["added_tokens"]}
        byte_of = {c: b for b, c in byte_letters().items()}
        ranks = {bytes(byte_of[c] for c in k): v for k, v in told["model"]["vocab"].items() if k not in special}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all", disallowed_special=())
            except BaseException as error:  # a panic of the library is no Exception
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)


def _width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, packing: Packing) -> tuple[DataFrame, str]:
    """First pass: tokens of all documents in order, stored, and the numpy type of the stored ids.

    Rows of one doc_id stand in the order of a hash of their text, equal rows in the order of the files; so a doc_id that
    a third of all rows share is split like any other.
    """
    path, end = packing.file, packing.end
    kind = _width(max(Encoder(path).size, end + 1))
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    rows = rows.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), "h", "row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = of_worker(("encoder", path), lambda: Encoder(path))
        part, before = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def batch_of() -> pa.RecordBatch:
            types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = [c.split(" ")[0] for c in STORED.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

        for batch in batches:
            for doc_id, words in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = np.append(encoder.ids(words.as_py()), end).astype(kind)
                held.append((part, doc_id.as_py(), len(ids), before, ids.tobytes()))
                before += len(ids)
                size += ids.nbytes + 64
                if size > HELD:
                    yield batch_of()
                    held, size = [], 0
        if held:
            yield batch_of()

    return written(placed.mapInArrow(run, STORED), "tokens"), kind


def offsets(stored: DataFrame) -> tuple[np.ndarray, int]:
    """The tokens before each partition, and of all: one number for each partition comes to the driver."""
    totals = stored.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("n")).collect()
    sizes = np.zeros(max((r.part for r in totals), default=-1) + 1, np.int64)
    for r in totals:
        sizes[r.part] = r.n
    return np.cumsum(sizes) - sizes, int(sizes.sum())


class Cutter:
    """Cuts a run of documents at the window borders; holds the window it is in."""

    def __init__(self, length: int, total: int):
        self.length, self.total, self.done = length, total, []
        self.size, self.at = 0, None  # place of the next token if the run goes on

    def add(self, doc_id: int | None, place: int, ids: np.ndarray) -> None:
        if place != self.at:
            self.flush()
            self.first, self.parts, self.pieces = place, [], []
        start, n = 0, len(ids)
        while start < n:
            offset = (place + start) % self.length
            take = min(self.length - offset, n - start)
            self.parts.append(ids[start : start + take])
            self.pieces.append((doc_id, start, take, offset, n))
            start += take
            self.at = place + start
            if self.at % self.length == 0:
                self.flush()
                self.first, self.parts, self.pieces = self.at, [], []
        self.at = place + n

    def flush(self) -> None:
        if self.at is not None and self.parts:
            ids, offset = np.concatenate(self.parts), self.first % self.length
            whole = offset == 0 and (len(ids) == self.length or self.at == self.total)
            data = ids.astype("<u4").tobytes()
            self.done.append((self.first // self.length, offset, len(ids), whole, data, self.pieces))
            self.size += len(data) + 64 * len(self.pieces)
            self.parts, self.pieces = [], []

    def batch(self) -> pa.RecordBatch:
        piece = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("offset", pa.int32()), ("doc_tokens", pa.int64())])
        sequence, offset, length, whole, data, pieces = zip(*self.done, strict=True)
        columns = [np.array(list(c), t) for c, t in zip(zip(*[x for p in pieces for x in p], strict=True), (object, "i8", "i4", "i4", "i8"), strict=True)]
        flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, piece, strict=True)], fields=list(piece))
        borders = pa.array(np.cumsum([0, *map(len, pieces)]), pa.int32())
        arrays = [pa.array(sequence, pa.int64()), pa.array(offset, pa.int32()), pa.array(length, pa.int32()), pa.array(whole), pa.array(data, pa.binary())]
        self.done, self.size = [], 0
        return pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(borders, flat)], [c.split(" ")[0] for c in RECORDS.split(", ")[:5]] + ["pieces"])


def records(docs: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """Both passes: windows of tokens with the pieces of documents in them (see the module).

    ``ids`` are little-endian unsigned 32-bit numbers. A record that is not ``whole`` is a part of its sequence, from
    ``offset`` on; no piece is ever divided between two records. Runs are followed by the places of their tokens, so the
    records are right however Spark splits or joins the stored files.
    """
    stored, kind = encoded(docs, packing)
    bases, total = offsets(stored)
    sent = docs.sparkSession.sparkContext.broadcast(bases)  # 8 bytes a partition
    length = packing.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, cut = sent.value, Cutter(length, total)
        for batch in batches:
            for part, doc_id, before, ids in zip(*(batch.column(c) for c in ("part", "doc_id", "before", "ids")), strict=True):
                cut.add(doc_id.as_py(), int(base[part.as_py()]) + before.as_py(), np.frombuffer(ids.as_buffer(), kind))
                if cut.size > HELD:
                    yield cut.batch()
        cut.flush()
        if cut.done:
            yield cut.batch()

    return stored.select("part", "doc_id", "before", "ids").mapInArrow(run, RECORDS)


def sequences(docs: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """One row for each sequence: ``sequence_id``, ``length``, ``ids`` and its ``pieces`` in order.

    Only the last sequence can be shorter than the others. Boundary records, a few for each partition, are joined by
    sequence; a sequence has at most as many as it has tokens.
    """
    cut = written(records(docs, packing), "packed")
    parts = cut.where("not whole").groupBy("sequence_id")
    parts = parts.agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids", "pieces"))).alias("p"))
    joined = parts.select(
        "sequence_id",
        F.aggregate("p", F.lit(0), lambda n, x: n + x["length"]).alias("length"),
        F.aggregate("p", F.lit(b""), lambda data, x: F.concat(data, x["ids"])).alias("ids"),
        F.flatten(F.transform("p", lambda x: x["pieces"])).alias("pieces"),
    )
    return cut.where("whole").select(*joined.columns).unionByName(joined)


def pieces(packed: DataFrame) -> DataFrame:
    """One row for each piece of records or sequences, with the ids of the piece alone."""
    begin = F.coalesce(F.col("offset"), F.lit(0)) if "offset" in packed.columns else F.lit(0)
    each = packed.select("sequence_id", begin.alias("_begin"), "ids", F.explode("pieces").alias("p"))
    own = F.expr("substring(ids, 4 * (p.offset - _begin) + 1, 4 * p.length)").alias("ids")
    return each.select("p.doc_id", "p.start", "p.length", "p.doc_tokens", "sequence_id", "p.offset", own)


def op11_packing(docs: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """All documents packed, a row for each piece with the checksum of its ids.

    NULL and empty texts are the end token alone. NULL doc_ids stand first. Rows with one doc_id are documents of their
    own; repeated rows are packed as often as they stand there. A very long text is cut into as many pieces as it needs.
    An empty table gives no rows. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
    """
    return pieces(records(docs, packing)).select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )
