"""WARC archives: a deterministic sharded writer, committed through temporary names and a manifest, and a reader.

Shards are ranges of page_id cut at exact ranks, so that they and every byte of the archives depend on the rows alone,
not on how Spark partitioned them. A task writes one shard at a time as a run of files, each record a gzip member of
its own, and begins a new file when the compressed size is reached. Files get their final names only when the manifest
of all tasks that succeeded has been written; what failed or repeated attempts wrote keeps its temporary name.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm.common import with_rank

LEAST_REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard namespace for URLs
MANIFEST = "shard int, seq int, name string, draft string, records long, bytes long, sha256 string"
READ = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "file string, html string"
)


@dataclass(frozen=True)
class Layout:
    """Uncompressed bytes of a shard, compressed bytes at which a file ends, gzip level and the date of all records."""

    shard_bytes: int = 32 << 20
    file_bytes: int = 8 << 20
    level: int = 6
    date: str = "2020-01-01T00:00:00Z"


def _fs(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}/{copy}')}>"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, digest: str, copy: int, refers_to, date: str) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone; head and digests are made from the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest, copy))]
    fields.append(("WARC-Date", date))
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~|{}^`\\\"<>")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 0)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    return record(fields, block)


class ShardWriter:
    """Writes the files of one shard under temporary names."""

    def __init__(self, folder: str, shard: int, layout: Layout):
        self.fs, self.root = _fs(folder)
        self.shard, self.layout, self.seq, self.done = shard, layout, 0, []
        self.out = None
        self.fs.create_dir(f"{self.root}/_drafts", recursive=True)

    def _open(self) -> None:
        self.name = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
        self.draft = f"_drafts/{self.name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(f"{self.root}/{self.draft}", compression=None)
        self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        info = f"filename: {self.name}\r\nformat: WARC File Format 1.1\r\n".encode()
        fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name, 0)), ("WARC-Date", self.layout.date)]
        self._put(record([*fields, ("Content-Type", "application/warc-fields")], info))

    def _put(self, data: bytes) -> None:
        machine = zlib.compressobj(self.layout.level, zlib.DEFLATED, 31)
        member = machine.compress(data) + machine.flush()
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def add(self, data: bytes) -> None:
        if self.out is None:
            self._open()
        self._put(data)
        self.records += 1
        if self.size >= self.layout.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.seq, self.name, self.draft, self.records, self.size, self.sha.hexdigest()))
            self.out = None
            self.seq += 1


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split(" ")[0] for x in MANIFEST.split(", ")]
    types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    """Rows of batches, a few hundred at a time as Python values."""
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def write(pages: DataFrame, folder: str, layout: Layout = Layout()) -> DataFrame:
    """Write all rows of ``pages`` (page_id, url, html) as archives in a new ``folder``; returns the manifest, in order.

    Of equal payloads of 100 bytes or more the one with the smallest page_id is a response, the others are revisits
    without payload. NULL html is the empty payload. Rows with a NULL page_id stand first, are always responses and are
    never referred to. Of repeated rows (same page_id and payload) the first is what the smallest page_id would be, and
    the others revisit it. NULL urls have no target line; control characters and non-ASCII in urls are percent-encoded.
    An empty table writes an empty manifest. Further columns are not read.

    Each payload is shuffled once. Who revisits whom is found from digests and travels as a narrow row that sorts just
    before its page, so a payload that a third of all pages share meets in no task.
    """
    spark = pages.sparkSession
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    narrow = base.select("page_id", F.sha2("html", 256).alias("digest"), F.octet_length("html").cast("long").alias("size"))
    total = narrow.agg(F.sum("size")).first()[0] or 0
    ranked, n = with_rank(narrow.select("page_id"), ["page_id"])
    per_shard = max(1, -(-n // max(1, -(-total // layout.shard_bytes))))
    starts = ranked.where((F.col("rank") % per_shard == 0) & (F.col("rank") > 0) & F.col("page_id").isNotNull())
    bounds = np.array(sorted(r[0] for r in starts.select("page_id").collect()), np.int64)  # one for each shard

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series) -> pd.Series:
        low = np.iinfo(np.int64).min
        return pd.Series(np.searchsorted(bounds, page_id.astype("Int64").fillna(low).to_numpy(np.int64), side="right"))

    big = narrow.where((F.col("size") >= LEAST_REVISIT) & F.col("page_id").isNotNull())
    first = big.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last")
    marks = big.join(first.select("digest", "first"), "digest").where("page_id > first").select("page_id", "digest", "first")
    empty = F.lit(None).cast("string")
    marked = marks.select("page_id", F.lit(0).alias("kind"), empty.alias("url"), empty.alias("html"), "digest", "first")
    payloads = base.select("page_id", F.lit(1).alias("kind"), "url", "html", F.sha2("html", 256).alias("digest"), F.lit(None).cast("long").alias("first"))
    both = payloads.unionByName(marked).withColumn("shard", shard_of("page_id"))
    dealt = both.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "kind", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: ShardWriter | None = None
        page, refers, seen = None, {}, {}
        for shard, page_id, kind, url, html, digest, to in _rows(batches, ("shard", "page_id", "kind", "url", "html", "digest", "first")):
            if out is None or out.shard != shard:
                if out is not None:
                    out.close()
                    yield _manifest_batch(out.done)
                out, page, refers, seen = ShardWriter(folder, shard, layout), None, {}, {}
            if page_id is None or page_id != page:
                page, refers, seen = page_id, {}, seen if page_id is None and page is None else {}
            if not kind:
                refers[digest] = to
                continue
            payload, copy = html.encode(), seen.get(digest, 0)
            seen[digest] = copy + 1
            if page_id is None or len(payload) < LEAST_REVISIT:
                to = None
            else:
                to = refers.get(digest, page_id if copy else None)
            out.add(page_record(page_id, url, payload, digest, copy, to, layout.date))
        if out is not None:
            out.close()
            yield _manifest_batch(out.done)

    # Written from the stage that made the files: the rows name the drafts of the attempts that succeeded.
    drafts = f"{folder}/_manifest-drafts"
    dealt.mapInArrow(run, MANIFEST).write.parquet(drafts)
    listed = spark.read.schema(MANIFEST).parquet(drafts)

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        for batch in batches:
            for name, draft in zip(batch.column("name").to_pylist(), batch.column("draft").to_pylist(), strict=True):
                kind = fs.get_file_info(f"{root}/{draft}").type
                if kind == pyarrow.fs.FileType.File:  # else an earlier attempt of this task has moved it
                    fs.move(f"{root}/{draft}", f"{root}/{name}")
                elif fs.get_file_info(f"{root}/{name}").type != pyarrow.fs.FileType.File:
                    raise FileNotFoundError(f"{draft} of the manifest is lost")
            yield batch

    listed.mapInArrow(publish, MANIFEST).write.parquet(f"{folder}/_manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The committed files of an archive folder, in order."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").drop("draft").orderBy("shard", "seq")


class Stream:
    """Records of a file of gzip members, read and unpacked in pieces; holds one record at a time."""

    def __init__(self, source, piece: int = 1 << 18):
        self.source, self.piece, self.held, self.machine = source, piece, bytearray(), zlib.decompressobj(31)
        self.fed = False

    def _more(self) -> bool:
        data = self.machine.unused_data if self.machine.eof else b""
        if self.machine.eof:
            self.machine, self.fed = zlib.decompressobj(31), False
        data = data or self.source.read(self.piece)
        if not data:
            if self.fed:
                raise ValueError("the archive ends within a gzip member")
            return False
        self.fed = True
        self.held += self.machine.decompress(data)
        return True

    def _until(self, mark: bytes) -> bytes | None:
        at = 0
        while (found := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark))
            if not self._more():
                if self.held:
                    raise ValueError("the archive ends within a record")
                return None
        out = bytes(self.held[:found])
        del self.held[: found + len(mark)]
        return out

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while (head := self._until(b"\r\n\r\n")) is not None:
            version, *lines = head.decode().split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError("not a WARC record")
            fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
            n = int(fields["content-length"])
            while len(self.held) < n + 4:
                if not self._more():
                    raise ValueError("the archive ends within a block")
            block = bytes(self.held[:n])
            if self.held[n : n + 4] != b"\r\n\r\n":
                raise ValueError("a block is not as long as its head says")
            del self.held[: n + 4]
            yield fields, block


def page_of(fields: dict[str, str], block: bytes, with_html: bool) -> tuple | None:
    """A row of a response or revisit record, its digests checked; None for other records."""
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"block digest of {fields['warc-record-id']}")
    head, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b": ")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length: "))
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']}")
    page, to = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    html = payload.decode() if with_html and kind == "response" else None
    return page and int(page), fields.get("warc-target-uri"), kind, to and int(to), size, digest, html


def read(spark: SparkSession, folder: str, with_html: bool = True) -> DataFrame:
    """One row for each page record of the committed files; ``html`` is NULL for revisits."""
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = [x.split(" ")[0] for x in READ.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        rows, held = [], 0
        for (name,) in _rows(batches, ("name",)):
            with fs.open_input_stream(f"{root}/{name}", compression=None) as source:
                for fields, block in Stream(source):
                    got = page_of(fields, block, with_html)
                    if got is not None:
                        rows.append((*got[:6], name, got[6]))
                        held += len(block) if with_html else 64
                    if held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    files = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").select("name")
    return files.repartition(max(1, files.count()), "name").mapInArrow(run, READ)


def op7_warc(pages: DataFrame, folder: str, layout: Layout = Layout()) -> DataFrame:
    """Write all pages, read the archives back, and return what they say of each page."""
    write(pages, folder, layout)
    return read(pages.sparkSession, folder, with_html=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = """
with p as (select page_id, coalesce(html, '') html from pages),
d as (select page_id, strlen(html) payload_bytes, sha256(html) payload_digest, from p),
f as (select payload_digest, min(page_id) first from d where payload_bytes >= 100 group by all)
select page_id, payload_bytes, payload_digest, case when first < page_id then 'revisit' else 'response' end record_type,
       case when first < page_id then first end refers_to
from d left join f using (payload_digest)
"""
