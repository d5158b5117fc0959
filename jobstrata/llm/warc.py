"""Web archives without repeated payloads.

Headers (id, payload digest, length) are shuffled by digest; where several payloads of some
length are equal, the record with the largest id stays a response and the others become
revisits of it. Archives are then written with fresh headers, payloads only in responses,
and read back: revisits find their payload's length through the response they refer to.

Archives are files of WARC/1.1 records below one folder, each record a gzip member of its own
behind a warcinfo record, so that a reader can begin at any record. Tasks write files of about
``FILE_BYTES`` under names that no reader looks for; the commit of the write gives them their
names, so files of lost tasks and of aborted writes don't count. The folder has to be one that
the driver and all executors reach by a plain path or a URI that Arrow's file systems know.

Defined cases: a null payload is empty; payloads shorter than the limit are always responses;
of repeated rows with one id and payload all are responses if any is; a null id is smaller
than any other; record ids are made of id and digest, so rows that repeat both share one; other
columns but url are ignored; an empty table gives no records.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from jobstrata.llm.common import map_arrow, stored
from jobstrata.sources.documents import Folder
from jobstrata.workspace import new_path

FILE_BYTES = 16 << 20
REVISITS_FROM = 1000
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVED = "2024-01-01T00:00:00Z"
_END = "\r\n"
# Before the name of a file that is not committed yet.
_HIDDEN = "_"


def headers(pages: DataFrame) -> DataFrame:
    """page_id, payload_digest and payload_bytes of every page."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        "page_id",
        F.sha1(payload.cast("binary")).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )


def resolved(heads: DataFrame, least: int = REVISITS_FROM) -> DataFrame:
    """Per digest that several ids share: the id its revisits refer to."""
    long_ones = heads.where(F.col("payload_bytes") >= least)
    return (
        long_ones.groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("records"))
        .where("records > 1 AND response_id IS NOT NULL")
        .select("digest", "response_id")
    )


def _urn(page_id: Column) -> Column:
    page = F.coalesce(page_id.cast("string"), F.lit(""))
    return F.concat(F.lit("<urn:page:"), page, F.lit(":"), F.col("payload_digest"), F.lit(">"))


def _record(revisit: Column) -> Column:
    """A whole record with the two line ends after it."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    block = F.when(revisit, http).otherwise(F.concat(http, payload))
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", "")
    refers = F.concat(
        F.lit("WARC-Refers-To: "),
        _urn(F.col("response_id")),
        F.lit(f"{_END}WARC-Profile: {REVISIT_PROFILE}{_END}"),
    )
    return F.concat(
        F.lit(f"WARC/1.1{_END}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{_END}WARC-Record-ID: "),
        _urn(F.col("page_id")),
        F.lit(f"{_END}WARC-Date: {ARCHIVED}{_END}WARC-Target-URI: "),
        uri,
        F.lit(f"{_END}WARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.lit(_END),
        F.when(revisit, refers).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{_END}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(_END + _END),
        block,
        F.lit(_END + _END),
    )


def _info(name: str) -> bytes:
    """The record that begins a file."""
    block = f"software: jobstrata{_END}format: WARC File Format 1.1{_END}".encode()
    head = (
        f"WARC/1.1{_END}WARC-Type: warcinfo{_END}WARC-Record-ID: <urn:file:{name}>{_END}"
        f"WARC-Date: {ARCHIVED}{_END}WARC-Filename: {name}{_END}"
        f"Content-Type: application/warc-fields{_END}Content-Length: {len(block)}{_END}{_END}"
    )
    return head.encode() + block + (_END + _END).encode()


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(wbits=31)
    return packer.compress(record) + packer.flush()


@dataclass
class Files(WriterCommitMessage):
    """Names that a task has written under, without what hides them."""

    names: list[str]


class ArchiveWriter(DataSourceArrowWriter):
    """Files of records, one gzip member each, that appear with the commit."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        folder, names, file, size = Folder(self.path), [], None, 0
        folder.files.create_dir(folder.path, recursive=True)
        try:
            for batch in iterator:
                for record in batch.column(0):
                    if file is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        file = folder.files.open_output_stream(
                            folder.at(_HIDDEN + names[-1]), compression=None
                        )
                        size = file.write(_member(_info(names[-1])))
                    size += file.write(_member(record.as_py()))
                    if size >= FILE_BYTES:
                        file.close()
                        file = None
        except BaseException:
            folder.remove([_HIDDEN + name for name in names])
            raise
        finally:
            if file is not None:
                file.close()
        return Files(names)

    def commit(self, messages: list[Files | None]) -> None:
        folder = Folder(self.path)
        for name in (n for message in messages if message for n in message.names):
            folder.files.move(folder.at(_HIDDEN + name), folder.at(name))

    def abort(self, messages: list[Files | None]) -> None:
        names = [_HIDDEN + n for message in messages if message for n in message.names]
        Folder(self.path).remove(names)


class Archives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc_archives"

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"])


def write_archives(pages: DataFrame, path: str, least: int = REVISITS_FROM) -> None:
    """Archives of all pages below ``path``."""
    heads = stored(headers(pages), "warc-headers")
    originals = stored(resolved(heads, least), "warc-originals")
    payload = F.coalesce(F.col("html"), F.lit(""))
    page = pages.select("page_id", "url", "html").withColumns(
        {
            "payload_digest": F.sha1(payload.cast("binary")),
            "payload_bytes": F.octet_length(payload).cast("long"),
        }
    )
    # Payloads are not shuffled for the join where few digests repeat: its other side holds
    # those alone, and Spark broadcasts it if it is small.
    matched = page.join(
        originals,
        (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= least),
        "left",
    )
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    records = matched.select(_record(revisit).cast("binary").alias("record"))
    pages.sparkSession.dataSource.register(Archives)
    records.write.format(Archives.name()).mode("append").save(path)


def record_at(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record that begins at byte ``at`` of an archive: header fields in lower case, the
    block, and where the next one begins."""
    unpacker, parts = zlib.decompressobj(wbits=31), []
    while not unpacker.eof:
        if at >= len(data):
            raise ValueError("the archive ends inside a record")
        chunk = data[at : at + (1 << 16)]
        parts.append(unpacker.decompress(chunk))
        at += len(chunk)
    fields, block = next(_parse(b"".join(parts)))
    return fields, block, at - len(unpacker.unused_data)


def _parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Unpacked records: header fields in lower case, and the block."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(_END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        named = (line.partition(":") for line in lines[1:])
        fields = {name.lower(): value.strip() for name, _, value in named}
        start = end + 4
        at = start + int(fields["content-length"])
        yield fields, data[start:at]
        at += 4


def _page_number(urn: str | None) -> int | None:
    number = (urn or "")[len("<urn:page:") :].partition(":")[0]
    return int(number) if number else None


_READ = "page_id long, url string, record_type string, refers_to long, digest string, html string"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            columns: list[list] = [[] for _ in range(6)]
            data, at = content.as_py(), 0
            while at < len(data):
                fields, block, at = record_at(data, at)
                kind = fields["warc-type"]
                if kind == "warcinfo":
                    continue
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                row = (
                    _page_number(fields["warc-record-id"]),
                    fields["warc-target-uri"],
                    kind,
                    _page_number(fields.get("warc-refers-to")),
                    fields["warc-payload-digest"].removeprefix("sha1:"),
                    payload if kind == "response" else None,
                )
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            arrays[-1] = arrays[-1].cast(pa.string())
            names = ["page_id", "url", "record_type", "refers_to", "digest", "html"]
            yield pa.record_batch(arrays, names)


def read_archives(spark, path: str) -> DataFrame:
    """All records: page_id, url, record_type, refers_to, digest as stated, html (null in
    revisits). Tasks hold one file each."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz")
    files = reader.load(path).select("content")
    return map_arrow(files, _read, _READ)


def archived_pages(records: DataFrame) -> DataFrame:
    """Per record page_id, record_type, refers_to, and the payload's length and digest; of
    revisits, those of the response that they refer to."""
    measured = stored(
        records.select(
            "page_id",
            "record_type",
            "refers_to",
            "digest",
            F.octet_length("html").cast("long").alias("own_bytes"),
            F.sha1(F.col("html").cast("binary")).alias("own_digest"),
        ),
        "warc-read",
    )
    responses = (
        measured.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("to"), F.col("own_digest").alias("to_digest"))
        .agg(F.max("own_bytes").alias("to_bytes"))
    )
    # Ids can repeat with other payloads; the stated digest tells which is meant.
    revisits = measured.where("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("to")) & (F.col("digest") == F.col("to_digest"))
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    full = measured.where("record_type = 'response'").withColumns(
        {"payload_bytes": F.col("own_bytes"), "payload_digest": F.col("own_digest")}
    )
    return full.select(*columns).unionByName(
        revisits.withColumns(
            {"payload_bytes": F.col("to_bytes"), "payload_digest": F.col("to_digest")}
        ).select(*columns)
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives and read back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return archived_pages(read_archives(pages.sparkSession, path))
