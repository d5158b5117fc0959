"""A document collection in files, as a Spark data source.

A collection is a folder of files with one JSON document per line, and a manifest that names the
files that count. Tasks write files of bounded size and report them; the commit replaces the
manifest in one move, which is when the new documents appear, and then removes files that no
longer count. A write that is aborted, or whose driver is lost, leaves the manifest as it was, and
so the old documents. A read has one partition per file.

    register(spark)
    df.write.format("document_collection").mode("overwrite").save(path)
    spark.read.format("document_collection").schema(schema).load(path)

The folder has to be one that the driver and all executors reach: a plain path, ``file:``,
or any URI that Arrow's file systems know. Documents hold texts, whole numbers, booleans and
doubles; a missing or null field is null. A double that is not finite can't stand in a
document and fails the write. Without a schema a read infers one from the first file.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

NAME = "document_collection"
MANIFEST = "_manifest.json"
# A file is closed when it holds so many bytes, which bounds a read's partition.
FILE_BYTES = 64 << 20
_KINDS = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType,
          T.FloatType, T.DoubleType)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocumentCollection)


class Folder:
    """Files of a collection, on any file system that Arrow reaches."""

    def __init__(self, path: str):
        if path.startswith("/"):
            self.files, self.path = fs.LocalFileSystem(), path.rstrip("/")
        else:
            local = path.startswith("file:")
            # Hadoop writes local URIs with one slash, Arrow reads them with three.
            uri = "file:///" + path[len("file:") :].lstrip("/") if local else path
            self.files, place = fs.FileSystem.from_uri(uri)
            self.path = place.rstrip("/")

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def manifest(self) -> list[dict]:
        """Files that count, or none where there is no collection."""
        try:
            with self.files.open_input_stream(self.at(MANIFEST)) as file:
                return json.loads(file.read())["files"]
        except FileNotFoundError:
            return []

    def publish(self, listed: list[dict]) -> None:
        """Replace the manifest in one move."""
        beside = self.at(f"_{uuid.uuid4().hex}.json")
        self.files.create_dir(self.path, recursive=True)
        with self.files.open_output_stream(beside) as file:
            file.write(json.dumps({"files": listed}).encode())
        self.files.move(beside, self.at(MANIFEST))

    def remove(self, names: list[str]) -> None:
        for name in names:
            if self.files.get_file_info(self.at(name)).type != fs.FileType.NotFound:
                self.files.delete_file(self.at(name))


@dataclass
class Written(WriterCommitMessage):
    """Files of one task."""

    files: list[dict] = field(default_factory=list)


@dataclass
class DocumentFile(InputPartition):
    name: str


class DocumentWriter(DataSourceArrowWriter):
    """Files per task; the commit says which of them count."""

    def __init__(self, path: str, schema: T.StructType, overwrite: bool, file_bytes: int):
        odd = [f.name for f in schema.fields if not isinstance(f.dataType, _KINDS)]
        if odd:
            raise ValueError(f"documents can't hold {', '.join(odd)}")
        self.path, self.overwrite, self.file_bytes = path, overwrite, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder, done = Folder(self.path), []
        folder.files.create_dir(folder.path, recursive=True)
        rows, held = 0, io.BytesIO()

        def close() -> None:
            nonlocal rows, held
            if rows:
                name = f"part-{uuid.uuid4().hex}.jsonl"
                done.append({"name": name, "rows": rows, "bytes": held.tell()})
                with folder.files.open_output_stream(folder.at(name)) as file:
                    file.write(held.getvalue())
            rows, held = 0, io.BytesIO()

        try:
            for batch in iterator:
                for document in batch.to_pylist():
                    filled = {k: v for k, v in document.items() if v is not None}
                    held.write(json.dumps(filled, ensure_ascii=False, allow_nan=False).encode())
                    held.write(b"\n")
                    rows += 1
                    if held.tell() >= self.file_bytes:
                        close()
            close()
        except BaseException:
            # The driver never hears of these files.
            folder.remove([file["name"] for file in done])
            raise
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        folder = Folder(self.path)
        before = folder.manifest()
        fresh = [file for message in messages if message for file in message.files]
        folder.publish(fresh if self.overwrite else before + fresh)
        if self.overwrite:
            folder.remove([file["name"] for file in before])

    def abort(self, messages: list[Written | None]) -> None:
        names = [file["name"] for message in messages if message for file in message.files]
        Folder(self.path).remove(names)


class DocumentReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema = path, schema

    def partitions(self) -> list[DocumentFile]:
        return [DocumentFile(file["name"]) for file in Folder(self.path).manifest()]

    def read(self, partition: DocumentFile | None) -> Iterator[pa.RecordBatch]:
        from pyarrow import json as arrow_json

        if partition is None:  # Without partitions, Spark asks for one.
            return

        folder = Folder(self.path)
        options = arrow_json.ParseOptions(
            explicit_schema=to_arrow_schema(self.schema), unexpected_field_behavior="ignore"
        )
        # A block has to hold the longest document.
        size = folder.files.get_file_info(folder.at(partition.name)).size
        reading = arrow_json.ReadOptions(use_threads=False, block_size=max(size, 1))
        with folder.files.open_input_stream(folder.at(partition.name)) as file:
            table = arrow_json.read_json(file, reading, options)
        names = [f.name for f in self.schema.fields]
        yield from table.select(names).to_batches()


class DocumentCollection(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def _path(self) -> str:
        return self.options["path"]

    def schema(self) -> T.StructType:
        from pyarrow import json as arrow_json

        folder = Folder(self._path())
        listed = folder.manifest()
        if not listed:
            raise ValueError(f"{self._path()} holds no documents to infer a schema from")
        with folder.files.open_input_stream(folder.at(listed[0]["name"])) as file:
            size = max(listed[0]["bytes"], 1)
            table = arrow_json.read_json(file, arrow_json.ReadOptions(block_size=size))
        return from_arrow_schema(table.schema)

    def reader(self, schema: T.StructType) -> DocumentReader:
        return DocumentReader(self._path(), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DocumentWriter:
        file_bytes = int(self.options.get("file_bytes", FILE_BYTES))
        return DocumentWriter(self._path(), schema, overwrite, file_bytes)
