"""A sink of JSON documents that commits all or nothing, as a Python data source.

Each task attempt writes to a folder of its own beside the target and reports it; the commit
drops folders that no successful task reported, renames the rest into place at once, and
writes the collection after the items. The driver handles a message a task, never one a document.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from orolith.sources import writers

FORMAT = "json_documents"


@dataclass
class Written(WriterCommitMessage):
    """A successful task's folder and its number of documents."""

    folder: str
    documents: int


class DocumentSink(DataSource):
    """df.write.format("json_documents"): (item_id, body) as <path>/items/<task>/<item_id>.json. Options: path, collection (text, written last), pending (a new folder beside path, there already)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> "DocumentWriter":
        if not overwrite:
            raise ValueError("documents replace what was there: use mode overwrite")
        return DocumentWriter(self.options["path"], self.options["pending"], self.options.get("collection"))


class DocumentWriter(DataSourceWriter):
    def __init__(self, path: str, pending: str, collection: str | None):
        self.path, self.pending, self.collection = path, pending, collection

    def _store(self, path: str) -> tuple[pa.fs.FileSystem, str]:
        return pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)

    def write(self, iterator: Iterator) -> Written:
        store, root = self._store(self.pending)
        folder, n = uuid.uuid4().hex, 0
        store.create_dir(f"{root}/{folder}", recursive=False)  # fails after an abort, so a task that is still ending leaves nothing
        for row in iterator:
            if row["item_id"] is None or not re.fullmatch(r"[^/\x00]+", row["item_id"]):
                raise ValueError(f"{row['item_id']!r} can't name a document")
            with store.open_output_stream(f"{root}/{folder}/{row['item_id']}.json") as file:
                file.write(f"{row['body'] or ''}\n".encode())
            n += 1
        return Written(folder, n)

    def commit(self, messages: list[Written | None]) -> None:
        store, staged = self._store(self.pending)
        _, target = self._store(self.path)
        kept = {m.folder for m in messages if m is not None}
        for found in store.get_file_info(pa.fs.FileSelector(staged)):
            if found.base_name not in kept:  # attempts that failed or lost against another one
                store.delete_dir(found.path)
        store.create_dir(target, recursive=True)
        old = f"{staged}.before"
        there = store.get_file_info(f"{target}/items").type == pa.fs.FileType.Directory
        if there:
            store.move(f"{target}/items", old)
        try:
            store.move(staged, f"{target}/items")
        except Exception:
            if there:
                store.move(old, f"{target}/items")
            raise
        if self.collection is not None:
            with store.open_output_stream(f"{staged}.collection") as file:
                file.write(f"{self.collection}\n".encode())
            store.move(f"{staged}.collection", f"{target}/collection.json")
        if there:
            store.delete_dir(old)

    def abort(self, messages: list[Written | None]) -> None:
        store, staged = self._store(self.pending)
        if store.get_file_info(staged).type == pa.fs.FileType.Directory:
            store.delete_dir(staged)


def write_documents(documents: DataFrame, path: str, collection: str | None = None) -> None:
    """Replaces the documents below path by rows (item_id, body), then its collection.json; after a failure both are as before.

    The path is resolved as Spark does; on a cluster a local one outside the shared folders, and stores without renames, are refused. A null body is an empty document, an id that can't be a file's name fails the
    write, and of rows that repeat an id in one task the last stays, so make ids distinct before. No rows leave an empty folder.
    """
    spark = documents.sparkSession
    fs, given = writers._fs(spark, path)
    full = fs.makeQualified(given).toString()
    if re.match("(s3[an]?|gs|abfss?):", full):
        raise ValueError(f"{full} has no renames")
    full = writers.local_or_uri(spark, full).rstrip("/")
    spark.dataSource.register(DocumentSink)
    pending = writers.beside(full)
    fs.mkdirs(writers._fs(spark, pending)[1])
    sink = documents.select("item_id", "body").write.format(FORMAT).option("path", full).option("pending", pending)
    try:
        (sink.option("collection", collection) if collection is not None else sink).mode("overwrite").save()
    except Exception:
        writers.delete(spark, pending)
        raise
