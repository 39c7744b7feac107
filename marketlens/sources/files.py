"""File inventory as a table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files up to this size are digested as one value; larger ones are streamed in blocks.
WHOLE_BYTES, BLOCK_BYTES = 64 << 20, 4 << 20


def open_stream(path: str) -> pa.NativeFile:
    """A file of the shared store as a stream, by its URI as Spark lists it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"))
    store, name = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return store.open_input_stream(name)


def streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each file (path, length, modificationTime) from blocks of fixed size."""
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            state = hashlib.sha256()
            with open_stream(path) as stream:
                while block := stream.read(BLOCK_BYTES):
                    state.update(block)
            found.append(state.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.string())], ["path", "length", "modificationTime", "sha256"])


def file_inventory(spark: SparkSession, root: str, *, digest: bool = False, whole: int = WHOLE_BYTES) -> DataFrame:
    """Recursive path, name, size, modification time and, on request, the content digest of every file.

    Without ``digest`` the content column is pruned and no file is opened. With it, files above ``whole`` bytes are
    opened in the tasks and streamed, so memory is bounded at every size; that needs a store pyarrow can open.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    about = ["path", "length", "modificationTime"]
    listed = files.select(*about)
    if digest:
        small = files.where(F.col("length") <= whole).select(*about, F.sha2("content", 256).alias("sha256"))
        large = listed.where(F.col("length") > whole).mapInArrow(streamed_digests, "path string, length long, modificationTime timestamp, sha256 string")
        listed = small.unionByName(large)
    shown: list[Column] = [F.col("sha256")] if digest else []
    return listed.select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"), F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), *shown)
