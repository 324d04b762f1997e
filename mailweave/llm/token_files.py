"""Token ids as Arrow files: equal-length sequences and masks for random access without copies.

Documents are laid out in ascending order of their ids by a range shuffle of the raw texts; each
task encodes its range and writes one Arrow file (the IPC file format) with two columns of
fixed-size lists, ``ids`` and ``mask``, in record batches of equal numbers of sequences. Sequence
i of a file is row i mod ``BATCH`` of batch i div ``BATCH``, a view into the mapped file. Documents
follow each other without gaps, so a sequence may hold several and a document may go on in the
next; only the end of a file is padded, with mask false. Ids take two bytes where the vocabulary
allows it.

An index row per document says where it lies. A file is written under a name of its own by each
attempt of a task and the index names the files of the attempts that counted, so a lost executor
or a second attempt leaves at most an unused file.

Edge cases: a null or empty text is a document of the end id alone. Null ids come first. Rows with
the same id are ordered by a hash of their text. Columns other than id and text are not read. An
empty table writes no file and gives an empty index.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailweave.llm.bpe import TOKENIZER, ready, slices
from mailweave.llm.common import table
from mailweave.operators.joins import attach
from mailweave.session import scratch_path, stored

LENGTH = 2048
BATCH = 64
END_ID = 2
REMEMBERED = 500_000  # pieces a task keeps the ids of, some 100 MB


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Local folders, hdfs, s3 and other stores by their URI."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


class SequenceWriter:
    """Packs ids into sequences and writes them a record batch at a time."""

    def __init__(self, path: str, kind: pa.DataType, length: int) -> None:
        self.store, self.path = file_system(path)
        self.kind, self.length = kind, length
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.store.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.sink = self.store.open_output_stream(self.path + ".writing")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.written = 0

    def add(self, ids: np.ndarray) -> int:
        """Append one document; returns the place of its first id in the file."""
        at = self.written + self.held
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BATCH * self.length:
            self._write(self.held - self.held % (BATCH * self.length))
        return at

    def _write(self, count: int) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        self.waiting, self.held = ([flat[count:].copy()] if count < len(flat) else []), len(flat) - count
        step = BATCH * self.length
        for start in range(0, count, step):
            self._batch(flat[start : min(start + step, count)])

    def _batch(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        values = np.zeros(rows * self.length, dtype=self.kind.to_pandas_dtype())
        values[: len(ids)] = ids
        mask = np.arange(rows * self.length) < len(ids)
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values, self.kind), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.written += len(ids)

    def close(self) -> None:
        self._write(self.held)
        self.writer.close()
        self.sink.close()
        self.store.move(self.path + ".writing", self.path)


class SequenceReader:
    """Random access to the ids of one file; local files are mapped, not read."""

    def __init__(self, path: str) -> None:
        store, at = file_system(path)
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(at) if local else store.open_input_file(at)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.batch_no, self.flat = -1, None

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of one sequence, as views."""
        batch = self.file.get_batch(i // BATCH)
        row = batch.column("ids")[i % BATCH].values.to_numpy()
        return row, batch.column("mask")[i % BATCH].values

    def ids(self, at: int, n: int) -> np.ndarray:
        """The ``n`` ids from place ``at`` on."""
        step, parts = BATCH * self.length, []
        while n > 0:
            if self.batch_no != at // step:
                self.batch_no = at // step
                self.flat = self.file.get_batch(self.batch_no).column("ids").values.to_numpy()
            part = self.flat[at % step : at % step + n]
            parts.append(part)
            at, n = at + len(part), n - len(part)
        return np.concatenate(parts) if len(parts) != 1 else parts[0]

    def close(self) -> None:
        self.flat = self.file = None
        self.source.close()


def write_token_files(
    df: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    tokenizer: str | None = None,
) -> DataFrame:
    """Write the files below ``path``; returns the stored index, ``(doc_id, file, at, start,
    n_tokens)``: place in the file and among the ids of all documents."""
    tokens = tokenizer or public_tokenizers.path(TOKENIZER)
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(f"`{doc_id}`").cast("bigint")
    rows = df.select(key.alias("doc_id"), F.col(f"`{text}`").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    laid = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    run = uuid.uuid4().hex[:8]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = writer = None
        end = np.uint32(end_id).astype("<u4").tobytes()
        task = TaskContext.get()
        name = f"{path.rstrip('/')}/part-{task.partitionId():06d}-{run}-{task.taskAttemptId()}.arrow"
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if writer is None:
                bpe = ready(tokens, REMEMBERED)
                kind = pa.uint16() if max(len(bpe.names) - 1, end_id) < 1 << 16 else pa.uint32()
                writer = SequenceWriter(name, kind, length)
            row = 0
            for group in slices([t or "" for t in batch.column("text").to_pylist()]):
                at, sizes = [], []
                for ids in bpe.encode(group):
                    ids = np.frombuffer(ids + end, dtype="<u4")
                    at.append(writer.add(ids))
                    sizes.append(len(ids))
                part = batch.column("doc_id").slice(row, len(group))
                row += len(group)
                files = pa.array([name] * len(group), pa.string())
                order_no = pa.array([task.partitionId()] * len(group), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part, order_no, files, pa.array(at, pa.int64()), pa.array(sizes, pa.int64())],
                    names=["doc_id", "part", "file", "at", "n_tokens"],
                )
        if writer is not None:
            writer.close()

    places = stored(
        laid.mapInArrow(write, "doc_id bigint, part int, file string, at bigint, n_tokens bigint"), "token_index"
    )
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = places.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    starts = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("first"))
    return attach(places, starts, ["part"], ["at"], how="inner", size=parts * 64).select(
        "doc_id", "file", "at", (F.col("first") + F.col("at")).alias("start"), "n_tokens"
    )


def read_token_files(index: DataFrame) -> DataFrame:
    """The index and ``ids``, read back from the files: little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name = None, None
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                out = []
                rows = zip(*[batch.column(c).to_pylist() for c in ("file", "at", "n_tokens")])
                for file, at, n in rows:
                    if file != name:
                        if reader:
                            reader.close()
                        reader, name = SequenceReader(file), file
                    out.append(reader.ids(at, n).astype("<u4").tobytes())
                columns = [*batch.columns, pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "ids"])
        if reader:
            reader.close()

    schema = index.select("*", F.lit(b"").alias("ids")).schema
    return index.mapInArrow(read, schema)


def op1_token_files(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = write_token_files(docs, scratch_path(spark, "token_files"))
    return read_token_files(index).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").cast("bigint").alias("ids_crc32")
    )
