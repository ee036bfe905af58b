"""Token ids as Arrow files of equal-length sequences, for reading at random without copying."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrec.llm.columns import quoted, text_or_empty
from sitrec.llm.word_tokens import WordEncoder, byte_slices, text_array, tokenizer_path
from sitrec.storage import new_path, written

SEQUENCES = 128  # of a record batch


def _files(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


class _Shard:
    """Writes one shard: ids cut into sequences, and the documents they belong to."""

    def __init__(self, fs, path: str, attempt: int, length: int, id_type: pa.DataType, key: pa.DataType):
        self.fs, self.path, self.attempt = fs, path, attempt
        self.length, self.key = length, key
        self.schema = pa.schema([("ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.docs_schema = pa.schema([("doc_id", key), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.ids = self._open(".ids", self.schema)
        self.docs = self._open(".docs", self.docs_schema)
        self.rest = np.empty(0, np.uint32)
        self.n_docs = self.n_tokens = 0

    def _open(self, kind: str, schema: pa.Schema) -> tuple:
        out = self.fs.open_output_stream(f"{self.path}{kind}.{self.attempt}")
        return out, pa.ipc.new_file(out, schema)

    def _sequences(self, ids: np.ndarray) -> None:
        pad = -len(ids) % self.length
        mask = np.ones(len(ids) + pad, bool)
        if pad:
            mask[len(ids) :] = False
            ids = np.concatenate([ids, np.zeros(pad, ids.dtype)])
        kind = self.schema.field("ids").type
        self.ids[1].write_batch(
            pa.RecordBatch.from_arrays(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(ids).cast(kind.value_type), self.length),
                    pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                ],
                schema=self.schema,
            )
        )

    def add(self, keys: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> None:
        start, count = self.n_tokens + offsets[:-1], np.diff(offsets)
        self.docs[1].write_batch(
            pa.RecordBatch.from_arrays([keys, pa.array(start), pa.array(count)], schema=self.docs_schema)
        )
        self.n_docs += len(keys)
        self.n_tokens += int(offsets[-1])
        ids = np.concatenate([self.rest, ids])
        step = SEQUENCES * self.length
        whole = len(ids) // step * step
        for at in range(0, whole, step):
            self._sequences(ids[at : at + step])
        self.rest = ids[whole:].copy()

    def close(self) -> None:
        """Finish both files; only then do they get their names, so a lost task leaves none behind."""
        if len(self.rest):
            self._sequences(self.rest)
        for kind, (out, writer) in ((".ids", self.ids), (".docs", self.docs)):
            writer.close()
            out.close()
            self.fs.move(f"{self.path}{kind}.{self.attempt}", f"{self.path}{kind}.arrow")


def write_token_files(
    docs: DataFrame,
    folder: str,
    end_id: int = 2,
    length: int = 2048,
    path: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Write the ids of all documents in ascending order of id; returns one row per shard.

    A shard holds a range of ids in two Arrow files.  ``<shard>.ids.arrow`` has record batches of ``SEQUENCES``
    rows (the last may be shorter): ``ids``, a fixed-size list of ``length`` numbers of 16 bits if the
    vocabulary allows and else 32, and ``mask``, false where the last sequence of the shard is padded with 0.
    ``<shard>.docs.arrow`` has ``doc_id, start, n_tokens``, the start within the shard.  The result is
    ``shard, path, n_docs, n_tokens, base``: a document's place in the whole is its base plus its start.

    A document is its ids and ``end_id``; a null text is empty, a null id stands before all others, and rows
    that repeat an id follow each other in the order of their texts' hashes.  Other columns are not carried.  An
    empty table gives no shards.  ``folder`` must be in a store that every executor can write to.
    """
    path = path or tokenizer_path()
    pa_key = pa.string() if dict(docs.dtypes)[doc_id] == "string" else None
    uri = folder.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, place = _files(uri)
        encoder, shard = None, None
        for batch in batches:
            if encoder is None:
                encoder = WordEncoder(path)
                small = encoder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
                key = pa_key or batch.schema.field(0).type
                name = f"{place}/shard-{task.partitionId():06d}"
                shard = _Shard(fs, name, task.taskAttemptId(), length, pa.uint16() if small else pa.uint32(), key)
            texts = text_array(batch.column(1))
            for begin, part in byte_slices(texts):
                shard.add(batch.column(0).slice(begin, len(part)).cast(shard.key), *encoder.encode(part, end_id))
        if shard is not None:
            shard.close()
            row = [[task.partitionId()], [f"{uri}/shard-{task.partitionId():06d}"], [shard.n_docs], [shard.n_tokens]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], names=["shard", "path", "n_docs", "n_tokens"])

    fs, place = _files(uri)
    fs.create_dir(place, recursive=True)
    whole = text_or_empty(text)
    table = docs.select(quoted(doc_id).alias("doc_id"), whole.alias("text"))
    keys = ["doc_id", F.xxhash64("text")]
    ordered = table.repartitionByRange(*keys).sortWithinPartitions(*keys)
    shards = ordered.mapInArrow(write, "shard long, path string, n_docs long, n_tokens long")
    # one row per shard, whatever the shard holds
    rows, base = [], 0
    for r in sorted(shards.collect()):
        rows.append((*r, base))
        base += r.n_tokens
    schema = "shard long, path string, n_docs long, n_tokens long, base long"
    return written(docs.sparkSession.createDataFrame(rows, schema), "shards")


def sequence(path: str, number: int) -> tuple[np.ndarray, pa.Array]:
    """Ids and mask of one sequence of a shard on a local path; the ids are a view of the mapped file."""
    with pa.memory_map(f"{path}.ids.arrow") as mapped:
        file = pa.ipc.open_file(mapped)
        batch = file.get_batch(number // SEQUENCES)
        ids, mask = (batch.column(c)[number % SEQUENCES].values for c in ("ids", "mask"))
        return ids.to_numpy(), mask


def _shard_ids(file: pa.ipc.RecordBatchFileReader) -> Iterator[np.ndarray]:
    for i in range(file.num_record_batches):
        batch = file.get_batch(i)
        ids = batch.column("ids").flatten().to_numpy(zero_copy_only=False)
        mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
        yield ids[mask].astype("<u4")


def read_token_files(shards: DataFrame, key: str = "long") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files that ``shards`` lists.

    Files are read batch by batch, so a task needs the memory of one batch and the shard's documents.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, place = _files(uri)
                with fs.open_input_file(f"{place}.docs.arrow") as f:
                    docs = pa.ipc.open_file(f).read_all().combine_chunks()
                first = docs["start"].to_numpy()
                ends = first + docs["n_tokens"].to_numpy()
                crc = np.zeros(len(first), np.int64)
                done, at = 0, 0
                with fs.open_input_file(f"{place}.ids.arrow") as f:
                    for ids in _shard_ids(pa.ipc.open_file(f)):
                        last = done + len(ids)
                        while at < len(first):
                            a, b = max(int(first[at]), done), min(int(ends[at]), last)
                            crc[at] = zlib.crc32(ids[a - done : b - done], int(crc[at]))
                            if ends[at] > last:  # the document goes on in the next batch
                                break
                            at += 1
                        done = last
                yield pa.RecordBatch.from_arrays(
                    [docs["doc_id"].combine_chunks(), pa.array(first + base), docs["n_tokens"].combine_chunks(), pa.array(crc)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = f"doc_id {key}, start long, n_tokens long, ids_crc32 long"
    listed = shards.select("path", "base")
    return listed.repartition(max(1, shards.count())).mapInArrow(read, schema)


def token_files(docs: DataFrame, folder: str | None = None, doc_id: str = "doc_id", **how) -> DataFrame:
    """Write all documents (see ``write_token_files``) and read them back, one row per document."""
    folder = folder or new_path(docs.sparkSession, "tokens")
    shards = write_token_files(docs, folder, doc_id=doc_id, **how)
    return read_token_files(shards, docs.select(quoted(doc_id)).schema[0].dataType.simpleString())
