"""Token ids in binary files: frequency-ranked, byte-aligned, control bytes apart from data bytes.

A file is a sequence of self-contained blocks, documents in ascending id. A block holds
``b"TOKB"``, six little-endian uint64 (documents, ids, distinct ids, bytes of doc ids and lengths,
control bytes, data bytes), the document ids and lengths, the ids by falling frequency in the block
(uint32), the control bytes and the data bytes. An id is written as its rank in 1 to 4 bytes; its
length less one is two bits of a control byte, four ids each. The frequencies are those of all ids in
the block. Decoding takes lengths of four ids at once from a table of the 256 control bytes, and gathers.

A first pass deals the texts by ranges of ids, so a file follows on the one before; a task encodes its
texts and writes its file under a name of its attempt before moving it into place.

Defined results: null text is empty and gives the end id alone; rows with a null id are left out;
rows that repeat an id are all written, side by side; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.bpe import PieceEncoder
from orrery.llm.files import open_store, put
from orrery.llm.shared import Workspace, task_count
from orrery.llm.wordhash import buffers, pieces

MAGIC = b"TOKB"
HEAD = struct.Struct("<4s6Q")
#: Ids of a block (one document at least).
BLOCK_IDS = 1_000_000
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def encode_block(doc_ids: list[int], documents: list[np.ndarray], end_id: int) -> bytes:
    """A block of documents, each followed by the end id."""
    end = np.array([end_id], np.uint32)
    ids = np.concatenate([part for d in documents for part in (d, end)])
    counts = np.bincount(ids)
    by_rank = np.argsort(-counts, kind="stable")[: int((counts > 0).sum())].astype(np.uint32)
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    rank = rank_of[ids]
    length = 1 + (rank > 0xFF).astype(np.uint8) + (rank > 0xFFFF) + (rank > 0xFFFFFF)
    codes = np.zeros(-(-len(rank) // 4) * 4, np.uint8)
    codes[: len(rank)] = length - 1
    control = (codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6).astype(np.uint8)
    wide = int(length.max())
    data = rank.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :wide][np.arange(wide) < length[:, None]]
    names = np.array(doc_ids, "<i8").tobytes() + np.array([len(d) + 1 for d in documents], "<i8").tobytes()
    head = HEAD.pack(MAGIC, len(doc_ids), len(ids), len(by_rank), len(names), len(control), len(data))
    return head + names + by_rank.astype("<u4").tobytes() + control.tobytes() + data.tobytes()


def decode_block(stream) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(document ids, lengths, ids) of the next block, None at the end."""
    head = stream.read(HEAD.size)
    if not head:
        return None
    magic, n, total, distinct, names, controls, size = HEAD.unpack(head)
    if magic != MAGIC:
        raise ValueError("not a token block")
    both = np.frombuffer(stream.read(names), "<i8")
    by_rank = np.frombuffer(stream.read(distinct * 4), "<u4")
    length = LENGTHS[np.frombuffer(stream.read(controls), np.uint8)].reshape(-1)[:total]
    data = np.frombuffer(stream.read(size), np.uint8)
    begin = np.cumsum(length, dtype=np.int64) - length
    rank = data[begin].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(length > k)
        rank[more] |= data[begin[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return both[:n], both[n:], by_rank[rank]


def _write(root: str, tokenizer_path: str, end_id: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        encoder = PieceEncoder.of(tokenizer_path)
        totals = [0, 0]

        def blocks(out):
            held: tuple[list, list] = ([], [])
            size = 0
            for batch in batches:
                ids = batch.column(0).to_pylist()
                _, at = buffers(batch.column(1))
                for lo, hi in pieces(at, 1_000_000):
                    for doc, found in zip(ids[lo:hi], encoder.encode(batch.column(1).slice(lo, hi - lo).to_pylist())):
                        held[0].append(doc)
                        held[1].append(found)
                        size += len(found) + 1
                        totals[0] += 1
                        totals[1] += len(found) + 1
                        if size >= BLOCK_IDS:
                            out.write(encode_block(*held, end_id))
                            held, size = ([], []), 0
            if held[0]:
                out.write(encode_block(*held, end_id))

        name = f"part-{part:06d}.tok"
        put(root, name, blocks)
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([name]), pa.array([totals[0]]), pa.array([totals[1]])], names=["part", "name", "n_docs", "n_ids"])

    return run


def write_token_files(docs: DataFrame, root: str, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Writes the files of all documents; (part, name, n_docs, n_ids) of each, in order of part."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("doc_id is not null")
    dealt = docs.repartitionByRange(task_count(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return dealt.mapInArrow(_write(root, tokenizer_path, end_id), "part long, name string, n_docs long, n_ids long")


def _read(root: str):
    def run(batches):
        store, path = open_store(root)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_stream(f"{path}/{name}", compression=None, buffer_size=1 << 20) as stream:
                    while (block := decode_block(stream)) is not None:
                        docs, lengths, ids = block
                        ends = np.cumsum(lengths)
                        raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                        yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(start + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(ends[-1])

    return run


def read_token_files(files: DataFrame, root: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read from the files; files: the rows of write_token_files."""
    spark, start, rows = files.sparkSession, 0, []
    for r in sorted(files.where("n_docs > 0").collect(), key=lambda r: r["part"]):  # a row a file
        rows.append((r["name"], start))
        start += r["n_ids"]
    table = spark.createDataFrame(rows, "name string, start long").repartition(max(1, len(rows)))
    return table.mapInArrow(_read(root), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> tuple[str, DataFrame]:
    """(folder, file rows) of the documents' token files in the shared folder."""
    ws = Workspace(docs.sparkSession, "tokens")
    root = ws.path("files")
    return root, ws.save(write_token_files(docs, root, tokenizer_path, end_id), "parts")
