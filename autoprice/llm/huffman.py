"""Token ids in a canonical, length-limited Huffman file format.

The codebook comes from the global counts of all ids: code lengths of at most MAX_BITS by package-merge,
codes assigned canonically (by length, then id), so the lengths alone are the stored codebook.

The store is a folder with two Parquet tables. ``codebook`` has (id, bits). ``blocks`` has one row per
independent block of consecutive documents, up to BLOCK ids (a longer document is a block of its own):
``part`` (file number, in document order), ``block`` (number in the part), ``before`` (ids ahead of it in the
part), ``doc`` and ``doc_ids`` (its documents and their numbers of ids), ``payload`` (the bit stream; a document
begins at a whole byte) and ``checkpoints`` (bit offsets of every STEP-th id of each document). Documents
come in ascending id order over parts, blocks and places.

Decoding looks up MAX_BITS bits at a time in a table of (id, length); the checkpoints are lanes that all
advance together.

Defined cases: null and empty texts are the end id alone; rows that repeat an id are stored one after the
other; a null id comes first; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autoprice.llm.common import materialise, releasing, shared_path, shuffle_partitions, text_batches
from autoprice.llm.textcore import slices
from autoprice.llm.tokens import _encoders, encoder

MAX_BITS = 16
BLOCK = 1 << 16
STEP = 256
TEXTS = 1024
CODED = 1 << 16  # ids that are coded at a time: about 10 MB of arrays
LANE_BLOCKS = 8


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for the ids with a count (package-merge)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    n = len(order)
    # each level lists the leaves merged with the pairs of the level below, by weight
    leaf_flags, level = [], weight
    is_leaf = np.ones(n, bool)
    leaf_flags.append(is_leaf)
    for _ in range(limit - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        place = np.argsort(both, kind="stable")
        leaf_flags.append(place < n)
        level = both[place]
    take = 2 * n - 2
    lengths = np.zeros(n, np.int64)
    for is_leaf in reversed(leaf_flags):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    codes = np.zeros(len(lengths), np.int64)
    ids = np.lexsort((np.arange(len(lengths)), lengths))
    ids = ids[lengths[ids] > 0]
    code, before = 0, 0
    first = {}
    per_length = np.bincount(lengths[ids], minlength=MAX_BITS + 1) if len(ids) else np.zeros(MAX_BITS + 1, np.int64)
    for bits in range(1, len(per_length)):
        code = (code + before) << 1
        first[bits] = code
        before = int(per_length[bits])
    rank = np.arange(len(ids)) - np.concatenate([[0], np.cumsum(per_length)])[lengths[ids]]
    codes[ids] = np.array([first[b] for b in lengths[ids].tolist()], np.int64) + rank
    return codes


def encode_documents(documents: list[np.ndarray], lengths: np.ndarray, codes: np.ndarray) -> list[tuple[bytes, np.ndarray]]:
    """(bit stream of whole bytes, bit offset of every STEP-th id) of each document."""
    n = np.array([len(x) for x in documents], np.int64)
    ids = np.concatenate([*documents, np.zeros(0, np.uint16)]).astype(np.int64)
    bits = lengths[ids]
    begin = np.cumsum(bits) - bits
    first = np.cumsum(n) - n
    total = np.add.reduceat(np.append(bits, 0), first) * (n > 0) if len(n) else n
    size = (total + 7) // 8
    at_byte = np.cumsum(size) - size
    own = begin - np.repeat(begin[np.minimum(first, max(len(ids) - 1, 0))] if len(ids) else first, n)  # within its document
    place = own + 8 * np.repeat(at_byte, n)
    # a code of at most 16 bits at bit offset 0..7 lies within three bytes
    word = codes[ids] << (24 - bits - (place & 7))  # 24 bits from the byte it begins in
    at, end = place >> 3, int(size.sum())
    out = np.zeros(end + 3, np.int64)
    for k in range(3):
        out += np.bincount(at + k, weights=(word >> (16 - 8 * k)) & 255, minlength=end + 3).astype(np.int64)
    raw = out[:end].astype(np.uint8).tobytes()
    return [(raw[b:b + s], own[f:f + m:STEP]) for b, s, f, m in zip(at_byte.tolist(), size.tolist(), first.tolist(), n.tolist())]


def coded(documents: list[np.ndarray], lengths: np.ndarray, codes: np.ndarray) -> Iterator[tuple[bytes, np.ndarray]]:
    """As ``encode_documents``, in arrays of CODED ids (or one longer document's)."""
    for i, j in slices(np.cumsum([0, *map(len, documents)]), CODED):
        yield from encode_documents(documents[i:j], lengths, codes)


def encode_ids(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bit stream, bit offset of every STEP-th id) of one document."""
    return encode_documents([ids], lengths, codes)[0]


def decode_table(lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, length) for every MAX_BITS bits that can come next."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    span = 1 << (MAX_BITS - lengths[ids])
    symbol, bits = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.int64)
    start = codes[ids] << (MAX_BITS - lengths[ids])
    symbol[:span.sum()] = np.repeat(ids, span)
    bits[:span.sum()] = np.repeat(lengths[ids], span)
    assert not len(ids) or (start == np.cumsum(span) - span).all()
    return symbol, bits


def decode_lanes(payloads: list[bytes], checkpoints: list[np.ndarray], sizes: list[np.ndarray], table) -> np.ndarray:
    """All ids of the blocks, in order. ``sizes`` are the ids of each document; every checkpoint is a lane,
    and the lanes of all blocks decode side by side."""
    symbol, bits = table
    n = np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)
    data = np.frombuffer(b"".join(payloads) + bytes(4), np.uint8)
    word = ((data[:-3].astype(np.uint32) << 24) | (data[1:-2].astype(np.uint32) << 16)
            | (data[2:-1].astype(np.uint32) << 8) | data[3:])
    base = np.cumsum([0, *map(len, payloads)])[:-1] * 8
    lanes = np.concatenate([*(c + b for c, b in zip(checkpoints, base)), np.zeros(0, np.int64)]).astype(np.int64)
    per_doc = -(-n // STEP)
    nth = np.arange(per_doc.sum()) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    left = np.minimum(np.repeat(n, per_doc) - nth * STEP, STEP)
    out = np.zeros((STEP, len(lanes)), np.uint32)
    last = len(word) - 1
    for k in range(int(left.max()) if len(left) else 0):
        peek = (word[np.minimum(lanes >> 3, last)] >> (16 - (lanes & 7)).astype(np.uint32)) & 0xFFFF
        out[k] = symbol[peek]
        lanes += bits[peek]
    return out.T[np.arange(STEP)[None, :] < left[:, None]]


def _tokenised(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text: str) -> DataFrame:
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, squeeze = encoder(vocabulary), zstandard.ZstdCompressor(level=1).compress
        encode = known.encode
        end = np.array([end_id], np.uint32)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                ids = [np.append(x, end) for x in encode(batch.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([squeeze(x.astype(f"<u{_narrow(x)().itemsize}").tobytes()) for x in ids], pa.binary()),
                     pa.array([_narrow(x)().itemsize for x in ids], pa.int32())], names=["id", "ids", "width"])
        known.release()  # counting and coding run in the same workers
        _encoders.clear()

    return base.mapInArrow(releasing(run), f"id {base.schema['id'].dataType.simpleString()}, ids binary, width int")


def _narrow(ids: np.ndarray) -> type:
    return np.uint16 if not len(ids) or ids.max() < 1 << 16 else np.uint32


def _stored(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    for x, width in zip(batch.column("ids").to_pylist(), batch.column("width").to_pylist()):
        yield np.frombuffer(expand(x), f"<u{width}")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        c = np.bincount(np.concatenate([*_stored(batch), np.zeros(0, np.uint16)]), minlength=len(total))
        c[:len(total)] += total
        total = c
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["token", "n"])


def write_store(docs: DataFrame, vocabulary: str, end_id: int, path: str, id_col: str = "doc_id", text: str = "text",
                parts: int | None = None) -> None:
    """Tokenise ``docs`` (null text: empty), append ``end_id`` to each and write the store to ``path``.

    The ids are kept once, compressed, between counting and coding. A document is coded before the
    shuffle that puts the documents in order (so that shuffles its coded size), as a stream of whole bytes.
    """
    spark = docs.sparkSession
    ids = materialise(_tokenised(docs, vocabulary, end_id, id_col, text), "ids")
    # one row per id of the vocabulary at most
    seen = ids.mapInArrow(releasing(_count), "token int, n bigint").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([x.token for x in seen], default=0) + 1, np.int64)
    for x in seen:
        counts[x.token] = x.n
    lengths = code_lengths(counts)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "token int, bits int") \
        .coalesce(1).write.parquet(f"{path}/codebook")
    book = spark.sparkContext.broadcast((lengths, canonical_codes(lengths)))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
            stored = list(_stored(batch))
            made = list(coded(stored, *book.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array([len(x) for x in stored], pa.int64()),
                 pa.array([m[0] for m in made], pa.binary()), pa.array([m[1].tolist() for m in made], pa.list_(pa.int64()))],
                names=["id", "row", "n", "bits", "marks"])

    id_type = ids.schema["id"].dataType.simpleString()
    streams = ids.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        releasing(code), f"id {id_type}, row bigint, n bigint, bits binary, marks array<bigint>")
    ordered = streams.repartitionByRange(parts or shuffle_partitions(spark), "id", "row").sortWithinPartitions("id", "row")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before, held, used = TaskContext.get().partitionId(), 0, 0, [], 0

        def close() -> pa.RecordBatch:
            at, marks = 0, []
            for _, _, bits, own in held:
                marks += [m + at for m in own]
                at += 8 * len(bits)
            one = lambda x, kind: pa.array([x], pa.list_(kind))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([b"".join(h[2] for h in held)], pa.binary()), one(marks, pa.int64()),
                 one([h[0] for h in held], kind), one([h[1] for h in held], pa.int64())],
                names=["part", "block", "before", "payload", "checkpoints", "doc", "doc_ids"])

        for batch in batches:
            kind = batch.schema.field("id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "bits", "marks"))):
                if held and used + row[1] > BLOCK:
                    yield close()
                    block, before, held, used = block + 1, before + used, [], 0
                held.append(row)
                used += row[1]
        if held:
            yield close()

    ordered.mapInArrow(releasing(blocks), "part int, block int, before bigint, payload binary, checkpoints array<bigint>, "
                               f"doc array<{id_type}>, doc_ids array<bigint>") \
        .write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, ids) of every document of a store: ``start`` counts the ids of all documents before it,
    ``ids`` are little-endian unsigned 32-bit integers."""
    lengths_of = {r.token: r.bits for r in spark.read.parquet(f"{path}/codebook").collect()}
    lengths = np.zeros(max(lengths_of, default=0) + 1, np.int64)
    for token, bits in lengths_of.items():
        lengths[token] = bits
    book = spark.sparkContext.broadcast(decode_table(lengths, canonical_codes(lengths)))
    stored = text_batches(spark.read.parquet(f"{path}/blocks"))
    # one row per file
    sizes = stored.groupBy("part").agg(F.sum(F.aggregate("doc_ids", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n")) \
        .orderBy("part").collect()
    begin, offsets = 0, []
    for x in sizes:
        offsets.append((x.part, begin))
        begin += x.n
    offsets = spark.createDataFrame(offsets, "part int, begin bigint")
    id_type = stored.schema["doc"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, LANE_BLOCKS):
                batch = whole.slice(at, LANE_BLOCKS)
                rows = {c: batch.column(c).to_pylist() for c in ("payload", "checkpoints", "doc", "doc_ids", "first")}
                n = [np.array(x, np.int64) for x in rows["doc_ids"]]
                ids = decode_lanes(rows["payload"], [np.array(x, np.int64) for x in rows["checkpoints"]], n, book.value)
                size = np.concatenate(n)
                end = np.cumsum(size)
                start = np.concatenate([f + np.cumsum(x) - x for f, x in zip(rows["first"], n)])
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").flatten(), pa.array(start),
                     pa.array([raw[4 * (b - s):4 * b] for s, b in zip(size.tolist(), end.tolist())], pa.binary())],
                    names=["id", "start", "ids"])

    return (stored.join(F.broadcast(offsets), "part")
            .select("payload", "checkpoints", "doc", "doc_ids", (F.col("begin") + F.col("before")).alias("first"))
            .mapInArrow(releasing(decode), f"id {id_type}, start bigint, ids binary"))


def stored_documents(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the store below the shared folder, read it back, and digest each document: id, start, n_tokens,
    ids_crc32."""
    path = shared_path(docs.sparkSession, "huffman")
    write_store(docs, vocabulary, end_id, path, id_col, text)
    return read_store(docs.sparkSession, path).select(
        F.col("id").alias(id_col), "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
