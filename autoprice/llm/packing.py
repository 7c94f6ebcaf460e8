"""Sum-of-squares packing of tokenised documents into sequences of a fixed capacity.

A document's ids (with an end id) form one piece, or, if longer than a sequence, pieces of full length
after a first piece with the rest. Pieces are placed one at a time, longest first: of the open sequences
with room, a piece goes into the one where the sum over residual gaps of the squared number of open
sequences with that gap becomes smallest (ties: the smallest gap left over); a sequence is begun only
where none has room. The rule keeps the open gaps spread, so that most lengths find an exact fit. (With a
new sequence as one more choice every time, as for pieces that come in any order, simulated length
distributions took 0.1 to 2.5 per cent more sequences.)

Pieces are dealt evenly to groups of about GROUP pieces and every group is packed by one task: their
number grows with the input, a group's rows and its gap table do not. A group leaves a few sequences
partly filled, a share that falls with GROUP.

Defined cases: null and empty texts are the end id alone; repeated rows are packed once each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from autoprice.llm.common import materialise, releasing
from autoprice.llm.tokens import FEW, REMEMBER, _encoders, encoder

CAPACITY = 2048
END_ID = 0
GROUP = 200_000
TEXTS = 1024


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, placed in the order given."""
    n_open = np.zeros(capacity + 1, np.int64)  # open sequences by gap; a gap of 0 is not open
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used = 0
    for i, size in enumerate(lengths.tolist()):
        room = np.flatnonzero(n_open[size:]) + size
        if len(room):
            # change of the sum when a gap g becomes g - size
            change = 2 * (n_open[room - size] - n_open[room]) + 2
            if room[0] == size:
                change[0] = 1 - 2 * n_open[size]  # full: no gap is left
            gap = int(room[change.argmin()])
            s = open_at[gap].pop()
            n_open[gap] -= 1
        else:
            gap, s, used = capacity, used, used + 1
        sequence[i], offset[i] = s, capacity - gap
        if gap > size:
            open_at[gap - size].append(s)
            n_open[gap - size] += 1
    return sequence, offset


def tokenised_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text",
                     capacity: int = CAPACITY, end_id: int = END_ID, release: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece of every document. With ``release``, a worker knows fewer
    units and gives their memory back after each task, for jobs whose other stages need it."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary, FEW if release else REMEMBER)
        encode = known.encode
        end = np.array([end_id], np.uint32)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                rows = []
                for r, own in enumerate(encode(batch.column(1))):
                    ids = np.append(own, end).astype("<u4").tobytes()
                    n = len(ids) // 4
                    start, piece = 0, 0
                    while start < n:
                        length = (n - start) % capacity or capacity
                        rows.append((r, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
                        start, piece = start + length, piece + 1
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(c[0])), pa.array(c[1], pa.int32())]
                    + [pa.array(x, pa.int64()) for x in c[2:]], names=["id", "piece", "start", "length", "ids_crc32"])
        if release:
            known.release()
            _encoders.clear()

    return base.mapInArrow(releasing(run), f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a materialised table with a ``length`` of at most ``capacity``) with sequence_id and offset."""
    groups = max(1, round(pieces.count() / GROUP))
    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got).combine_chunks()
        length = rows.column("length").to_numpy()
        order = np.lexsort((rows.column("start").to_numpy(), -length))
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        sequence[order], offset[order] = sum_of_squares(length[order], capacity)
        sequence += TaskContext.get().partitionId() << 40
        rows = rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from rows.to_batches()

    return pieces.repartition(groups).mapInArrow(releasing(run), schema)


def packed_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text",
                     release: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialise(tokenised_pieces(docs, vocabulary, id_col, text, release=release), "pieces")
    return pack(pieces).withColumnRenamed("id", id_col)
