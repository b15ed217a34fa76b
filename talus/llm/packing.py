"""Cost-balanced packing of documents into training sequences.

Documents are encoded and packed in blocks of bounded size, where they lie: no
shuffle. A piece of ``l`` tokens costs ``l + l * l / length`` (the linear layers
and its own attention). A block's tokens define its sequences: as many full
ones as they fill and, for the rest, one for each power of two in the
remainder, so nothing needs padding. Pieces are then dealt in descending order
to the sequence with the lowest cost so far that has room; where none has, the
roomiest takes what it can and the rest of the piece is dealt again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import to_workers
from .encode import encoder, word_vocabulary

LENGTH = 2048
#: The id that ends each document.
END = 1
#: Tokens packed together: a bound on memory.
BLOCK_TOKENS = 4_000_000

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def sequence_sizes(tokens: int, length: int = LENGTH) -> np.ndarray:
    """Capacities that add up to ``tokens``: ``length`` each, then powers of two."""
    full, rest = divmod(tokens, length)
    return np.array([length] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1], dtype=np.int64)


def pack(lengths: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, tokens, sequence, offset)`` of each piece of a block.

    ``lengths`` are the documents' tokens; sequences are numbered from 0. Every
    token lies in one piece, and every sequence of :func:`sequence_sizes` is full.
    """
    room = sequence_sizes(sum(lengths), length)
    size, cost = room.copy(), np.zeros(len(room))
    out: list[tuple[int, int, int, int, int]] = []

    def place(doc: int, start: int, tokens: int, seq: int) -> None:
        out.append((doc, start, tokens, seq, int(size[seq] - room[seq])))
        room[seq] -= tokens
        cost[seq] += tokens + tokens * tokens / length if room[seq] else np.inf

    # Full-length pieces fill sequences of their own; what is left of each document is dealt out.
    nth = 0
    rests: list[tuple[int, int, int]] = []
    for doc, tokens in enumerate(lengths):
        for start in range(0, tokens - length + 1, length):
            place(doc, start, length, nth)
            nth += 1
        if tokens % length:
            rests.append((tokens % length, doc, tokens - tokens % length))
    rests.sort(key=lambda r: (-r[0], r[1]))
    for tokens, doc, start in rests:
        while tokens:
            costs = np.where(room >= tokens, cost, np.inf)
            seq = int(costs.argmin())
            if not np.isfinite(costs[seq]):
                seq = int(room.argmax())
            taken = min(tokens, int(room[seq]))
            place(doc, start, taken, seq)
            start, tokens = start + taken, tokens - taken
    return out


def packed(
    docs: DataFrame,
    vocabulary: str | None = None,
    text: str = "text",
    id_col: str = "doc_id",
    length: int = LENGTH,
    block_tokens: int = BLOCK_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens (a power of two).

    Returns a row for each piece: ``doc_id``; ``start``, its document's ids
    before it; ``length``; ``ids_crc32`` of its ids as little-endian 32-bit
    integers; ``doc_tokens``, the document's ids with the end id;
    ``sequence_id``; ``offset`` in the sequence; and with ``with_ids`` the
    ``ids``.

    A null or blank text is the end id alone. Repeated rows and ids are packed
    as often as they occur, null ids stay null, an empty table gives no rows.
    Costs are balanced within a task's block of about ``block_tokens``, not
    across blocks; a document is always of one block, however long. Ids of
    sequences combine task and number,
    so a task that runs again gives the same ones. Other columns are not read.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    path = vocabulary or word_vocabulary()
    end = END.to_bytes(4, "little")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        encode = words.encode
        nth = TaskContext.get().partitionId() << 36
        block: list[tuple[int | None, bytes]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal nth
            pieces = pack([len(ids) // 4 for _, ids in block], length)
            made = []
            for doc, start, tokens, seq, offset in pieces:
                doc_id, ids = block[doc]
                part = ids[4 * start : 4 * (start + tokens)]
                row = (doc_id, start, tokens, zlib.crc32(part), len(ids) // 4, nth + seq, offset)
                made.append(row + (np.frombuffer(part, "<i4"),) if with_ids else row)
            nth += 1 + max(p[3] for p in pieces)
            columns = [pa.array(values, field.type) for values, field in zip(zip(*made), arrow)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for doc_id, whole in zip(batch.column(0), batch.column(1)):
                ids = encode(whole.as_py()) + end
                block.append((doc_id.as_py(), ids))
                held += len(ids) // 4
                if held >= block_tokens:
                    yield flush()
                    block, held = [], 0
        words.forget()
        if block:
            yield flush()

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    arrow = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")] + [("ids", pa.list_(pa.int32()))] * with_ids)
    read = to_workers(docs).select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(rows, schema)
