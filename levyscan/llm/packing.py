"""Hierarchical packing: documents as token pieces in sequences of several context sizes.

A document's tokens are its text's ids and one closing id. Documents are routed by length to
the smallest context size (tier) that holds them; a longer document first fills windows of
the largest size. Each tier, from the longest down, opens a window for its longest piece;
the gap is filled with the longest pieces of shorter tiers that fit, and the last gap by
cutting a piece. What a slice of the input leaves over is cut into windows whose sizes are
powers of two, so that nothing is padded. Sequences of one size are dealt into step groups of equal token counts, so that each
group has about the same sum of squared piece lengths (the cost of attention).

Tasks pack what they have tokenised themselves: nothing is shuffled, a task holds at most
`BUFFER_TOKENS` ids and one document at a time, and a retried task that reads its rows in the
same order gives the same sequences. Sequence numbers carry the task's number in the upper bits.

Defined results: a null or empty text is one piece, the closing id; rows with one doc_id are
documents of their own; an empty table gives no piece; other columns are not read.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from levyscan.llm.common import only, slices
from levyscan.llm.wordpieces import default_tokenizer_path, tokenizer_for

WINDOW = 4096
TIERS = (512, 1024, 2048, WINDOW)
CLOSING_ID = 2
BUFFER_TOKENS = 2_000_000
STEP_TOKENS = 16 * WINDOW
_TASK_SHIFT = 33


def powers_of_two(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


class _Shelf:
    """Pieces that wait, by length: the longest that fits is found by bisection."""

    def __init__(self, pieces: list[tuple[int, int, int]]):
        self.by_length: dict[int, list[tuple[int, int, int]]] = {}
        for piece in pieces:
            self.by_length.setdefault(piece[2], []).append(piece)
        self.present = np.zeros(WINDOW + 1, dtype=bool)
        self.present[list(self.by_length)] = True
        self.left = sum(p[2] for p in pieces)

    def take(self, most: int) -> tuple[int, int, int] | None:
        """The longest piece of at most `most` tokens."""
        below = self.present[most::-1]
        at = int(below.argmax())
        if not below[at]:
            return None
        length = most - at
        piece = self.by_length[length].pop()
        if not self.by_length[length]:
            self.present[length] = False
        self.left -= length
        return piece

    def cut(self, length: int) -> tuple[int, int, int]:
        """The first `length` tokens of the longest piece; its rest stays."""
        doc, start, whole = self.take(WINDOW)
        if whole > length:
            self.by_length.setdefault(whole - length, []).append((doc, start + length, whole - length))
            self.present[whole - length] = True
            self.left += whole - length
        return doc, start, min(length, whole)


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (size, pieces) of documents given by length; a piece is (document, start,
    length). Every token lies in one piece, and every sequence is full."""
    top = tiers[-1]
    sequences, pieces = [], []
    for doc, length in enumerate(lengths):
        whole = length - length % top
        sequences += [(top, [(doc, at, top)]) for at in range(0, whole, top)]
        if length % top:
            pieces.append((doc, whole, length % top))
    shelf = _Shelf(pieces)

    def fill(size: int) -> None:
        room, inside = size, []
        while room:
            piece = shelf.take(room) or shelf.cut(room)
            inside.append(piece)
            room -= piece[2]
        sequences.append((size, inside))

    for tier, shorter in zip(reversed(tiers), [*reversed(tiers[:-1]), 0]):
        while shelf.left >= tier and shelf.present[shorter + 1 :].any():
            fill(tier)
    for size in powers_of_two(shelf.left):
        fill(size)
    return sequences


def step_groups(sequences: list[tuple[int, list[tuple[int, int, int]]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group for each sequence: sequences of one size by falling cost, dealt out and
    back over groups of `step_tokens` tokens."""
    groups, first = [0] * len(sequences), 0
    for size in sorted({s for s, _ in sequences}, reverse=True):
        own = [i for i, (s, _) in enumerate(sequences) if s == size]
        own.sort(key=lambda i: (-sum(p[2] ** 2 for p in sequences[i][1]), i))
        n = max(1, -(-len(own) * size // step_tokens))
        for place, i in enumerate(own):
            turn, at = divmod(place, n)
            groups[i] = first + (at if turn % 2 == 0 else n - 1 - at)
        first += n
    return groups


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    closing_id: int = CLOSING_ID,
    tiers: tuple[int, ...] = TIERS,
    buffer_tokens: int = BUFFER_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    context (the sequence's size), step_group, and the ids themselves if asked for."""
    path = tokenizer_path or default_tokenizer_path()
    docs = only(docs, doc_id=id_col, text=text_col)
    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, context long, step_group long" + (", ids array<long>" if with_ids else "")
    )
    end = np.array([closing_id], dtype="<u4")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_for(path)
        task = (TaskContext.get().partitionId() if TaskContext.get() else 0) << _TASK_SHIFT
        numbers, groups = task, task
        held_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def flush():
            nonlocal numbers, groups
            sequences = pack([len(i) for i in held], tiers)
            steps = step_groups(sequences)
            columns: list[list] = [[] for _ in range(9 + with_ids)]
            for k, (context, inside) in enumerate(sequences):
                offset = 0
                for doc, start, length in inside:
                    ids = held[doc][start : start + length]
                    row = (held_ids[doc], start, length, zlib.crc32(ids.tobytes()), len(held[doc]), numbers + k, offset, context, groups + steps[k])
                    for column, value in zip(columns, row):
                        column.append(value)
                    if with_ids:
                        columns[9].append(ids.astype(np.int64))
                    offset += length
            numbers += len(sequences)
            groups += max(steps) + 1
            kinds = [ids_kind, *[pa.int64()] * 8, pa.list_(pa.int64())]
            names = [f.split()[0] for f in schema.split(", ")]
            return pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})

        ids_kind = None
        for batch in slices(batches, 1, 1 << 21):
            ids_kind = batch.column(0).type
            for doc, ids in zip(batch.column(0).to_pylist(), tokenizer.encode(batch.column(1))):
                held_ids.append(doc)
                held.append(np.append(ids, end))
                size += len(ids) + 1
            if size >= buffer_tokens:
                yield flush()
                held_ids, held, size = [], [], 0
        if held:
            yield flush()

    return docs.mapInArrow(packed, schema)
