"""Packing of documents into training sequences of one length, balanced by cost.

The cost of a piece of n tokens is linear plus quadratic, as attention within a document has it. Pieces as long as a
sequence are one; the rest of a document waits in a block. Of each block, pieces go in descending cost to the sequence of
the lowest cost that has room, and a piece that fits nowhere is cut. A task packs the documents that it reads, a block at a
time, so nothing is shuffled and memory is bounded by the block and one document. A block's sequences are all full, what is
over goes to the next one; what a task has over at its end fills sequences whose lengths are powers of two, which need no
padding.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Cost of n tokens: LINEAR * n + QUADRATIC * n^2. Width 1024 layers spend as much on 6 * 1024 tokens of attention as on the rest.
LINEAR, QUADRATIC = 6 * 1024, 1
#: Sequences that a block fills.
BLOCK_SEQUENCES = 512
#: Characters tokenized at a time, and output rows' bytes of ids sent at a time.
CHUNK_CHARS, SENT_BYTES = 1 << 20, 1 << 22

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Fixed value: how byte-level vocabularies of this kind split texts before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts on which an encoder must agree with the library that the file belongs to, before it is used.
_PROBES = ("It's 12 o'clock;  we'll see\n\n\tTHE end.", " \u00e9t\u00e9 \u00df \u4f60\u597d \U0001f389\u200d x1\u00b2 \u0661", "<|endoftext|> a  b   ", "\x00\x1f\x85\u2003z")


def _byte_names() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones are themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder:
    """Ids of texts by a byte-level BPE file of the library tokenizers.

    The merges run in tiktoken, several times faster than in the library itself, with the file's vocabulary, whose ids are in the
    order of its merges. Both must agree on some texts first. Strings of special tokens are ordinary text, as with
    encode_special_tokens.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        if library.normalizer is not None or not isinstance(library.pre_tokenizer, pre_tokenizers.ByteLevel) or library.pre_tokenizer.add_prefix_space:
            raise ValueError(f"{path} is no byte-level vocabulary without normalization")
        names = _byte_names()
        special = {t.content for t in library.get_added_tokens_decoder().values()}
        ranks = {bytes(names[c] for c in token): n for token, n in library.get_vocab(with_added_tokens=False).items() if token not in special}
        self.encode = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for text in _PROBES:
            if self.encode(text) != library.encode(text, add_special_tokens=False).ids:
                raise ValueError(f"{path} does not merge in the order of its ids")

    def ids(self, text: str) -> np.ndarray:
        """Ids of the whole text as little-endian unsigned 32 bit numbers; long ones in chunks, cut where the splitting cuts."""
        out, at = [], 0
        while at < len(text):
            cut = _BETWEEN.search(text, at + CHUNK_CHARS) if len(text) - at > CHUNK_CHARS else None
            end = cut.start() if cut else len(text)
            out.append(np.array(self.encode(text[at:end]), dtype="<u4"))
            at = end  # the space goes with the word behind it
        return np.concatenate(out) if out else np.empty(0, "<u4")


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """A worker process makes each encoder once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cost(length: int) -> int:
    return LINEAR * length + QUADRATIC * length * length


def balance(lengths: list[int], rooms: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each sequence, of `rooms` tokens, its parts (piece, from, to), filled in that order.

    Pieces go in descending cost, each whole to the sequence of the lowest cost with room for it; where none has, the
    lowest-cost sequence takes as much as it has room for. Stops when the sequences are full.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in rooms]
    free, spent = np.array(rooms, dtype=np.int64), np.zeros(len(rooms), dtype=np.int64)
    waiting = [(-n, p, 0) for p, n in enumerate(lengths)]
    heapq.heapify(waiting)
    most = np.iinfo(np.int64).max
    while waiting and free.any():
        negative, piece, start = heapq.heappop(waiting)
        n = -negative
        k = int(np.where(free >= n, spent, most).argmin())
        if free[k] < n:
            k = int(np.where(free > 0, spent, most).argmin())
        part = min(n, int(free[k]))
        out[k].append((piece, start, start + part))
        free[k] -= part
        spent[k] += cost(part)
        if part < n:
            heapq.heappush(waiting, (part - n, piece, start + part))
    return out


class _Packer:
    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.waiting: list[tuple] = []  # doc_id, start, ids, doc_tokens
        self.tokens = 0
        self.rows: list[tuple] = []
        self.bytes = 0

    def _put(self, doc_id, start, ids, total, sequence, offset) -> None:
        self.rows.append((doc_id, start, len(ids), ids.tobytes(), total, sequence, offset))
        self.bytes += 4 * len(ids)

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, size = len(ids), self.capacity
        whole = total - total % size
        for start in range(0, whole, size):
            self._put(doc_id, start, ids[start : start + size], total, self.next_id, 0)
            self.next_id += 1
        if whole < total:
            self.waiting.append((doc_id, whole, ids[whole:].copy(), total))
            self.tokens += total - whole

    def pack(self, last: bool = False) -> None:
        """Fills as many sequences as the waiting pieces can; the rest waits on, or at last goes to shorter ones."""
        full, over = divmod(self.tokens, self.capacity)
        rooms = [self.capacity] * full + ([1 << b for b in reversed(range(over.bit_length())) if over >> b & 1] if last else [])
        if not rooms:
            return
        used = [0] * len(self.waiting)
        for parts in balance([len(w[2]) for w in self.waiting], rooms):
            offset = 0
            for piece, a, b in parts:
                doc_id, start, ids, total = self.waiting[piece]
                self._put(doc_id, start + a, ids[a:b], total, self.next_id, offset)
                offset += b - a
                used[piece] += b - a
            self.next_id += 1
        # a piece is cut from its front, so what is left of it is its end
        self.waiting = [(d, s + u, ids[u:], t) for (d, s, ids, t), u in zip(self.waiting, used, strict=True) if u < len(ids)]
        self.tokens = sum(len(w[2]) for w in self.waiting)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
        self.rows, self.bytes = [], 0
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def _pack(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _encoder(path), _Packer(capacity, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, np.concatenate([encoder.ids(text.as_py() or ""), end]))
                if packer.tokens >= BLOCK_SEQUENCES * capacity:
                    packer.pack()
                if packer.bytes >= SENT_BYTES:
                    yield packer.take()
        packer.pack(last=True)
        if packer.rows:
            yield packer.take()

    return run


def packed(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of documents in sequences of at most `capacity` (a power of two) tokens.

    docs: doc_id long, text string; other columns are ignored. `tokenizer` is the path of a byte-level BPE file that every
    machine has. A document is the ids of its text, then `end_id`. One row per piece: doc_id, start (ids of the document
    before it), length, ids (binary, little-endian unsigned 32 bit), doc_tokens (ids of the document), sequence_id, offset in the
    sequence. Offsets of a sequence run from 0 without gaps and each id is in one piece. Sequences are full, but for those
    at a task's end, whose lengths are lesser powers of two. A null or empty text is the end id alone; a null doc_id stays
    null; repeated rows are packed as often as they come; an empty table gives no rows. Sequence ids hold the number of the
    partition, so a task that runs again gives the same rows.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(_pack(tokenizer, capacity, end_id), SCHEMA)
