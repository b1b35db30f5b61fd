"""Which texts have which words and pieces, as an inverted index of blocks of texts.

A text is a number of two bytes in its block, so a pair of a word and a text takes that much, wherever it goes. A row is one of a kind:

    WORD    a word, by white space, and the texts of the block that have it
    PIECE   a piece looked up as it is: in frames, or of so many characters
    KEYS    instead of numbers, the keys of the block's texts in the order of their numbers, as an Arrow stream
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.session import shared_folder

WORD, PIECE, KEYS = range(3)
#: What an index can be asked for, besides the pieces of so many characters.
WORDS, FRAMES = 0, -1
#: A block ends after so many texts, as many as two bytes number, or so many bytes of text. Bounds the memory of a task.
BLOCK_TEXTS, BLOCK_BYTES = 1 << 16, 16 << 20
#: Rows sent from a worker at a time.
ROWS = 10_000


def index(texts: DataFrame, key: str, text: str, asked: Column, frame: tuple[str, str], framed_length: int) -> DataFrame:
    """(block, kind, piece, texts) of all texts, for what the array `asked` holds: WORDS, FRAMES, numbers of characters.

    It is stored, so that a block has the same texts wherever its rows are read.
    """
    kind = "block long, kind int, piece binary, texts binary"
    given = texts.select(F.col(key), F.col(text).cast("string"), asked.alias("_asked"))
    place = f"{shared_folder(texts.sparkSession)}/index"
    given.mapInArrow(_cut(frame, framed_length, BLOCK_TEXTS, BLOCK_BYTES), kind).write.parquet(place, compression="zstd")
    return texts.sparkSession.read.schema(kind).parquet(place).withColumn("piece", F.col("piece").cast("string"))


def _cut(frame: tuple[str, str], framed_length: int, most_texts: int, most_bytes: int) -> Callable:
    first, before, behind = (re.escape(x) for x in (frame[0][:1], frame[0][1:], frame[1]))
    in_frames = re.compile(f"(?s){first}(?={before}(.{{{framed_length}}}){behind})")  # frames may share a character

    def rows(block: int, kind: int, names: pa.Array, of: np.ndarray, texts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A row per name, of[i] says which one texts[i] has."""
        both = np.sort(of.astype(np.int64) << 16 | texts)
        both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
        ends = 2 * np.cumsum(np.bincount(both >> 16, minlength=len(names)))
        held = [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer((both & 0xFFFF).astype(np.uint16))]
        numbers = pa.Array.from_buffers(pa.binary(), len(names), held)
        for at in range(0, len(names), ROWS):
            some = names.slice(at, ROWS)
            columns = [np.full(len(some), block), np.full(len(some), kind, np.int32), some, numbers.slice(at, ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["block", "kind", "piece", "texts"])

    def named(found: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        coded = pa.concat_arrays([x for x, _ in found]).dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(), np.concatenate([x for _, x in found])

    def pieces_of(chars: list[str], length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(pieces in a number each, number of the text), a piece once per text."""
        for n, x in enumerate(chars):
            code = np.frombuffer(x.encode("utf-32-le"), np.uint32).astype(np.uint64)
            piece = np.zeros(max(0, len(code) - length + 1), np.uint64)
            for k in range(length):
                piece = piece << np.uint64(21) | code[k : k + len(piece)]
            piece.sort()
            piece = piece[np.concatenate([[True], piece[1:] != piece[:-1]])] if len(piece) else piece
            yield piece, np.full(len(piece), n)

    def as_text(piece: int, length: int) -> bytes:
        return "".join(chr(piece >> 21 * k & 0x1FFFFF) for k in reversed(range(length))).encode()

    def ended(block: int, asked: set[int], texts: list[pa.Array], keys: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        number, words, chars, framed = 0, [], [], []
        for part in texts:
            if WORDS in asked:
                split = pc.ascii_split_whitespace(part)
                words.append((split.values.cast(pa.binary()), np.repeat(np.arange(number, number + len(part)), pc.list_value_length(split).to_numpy())))
            number += len(part)
            if asked - {WORDS}:
                chars += [x.decode("utf-8", "replace") for x in part.cast(pa.binary()).to_pylist()]
        if WORDS in asked:
            names, of, at = named(words)
            real = np.flatnonzero(pc.binary_length(names).to_numpy() > 0)
            again = np.full(len(names), -1)
            again[real] = np.arange(len(real))
            of = again[of]
            yield from rows(block, WORD, names.take(pa.array(real)), of[of >= 0], at[of >= 0])
        if FRAMES in asked:
            for number, x in enumerate(chars):
                found = [y.encode() for y in set(in_frames.findall(x))]
                framed.append((pa.array(found, pa.binary()), np.full(len(found), number)))
            yield from rows(block, PIECE, *named(framed))
        for length in sorted(x for x in asked if x > 0):
            found = list(pieces_of(chars, length))
            names, of = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
            yield from rows(block, PIECE, pa.array([as_text(int(x), length) for x in names], pa.binary()), of, np.concatenate([x for _, x in found]))
        every, stream = pa.RecordBatch.from_arrays([pa.concat_arrays(keys)], ["keys"]), pa.BufferOutputStream()
        with pa.ipc.new_stream(stream, every.schema) as out:
            out.write_batch(every)
        columns = [pa.array([block]), pa.array([KEYS], pa.int32()), pa.nulls(1, pa.binary()), pa.array([stream.getvalue().to_pybytes()])]
        yield pa.RecordBatch.from_arrays(columns, ["block", "kind", "piece", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        asked, texts, keys, n, size = set(), [], [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            asked, start = set(batch.column(2)[0].as_py()), 0
            for i, length in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
                n, size = n + 1, size + length
                if n == most_texts or size >= most_bytes:
                    keys.append(batch.column(0).slice(start, i + 1 - start))
                    texts.append(batch.column(1).slice(start, i + 1 - start))
                    yield from ended(block, asked, texts, keys)
                    texts, keys, n, size, start, block = [], [], 0, 0, i + 1, block + 1
            if start < batch.num_rows:
                keys.append(batch.column(0).slice(start))
                texts.append(batch.column(1).slice(start))
        if n:
            yield from ended(block, asked, texts, keys)

    return run


def pairs_of(rows: DataFrame, key: str, key_type: T.DataType) -> DataFrame:
    """(token, `key`) for index rows whose pieces are tokens, each text of a block with a token once.

    A piece of the kind WORD is tokens parted by spaces. A task has one block at a time.
    """
    dealt = rows.select("block", "kind", F.col("piece").cast("binary"), "texts").repartition("block").sortWithinPartitions("block")
    found = dealt.mapInArrow(_merged(key), T.StructType().add("token", T.BinaryType()).add(key, key_type))
    return found.withColumn("token", F.col("token").cast("string"))


def _merged(key: str) -> Callable:
    def once(texts: list[bytes], n: int) -> np.ndarray:
        numbers = np.frombuffer(b"".join(texts), np.uint16)
        if len(texts) == 1:
            return numbers
        if len(numbers) < n // 8:
            return np.unique(numbers)
        has = np.zeros(n, bool)
        has[numbers] = True
        return np.flatnonzero(has).astype(np.uint16)

    def rows(tokens: list[bytes], texts: list[np.ndarray], keys: pa.Array) -> pa.RecordBatch:
        of = np.repeat(np.arange(len(tokens)), [len(x) for x in texts])
        return pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()).take(pa.array(of)), keys.take(pa.array(np.concatenate(texts)))], ["token", key])

    def ended(held: dict[bytes, list[bytes]], keys: pa.Array) -> Iterator[pa.RecordBatch]:
        tokens, texts, n = [], [], 0
        for token, lists in held.items():
            tokens.append(token)
            texts.append(once(lists, len(keys)))
            n += len(texts[-1])
            if n >= 5 * ROWS:
                yield rows(tokens, texts, keys)
                tokens, texts, n = [], [], 0
        if n:
            yield rows(tokens, texts, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, keys = None, defaultdict(list), None
        for batch in batches:
            for at, kind, piece, texts in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if at != block:
                    if held:
                        yield from ended(held, keys)
                    block, held, keys = at, defaultdict(list), None
                if kind == KEYS:
                    keys = pa.ipc.open_stream(texts).read_all().column(0).chunk(0)
                elif kind == WORD:
                    for token in piece.split(b" "):
                        held[token].append(texts)
                else:
                    held[piece].append(texts)
        if held:
            yield from ended(held, keys)

    return run
