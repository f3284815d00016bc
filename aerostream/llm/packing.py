"""Vector bin packing of examples into sequences.

Pieces of examples are placed under three limits at once: tokens, segments
(pieces) and loss-bearing tokens of a sequence. The next piece for an open
sequence is the waiting one with the largest dot product of its needs with what
the sequence has left, both as fractions of the limits; needs that would leave
room nothing else fills are met by cutting a piece at the end of the sequence.

Each task packs its own examples with a pool of at most ``POOL`` waiting pieces,
so memory is bounded and nothing is shuffled. What is left open at the end of a
task is cut into sequences whose lengths are powers of two, which need no
padding.

Examples longer than a sequence are cut; every id lies in exactly one piece. An
example's ids are its text's, without special tokens, and then ``end_id``. With
``prompt_col`` the ids of the prompt come first and bear no loss; the first id
of a piece never does, as it has nothing to be predicted from.

Defined results: null text counts as empty (one id, ``end_id``); null or
repeated ids of rows are kept as they are, each row being packed on its own; an
empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, "
          "sequence_id long, offset long")
POOL = 256
ROWS = 20_000

# texts for which both tokenizer libraries read the vocabulary's pattern alike:
# Latin letters, ASCII and its line ends, without the special token's name
PLAIN = re.compile(r"(?!.*<\|endoftext\|>)[\t\n\r\x20-\x7e\xa1-ɏ]*", re.S)


class Encoder:
    """Ids of texts by ``tokenizer_json``. With ``ranks_file``, the same
    vocabulary as ranks, plain texts go through the faster library; the ids are
    the same (see the tests)."""

    def __init__(self, tokenizer_json: str, ranks_file: str | None = None, pattern: str | None = None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer_json)
        self.fast = None
        if ranks_file:
            import base64

            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and PLAIN.fullmatch(text):
            return np.asarray(self.fast.encode_to_numpy(text), np.uint32)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


class Packer:
    """Places pieces (doc, start, tokens, loss-free tokens) into sequences."""

    def __init__(self, limits: tuple[int, int, int], first_id: int):
        self.limits, self.next_id = np.array(limits, np.int64), first_id
        self.need = np.zeros((POOL, 3), np.int64)
        self.what: list = [None] * POOL
        self.n = 0
        self.left = self.limits.copy()
        self.open: list[tuple] = []  # (piece, offset)

    def add(self, piece: tuple) -> Iterator[tuple]:
        """piece: (doc, start, length, free): the first ``free`` ids bear no loss."""
        doc, start, length, free = piece
        seq = int(self.limits[0])
        # whole sequences of a long example
        while length >= seq and seq - max(1, free) <= self.limits[2]:
            yield self._closed([((doc, start, seq, min(free, seq)), 0)])
            start, length, free = start + seq, length - seq, max(0, free - seq)
        if length:
            while self.n == POOL:
                yield from self._place()
            self._wait((doc, start, length, free))

    @staticmethod
    def loss(length: int, free: int) -> int:
        return max(0, length - max(1, free))

    def _wait(self, p: tuple) -> None:
        self.need[self.n] = p[2], 1, self.loss(p[2], p[3])
        self.what[self.n] = p
        self.n += 1

    def _drop(self, i: int) -> tuple:
        p = self.what[i]
        self.n -= 1
        self.need[i], self.what[i] = self.need[self.n], self.what[self.n]
        return p

    def _closed(self, pieces: list[tuple]) -> tuple:
        self.next_id += 1
        return self.next_id - 1, pieces

    def _shut(self) -> tuple:
        out = self._closed(self.open)
        self.open, self.left = [], self.limits.copy()
        return out

    def _put(self, p: tuple) -> None:
        self.open.append((p, int(self.limits[0] - self.left[0])))
        self.left -= np.array((p[2], 1, self.loss(p[2], p[3])))

    def _place(self) -> Iterator[tuple]:
        """Put one waiting piece, whole or cut; yields a sequence when it is full."""
        need = self.need[:self.n]
        fits = (need <= self.left).all(axis=1)
        if fits.any():
            score = (need / self.limits) @ (self.left / self.limits)
            self._put(self._drop(int(np.where(fits, score, -1.0).argmax())))
        elif self.left[1] < 1:
            yield self._shut()
            return
        else:
            # nothing fits whole: the longest piece fills the sequence with its start
            doc, start, length, free = self._drop(int(need[:, 0].argmax()))
            cut = int(min(length, self.left[0], self.left[2] + max(1, free)))
            if cut < 1:
                self._wait((doc, start, length, free))
                yield self._shut()
                return
            self._put((doc, start, cut, min(free, cut)))
            if cut < length:
                self._wait((doc, start + cut, length - cut, max(0, free - cut)))
            if self.left[0] > 0:  # closed by the limit on loss
                yield self._shut()
                return
        if self.left[0] == 0:
            yield self._shut()

    def flush(self) -> Iterator[tuple]:
        """Place all that waits; cut the last sequence into powers of two."""
        while self.n:
            yield from self._place()
        rest = [p for p, _ in self.open]
        total = sum(p[2] for p in rest)
        for size in (1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1):
            pieces, at = [], 0
            while at < size:
                doc, start, length, free = rest.pop(0)
                cut = min(length, size - at)
                pieces.append(((doc, start, cut, min(free, cut)), at))
                if cut < length:
                    rest.insert(0, (doc, start + cut, length - cut, max(0, free - cut)))
                at += cut
            yield self._closed(pieces)
        self.open, self.left = [], self.limits.copy()


def packed(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text",
           prompt_col: str | None = None, max_tokens: int = 1024, max_segments: int = 256,
           max_loss: int | None = None, end_id: int = 0, ranks_file: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start (its example's ids before it), length,
    ids_crc32 (of its ids, little-endian unsigned 32 bits), doc_tokens,
    loss_tokens, sequence_id, offset in the sequence."""
    limits = (max_tokens, max_segments, max_tokens if max_loss is None else max_loss)
    out = pa.schema([(c.split(" ")[0], pa.int64()) for c in SCHEMA.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_json, ranks_file, pattern)
        packer = Packer(limits, TaskContext.get().partitionId() << 36)
        rows: list[tuple] = []

        def emit(seq: tuple) -> None:
            for (doc, start, length, free), offset in seq[1]:
                ident, base, ids, count = doc
                rows.append((ident, start, length, zlib.crc32(ids[start - base:start - base + length].tobytes()), count,
                             Packer.loss(length, free), seq[0], offset))

        def batch() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=out)
            rows.clear()
            return done

        for b in batches:
            cols = [b.column(i) for i in range(b.num_columns)]
            for i in range(b.num_rows):
                prompt = cols[2][i].as_py() if prompt_col else None
                ids = encode(cols[1][i].as_py() or "")
                free = 0
                if prompt:
                    head = encode(prompt)
                    free, ids = len(head), np.concatenate([head, ids])
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                # a waiting rest keeps only its own ids, not its whole example's
                seq, whole = limits[0], 0
                if len(ids) > 4 * seq and limits[2] >= seq:
                    whole = len(ids) // seq * seq
                    for s in packer.add(((cols[0][i].as_py(), 0, ids[:whole], len(ids)), 0, whole, min(free, whole))):
                        emit(s)
                doc = (cols[0][i].as_py(), whole, ids[whole:].copy(), len(ids))
                for s in packer.add((doc, whole, len(ids) - whole, max(0, free - whole))):
                    emit(s)
                if len(rows) >= ROWS:
                    yield batch()
        for s in packer.flush():
            emit(s)
        if rows:
            yield batch()

    cols = [F.col(id_col).cast("long"), F.col(text_col).cast("string")]
    if prompt_col:
        cols.append(F.col(prompt_col).cast("string"))
    return docs.select(*cols).mapInArrow(pack, SCHEMA)
