"""Token ids in packed binary rows.

Texts are tokenised, an end id is added, documents longer than a row are cut into full rows and a rest, and the
rests are packed best-fit-decreasing: each goes to the row with the least room that still holds it, found by a
segment tree over capacities. A block of documents (``block_tokens``) is packed inside the task that read it,
so nothing is shuffled and a lost task is simply run again.

Each output row is one line of an id matrix: ids (little-endian, two bytes where the vocabulary allows, else
four; padded with the end id), cu_seqlens (cumulative segment lengths, from 0), position_resets (offsets at
which positions start again at 0), and for each segment doc_ids, doc_nos (number of the document in its block)
and doc_offsets (where in the document's ids the segment starts), so documents can be put together again.

Edge cases: null and empty texts have no tokens and no segment; very long texts take as many rows as they
need, and white space of any length keeps the ids of the published pattern; repeated rows and null ids are packed as any other; an empty table gives no rows; other columns are
ignored. The tokenizer's file is a parameter; it is read on the driver and sent to the tasks (a few MB).
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pressmill.llm._common import map_rows

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The pattern that splits text before merges, as published with the byte-level vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROW_TOKENS = 2048
BLOCK_TOKENS = 4_000_000


class Room:
    """Open rows by free capacity, with a segment tree that finds the least capacity that is enough."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def _mark(self, capacity: int, value: bool) -> None:
        node = capacity + self.leaves
        self.any[node] = value
        while node > 1:
            node >>= 1
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def put(self, capacity: int, row: int) -> None:
        held = self.rows.setdefault(capacity, [])
        held.append(row)
        if len(held) == 1:
            self._mark(capacity, True)

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of the fullest row with room for need."""
        node = need + self.leaves
        if not self.any[node]:
            while node > 1 and not (node % 2 == 0 and self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        held = self.rows[capacity]
        row = held.pop()
        if not held:
            self._mark(capacity, False)
        return capacity, row


def best_fit_decreasing(lengths: list[int], most: int) -> list[list[int]]:
    """Rows of piece numbers; each row's lengths sum to at most ``most``."""
    room, rows = Room(most), []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = room.take(lengths[piece])
        capacity, row = found or (most, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(piece)
        if capacity > lengths[piece]:
            room.put(capacity - lengths[piece], row)
    return rows


SCHEMA = "block long, row int, n_tokens int, doc_ids array<long>, doc_nos array<int>, doc_offsets array<int>, cu_seqlens array<int>, position_resets array<int>, ids binary"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


#: Runs of the pattern's \s (Unicode white space) that are too long for its look-ahead, which keeps a state for each character.
_WIDE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{256,}")


class Coder:
    """Token ids of texts: those of PATTERN, whatever the length of their white space."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import tiktoken

        self._split = tiktoken.Encoding("packed", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._whole = tiktoken.Encoding("whole", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        ids, at = [], 0
        for run in _WIDE.finditer(text):
            end = run.end() - (run.end() < len(text))  # before a word the pattern leaves the last character to it
            ids += self._split.encode_ordinary(text[at : run.start()])
            ids += self._whole.encode_ordinary(text[run.start() : end])
            at = end
        return ids + self._split.encode_ordinary(text[at:])


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, row_tokens: int = ROW_TOKENS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(tokenizer))
    end = len(ranks.value)
    width = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")

    def rows_of(block: int, docs_: list[tuple[int | None, np.ndarray]]) -> dict:
        pieces = [(no, at) for no, (_, ids) in enumerate(docs_) for at in range(0, len(ids), row_tokens)]
        lengths = [min(row_tokens, len(docs_[no][1]) - at) for no, at in pieces]
        out: dict[str, list] = {name.split()[0]: [] for name in SCHEMA.split(", ")}
        for row, members in enumerate(best_fit_decreasing(lengths, row_tokens)):
            matrix = np.full(row_tokens, end, width)
            ends = np.cumsum([lengths[i] for i in members]).tolist()
            for i, stop in zip(members, ends, strict=True):
                no, at = pieces[i]
                matrix[stop - lengths[i] : stop] = docs_[no][1][at : at + lengths[i]]
            values = (block, row, ends[-1], [docs_[pieces[i][0]][0] for i in members], [pieces[i][0] for i in members], [pieces[i][1] for i in members], [0, *ends], [0, *ends[:-1]], matrix.tobytes())
            for column, value in zip(out.values(), values, strict=True):
                column.append(value)
        return out

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        coder = Coder(ranks.value)
        block, held, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                if not text:
                    continue
                ids = np.array([*coder.encode(text), end], width)
                held.append((doc_id, ids))
                n += len(ids)
                if n >= block_tokens:
                    yield rows_of(block, held)
                    block, held, n = block + 1, [], 0
        if held:
            yield rows_of(block, held)

    return map_rows(docs.select("doc_id", "text"), SCHEMA, run)


def write(packed: DataFrame, path: str) -> None:
    """One Parquet table of id matrices; readers map ``ids`` to arrays without parsing."""
    packed.write.parquet(path)


def digest(docs: DataFrame) -> DataFrame:
    return pack(docs)
