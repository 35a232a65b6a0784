"""Token counts by byte-pair merging with a heap over a linked list.

``count_tokens(df, tokenizer_path)`` adds ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.
A text is cut at the vocabulary's special strings (one token each), then into the pre-tokens of
the byte-level scheme. The count of a pre-token is its number of bytes less the merges that the
rank table allows; no identifiers are made. NULL and empty texts have 0 tokens; rows are
never dropped, repeated rows are counted each, other columns are not looked at.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plantlake.llm.common import slices

# Fixed values of the byte-level scheme: its pre-token pattern, and the code points its files use for bytes.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Pre-tokens whose counts a worker remembers before it starts over; a memory bound, not a limit on the data.
REMEMBERED = 800_000

LIMIT = 1024


class MergeCounter(dict):
    """Tokens of a pre-token, remembered by pre-token."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        spare = iter(range(256, 512))
        letter = {chr(b if b in PRINTABLE else next(spare)): b for b in sorted(range(256), key=lambda b: (b in PRINTABLE, b))}
        number = {}
        for b in range(256):
            number[bytes([b])] = b
        self.after, self.joined = {}, []  # rank of a pair, packed; what a rank's merge makes
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = (bytes(letter[c] for c in part) for part in (merge.split(" ") if isinstance(merge, str) else merge))
            self.joined.append(number.setdefault(left + right, len(number)))
            self.after.setdefault(number[left] << 32 | number[right], rank)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.words = regex.compile(PRE_TOKEN).findall

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = self[word] = self.merge(word.encode())
        return count

    def merge(self, data: bytes) -> int:
        """Pop the lowest-ranked adjacent pair, leftmost first, until none is left.

        A heap entry packs rank and position. It is stale if the pair now at that position has another rank.
        """
        symbol, n, after = list(data), len(data), self.after
        bits = n.bit_length()
        here = (1 << bits) - 1
        heap = [rank << bits | i for i, a in enumerate(symbol[:-1]) if (rank := after.get(a << 32 | symbol[i + 1])) is not None]
        heapq.heapify(heap)
        before, behind = list(range(-1, n - 1)), list(range(1, n + 1))
        merges = 0
        while heap:
            entry = heapq.heappop(heap)
            i, rank = entry & here, entry >> bits
            j = behind[i]
            if j >= n or symbol[i] < 0 or after.get(symbol[i] << 32 | symbol[j]) != rank:
                continue
            merges += 1
            joined = symbol[i] = self.joined[rank]
            symbol[j] = -1
            k = behind[i] = behind[j]
            if k < n:
                before[k] = i
                if (rank := after.get(joined << 32 | symbol[k])) is not None:
                    heapq.heappush(heap, rank << bits | i)
            h = before[i]
            if h >= 0 and (rank := after.get(symbol[h] << 32 | joined)) is not None:
                heapq.heappush(heap, rank << bits | h)
        return n - merges

    def count(self, text: str) -> int:
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.words(part))) for part in parts)


_COUNTERS: dict[str, MergeCounter] = {}


def _counter(path: str) -> MergeCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_path)
        for batch in slices(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=schema.names,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
