"""SentencePiece encoding and decoding with a batched Viterbi in numpy.

``PieceModel`` reads a model file (pieces, scores, kinds, flags). A text is escaped as the model says (a space
becomes U+2581, one is put in front) and cut before each run of U+2581, which no piece crosses. Distinct words of
one length advance together: hashes of all their substrings probe the sorted hashes of the pieces, and for each end position
vectorised maxima over the piece lengths store a backpointer.

* Unigram models: a path's score is the sum of its pieces' scores; unknown characters cost a penalty.
* Byte-pair models: the merges of a word leave the one segmentation in which every two neighbouring pieces, encoded together,
  stay as they are. So a piece that ends a prefix scores 1 if it agrees with the backpointer at its start and 0 otherwise;
  exactly one piece per prefix scores 1. Whether two pieces agree follows from the merges that made them.

Characters that no piece covers become byte pieces if the model has them, else the unknown piece. Decoding joins pieces and bytes
and takes the escape and the leading space back. Runs of several U+2581, whose pieces tie in score, are merged directly.

NULL texts are encoded as empty ones: no pieces. Rows are never dropped.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plantlake.llm.common import mixed, slices

# Fixed values of the model format: kinds of pieces and of models, and the escape of a space.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, PAIRS = 1, 2
MARK = "▁"

#: Bytes, about, that the words a worker remembers may take, and bytes of texts that are encoded together; memory bounds.
REMEMBERED, PIECE = 64 << 20, 2 << 20
#: Words that advance together.
TOGETHER = 8192
_BASE = 0x9E3779B97F4A7C15


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of one protocol message."""
    at = 0

    def number() -> int:
        nonlocal at
        shift = value = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        elif kind == 2:
            size = number()
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            size = 4 if kind == 5 else 8
            yield tag >> 3, data[at : at + size]
            at += size


class PieceModel:
    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.model, self.prefix, self.collapse, self.escape, charsmap = UNIGRAM, True, True, True, b""
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                self.model = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                flags = dict(_fields(value))
                charsmap = flags.get(2, b"")
                self.prefix, self.collapse, self.escape = (bool(flags.get(k, 1)) for k in (3, 4, 5))
        if charsmap or self.collapse or not self.escape:
            raise ValueError("only models without character mapping and with plain space escapes are supported")
        if self.model not in (UNIGRAM, PAIRS) or USER in self.kinds:
            raise ValueError("only unigram and byte-pair models without user-defined pieces are supported")
        usable = [i for i, k in enumerate(self.kinds) if k == NORMAL]
        if any(MARK in self.pieces[i].lstrip(MARK) for i in usable):
            raise ValueError("pieces that cross a space are not supported")
        self.unknown = self.kinds.index(UNKNOWN)
        self.byte = np.full(256, -1, dtype=np.int64)
        for i, k in enumerate(self.kinds):
            if k == BYTE:
                self.byte[int(self.pieces[i][3:5], 16)] = i
        self.fallback = bool((self.byte >= 0).all())
        self.id = {self.pieces[i]: i for i in usable}
        self.longest = max(map(len, self.id), default=1)
        self.score = np.array(self.scores)
        self.penalty = (min((self.scores[i] for i in usable), default=0.0)) - 10.0
        self.weight = np.where(np.array(self.kinds) == BYTE, self.penalty, self.score)
        self._keys()
        if self.model == PAIRS:
            self._merges()
        self.raw = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode()
            for p, k in zip(self.pieces, self.kinds, strict=True)
        ]
        self.raw_size = np.array([len(r) for r in self.raw], dtype=np.int64)
        self.raw_start = np.concatenate(([0], np.cumsum(self.raw_size)[:-1]))
        self.raw_data = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        # Pieces of the words seen so far, one after the other; a word maps to its place in ``start`` and ``size``.
        self.words: dict[str, int] = {}
        self._forget()
        covered = {c for p in self.id for c in p}
        loose = "\n" if "\n" not in covered else ""
        self.cut = regex.compile(f"{MARK}+[^{MARK}{loose}]*|[^{MARK}{loose}]+" + (f"|{loose}+" if loose else ""))

    def _keys(self) -> None:
        """Hashes of the pieces, sorted, by number of characters."""
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths: dict[int, list[str]] = {}
        for piece in self.id:
            lengths.setdefault(len(piece), []).append(piece)
        for n, pieces in lengths.items():
            codes = np.array([[ord(c) for c in p] for p in pieces], dtype=np.uint64)
            keys = self._hash(codes, n)[:, 0]
            order = np.argsort(keys)
            keys = keys[order]
            if (keys[1:] == keys[:-1]).any():
                raise ValueError("two pieces share a hash")
            self.by_length[n] = keys, np.array([self.id[p] for p in pieces], dtype=np.int64)[order]

    @staticmethod
    def _hash(codes: np.ndarray, n: int) -> np.ndarray:
        """Hashes of all substrings of n characters, one row per word."""
        size = codes.shape[1] - n + 1
        total = np.zeros((codes.shape[0], size), dtype=np.uint64)
        for k in range(n):
            total *= np.uint64(_BASE)
            total += codes[:, k : k + size] + np.uint64(1)
        return mixed(total)

    def _lookup(self, codes: np.ndarray, n: int) -> np.ndarray:
        """Ids of the substrings of n characters, -1 where there is no such piece."""
        if n not in self.by_length:
            return np.full((codes.shape[0], codes.shape[1] - n + 1), -1, dtype=np.int64)
        keys, ids = self.by_length[n]
        wanted = self._hash(codes, n)
        at = np.searchsorted(keys, wanted.ravel()).reshape(wanted.shape)
        at[at == len(keys)] = 0
        return np.where(keys[at] == wanted, ids[at], -1)

    def _forget(self) -> None:
        self.words.clear()
        self.held = 0
        self.start, self.size, self.store = (np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int32))

    def _remember(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Append the pieces of new words; ``sizes`` has how many each has."""
        first = len(self.start)
        self.held += sum(map(len, words)) * 4 + 180 * len(words)
        self.words.update(zip(words, range(first, first + len(words)), strict=True))
        self.start = np.concatenate((self.start, len(self.store) + np.cumsum(sizes) - sizes))
        self.size = np.concatenate((self.size, sizes))
        self.store = np.concatenate((self.store, ids.astype(np.int32)))

    # --- byte-pair models ---------------------------------------------------------------

    def _merges(self) -> None:
        """For each piece the two pieces whose merge makes it; pieces that merging never makes are not used."""
        by_score = sorted(self.id.items(), key=lambda item: (-self.scores[item[1]], item[1]))
        self.rank = np.full(len(self.pieces), -1, dtype=np.int64)
        for rank, (_, i) in enumerate(by_score):
            self.rank[i] = rank
        self.left, self.right = (np.full(len(self.pieces), -1, dtype=np.int64) for _ in range(2))
        pairs: dict[tuple[int, int], int] = {}
        for piece, i in self.id.items():
            for cut in range(1, len(piece)):
                a, b = self.id.get(piece[:cut]), self.id.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = i
        unreachable = []
        for piece, i in self.id.items():
            if len(piece) > 1:
                whole, last = self._merge(piece)
                if len(whole) == 1 and last is not None:
                    self.left[i], self.right[i] = last
                else:
                    unreachable.append(piece)
        self.reachable = np.ones(len(self.pieces), dtype=bool)
        for piece in unreachable:
            self.reachable[self.id[piece]] = False
        codes = np.array([a << 32 | b for a, b in pairs], dtype=np.int64)
        order = np.argsort(codes)
        self.pair_key = codes[order]
        self.pair_rank = self.rank[np.array(list(pairs.values()), dtype=np.int64)[order]]
        self.memo_key = np.full(1 << 20, -1, dtype=np.int64)
        self.memo = np.zeros(1 << 20, dtype=bool)

    def _merge(self, word: str) -> tuple[list[str], tuple[int, int] | None]:
        """Merge a word pair by pair: highest score first, then leftmost. Also the ids of the last merge."""
        symbol: list[str | None] = list(word)
        n = len(symbol)
        before, behind = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list = []

        def offer(i: int) -> None:
            j = behind[i]
            if i >= 0 and j < n:
                joined = symbol[i] + symbol[j]
                if (found := self.id.get(joined)) is not None:
                    heapq.heappush(heap, (-self.scores[found], i, joined))

        for i in range(n - 1):
            offer(i)
        last = None
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = behind[i] if symbol[i] is not None else n
            if j >= n or symbol[i] + symbol[j] != joined:
                continue
            last = self.id.get(symbol[i], -1), self.id.get(symbol[j], -1)
            symbol[i], symbol[j] = joined, None
            behind[i] = behind[j]
            if behind[i] < n:
                before[behind[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbol if s is not None], last

    def _joined_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that a pair merges to; a large number if none."""
        key = a << 32 | b
        at = np.searchsorted(self.pair_key, key)
        at[at == len(self.pair_key)] = 0
        return np.where(self.pair_key[at] == key, self.pair_rank[at], 1 << 42)

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of pieces a and b together leaves just a and b. Unknown characters (-1) always agree."""
        out = (a < 0) | (b < 0)
        key = np.where(out, -2, a << 32 | b)
        slot = (mixed(key.view(np.uint64).copy()) & np.uint64(len(self.memo) - 1)).astype(np.int64)
        known = self.memo_key[slot] == key
        out |= known & self.memo[slot]
        todo = np.flatnonzero(~known & (key != -2))
        if len(todo):
            pairs, back = np.unique(key[todo], return_inverse=True)
            found = self._agree(pairs >> 32, pairs & 0xFFFFFFFF)
            out[todo] = found[back]
            slots = (mixed(pairs.view(np.uint64).copy()) & np.uint64(len(self.memo) - 1)).astype(np.int64)
            self.memo_key[slots], self.memo[slots] = pairs, found
            # Two pairs may want one slot: the later key won, so its answer is written once more.
            self.memo[slots] = np.where(self.memo_key[slots] == pairs, found, self.memo[slots])
        return out

    def _agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo merges on both sides of the seam, latest first; a pair across the seam must never be due before them."""
        a, b = a.copy(), b.copy()
        result = np.ones(len(a), dtype=bool)
        # A merge across the seam happens if its rank is below ``limit``: the rank of the merge that removed one of its parts.
        # Of equal ranks the left one comes first, hence the half steps.
        limit = np.full(len(a), float(1 << 41))
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            crossing = self._joined_rank(x, y)
            bad = crossing < limit[live]
            result[live[bad]] = False
            live, x, y = live[~bad], x[~bad], y[~bad]
            rx = np.where(self.left[x] >= 0, self.rank[x], -1)
            ry = np.where(self.left[y] >= 0, self.rank[y], -1)
            going = (rx >= 0) | (ry >= 0)
            live, x, y, rx, ry = live[going], x[going], y[going], rx[going], ry[going]
            # The later merge is undone first; of equal merges the right one is the later.
            undo_left = rx > ry
            limit[live] = np.where(undo_left, rx, ry + 0.5)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
        return result

    # --- words --------------------------------------------------------------------------

    def _encode_words(self, words: list[str]) -> None:
        groups: dict[int, list[str]] = {}
        done: list[tuple[list[str], np.ndarray, np.ndarray]] = []
        for word in words:
            if self.model == PAIRS and word.startswith(MARK * 2):
                ids = self._finish(word, *self._direct(word))
                done.append(([word], ids, np.array([len(ids)])))
            else:
                groups.setdefault(len(word), []).append(word)
        for n, group in groups.items():
            step = max(1, min(TOGETHER, (1 << 22) // (n * min(n, self.longest))))
            done += [self._advance(group[at : at + step], n) for at in range(0, len(group), step)]
        if done:
            names, ids, sizes = zip(*done, strict=True)
            self._remember([w for group in names for w in group], np.concatenate(ids), np.concatenate(sizes))

    def _direct(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        parts, _ = self._merge(word)
        return np.array([self.id.get(p, -1) for p in parts], dtype=np.int64), np.array([len(p) for p in parts], dtype=np.int64)

    def _advance(self, words: list[str], n: int) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Viterbi over words of n characters, all words one position at a time."""
        w = len(words)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(w, n).astype(np.uint64)
        most = min(n, self.longest)
        ids = {k: self._lookup(codes, k) for k in range(1, most + 1)}
        if self.fallback:  # an uncovered one-byte character is its byte's piece, which merges with nothing
            ids[1] = np.where((ids[1] < 0) & (codes < 128), self.byte[np.minimum(codes, 255).astype(np.int64)], ids[1])
        piece, size = np.full((w, n + 1), -1, dtype=np.int64), np.zeros((w, n + 1), dtype=np.int64)
        best = np.full((w, n + 1), -np.inf)
        best[:, 0] = 0.0
        for end in range(1, n + 1):
            for k in range(min(end, most), 0, -1):
                found = ids[k][:, end - k]
                rows = np.flatnonzero((found >= 0) | (k == 1))
                if self.model == PAIRS:
                    rows = rows[best[rows, end] < 1]
                    if not len(rows):
                        continue
                    new = found[rows]
                    fits = (new < 0) | self.reachable[new]
                    if end > k:
                        fits &= self.agree(piece[rows, end - k], new)
                    gain = np.where(fits, 1.0, 0.0)
                else:
                    new = found[rows]
                    gain = best[rows, end - k] + np.where(new >= 0, self.weight[new], self.penalty)
                better = gain > best[rows, end]
                rows = rows[better]
                best[rows, end], piece[rows, end], size[rows, end] = gain[better], new[better], k
        # Walk all backpointers at once, from the ends.
        at, path = np.full(w, n), []
        while (at > 0).any():
            row = np.arange(w)
            path.append((np.where(at > 0, piece[row, at], -2), np.where(at > 0, size[row, at], 0)))
            at = at - path[-1][1]
        ids_back, sizes_back = np.array([p for p, _ in path]).T[:, ::-1], np.array([k for _, k in path]).T[:, ::-1]
        used = sizes_back > 0
        plain = ~((ids_back == -1) & used).any(axis=1)
        flat, counts = ids_back[plain][used[plain]], used[plain].sum(axis=1)
        if plain.all():
            return words, flat, counts
        odd = np.flatnonzero(~plain).tolist()
        parts = [self._finish(words[r], ids_back[r][used[r]], sizes_back[r][used[r]]) for r in odd]
        order = [words[r] for r in np.flatnonzero(plain).tolist()] + [words[r] for r in odd]
        return order, np.concatenate([flat, *parts]), np.concatenate([counts, [len(p) for p in parts]])

    def _finish(self, word: str, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Replace uncovered characters by bytes or the unknown piece."""
        if (ids >= 0).all():
            return ids.astype(np.int32)
        out, at = [], 0
        for i, k in zip(ids.tolist(), sizes.tolist(), strict=True):
            if i >= 0:
                out.append(i)
            elif self.fallback:
                out += self.byte[list(word[at : at + k].encode())].tolist()
            elif not (out and out[-1] == self.unknown):  # neighbouring unknown characters are one piece
                out.append(self.unknown)
            at += k
        return np.array(out, dtype=np.int32)

    # --- texts --------------------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        escaped = (MARK if self.prefix else "") + text.replace(" ", MARK)
        return self.cut.findall(escaped)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text."""
        split = [self.split(t) for t in texts]
        missing = {w for words in split for w in words if w not in self.words}
        if self.held > REMEMBERED:
            self._forget()
            missing = {w for words in split for w in words}
        self._encode_words(list(missing))
        last = np.cumsum([len(words) for words in split])
        found = map(self.words.__getitem__, chain.from_iterable(split))
        at = np.fromiter(found, dtype=np.int32, count=int(last[-1]) if len(last) else 0)
        del split, missing
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.store[np.arange(total) + np.repeat(self.start[at] - (ends - sizes), sizes)]
        upto = np.concatenate(([0], ends))[last] if len(texts) else np.zeros(0, dtype=np.int64)
        return ids, np.diff(upto, prepend=0).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 texts of ids; the leading space that encoding put in front goes."""
        sizes = self.raw_size[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(self.raw_start[ids] - (ends - sizes), sizes)
        data = self.raw_data[source].tobytes()
        text_ends = np.concatenate(([0], ends))[np.cumsum(counts)] if len(counts) else []
        out, start = [], 0
        for end in np.asarray(text_ends, dtype=np.int64).tolist():
            text = data[start:end]
            out.append(text[1:] if self.prefix and text[:1] == b" " else text)
            start = end
        return out


_MODELS: dict[str, PieceModel] = {}


def _model(path: str) -> PieceModel:
    if path not in _MODELS:
        with open(path, "rb") as file:
            _MODELS[path] = PieceModel(file.read())
    return _MODELS[path]


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, token_ids, n_tokens, decoded_sha256 (of the decoded text), round_trip (whether it is the text again).

    A text that holds U+2581 itself comes back with spaces there, as the escape is not reversible for it.
    """
    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("token_ids", T.ArrayType(T.IntegerType())),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("decoded_sha256", T.StringType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in slices(batches, 1, PIECE):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, counts = model.encode(texts)
            decoded = model.decode(ids, counts)
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                    pa.array(counts),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                    pa.array([d == t.encode() for d, t in zip(decoded, texts, strict=True)], pa.bool_()),
                ],
                names=schema.names,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode_tokens(tokens: DataFrame, model_path: str, id_col: str = "doc_id", tokens_col: str = "token_ids") -> DataFrame:
    """id and text of each row of token ids; NULL or empty lists give empty texts, bytes that are no UTF-8 become U+FFFD."""
    schema = T.StructType([tokens.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            ids = np.array([i for x in lists for i in x], dtype=np.int64)
            texts = model.decode(ids, np.array([len(x) for x in lists], dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.decode(errors="replace") for t in texts], pa.string())], names=schema.names
            )

    return tokens.select(id_col, tokens_col).mapInArrow(run, schema)
