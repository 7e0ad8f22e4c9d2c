"""Byte-level BPE by rounds over padded matrices.

A text is split by a pattern; each distinct chunk is encoded once while a worker remembers it. Matches of like length stand as rows of
one padded matrix of token ids. In each round every row finds its pairs' ranks in a hashed table, merges its leftmost pair of the least rank and closes
up; rows without a pair that is in the table leave.

A long match stands in several rows, windows of it, whose ids are then joined. Ids are those of the whole match exactly if any two neighbours, encoded
alone, stay as they are: before the first merge across a border between tokens all merges are inside them, in the order that they have in each pair of
neighbours alone, so that merge would happen there, too. So only the neighbours at the borders of windows are tried, and where they do not stay, both windows are
encoded as one row and cut anew at one of its tokens, until all borders hold.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.vocabularies import Memory, chunks

#: Chunks of text after which a worker starts a new memory, keeping the last one; about 200 bytes each.
REMEMBERED = 400_000
#: Bytes of a row at first; a longer match takes several. Joined windows are longer rows.
WINDOW = 128
#: Cells of a matrix at most.
CELLS = 1 << 18
_NONE = np.int64(1) << 40
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """The ranks of a vocabulary's byte strings and a hashed table from pairs of ids to the id of their merge."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.bytes = {i: b for b, i in ranks.items()}
        if any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        lefts, rights, ids = [], [], []
        get = ranks.get
        for whole, i in ranks.items():
            for cut in range(1, len(whole)):
                if (a := get(whole[:cut])) is not None and (b := get(whole[cut:])) is not None:
                    lefts.append(a)
                    rights.append(b)
                    ids.append(i)
        self.bits = max(10, int(len(ids) * 4).bit_length())
        size = 1 << self.bits
        self.keys, self.ids = np.full(size, -1, np.int64), np.full(size, _NONE)
        keys = (np.array(lefts, np.int64) << 32) | np.array(rights, np.int64)
        left, values, self.probes = np.arange(len(keys)), np.array(ids, np.int64), 0
        at = self._slot(keys)
        # Linear probing, all keys at a time: of those that want one free slot the last gets it.
        while len(left):
            self.probes += 1
            free = self.keys[at[left]] == -1
            some = left[free]
            self.keys[at[some]] = keys[some]
            own = self.keys[at[left]] == keys[left]
            self.ids[at[left[own]]] = values[left[own]]
            left = left[~own]
            at[left] = (at[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges into, or a number above all ids. Padding is -1."""
        keys = (left << 32) | (right & 0xFFFFFFFF)
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.ids[at], _NONE)
        missed = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != -1))
        for _ in range(1, self.probes):
            if not len(missed):
                break
            at.flat[missed] = (at.flat[missed] + 1) & (len(self.keys) - 1)
            found, key = self.keys[at.flat[missed]], keys.flat[missed]
            hit = found == key
            out.flat[missed[hit]] = self.ids[at.flat[missed[hit]]]
            missed = missed[~hit & (found != -1)]
        out[(left < 0) | (right < 0)] = _NONE
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as 32-bit integers."""
        pieces = [[w[a : a + WINDOW] for a in range(0, len(w), WINDOW)] or [w] for w in words]
        found = iter(self._rows(list(chain.from_iterable(pieces))))
        out = []
        for some in pieces:
            ids = [next(found) for _ in some]
            out.append(ids[0] if len(ids) == 1 else self._joined(ids))
        return out

    def _rows(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, each a row of a matrix with others of like length, of ``CELLS`` cells or one row at most."""
        out = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            n = len(words[order[at]])
            width, end = max(2, n + (n + 3) // 4), at + 1  # lengths up to a quarter above share a matrix
            while end < len(order) and len(words[order[end]]) <= width and (end - at) * width < CELLS:
                end += 1
            some = order[at:end]
            for i, ids in zip(some, self._matrix([words[i] for i in some]), strict=True):
                out[i] = ids
            at = end
        return out

    def _joined(self, windows: list[bytes]) -> bytes:
        """The ids of a match from those of its windows."""
        parts = [np.frombuffer(w, "<i4").tolist() for w in windows]
        untried = [True] * (len(parts) - 1)  # borders: of parts i and i + 1
        stays: dict[tuple[int, int], bool] = {}
        spell = lambda ids: b"".join(map(self.bytes.__getitem__, ids))
        rounds, patience = 0, 4 * len(parts) + 16
        while True:
            borders = [i for i, u in enumerate(untried) if u]
            pairs = {(parts[i][-1], parts[i + 1][0]) for i in borders} - stays.keys()
            for pair, ids in zip(pairs, self._rows([spell(p) for p in pairs]), strict=True):
                stays[pair] = np.frombuffer(ids, "<i4").tolist() == list(pair)
            wrong = [i for i in borders if not stays[parts[i][-1], parts[i + 1][0]]]
            if not wrong:
                return np.array(list(chain.from_iterable(parts)), "<i4").tobytes()
            for i in borders:
                untried[i] = False
            chosen, last = [], -2  # no part in two joins at a time
            for i in wrong:
                if i > last + 1:
                    chosen.append(i)
                    last = i
                else:
                    untried[i] = True
            whole = self._rows([spell(parts[i]) + spell(parts[i + 1]) for i in chosen])
            rounds += 1
            gone = []
            for i, ids in zip(chosen, whole, strict=True):
                ids = np.frombuffer(ids, "<i4").tolist()
                for border in (i - 1, i + 1):
                    if 0 <= border < len(untried):
                        untried[border] = True
                if len(ids) > 1 and rounds <= patience:  # tokens of one row stay beside each other
                    sizes = np.cumsum([len(self.bytes[t]) for t in ids])
                    cut = min(int(np.searchsorted(sizes, sizes[-1] / 2)) + 1, len(ids) - 1)
                    parts[i], parts[i + 1] = ids[:cut], ids[cut:]
                else:  # joined for good
                    parts[i] = ids
                    gone.append(i)
            for i in reversed(gone):
                del parts[i + 1], untried[i]

    def _matrix(self, words: list[bytes]) -> list[bytes]:
        lengths = np.array([len(w) for w in words], np.int64)
        width = max(int(lengths.max()), 2)
        ids = np.full((len(words), width), -1, np.int64)
        inside = np.arange(width) < lengths[:, None]
        ids[inside] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self.merged(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), width - 1)
        live, done = np.arange(len(words)), np.empty((len(words), width), np.int64)
        columns = np.arange(width)
        while True:
            place = ranks.argmin(1)  # the leftmost of the least
            rank = ranks[np.arange(len(live)), place]
            ended = rank == _NONE
            if ended.any():
                done[live[ended], : ids.shape[1]] = ids[ended]
                done[live[ended], ids.shape[1] :] = -1
                live, ids, ranks, place, rank = live[~ended], ids[~ended], ranks[~ended], place[~ended], rank[~ended]
                if not len(live):
                    break
            rows, width = np.arange(len(live)), ids.shape[1]
            ids[rows, place] = rank
            # Close up behind the merged pair.
            after = (columns[: width - 1] > place[:, None]).astype(np.int64) + columns[: width - 1]
            ids = np.take_along_axis(ids, after, 1)
            if width == 2:
                ids = np.concatenate([ids, np.full((len(live), 1), -1)], 1)
                ranks = np.full((len(live), 1), _NONE)
                continue
            ranks = np.take_along_axis(ranks, after[:, : width - 2], 1)
            right = np.minimum(place, width - 3)
            ranks[rows, right] = self.merged(ids[rows, right], ids[rows, right + 1])
            some = place > 0
            left = place[some] - 1
            ranks[rows[some], left] = self.merged(ids[rows[some], left], ids[rows[some], left + 1])
        counts = (done >= 0).sum(1)
        flat, ends = done[done >= 0].astype("<i4").tobytes(), np.cumsum(counts) * 4
        return [flat[a:b] for a, b in zip((ends - 4 * counts).tolist(), ends.tolist(), strict=True)]


class Encoder:
    """Encodes texts piece by piece and decodes ids; remembers the pieces it has met."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = Ranks({base64.b64decode(a): int(b) for a, b in pairs})
        self.split = regex.compile(pattern).findall
        self.memory = Memory(REMEMBERED)  # ids of chunks as 32-bit integers

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. A text is cut into chunks first, which no match of the pattern crosses."""
        cut = [chunks(t) for t in texts]
        found, new = self.memory.recall(set().union(*cut))
        split = list(map(self.split, new))
        pieces = list(set().union(*split))
        ids = dict(zip(pieces, self.ranks.encode([w.encode() for w in pieces]), strict=True))
        fresh = {chunk: ids[own[0]] if len(own) == 1 else b"".join(map(ids.__getitem__, own)) for chunk, own in zip(new, split, strict=True)}
        found.update(fresh)
        self.memory.learn(fresh)
        get = found.__getitem__
        return [np.frombuffer(b"".join(map(get, parts)), "<i4") for parts in cut]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.ranks.bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder; kept between tasks."""
    return Encoder(path, pattern)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", *, keep_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of every row. One pass, no shuffle.

    ``ids`` are the ids (null without ``keep_ids``); the digests are of the ids in decimal with commas between and of the bytes that the ids decode to. Null texts are
    empty: no ids, and the digests of no bytes. Repeated rows and ids are kept; other columns are not read. Texts are handled some at a time, so
    a batch's memory is bounded by ``GROUP`` bytes or its longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ranks, pattern)
        for batch in batches:
            texts = ["" if x is None else x for x in batch.column(1).to_pylist()]
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and size < GROUP:
                    size += len(texts[last])
                    last += 1
                each = bpe.encode(texts[first:last])
                lists = [ids.tolist() for ids in each]
                digests = [hashlib.sha256(str(ids)[1:-1].replace(" ", "").encode()).hexdigest() for ids in lists]
                decoded = [hashlib.sha256(bpe.decode(ids)).hexdigest() for ids in lists]
                columns = [
                    batch.column(0).slice(first, last - first),
                    pa.array([len(ids) for ids in each], pa.int64()),
                    pa.array(each if keep_ids else [None] * len(each), pa.list_(pa.int32())),
                    pa.array(digests),
                    pa.array(decoded),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])
                first = last

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")


#: Characters of text that are encoded together.
GROUP = 600_000
