"""Documents packed into as few sequences of a fixed length as possible, by best fit and a swap-based local search.

Pieces are dealt into groups at random and each group is packed in one task: best fit, longest piece first, then a
local search over the underfull bins. It exchanges one piece for one, one for two, two for one, or moves a piece, whenever that
raises the sum of squared fills, which drives small bins towards empty; emptied bins vanish. Bins that stay
underfull give up their pieces, which are dealt anew with those of other groups and packed once more.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.vocabularies import encoder
from recordlens.sources.scratch import materialize

LENGTH = 2048
#: Pieces that one task packs; some 3 MB of its memory, and up to 4 KB for each underfull bin.
GROUP = 20_000
#: Chunks that a worker's encoder remembers, half as many as elsewhere: it stays in memory beside what the stages of a pipeline need.
REMEMBERED = 250_000
#: Bins filled less than this share are dealt anew in the second pass.
REPACK_BELOW = 0.99
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, end: int, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids with ``end`` behind them, cut where they exceed ``length``.

    All pieces but the first are full. Null texts are empty, that is one piece with the end id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, REMEMBERED)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                keys, out = part.column(0).to_pylist(), []
                ids, offsets = encode(part.column(1))
                whole = np.insert(ids, offsets[1:], end).tobytes()
                borders = (offsets + np.arange(len(offsets))).tolist()
                for key, here, there in zip(keys, borders, borders[1:], strict=False):
                    raw, n = memoryview(whole)[4 * here : 4 * there], there - here
                    first = n % length or length
                    cuts = [0, *range(first, n + 1, length)] if n > length else [0, n]
                    out += [(key, i, a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, _PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of places in ``lengths``: longest first, each into the fullest bin that still has room."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # rooms with open bins, ascending
    for i in order:
        n = lengths[i]
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            bins[b].append(i)
            left = room - n
        else:
            b, left = len(bins), capacity - n
            bins.append([i])
        if left > 0:
            if not by_room[left]:
                bisect.insort(rooms, left)
            by_room[left].append(b)
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, rounds: int | None = None) -> list[list[int]]:
    """Raise the sum of squared fills of the underfull bins by moves and exchanges; drop bins that become empty.

    Bins are taken from the emptiest up. From such a donor to a fuller receiver of room ``r``: a piece of at most
    ``r`` is moved; or a longer piece goes over against one shorter piece, or against two, where the receiver gains
    at least one token and at most ``r``; or, where no piece alone can go, two go over against one in the same way. All receivers are tried, the fullest first. Every such step raises the sum of squares, as the receiver is the fuller
    one, so the search ends: after ``rounds`` rounds, or else when no step is left.
    """
    full = [b for b in bins if sum(lengths[i] for i in b) == capacity]
    open_ = [b for b in bins if sum(lengths[i] for i in b) < capacity]
    while rounds is None or rounds > 0:
        rounds = None if rounds is None else rounds - 1
        open_.sort(key=lambda b: sum(lengths[i] for i in b))
        fills = [sum(lengths[i] for i in b) for b in open_]
        changed = False
        # Open receivers by room, and for all at once the room and the exchanges on offer.
        rooms = sorted((capacity - f, k) for k, f in enumerate(fills))
        offers = _Offers(open_, lengths, capacity)
        for d, donor in enumerate(open_):
            step = True
            while step and donor:
                step = False
                donor.sort(key=lambda i: -lengths[i])
                for out in _outgoing(donor, lengths):
                    n, r, given = sum(lengths[i] for i in out), None, []
                    # The tightest receiver with room for the whole piece: a move.
                    at = bisect.bisect_left(rooms, (n, -1))
                    if at < len(rooms) and rooms[at][1] == d:
                        at += 1
                    if len(out) == 1 and at < len(rooms) and fills[rooms[at][1]] >= fills[d]:
                        r = rooms[at][1]
                    else:  # Else the fullest receiver that has pieces to exchange: one or two for one, one for two.
                        r = offers.fullest(n, d, 3 - len(out))
                        if r is not None:
                            given = _exchange(open_[r], lengths, n, capacity - fills[r], 3 - len(out))
                    if r is not None:
                        gain = n - sum(lengths[j] for j in given)
                        _shift(rooms, fills, capacity, r, gain)
                        _shift(rooms, fills, capacity, d, -gain)
                        open_[r] = [j for j in open_[r] if j not in given] + out
                        donor[:] = [j for j in donor if j not in out] + given
                        offers.update(r, open_[r])
                        offers.update(d, donor)
                        step = changed = True
                        break
        full += [b for b, f in zip(open_, fills, strict=True) if f == capacity]
        open_ = [b for b, f in zip(open_, fills, strict=True) if 0 < f < capacity]
        if not changed:
            break
    return full + open_


def _outgoing(donor: list[int], lengths: list[int]) -> Iterator[list[int]]:
    """A donor's pieces, longest first, then its pairs: one for each length and each sum."""
    tried = set()
    for i in donor:
        if lengths[i] not in tried:
            tried.add(lengths[i])
            yield [i]
    tried = set()
    some = _two_of_each(donor, lengths)
    for a, i in enumerate(some):
        for j in some[a + 1 :]:
            if lengths[i] + lengths[j] not in tried:
                tried.add(lengths[i] + lengths[j])
                yield [i, j]


class _Offers:
    """Which bins offer an exchange for which sum: one piece for the sum of two, one or two pieces for the length of one.

    ``fits[most]`` has a row for each such sum and says of every bin whether one to ``most`` of its pieces are shorter by 1 up to its room.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.room = np.zeros(len(bins), np.int32)
        held = np.array(sorted({lengths[i] for b in bins for i in b}), np.int64)
        paired = np.zeros(2 * capacity + 1, bool)
        for n in held:
            paired[n + held] = True
        # By the most pieces that are given.
        self.sums = {1: np.flatnonzero(paired[: capacity + 1]), 2: held}
        self.rows = {most: {n: i for i, n in enumerate(sums.tolist())} for most, sums in self.sums.items()}
        self.fits = {most: np.zeros((len(sums), len(bins)), bool) for most, sums in self.sums.items()}
        for k, b in enumerate(bins):
            self.update(k, b)

    def update(self, k: int, pieces: list[int]) -> None:
        room = self.capacity - sum(self.lengths[i] for i in pieces)
        self.room[k] = room
        some = [self.lengths[i] for i in _two_of_each(pieces, self.lengths)]
        singles = set(some)
        pairs = {n + m for i, n in enumerate(some) for m in some[i + 1 :]}
        for most, given in ((1, singles), (2, singles | pairs)):
            fits = np.zeros(self.capacity + 1, bool)
            for n in given:
                fits[n + 1 : n + room + 1] = True
            self.fits[most][:, k] = fits[self.sums[most]]

    def fullest(self, n: int, donor: int, most: int) -> int | None:
        """The fullest bin, not emptier than the donor, that gains 1 up to its room by a length of ``n`` for one to ``most`` of its pieces."""
        fits = np.flatnonzero(self.fits[most][self.rows[most][n]] & (self.room <= self.room[donor]))
        fits = fits[fits != donor]
        return int(fits[np.argmin(self.room[fits])]) if len(fits) else None


def _shift(rooms: list[tuple[int, int]], fills: list[int], capacity: int, k: int, change: int) -> None:
    """A bin's new fill. Full bins take nothing more and leave ``rooms``."""
    rooms.pop(bisect.bisect_left(rooms, (capacity - fills[k], k)))
    fills[k] += change
    if fills[k] < capacity:
        bisect.insort(rooms, (capacity - fills[k], k))


def _two_of_each(pieces: list[int], lengths: list[int]) -> list[int]:
    """Pieces without the third and later ones of a length."""
    seen: dict[int, int] = {}
    some = []
    for j in pieces:
        seen[lengths[j]] = seen.get(lengths[j], 0) + 1
        if seen[lengths[j]] <= 2:
            some.append(j)
    return some


def _exchange(receiver: list[int], lengths: list[int], n: int, room: int, most: int) -> list[int]:
    """One to ``most`` (1 or 2) pieces of the receiver, shorter than ``n`` together by 1 to ``room``: those that fill it best."""
    best, best_gain = [], 0
    some = _two_of_each(receiver, lengths)
    for a, j in enumerate(some):
        gain = n - lengths[j]
        if best_gain < gain <= room:
            best, best_gain = [j], gain
        for k in some[a + 1 :] if most > 1 else ():
            if best_gain < gain - lengths[k] <= room:
                best, best_gain = [j, k], gain - lengths[k]
    return best


def _pack_group(length: int, keep: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        lengths = frame["length"].tolist()
        bins = local_search(best_fit(lengths, length), lengths, length)
        n = len(frame)
        sequence, offset, fill = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
        for k, places in enumerate(bins):
            at = 0
            for i in places:
                sequence[i], offset[i] = k, at
                at += lengths[i]
            fill[places] = at
        group = frame["_group"].astype(np.int64)
        return pd.DataFrame(
            {"doc_id": frame["doc_id"].astype("Int64"), "piece": frame["piece"], "start": frame["start"], "length": frame["length"], "ids_crc32": frame["ids_crc32"]}
            | {"sequence_id": group * (1 << 32) + sequence + (1 << 62 if keep else 0), "offset": offset, "fill": fill}
        )

    return run


def pack(rows: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``rows (doc_id, piece, start, length, ids_crc32)``. Runs jobs.

    Full pieces are sequences of their own. Every task packs about ``group`` pieces whatever the input's size, so
    what many groups lose to one is the underfull bins; those are packed again, also in groups, in a second
    pass. Repeated rows are packed each. An empty table gives no rows.
    """
    packed = f"{_PIECES}, sequence_id long, offset long, fill long"

    def dealt(df: DataFrame) -> DataFrame:
        n = -(-df.count() // group) or 1
        # By the row's place in the written table, so that rows of equal keys are dealt out as well.
        return df.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)))

    cut = materialize(rows, "pieces")
    alone = cut.where(F.col("length") >= length)
    rest = cut.where(F.col("length") < length)
    once = materialize(dealt(rest).groupBy("_group").applyInPandas(_pack_group(length, False), packed), "packed")
    good = once.where(F.col("fill") >= REPACK_BELOW * length)
    again = once.where(F.col("fill") < REPACK_BELOW * length).drop("sequence_id", "offset", "fill")
    twice = dealt(again).groupBy("_group").applyInPandas(_pack_group(length, True), packed)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    # Ids of full pieces: negative, one for each row of the written table.
    own = alone.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return own.select(*columns).unionByName(good.select(*columns)).unionByName(twice.select(*columns))


def pack_documents(docs: DataFrame, vocabulary: str, end: int, length: int = LENGTH) -> DataFrame:
    """Cut and pack all documents. Null and empty texts are one piece of the end id. Runs jobs."""
    return pack(pieces(docs, vocabulary, end, length), length)
