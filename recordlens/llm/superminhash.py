"""Near-duplicate documents by SuperMinHash, banding, exact verification and components.

A document's set is its distinct shingles of ``words`` words. SuperMinHash gives each element one random permutation of
the signature's slots and ranks ``step + random`` along it; a slot keeps the least rank of all elements. The slots of an element are
correlated, which lowers the variance for small sets, and no element need look at a step once every slot of its set
is below it, so most sets end after a few of the steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.llm import hashing
from recordlens.llm.common import components, slices, utf8
from recordlens.sources.scratch import materialize

#: Bands and slots in a band. A pair of similarity s shares a band with 1 - (1 - s**SLOTS)**BANDS: at 0.85 all but 2 in
#: a million, at 0.8 with (32, 5) all but 3 in a million.
BANDS, SLOTS = 28, 6
#: Bytes of text that are hashed at a time; some 50 bytes of memory each.
CHUNK = 1 << 18
#: Elements that are ranked at a time; up to two permutations of all slots each.
RANKED = 1 << 15
#: Sets that one task compares with as many others.
TILE = 512
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(40)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles' hashes of each text, sorted, with their texts' numbers.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z as a-z. A text of fewer words has its whole sequence as its
    only shingle; one without words has none.
    """
    if len(offsets) == 2 and len(data) > 2 * CHUNK:  # one very long text: its words' hashes piece by piece
        hashes = hashing.run_hashes(data, ~hashing.SPACES, CHUNK)
        owner = np.zeros(len(hashes), np.int64)
        grams = hashing.long_gram_hashes(hashes, words, CHUNK)
        at = np.zeros(len(grams), np.int64)
    else:
        starts, ends, owner = hashing.spans(~hashing.SPACES[data], offsets)
        hashes = hashing.span_hashes(data, starts, ends)
        grams, at = hashing.gram_hashes(hashes, owner, words)
    short, short_at = _short(hashes, owner, words)
    grams, at = np.concatenate([grams, short]), np.concatenate([at, short_at])
    order = np.lexsort((grams, at))
    grams, at = grams[order], at[order]
    if len(grams):
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (at[1:] != at[:-1])
        grams, at = grams[new], at[new]
    return grams, at


def _short(hashes: np.ndarray, owner: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    texts, first, counts = np.unique(owner, return_index=True, return_counts=True)
    out, at = [], []
    for n in range(1, words):
        some = counts == n
        if some.any():
            places = first[some][:, None] + np.arange(n)
            flat = hashes[places.ravel()]
            grams, _ = hashing.gram_hashes(flat, np.repeat(np.arange(some.sum()), n), n)
            out.append(grams)
            at.append(texts[some])
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out), np.concatenate(at)


def signatures(elements: np.ndarray, owner: np.ndarray, n_sets: int, slots: int) -> np.ndarray:
    """SuperMinHash signatures of the sets: ``n_sets`` rows of ``slots`` ranks; all ones for an empty set."""
    best = np.full(n_sets * slots, _EMPTY)
    live_sets = np.unique(owner)
    for a, b in slices(np.searchsorted(owner, np.append(live_sets, n_sets)), RANKED):
        low, high = np.searchsorted(owner, [live_sets[a], live_sets[b - 1] + 1])
        # One set of very many elements is done in parts: a slot keeps the least rank of all.
        for at in range(low, high, RANKED):
            _rank(elements[at : min(high, at + RANKED)], owner[at : min(high, at + RANKED)], best, slots)
    return best.reshape(n_sets, slots)


def _rank(elements: np.ndarray, owner: np.ndarray, best: np.ndarray, slots: int) -> None:
    grid = best.reshape(-1, slots)
    permutation = None
    for step in range(slots):
        x = hashing.mix(elements + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        low = (x & np.uint64(0xFFFFFF)).astype(np.int64)
        drawn = step + ((low * (slots - step)) >> 24)
        if permutation is None:
            slot = drawn
        else:
            rows = np.arange(len(elements))
            slot = permutation[rows, drawn].astype(np.int64)
            permutation[rows, drawn] = permutation[:, step]
            permutation[:, step] = slot
        np.minimum.at(best, owner * slots + slot, (np.uint64(step) << _STEP) | (x >> np.uint64(24)))
        sets = np.unique(owner)
        done = np.zeros(int(sets[-1]) + 1, bool)
        done[sets] = (grid[sets] < np.uint64(step + 1) << _STEP).all(1)
        live = ~done[owner]
        if not live.any():
            return
        if permutation is None:
            permutation = np.tile(np.arange(slots, dtype=np.int16), (int(live.sum()), 1))
            first = slot[live]
            permutation[np.arange(len(first)), first] = 0
            permutation[:, 0] = first
        elif not live.all():
            permutation = permutation[live]
        elements, owner = elements[live], owner[live]


def _signed(words: int, bands: int, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = hashing.mix(np.arange(1, slots + 1, dtype=np.uint64))
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, CHUNK):
                grams, owner = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                n = b - a
                sign = signatures(grams, owner, n, bands * slots).reshape(n, bands, slots)
                band = hashing.mix((sign * places).sum(2, dtype=np.uint64) + hashing.mix(np.arange(bands, dtype=np.uint64)))
                cuts = np.searchsorted(owner, np.arange(n + 1))
                sets = [hashing.set_hash(grams[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
                flat = pa.array(band.ravel().view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, n),
                        pa.array(np.diff(cuts)),
                        pa.array(np.array(sets, np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)), flat),
                    ],
                    names=["doc_id", "n_shingles", "set_id", "bands"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, CHUNK):
                grams, owner = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                cuts = np.searchsorted(owner, np.arange(b - a + 1))
                sets = [hashing.set_hash(grams[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.array(sets, np.uint64).view(np.int64)), lists], names=["set_id", "elements"])

    return run


def _tile_links(percent: int):
    """Exact links inside one tile, as a forest: each linked set with the least set that it reaches here."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("set_id").reset_index(drop=True)
        n = len(frame)
        ids, sets = frame["set_id"].to_numpy(), frame["elements"].tolist()
        sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if n else np.empty(0, np.int64)
        owner = np.repeat(np.arange(n), sizes)
        order = np.argsort(flat, kind="stable")
        _, code, counts = np.unique(flat[order], return_inverse=True, return_counts=True)
        shared = counts > 1  # an element of one set only adds to no intersection
        column = np.cumsum(shared) - 1
        kept = shared[code]
        rows, columns = owner[order][kept], column[code[kept]]
        common = np.zeros((n, n), np.float32)
        for first in range(0, int(shared.sum()), 1024):  # columns ascend, so a block is a slice
            a, b = np.searchsorted(columns, [first, first + 1024])
            block = np.zeros((n, 1024), np.float32)
            block[rows[a:b], columns[a:b] - first] = 1
            common += block @ block.T
        linked = np.zeros((n, n), bool)
        for a in range(0, n, 128):
            same = common[a : a + 128].astype(np.int64)
            linked[a : a + 128] = 100 * same >= percent * (sizes[a : a + 128, None] + sizes[None, :] - same)
        label = np.arange(n)
        while True:  # every set takes the least label of its neighbours until none changes
            least = np.where(linked, label[None, :], n).min(1) if n else label
            least = np.minimum(least, label)
            least = least[least]
            if (least == label).all():
                break
            label = least
        moved = label != np.arange(n)
        return pd.DataFrame({"a": ids[label[moved]], "b": ids[moved]})

    return run


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = 5,
    percent: int = 80,
    bands: int = 32,
    slots: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, set_id, n_shingles, component, component_id, kept`` of every row of ``docs``. Runs jobs.

    Documents whose sets have ``100 * intersection >= percent * union`` are linked; ``component_id`` is the least id
    that links lead to, ``kept`` says that it is the own one, ``component`` names it by its least ``set_id``. A document without words has an empty set and no
    link. Null texts are empty. Rows of equal ids are compared each; a null id is larger than all others, so a
    component of null ids only has a null ``component_id`` and keeps its null rows. An empty table gives no rows.

    Equal sets are collapsed first, whatever their number, so a copied document costs one row of its kind from there
    on. Candidates are sets that share a band. In each band's bucket all sets are first compared with one leader,
    after which most buckets are one component and done. In those that are not, all sets are compared with each
    other, in tiles of bounded size spread over the tasks; a tile gives back a forest, never all its pairs. Every
    comparison is of full sets (of 64-bit hashes).
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = materialize(source.mapInArrow(_signed(words, bands, slots), "doc_id long, n_shingles long, set_id long, bands array<long>"), "signed")
    # One row for each distinct set. Its bands are the same in all its rows; the first do.
    kinds = signed.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    kinds = materialize(kinds, "kinds")
    banded = kinds.select("set_id", F.posexplode("bands").alias("_band", "_hash")).select("set_id", F.xxhash64("_band", "_hash").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("set_id").alias("leader"), F.sum(F.xxhash64("set_id").cast("decimal(38,0)")).alias("members"))
    buckets = materialize(buckets.where("n > 1"), "buckets")
    members = materialize(banded.join(buckets, "bucket"), "members")

    # The full sets of all candidates, made anew from their texts.
    wanted = members.select("set_id").distinct().join(kinds.select("set_id", F.col("doc_id").alias("_doc")), "set_id")
    read = source.join(wanted.select("_doc").distinct(), F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    sets = read.mapInArrow(_sets(words), "set_id long, elements array<long>")
    sets = materialize(sets.dropDuplicates(["set_id"]), "sets")

    # First every set with the least leader of its buckets.
    led = members.where("set_id <> leader").groupBy("set_id").agg(F.min("leader").alias("leader"))
    mine = sets.select("set_id", F.col("elements").alias("_a"))
    theirs = sets.select(F.col("set_id").alias("leader"), F.col("elements").alias("_b"))
    same = F.size(F.array_intersect("_a", "_b"))
    compared = led.join(mine, "set_id").join(theirs, "leader").where(same * 100 >= (F.size("_a") + F.size("_b") - same) * percent)
    star = materialize(compared.select(F.col("leader").alias("a"), F.col("set_id").alias("b")), "star")
    found = components(star)

    # Then whole buckets, where more than one component is left; buckets of the same members once.
    parts = members.select("bucket", "n", "members", "set_id").join(found, F.col("set_id") == F.col("node"), "left")
    parts = parts.withColumn("component", F.coalesce("component", "set_id"))
    split = parts.groupBy("bucket", "n", "members").agg((F.min("component") < F.max("component")).alias("split")).where("split")
    once = split.groupBy("n", "members").agg(F.min("bucket").alias("bucket"))
    open_ = members.join(once.select("bucket"), "bucket", "left_semi").select("bucket", "n", "set_id")
    n_parts = F.ceil(F.col("n") / TILE).cast("int")
    part = F.pmod(F.xxhash64("set_id", "bucket"), n_parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), n_parts - 1))
    tiled = open_.withColumn("_part", part).withColumn("_other", other)
    tiled = tiled.select("set_id", "bucket", F.least("_part", "_other").alias("_x"), F.greatest("_part", "_other").alias("_y"))
    links = tiled.join(sets, "set_id").groupBy("bucket", "_x", "_y").applyInPandas(_tile_links(percent), "a long, b long")
    links = materialize(links.unionByName(star), "links")
    whole = components(links)

    by_kind = materialize(kinds.select("set_id", "doc_id").join(whole, F.col("set_id") == F.col("node"), "left").select("set_id", "doc_id", F.coalesce("component", "set_id").alias("component")), "by-kind")
    least = by_kind.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = by_kind.join(least, "component").select("set_id", "component", "component_id")
    out = signed.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "set_id", "n_shingles", "component", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def with_set_ids(docs: DataFrame, name: str, *, words: int = 5, text: str = "text") -> DataFrame:
    """Add the ``set_id`` of ``near_duplicates`` to each row; null for a document without words. One pass."""
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            out: list[int | None] = []
            for a, b in slices(offsets, CHUNK):
                grams, owner = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                cuts = np.searchsorted(owner, np.arange(b - a + 1))
                ids = np.array([hashing.set_hash(grams[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)], np.uint64)
                out += [x if n else None for x, n in zip(ids.view(np.int64).tolist(), np.diff(cuts).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)
