"""SimHash near duplicates through Golay-code keys.

A fingerprint of 64 bits is cut into five segments. Fingerprints within 3 bits agree exactly in two segments at
least; of the other three, cut into two halves, one half has at most one error. So for each
choice of two segments and a half, a key is made of the two segments and the Golay index of the half. The
key of one side uses the index of the half itself, that of the other the indices of its neighbours too; two
fingerprints that link meet under one of these keys. Keys have 38 bits, so few others meet.

Equal fingerprints are one node before any key is made. The nodes under a key are compared in the task
that gets the key, in blocks, and only enough links to connect them come out of it: a group of m near copies
gives m - 1 links. A key with more than ``tile`` nodes is dealt out as pairs of tiles, each a
task of its own, so a frequent key stays bounded in memory and loses no link.

Edge cases: NULL and empty texts have no words and the fingerprint zero, and link like any others; texts with fewer
words than a shingle are one shingle; a NULL doc_id is larger than any other; repeated rows are
separate documents with one fingerprint; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import codes
from tidemark.llm.common import packed, text_key, unpacked
from tidemark.llm.graph import components
from tidemark.llm.runs import complete_runs
from tidemark.session import stored

SEED = 42
WIDTHS = (13, 13, 13, 13, 12)
DISTANCE = 3


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one whole text, as a signed 64-bit number."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(body[a:b], SEED) for a, b in zip(starts.tolist(), last, strict=False)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):  # bounded memory for long texts
        block = hashes[i : i + 4096].byteswap().view(np.uint8)
        ones += np.unpackbits(block).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hashes)).astype(np.uint8))
    return int(bits.view(">i8")[0])


_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprints(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return of(text)


def hex_of(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _schemes() -> list[tuple[tuple[int, int], tuple[tuple[int, ...], ...]]]:
    """(exact segments, halves of the remaining bits as bit positions from the lowest)."""
    starts = np.concatenate([[0], np.cumsum(WIDTHS)])
    spans = [tuple(range(starts[i], starts[i + 1])) for i in range(len(WIDTHS))]
    out = []
    for exact in combinations(range(len(WIDTHS)), 2):
        rest = [b for i, span in enumerate(spans) if i not in exact for b in span]
        middle = len(rest) // 2
        out.append((tuple(spans[exact[0]] + spans[exact[1]]), (tuple(rest[:middle]), tuple(rest[middle:]))))
    return out


def _gather(words: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    """The named bits of each word, packed; runs of neighbouring bits move together."""
    out, at, i = np.zeros(len(words), np.int64), 0, 0
    while i < len(bits):
        j = i
        while j + 1 < len(bits) and bits[j + 1] == bits[j] + 1:
            j += 1
        size = j - i + 1
        out |= ((words >> np.uint64(bits[i])) & np.uint64((1 << size) - 1)).astype(np.int64) << at
        at, i = at + size, j + 1
    return out


def keys_of(fingerprints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, row, own) arrays per scheme: ``own`` marks the key made from the fingerprint's own index."""
    words = fingerprints.astype(np.int64).view(np.uint64)
    rows = np.arange(len(words))
    number = 0
    for exact, halves in _schemes():
        fixed = _gather(words, exact)
        for half in halves:
            part = _gather(words, half)
            indices = codes.neighbour_indices(part, len(half))
            own = codes.index_table(len(half))[part].astype(np.int32)
            keep = indices >= 0
            row = np.broadcast_to(rows[:, None], indices.shape)[keep]
            index = indices[keep]
            key = (np.int64(number) << 40) | (fixed[row] << 12) | index
            yield key, row, index == own[row]
            number += 1


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        all_rows = batch.column(0).to_numpy()
        for i in range(0, len(all_rows), 20_000):
            prints = all_rows[i : i + 20_000]
            for key, row, own in keys_of(prints):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(prints[row]), pa.array(own)], names=["key", "fp", "own"]
                )


def spanning_links(prints: np.ndarray, own: np.ndarray, block: int = 512) -> list[tuple[int, int]]:
    """Links that connect all ``prints`` within the distance, as many as joins of two groups were needed.

    Only pairs with at least one side under its own key are compared: the others meet elsewhere.
    """
    words, parent, links = prints.view(np.uint64), list(range(len(prints))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    mine = np.flatnonzero(own)
    for i in range(0, len(mine), block):
        left = mine[i : i + block]
        for j in range(0, len(words), 4 * block):
            near = np.bitwise_count(words[left][:, None] ^ words[None, j : j + 4 * block]) <= DISTANCE
            for a, b in zip(*np.nonzero(near), strict=True):
                x, y = root(int(left[a])), root(int(b) + j)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    links.append((int(prints[left[a]]), int(prints[b + j])))
    return links


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for columns, starts in complete_runs(batches, ("key", "tile_a", "tile_b")):
        prints, own, a, b = columns["fp"], columns["own"], [], []
        sizes = np.diff(starts)
        # runs of two need no loop
        two = starts[:-1][sizes == 2]
        near = (np.bitwise_count((prints[two] ^ prints[two + 1]).view(np.uint64)) <= DISTANCE) & (own[two] | own[two + 1])
        a += prints[two[near]].tolist()
        b += prints[two[near] + 1].tolist()
        for k in np.flatnonzero(sizes > 2):
            for x, y in spanning_links(prints[starts[k] : starts[k + 1]], own[starts[k] : starts[k + 1]]):
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def tiled(keyed: DataFrame, key: str, member: Column, tile: int) -> DataFrame:
    """``keyed`` plus tile_a and tile_b: rows of a key with more than ``tile`` rows go to pairs of tiles.

    Every two rows of such a key meet in one pair of tiles at least. Rows of other keys stay as they are.
    """
    large = keyed.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > tile).withColumnRenamed(key, "_key")
    met = keyed.join(large, F.col(key) == F.col("_key"), "left")
    tiles = F.ceil(F.col("_n") / tile).cast("int")
    own = F.pmod(F.xxhash64(member), tiles).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), tiles - 1), lambda t: F.struct(F.least(t, own).alias("a"), F.greatest(t, own).alias("b"))
    )
    one = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))
    return met.withColumn("_t", F.explode(F.when(F.col("_n").isNull(), one).otherwise(pairs))).select(
        *[f"`{c}`" for c in keyed.columns], F.col("_t.a").alias("tile_a"), F.col("_t.b").alias("tile_b")
    )


def links(prints: DataFrame, tile: int = 4096) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` exactly as all links do."""
    keyed = prints.select("fp").mapInArrow(_key_batches, "key long, fp long, own boolean")
    dealt = tiled(keyed, "key", F.col("fp"), tile)
    together = dealt.repartition("key", "tile_a", "tile_b").sortWithinPartitions("key", "tile_a", "tile_b", "fp")
    return together.mapInArrow(_link_batches, "a long, b long").distinct()


def _classes(docs: DataFrame, shingle: int, tile: int) -> DataFrame:
    """doc_id, key (of the text), fp, component_id per row."""
    printed = docs.select(
        "doc_id", text_key(F.coalesce("text", F.lit(""))).alias("key"), fingerprints(F.col("text"), shingle).alias("fp")
    )
    printed = stored(printed, "fingerprints")
    nodes = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    joined = components(links(nodes, tile)).withColumnRenamed("node", "fp")
    placed = nodes.join(joined, "fp", "left").withColumn("group", F.coalesce("component", "fp"))
    least = placed.groupBy("group").agg(F.min("least_id").alias("component_id"))
    named = placed.join(least, "group").select("fp", "group", "component_id")
    return printed.join(named, "fp")


def classes(docs: DataFrame, shingle: int = 3, tile: int = 4096) -> DataFrame:
    """doc_id, fp, component_id of every row of (doc_id, text)."""
    return _classes(docs, shingle, tile).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, tile: int = 4096) -> DataFrame:
    """One row of each class, all columns kept: the smallest doc_id, of equal ids the smallest text hash."""
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"), F.lit(0))
    kept = _classes(docs.select("doc_id", "text"), shingle, tile).groupBy("group").agg(F.min(rank).alias("best"))
    kept = kept.select(F.col("best.doc_id").alias("kept_id"), F.col("best.key").alias("kept_key"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    rows = packed(docs, id=F.col("doc_id"), key=text_key(F.coalesce("text", F.lit(""))))
    stays = stored(rows.join(kept, same, "left_semi"), "kept")
    # rows equal in id and text both come through; only those are gathered
    again = stays.groupBy(F.col("id").alias("kept_id"), F.col("key").alias("kept_key")).agg(F.count("*").alias("n"))
    again = again.where("n > 1").drop("n")
    single = stays.join(again, same, "left_anti")
    return unpacked(single.unionByName(stays.join(again, same, "left_semi").dropDuplicates(["id", "key"])), docs.columns)
