"""SimHash near-duplicates: 64-bit fingerprints, compared exactly tile against tile.

Distinct fingerprints are laid into tiles by the bit counts of a few words of the fingerprint. Two fingerprints
within ``radius`` bits differ by at most ``radius`` in the sum of the differences of those counts, so all other pairs
of tiles are skipped without losing a link. The rest is compared with numpy exclusive-or and bit counts.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import components, documents, fresh, prepare, whole_text, written

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 21
#: How many comparisons take as long as dealing a row to a tile: shuffling, sorting and reading it.
PAIRS_A_ROW = 1000


def fingerprint(text: str, words: int = 3) -> int:
    """A bit is set if it is set in over half of the hashes of the shingles, repeats included; 0 without words.

    Words are runs of other than space, tab, line feed, vertical tab, form feed and carriage return; A-Z are lower-cased.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    size = np.fromiter(map(len, found), np.int64, len(found))
    end = np.cumsum(size + 1) - 1
    start = end - size
    if len(found) > words:
        start, end = start[: 1 - words or None], end[words - 1:]
    else:
        start, end = start[:1], end[-1:]
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(start), SHINGLES_AT_ONCE):
        pieces = zip(start[at:at + SHINGLES_AT_ONCE].tolist(), end[at:at + SHINGLES_AT_ONCE].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in pieces], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * total > len(start), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp)`` for every row; ``fp`` holds the 64 bits as a signed long, ``text_key`` a hash of the text.

    Missing texts and those without words have fingerprint zero; missing ids stay missing, and equal texts have equal results.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = np.array([fingerprint(t, words) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_key": batch["text_key"], "fp": fp})

    rows = documents(docs).withColumn("text_key", F.xxhash64("text"))
    return rows.mapInPandas(run, "doc_id long, text_key long, fp long")


def _shifts(blocks: int, radius: int) -> np.ndarray:
    """Offsets of tile keys with a sum of absolute differences of at most ``radius``, of each +/- pair one."""
    found = [np.zeros(blocks, np.int64)]
    for n in range(1, radius + 1):
        for picked in itertools.combinations_with_replacement(range(blocks), n):
            for signs in itertools.product((1, -1), repeat=n):
                shift = np.zeros(blocks, np.int64)
                np.add.at(shift, list(picked), signs)
                found.append(shift)
    unique = {tuple(s) for s in found if np.abs(s).sum() <= radius}
    return np.array(sorted(s for s in unique if s >= tuple(-x for x in s)), np.int64)


def _tiles(fp: np.ndarray, blocks: int) -> np.ndarray:
    """Bit counts of the fingerprint's words, one row a fingerprint."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    bits = fp.view(np.uint64)
    return np.stack([np.bitwise_count(bits & np.uint64(m)) for m in masks], axis=1).astype(np.int64)


def _keys(tiles: np.ndarray) -> np.ndarray:
    """Tile keys as longs, from the counts modulo 2^64. Tiles that share a key meet too, which costs time and loses no link."""
    weights = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(tiles.shape[1])], np.uint64)
    return (tiles.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64).view(np.int64)


def best_blocks(prints: int, radius: int) -> int:
    """Words of the fingerprint that make dealing and comparing so many distinct fingerprints cheapest.

    More words make more tiles, so fewer pairs meet, but deal a fingerprint to more of them. Links are the same for any number.
    Four words or more make thousands of tiles, so that no task gets a large share of a short table.
    """
    def cost(blocks: int) -> float:
        dealt = 1 + len(_shifts(blocks, radius))
        near = np.r_[1.0, np.zeros(radius)]  # chances of each sum of differences of two random fingerprints' counts
        for k in range(blocks):
            bits = BITS * (k + 1) // blocks - BITS * k // blocks
            differs = [math.comb(2 * bits, bits + d) / 4 ** bits * (2 if d else 1) for d in range(min(radius, bits) + 1)]
            near = np.convolve(near, differs)[: radius + 1]
        return prints * dealt * PAIRS_A_ROW + prints * prints / 2 * near.sum()

    return min(range(4, 17), key=cost)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same fingerprints: each to the smallest of its group, instead of all pairs."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]]


def _compare(group, visitor, fp, radius: int):
    """Links between the visitors and the members of each group; rows come sorted by group, the members first."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    last = np.r_[first[1:], len(group)]
    members = np.add.reduceat(~visitor, first)
    for k in np.flatnonzero((members > 0) & (last - first > members)):
        own, rows = fp[first[k]:first[k] + members[k]], fp[first[k] + members[k]:last[k]]
        step = max(1, PAIRS_AT_ONCE // len(own))
        for at in range(0, len(rows), step):
            i, j = np.nonzero(np.bitwise_count(rows[at:at + step, None] ^ own[None, :]) <= radius)
            yield rows[at + i], own[j]


def _runs(batches, rows_at_once: int = 1 << 18):
    """Sorted rows as arrays ``(group, visitor, fp)``. A group that goes on in the next run takes its members along."""
    held, size, group, previous = [], 0, 0, None

    def arrays():
        return [np.concatenate(columns) for columns in zip(*held)]

    for batch in batches:
        if batch.empty:
            continue
        tile, part = batch["tile"].to_numpy(), batch["part"].to_numpy()
        starts = np.r_[previous != (tile[0], part[0]), (tile[1:] != tile[:-1]) | (part[1:] != part[:-1])]
        ids = group + np.cumsum(starts)
        group, previous = ids[-1], (tile[-1], part[-1])
        held.append((ids, batch["visitor"].to_numpy(bool), batch["fp"].to_numpy().view(np.uint64)))
        size += len(ids)
        if size >= rows_at_once:
            ids, visitor, fp = arrays()
            yield ids, visitor, fp
            keep = (ids == group) & ~visitor
            held, size = [(ids[keep], visitor[keep], fp[keep])], 0
    if held:
        yield arrays()


def links(prints: DataFrame, radius: int = 2, blocks: int | None = None, tile_rows: int = 8192) -> DataFrame:
    """``(a, b)``: fingerprints that chains of differences of at most ``radius`` bits join; a forest, not all pairs.

    ``prints`` holds distinct ``fp``. A fingerprint is a member of its own tile and visits it and half of the tiles
    near it, so each pair meets once. The members of a tile with more than ``tile_rows`` are dealt over several
    tasks, which all see its visitors; a task holds one part's members and streams the visitors past them. Without
    ``blocks`` their number follows the count of fingerprints.
    """
    blocks = blocks or best_blocks(prints.count(), radius)
    shifts = _shifts(blocks, radius)

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"tile": _keys(_tiles(batch["fp"].to_numpy(), blocks))})

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy()
            tiles = _tiles(fp, blocks)
            yield pd.DataFrame({"tile": _keys(tiles), "visitor": False, "fp": fp})
            for shift in shifts:
                there = tiles + shift
                ok = (there >= 0).all(axis=1)
                yield pd.DataFrame({"tile": _keys(there[ok]), "visitor": True, "fp": fp[ok]})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches):
            found = list(_compare(*run, radius))
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                off = a != b
                a, b = _forest(a[off], b[off])
                yield pd.DataFrame({"a": a, "b": b})

    counts = prints.mapInPandas(home, "tile long").groupBy("tile").agg(F.count("*").alias("n"))
    # Written, so that Spark knows its size and broadcasts it only if small; at most one row per tile_rows fingerprints.
    large = written(counts.where(F.col("n") > tile_rows).selectExpr("tile", f"cast(ceil(n / {tile_rows}) AS int) AS parts"), "large-tiles")
    own_part = "array(cast(pmod(xxhash64(fp), coalesce(parts, 1)) AS int))"
    rows = prints.mapInPandas(deal, "tile long, visitor boolean, fp long").join(large, "tile", "left").select(
        "tile", "visitor", "fp", F.explode(F.expr(f"if(visitor, sequence(0, coalesce(parts, 1) - 1), {own_part})")).alias("part"))
    dealt = rows.repartition("tile", "part").sortWithinPartitions("tile", "part", "visitor")
    return dealt.mapInPandas(meet, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, blocks: int | None = None) -> DataFrame:
    """``(doc_id, text_key, fp, group_fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over fingerprints that differ in at most ``radius`` bits, and
    ``group_fp`` one of those fingerprints. A missing or empty text has fingerprint 0 and is linked like any other; rows
    that repeat a ``doc_id`` are linked by their own fingerprints; a missing ``doc_id`` counts as larger than all, and a
    component of such rows alone has none. Other columns are ignored; an empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    marked = written(fingerprints(docs, words), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    joined = components(links(distinct.select("fp"), radius, blocks)).withColumnsRenamed({"node": "fp", "component": "group_fp"})
    lowest = joined.join(distinct, "fp").groupBy("group_fp").agg(F.min("low").alias("component_id"))
    moved = joined.join(lowest, "group_fp")
    # One row a fingerprint on this side: a fingerprint that many rows have is one that Spark can split at run time.
    classes = written(distinct.join(moved, "fp", "left").select(
        "fp", F.coalesce("group_fp", "fp").alias("group_fp"),
        F.when(F.col("group_fp").isNull(), F.col("low")).otherwise(F.col("component_id")).alias("component_id")), "classes")
    return marked.join(classes, "fp").select("doc_id", "text_key", "fp", "group_fp", "component_id")


def representatives(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One row of each group of near-duplicates as it is: that with the smallest id, then the smallest hash of its text.

    Of rows that repeat an id and a text one stays. A missing id counts as the largest.
    """
    found = near_duplicates(docs, words, radius)
    last = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = written(found.groupBy("group_fp").agg(F.min(last).alias("row"), F.count("*").alias("n")), "first-rows")
    row_id, row_key = fresh(docs, "_row_id", "_row_key")
    wanted = first.select(F.col("row.doc_id").alias("wanted_id"), F.col("row.text_key").alias("wanted_key"))
    marked = docs.withColumns({row_id: F.col("doc_id").cast("long"), row_key: F.xxhash64(whole_text(F.col("text")))})
    kept = marked.join(wanted, F.col(row_id).eqNullSafe(F.col("wanted_id")) & (F.col(row_key) == F.col("wanted_key")), "left_semi")
    again = written(found.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "text_key"), "repeated-rows")
    if not again.isEmpty():
        same = again.toDF("again_id", "again_key")
        on = F.col(row_id).eqNullSafe(F.col("again_id")) & (F.col(row_key) == F.col("again_key"))
        kept = kept.join(same, on, "left_anti").unionByName(kept.join(same, on, "left_semi").dropDuplicates([row_id, row_key]))
    return kept.drop(row_id, row_key)
