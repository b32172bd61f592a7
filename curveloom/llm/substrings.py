"""Exact substring deduplication behind a count-min sketch.

A window is ``size`` consecutive words. Of each window the sketch counts its smallest gram of half the length: equal
windows have equal smallest grams at different places, so a window that occurs twice is always estimated as repeated.
The first pass sketches each partition and adds the sketches up; the second groups only the windows that are
estimated repeated, by 96 bits of hash of all their words.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import fresh, whole_text

ROWS = 3
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
SHARDS = 256
LAST_ID = (1 << 63) - 1
WORDS_AT_ONCE = 1 << 20


def split(text: str) -> list[bytes]:
    """Runs of other than space, tab, line feed, vertical tab, form feed and carriage return."""
    return text.encode("utf-8", "surrogatepass").split()


def _mix(x: np.ndarray, y: np.ndarray, salt: int) -> np.ndarray:
    z = x * np.uint64(0x9E3779B97F4A7C15 + 2 * salt) ^ (y + np.uint64(salt))
    z ^= z >> np.uint64(29)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(32))


def _grams(words: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, put together from runs of powers of two."""
    power, length, out, used = words, 1, None, 0
    while size:
        if size & 1:
            if out is None:
                out, used = power, length
            else:
                n = len(words) - used - length + 1
                out, used = _mix(out[:n], power[used:used + n], salt + used + length), used + length
        size >>= 1
        if size:
            n = len(power) - length
            power, length = _mix(power[:max(n, 0)], power[length:], salt + length), 2 * length
    return out


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The ``pick`` (minimum or maximum) of every ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values, reach = pick(values[:-reach], values[reach:]), 2 * reach
    return values if reach == width else pick(values[:len(values) - width + reach], values[width - reach:])


def _smallest(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest gram of each window, and each place at which some window has its smallest gram."""
    gram = size - size // 2
    hashes = _grams(words, gram, 1)
    width = size - gram + 1
    low = _slide(hashes, width, np.minimum)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    return low, hashes[_slide(padded, width, np.maximum) == hashes]


def _hashed(text: str, size: int) -> np.ndarray | None:
    words = split(text)
    if len(words) < size:
        return None
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _counters(hashes: np.ndarray, width: int) -> list[np.ndarray]:
    return [((hashes * np.uint64(odd)) >> np.uint64(64 - width.bit_length() + 1)).astype(np.int64)
            for odd in MULTIPLIERS[:ROWS]]


def _packed(places: np.ndarray) -> bytes:
    return zlib.compress(np.diff(places, prepend=0).astype("<u4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), "<u4"), dtype=np.int64)


def sketch(docs: DataFrame, size: int = 20, width: int = 1 << 27) -> np.ndarray:
    """Bitmaps, one a row of the sketch, of the counters that reach two: ``ROWS`` times ``width`` bits, whatever the data.

    Partitions send the counters they have used, in ``SHARDS`` ranges; a task adds up one range at a time.
    """
    reach = width // SHARDS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total = [], 0
        for batch in batches:
            for text in batch["text"]:
                hashes = _hashed(text, size)
                if hashes is not None:
                    held.append(_smallest(hashes, size)[1])
                    total += len(held[-1])
                    if total >= WORDS_AT_ONCE:
                        yield from shards(np.concatenate(held))
                        held, total = [], 0
        if held:
            yield from shards(np.concatenate(held))

    def shards(hashes: np.ndarray) -> Iterator[pd.DataFrame]:
        for row, places in enumerate(_counters(hashes, width)):
            places.sort()
            cuts = np.searchsorted(places, np.arange(SHARDS + 1) * reach)
            found = [(row * SHARDS + k, _packed(places[a:b] - k * reach))
                     for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
            yield pd.DataFrame(found, columns=["shard", "places"])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, seen, twice = None, None, None
        for batch in batches:
            for now, data in zip(batch["shard"], batch["places"]):
                if now != shard:
                    if shard is not None:
                        yield pd.DataFrame({"shard": [shard], "places": [np.packbits(twice).tobytes()]})
                    shard, seen, twice = now, np.zeros(reach, bool), np.zeros(reach, bool)
                places = _unpacked(data)
                twice[places[seen[places]]] = True
                twice[places[1:][places[1:] == places[:-1]]] = True
                seen[places] = True
        if shard is not None:
            yield pd.DataFrame({"shard": [shard], "places": [np.packbits(twice).tobytes()]})

    rows = docs.mapInPandas(count, "shard int, places binary")
    merged = rows.repartition("shard").sortWithinPartitions("shard").mapInPandas(add, "shard int, places binary")
    bits = np.zeros((ROWS * SHARDS, reach // 8), np.uint8)
    for shard, data in merged.collect():  # its size is that of the sketch
        bits[shard] = np.frombuffer(data, np.uint8)
    return bits.reshape(ROWS, -1)


def _estimated_twice(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for row, places in zip(bits, _counters(hashes, bits.shape[1] * 8)):
        found &= (row[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 == 1
    return found


def _candidates(docs: DataFrame, bits, size: int, flush: int = 1 << 20) -> DataFrame:
    """Windows estimated repeated, the first of each kind that a task holds at once; the others are certain repeats.

    A kind of window that a third of the rows share so leaves a task in one row per ``flush`` windows. ``place`` is the start
    in the upper and the row's key in the lower half. ``h1`` and the upper half of ``h2`` are the window's hash;
    the lower half is 0, or the length of a run of certain repeats, which get a place's own ``h1`` to spread them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total = [], 0
        for batch in batches:
            for doc, key, text in zip(batch["doc_id"].fillna(LAST_ID).astype("int64"), batch["_key"], batch["text"]):
                hashes = _hashed(text, size)
                if hashes is None:
                    continue
                starts = np.flatnonzero(_estimated_twice(bits.value, _smallest(hashes, size)[0]))
                if len(starts):
                    upper = _grams(hashes, size, 5)[starts] & np.uint64(0xFFFFFFFF00000000)
                    held.append((doc, (starts << 32) | (key & 0xFFFFFFFF), _grams(hashes, size, 3)[starts], upper))
                    total += len(starts)
                    if total >= flush:
                        yield from frames(held)
                        held, total = [], 0
        if held:
            yield from frames(held)

    def frames(held) -> Iterator[pd.DataFrame]:
        doc = np.repeat(np.array([h[0] for h in held], np.int64), [len(h[1]) for h in held])
        place, h1, h2 = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3))
        order = np.lexsort((place >> 32, doc, h2, h1))
        doc, place, h1, h2 = doc[order], place[order], h1[order], h2[order]
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        repeat = (doc != doc[first]) | (place >> 32 != place[first] >> 32)
        yield rows(doc[~repeat], place[~repeat], h1[~repeat], h2[~repeat])
        doc, place = doc[repeat], place[repeat]
        if len(doc):
            order = np.lexsort((place >> 32, place & 0xFFFFFFFF, doc))
            doc, place = doc[order], place[order]
            at = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] != 1 << 32)])
            length = np.diff(np.r_[at, len(doc)]).astype(np.uint64)
            doc, place = doc[at], place[at]
            yield rows(doc, place, _mix(doc.view(np.uint64), place.view(np.uint64), 7), length)

    def rows(doc, place, h1, h2) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": doc, "place": place, "h1": h1.view(np.int64), "h2": h2.view(np.int64)})

    return docs.mapInPandas(run, "doc_id long, place long, h1 long, h2 long")


def repeated_windows(docs: DataFrame, size: int = 20, width: int = 1 << 27) -> DataFrame:
    """``(doc_id, _key, run)``: windows that also start earlier, as runs: first start in the upper, last in the lower half."""
    bits = docs.sparkSession.sparkContext.broadcast(sketch(docs, size, width))
    # At most a row per flush and kind is left, so a window shared by any number of rows makes no long group.
    earlier = F.expr("rank() OVER (PARTITION BY h1, h2 ORDER BY doc_id, shiftright(place, 32)) > 1")
    ranked = _candidates(docs, bits, size).withColumn("_repeat", earlier).withColumn("_run", F.expr("h2 & 4294967295"))
    last = "shiftright(place, 32) + greatest(_run, 1) - 1"
    return ranked.where("_repeat OR _run > 0").selectExpr(
        "doc_id", "place & 4294967295 AS _key", f"shiftleft(shiftright(place, 32), 32) + {last} AS run")


def kept(docs: DataFrame, size: int = 20, width: int = 1 << 27, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """Every row with ``n_words``, ``n_removed`` and ``kept_text``, the kept words joined by one space.

    A word goes if a window of ``size`` words over it has the same words as one that starts earlier: in a row with a
    smaller id, or earlier in the same row. Windows are judged on the input. A missing text is empty, and texts of less than
    ``size`` words stay whole. A missing id counts as the largest. Rows that share an id are one document: windows at
    the same place of them don't remove each other. Other columns stay; added ones whose names are taken get an underscore.
    ``width`` counters make a sketch of ``3 * width / 8`` bytes; more data than that make it let more windows
    through to the second pass, never fewer.
    """
    names = fresh(docs, "n_words", "n_removed", "kept_text")
    text, row_key = whole_text(F.col(text_column)), F.xxhash64(whole_text(F.col(text_column))).bitwiseAND(0xFFFFFFFF)
    base = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), row_key.alias("_key"))
    runs = repeated_windows(base, size, width)
    gone = runs.groupBy("doc_id", "_key").agg(F.collect_list("run").alias("_gone"))
    key, at, gone_at = fresh(docs, "_key", "_at", "_gone")
    gone = gone.withColumnsRenamed({"doc_id": at, "_key": key, "_gone": gone_at})
    marked = docs.withColumns({key: row_key, at: F.coalesce(F.col(id_column).cast("long"), F.lit(LAST_ID))})
    rows = marked.join(gone, [at, key], "left").drop(at, key)
    result = F.pandas_udf(_removed_by(size), "n_words long, n_removed long, kept_text string")
    out = fresh(docs, "_result")[0]
    return rows.withColumn(out, result(text, gone_at)).select(
        *docs.columns, *(F.col(f"{out}.{c}").alias(n) for c, n in zip(("n_words", "n_removed", "kept_text"), names)))


def _removed_by(size: int):
    def remove(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        found = []
        for text, runs in zip(texts, gone):
            words = split(text)
            out = np.zeros(len(words) + 1, np.int64)
            if runs is not None:
                runs = np.asarray(runs, np.int64)
                np.add.at(out, runs >> 32, 1)
                np.add.at(out, (runs & 0xFFFFFFFF) + size, -1)
            stays = np.cumsum(out[:-1]) == 0
            kept_words = words if stays.all() else [w for w, k in zip(words, stays.tolist()) if k]
            found.append((len(words), len(words) - len(kept_words), b" ".join(kept_words).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(found, columns=["n_words", "n_removed", "kept_text"])

    return remove
