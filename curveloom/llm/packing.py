"""Packing of tokenised documents into sequences by a grouping genetic algorithm on islands.

Pieces are dealt into blocks. Every block has a few islands; each evolves whole packings: crossover injects
well-filled bins of another packing, bins that then hold a piece twice are emptied, and the displaced pieces are
placed by best fit. After each epoch the best packing of an island moves on to the next one.
"""

import bisect
import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import documents, written

CAPACITY = 4096
# Fixed value: the id behind each document.
END_ID = 1
KNOWN_RUNS = 1 << 18
PIECE_SCHEMA = "part int, row long, doc_id long, piece int, start long, length long, ids_crc32 long"
# Between an ASCII letter and an ASCII mark other than the apostrophe the pre-tokeniser always cuts.
_CUT = re.compile(rb"(?<=[a-z])(?=[!-&(-/:-@\[-`{-~])|(?<=[!-&(-/:-@\[-`{-~])(?=[a-z])")
# A comma or stop before a blank, other than behind an ASCII or a Latin-1 letter.
_ODD_STOP = re.compile(rb"[,.] (?<![a-z][,.] )(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][,.] )")
_TAIL = re.compile(rb"(?<=[a-z])([!-&(-/:-@\[-`{-~]+)(?= )")


def _blanked(text: str) -> bytes:
    """The text with a blank between its runs; marks behind letters, where the pre-tokeniser cuts, are runs of their own."""
    data = text.encode("utf-8", "replace").lower().replace(b"\n", b" ")
    if _ODD_STOP.search(data):
        return _TAIL.sub(rb" \1", data)
    return data.replace(b", ", b" , ").replace(b". ", b" . ")


class TokenIds:
    """Ids of whole texts, little-endian in 32 bits, from ids of their runs between blanks.

    The vocabulary's pre-tokeniser drops white space and never looks across it, so a text's ids are those of its
    runs, one after another. Ids of runs are kept, up to a number; texts that may hold special tokens go in whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        words = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {b"": b""}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, runs: set[bytes]) -> None:
        """Adds the ids of runs; those of parts between cuts are added and looked up too."""
        letters = {run for run in runs if run.isalpha() or run.decode("utf-8", "replace").isalpha()}
        others, compound = set(), {}
        for run in runs - letters:
            parts = _CUT.split(run)
            if len(parts) > 1:
                compound[run] = parts
            for part in parts:
                if part not in self.known:
                    (letters if part.decode("utf-8", "replace").isalpha() else others).add(part)
        # A run of letters is one pre-token and ends in the one id with a word end, so many can be encoded at once.
        words = list(letters)
        for at in range(0, len(words), 512):
            some = words[at:at + 512]
            found = self._encode([b" ".join(some).decode("utf-8", "replace")])[0]
            cuts = (4 * np.flatnonzero(self.ends[found]) + 4).tolist()
            if len(cuts) == len(some):
                data = found.tobytes()
                self.known.update((w, data[a:b]) for w, a, b in zip(some, [0, *cuts], cuts))
            else:
                others.update(some)
        rest = list(others)
        self.known.update(zip(rest, (x.tobytes() for x in self._encode([r.decode("utf-8", "replace") for r in rest]))))
        known = self.known.__getitem__
        self.known.update([(run, b"".join(map(known, parts))) for run, parts in compound.items()])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        # Special tokens are found in the text itself, so such texts go in as they are.
        special = [k for k, t in enumerate(texts) if "<|" in t]
        plain = set(range(len(texts))).difference(special)
        lists = pc.split_pattern(pa.array([_blanked(t) if k in plain else b"" for k, t in enumerate(texts)], pa.large_binary()), " ")
        coded = lists.flatten().dictionary_encode()
        runs, index = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        if len(self.known) > KNOWN_RUNS:
            self.known = {b"": b""}
        found = list(map(self.known.get, runs))
        new = [k for k, ids in enumerate(found) if ids is None]
        self._learn({runs[k] for k in new})
        for k in new:
            found[k] = self.known[runs[k]]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, start = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        n = size[index]
        end = np.cumsum(n)
        ids = flat[np.repeat(start[index] - end + n, n) + np.arange(n.sum())]
        cuts = np.r_[0, end][lists.offsets.to_numpy()].tolist()
        out = [ids[a:b] for a, b in itertools.pairwise(cuts)]
        for k, own in zip(special, self._encode([texts[k] for k in special])):
            out[k] = own
        return out


_TOKENIZERS: dict[str, TokenIds] = {}


def _batches_of(texts: list[str], most: int = 1 << 22) -> Iterator[tuple[int, list[str]]]:
    """Slices of at most about ``most`` characters, with the place of their first text."""
    at, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield at, texts[at:k + 1]
            at, size = k + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Token counts and checksums of each document's pieces; ``part`` and ``row`` number them by task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encode = _TOKENIZERS.get(tokenizer) or _TOKENIZERS.setdefault(tokenizer, TokenIds(tokenizer))
        end = np.array([END_ID], "<u4")
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            names = batch["doc_id"].astype("Int64")
            for at, texts in _batches_of(batch["text"].tolist()):
                found = []
                for k, ids in enumerate(encode(texts)):
                    ids = np.concatenate([ids, end])
                    for p, a in enumerate(range(0, len(ids), capacity)):
                        cut = ids[a:a + capacity]
                        found.append((part, row, names.iloc[at + k], p, a, len(cut), zlib.crc32(cut)))
                        row += 1
                frame = pd.DataFrame(found, columns=["part", "row", "doc_id", "piece", "start", "length", "ids_crc32"])
                yield frame.astype({"doc_id": "Int64"})

    return documents(docs).mapInPandas(run, PIECE_SCHEMA)


class Packing:
    """Bins of items, with the room left in each."""

    def __init__(self, lengths: np.ndarray, capacity: int, bins: list[list[int]] | None = None):
        self.lengths, self.capacity = lengths, capacity
        self.bins = bins or []
        self.left = [capacity - int(lengths[b].sum()) for b in self.bins]

    def best_fit(self, items: list[int]) -> "Packing":
        """Places items, the largest first, each into the fullest bin that takes it."""
        rooms = sorted((room, k) for k, room in enumerate(self.left))
        for item in sorted(items, key=lambda i: (-self.lengths[i], i)):
            need = int(self.lengths[item])
            at = bisect.bisect_left(rooms, (need, -1))
            if at == len(rooms):
                self.bins.append([item])
                self.left.append(self.capacity - need)
                bisect.insort(rooms, (self.capacity - need, len(self.bins) - 1))
            else:
                room, k = rooms.pop(at)
                self.bins[k].append(item)
                self.left[k] = room - need
                bisect.insort(rooms, (room - need, k))
        return self

    def fitness(self) -> tuple:
        """Fewer bins first, then bins of more uneven fill (Falkenauer 1996)."""
        return -len(self.bins), sum((1 - room / self.capacity) ** 2 for room in self.left)

    def genes(self) -> np.ndarray:
        out = np.zeros(len(self.lengths), "<i4")
        for k, items in enumerate(self.bins):
            out[items] = k
        return out


def _from_genes(lengths: np.ndarray, capacity: int, genes: np.ndarray) -> Packing:
    order = np.argsort(genes, kind="stable")
    cuts = np.flatnonzero(np.diff(genes[order])) + 1
    return Packing(lengths, capacity, [b.tolist() for b in np.split(order, cuts)] if len(order) else [])


def _cross(one: Packing, two: Packing, rng) -> Packing:
    """``one`` with a share of the fullest bins of ``two``; the bins they hit are emptied and their rest best-fitted."""
    n = len(two.bins)
    full = sorted(range(n), key=lambda k: two.left[k])[: max(1, n * 3 // 4)]
    picked = rng.choice(full, size=max(1, len(full) // 3), replace=False)
    injected = [list(two.bins[k]) for k in picked]
    inside = np.zeros(len(one.lengths), bool)
    for items in injected:
        inside[items] = True
    kept, displaced = [], []
    for items in one.bins:
        hit = inside[items]
        if hit.any():
            displaced += [i for i, h in zip(items, hit) if not h]
        else:
            kept.append(list(items))
    return Packing(one.lengths, one.capacity, injected + kept).best_fit(displaced)


def _mutate(packing: Packing, rng) -> Packing:
    """Opens the emptiest bin and a few others and best-fits what they held."""
    n = len(packing.bins)
    emptiest = max(range(n), key=lambda k: packing.left[k])
    out = {emptiest, *rng.integers(0, n, size=min(n, 3)).tolist()}
    freed = [i for k in out for i in packing.bins[k]]
    return Packing(packing.lengths, packing.capacity,
                   [list(b) for k, b in enumerate(packing.bins) if k not in out]).best_fit(freed)


def evolve(lengths: np.ndarray, capacity: int, population: list[np.ndarray], generations: int, size: int, seed: int) -> list[np.ndarray]:
    """Packings of one island, the best first; it stops early at the lower bound of bins."""
    rng, n = np.random.default_rng(seed), len(lengths)
    if not n:
        return [np.zeros(0, "<i4")]
    packed = [_from_genes(lengths, capacity, g) for g in population]
    if not packed:
        packed = [Packing(lengths, capacity).best_fit(list(range(n)))]
    floor = -(-int(lengths.sum()) // capacity)
    packed.sort(key=Packing.fitness, reverse=True)
    if len(packed[0].bins) > floor:
        while len(packed) < size:  # first-comers in random order, the rest by best fit
            some = rng.permutation(n)[: n // 4].tolist()
            start = Packing(lengths, capacity)
            for item in some:
                start.best_fit([item])
            packed.append(start.best_fit(sorted(set(range(n)) - set(some))))
        for _ in range(generations):
            packed.sort(key=Packing.fitness, reverse=True)
            if len(packed[0].bins) <= floor:
                break
            a, b = rng.choice(len(packed), size=2, replace=False)
            child = _cross(packed[min(a, b)], packed[max(a, b)], rng)
            packed[-1] = max(child, _mutate(child, rng), key=Packing.fitness)
        packed.sort(key=Packing.fitness, reverse=True)
    return [p.genes() for p in packed]


def _epoch(state: DataFrame, capacity: int, generations: int, size: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                lengths = np.asarray(row.lengths, np.int64)
                given = [np.frombuffer(g, "<i4") for g in row.packings]
                found = evolve(lengths, capacity, given, generations, size, int(row.block) * 1009 + int(row.island))
                rows.append((row.block, row.island, row.lengths, [g.tobytes() for g in found]))
            yield pd.DataFrame(rows, columns=["block", "island", "lengths", "packings"])

    return state.mapInPandas(run, "block long, island int, lengths array<int>, packings array<binary>")


def _evolved(items: DataFrame, capacity: int, islands: int, epochs: int, generations: int, size: int) -> DataFrame:
    """``(block, rank, bin)`` of each item; ``items`` has ``block``, ``rank`` from 0 and ``length``."""
    blocks = items.groupBy("block").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "length"))), lambda x: x["length"].cast("int")).alias("lengths"))
    state = blocks.selectExpr("block", f"explode(sequence(0, {islands - 1})) AS island", "lengths",
                              "cast(array() AS array<binary>) AS packings")
    for epoch in range(epochs):
        state = written(_epoch(state.repartition("block", "island"), capacity, generations, size), "islands")
        if epoch + 1 < epochs:
            elite = state.selectExpr("block", f"cast((island + 1) % {islands} AS int) AS island", "packings[0] AS elite")
            state = state.join(elite, ["block", "island"]).selectExpr(
                "block", "island", "lengths",
                "concat(array(elite), slice(packings, 1, greatest(size(packings) - 1, 1))) AS packings")

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                lengths = np.asarray(row.lengths, np.int64)
                genes = max((np.frombuffer(g, "<i4") for g in row.firsts),
                            key=lambda g: _from_genes(lengths, capacity, g).fitness())
                yield pd.DataFrame({"block": row.block, "rank": np.arange(len(genes), dtype=np.int32), "bin": genes})

    firsts = state.groupBy("block").agg(F.any_value("lengths").alias("lengths"),
                                        F.sort_array(F.collect_list(F.expr("packings[0]"))).alias("firsts"))
    return firsts.mapInPandas(best, "block long, rank int, bin int")


def _dealt(rows: DataFrame, block_items: int) -> DataFrame:
    """Adds ``block`` and ``rank``: items in the order of ``part`` and ``row``, cut every ``block_items``."""
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    # One row a task of the pass before.
    offsets = counts.selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS before")
    nth = "before + row_number() OVER (PARTITION BY part ORDER BY row) - 1"
    placed = rows.join(offsets, "part").withColumn("_nth", F.expr(nth))
    return placed.selectExpr(*rows.columns, f"_nth div {block_items} AS block", f"cast(_nth % {block_items} AS int) AS rank")


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, block_items: int = 4096, islands: int = 2,
           epochs: int = 2, generations: int = 6, size: int = 4, poor_fill: float = 0.98) -> DataFrame:
    """One row a piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``tokenizer`` is the path of a vocabulary that is there on all executors. A document is its ids and then id 1;
    only documents longer than ``capacity`` are cut, into pieces of that length and a last, shorter one. Pieces of full
    length are sequences of their own. Bins filled below ``poor_fill`` are taken up again and packed across blocks.
    A missing or empty text is the one id; a missing ``doc_id`` stays missing and rows that repeat are packed like
    any others. Other columns are ignored; an empty table gives an empty one.
    """
    every = written(pieces(docs, tokenizer, capacity), "pieces")
    options = (capacity, islands, epochs, generations, size)
    small = _dealt(every.where(F.col("length") < capacity).select("part", "row", "length"), block_items)
    first = written(small.join(_evolved(small, *options), ["block", "rank"]).select("part", "row", "length", "block", "bin"), "bins")
    fill = first.groupBy("block", "bin").agg(F.sum("length").alias("used"))
    poor = written(fill.where(F.col("used") < poor_fill * capacity).select("block", "bin"), "poor-bins")
    again = _dealt(first.join(poor, ["block", "bin"], "left_semi").select("part", "row", "length"), block_items)
    second = again.join(_evolved(again, *options), ["block", "rank"]).select("part", "row", "length", "block", "bin")
    # Numbers of the first packing are even, those of the second odd, those of full pieces negative.
    number = f"2 * (block * {block_items} + bin)"
    sets = first.join(poor, ["block", "bin"], "left_anti").selectExpr("part", "row", "length", f"{number} AS sequence_id").unionByName(
        second.selectExpr("part", "row", "length", f"{number} + 1 AS sequence_id"))
    offset = "sum(length) OVER (PARTITION BY sequence_id ORDER BY part, row) - length"
    places = sets.selectExpr("part", "row", "sequence_id", f"{offset} AS offset")
    full = "cast(-1 - (cast(part AS long) * 4294967296 + row) AS long)"
    return every.join(places, ["part", "row"], "left").selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32",
        f"coalesce(sequence_id, {full}) AS sequence_id", "coalesce(offset, 0) AS offset")
