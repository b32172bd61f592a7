"""Benchmark passages in documents, found with the q-gram lemma and verified by banded alignment.

A text within ``k`` edits of a passage of ``m`` characters shares at least ``m + 1 - q * (k + 1)`` of its q-grams with it,
all on diagonals that lie within ``k`` of each other (Jokinen and Ukkonen 1991). Shared q-grams are counted in
overlapping bands of diagonals; only bands that reach the bound are aligned. The lemma holds for any q: an index of long
grams tells the bands to look at, and short grams, whose bound is tighter, are counted in those alone.
"""

import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import prepare, whole_text, written

Q = 8
SHORT_Q = 4
SEGMENT = 1024
CHARS_AT_ONCE = 1 << 20
ALIGNED_AT_ONCE = 256
HITS_AT_ONCE = 1 << 20
BANDS_AT_ONCE = 4096
CELLS_AT_ONCE = 1 << 20
LEAK_TYPE = "array<struct<item:long,edits:int,start:int,end:int>>"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_GAP = "\x00"
_FAR = 1 << 28


def normalised(text: str) -> str:
    """Lower case, with every run of other than letters and digits as one space."""
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Polynomial hashes of all runs of ``q`` (a power of two) characters."""
    hashes, reach = codes.astype(np.uint64), 1
    while reach < q:
        if len(hashes) <= reach:
            return np.zeros(0, np.uint64)
        hashes = hashes[:-reach] * np.uint64(pow(_BASE, reach, 1 << 64)) + hashes[reach:]
        reach *= 2
    return hashes * _MIX


def edit_budget(length: int, rate: float, q: int = Q) -> int:
    """Edits allowed: a share of the length, and never so many that the lemma's bound falls below one shared q-gram."""
    return max(0, min(int(rate * length), length // q - 1))


@dataclass
class Index:
    """Passages of at most ``SEGMENT`` characters and the places of their q-grams."""

    items: np.ndarray  # the item of each passage
    codes: list[np.ndarray]
    budget: np.ndarray
    bound: np.ndarray
    keys: np.ndarray  # q-gram hashes, sorted
    first: np.ndarray  # where a key's places begin; one more at the end
    passage: np.ndarray
    place: np.ndarray
    seen: np.ndarray  # a bit table over hashes
    exact: ahocorasick.Automaton | None  # items without a q-gram, which no edit is allowed in

    @staticmethod
    def build(items: list[tuple[int, str]], rate: float, shortest: int) -> "Index":
        ids, codes, exact = [], [], {}
        for item, text in items:
            plain = normalised(text)
            whole = _codes(plain)
            if len(whole) < max(shortest, 1):
                continue
            if len(whole) < Q:
                exact.setdefault(plain, []).append(item)
                continue
            n = -(-len(whole) // SEGMENT)
            for part in np.array_split(whole, n):  # parts are longer than SEGMENT / 2, if there are several
                ids.append(item)
                codes.append(part)
        lengths = np.array([len(c) for c in codes], np.int64)
        budget = np.array([edit_budget(n, rate) for n in lengths.tolist()], np.int64)
        hashes = [_grams(c) for c in codes]
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        keys, first = np.unique(every[order], return_index=True)
        passage = np.repeat(np.arange(len(codes)), [len(h) for h in hashes]) if hashes else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
        seen = np.zeros(1 << 22, bool)
        seen[(keys >> np.uint64(42)).astype(np.int64)] = True
        words = None
        if exact:
            words = ahocorasick.Automaton()
            for plain, own in exact.items():
                words.add_word(plain, (len(plain), tuple(sorted(set(own)))))
            words.make_automaton()
        return Index(np.array(ids, np.int64), codes, budget, lengths + 1 - Q * (budget + 1), keys,
                     np.r_[first, len(every)], passage[order], place[order], seen, words)

    def bands(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(passage, band)``: bands of diagonals, ``budget + 1`` apart, that share enough q-grams with a passage."""
        hashes = _grams(codes)
        at = np.flatnonzero(self.seen[(hashes >> np.uint64(42)).astype(np.int64)])
        slot = np.searchsorted(self.keys, hashes[at])
        hit = (slot < len(self.keys)) & (self.keys[np.minimum(slot, len(self.keys) - 1)] == hashes[at])
        at, slot = at[hit], slot[hit]
        n = self.first[slot + 1] - self.first[slot]
        ends, counted, at_hit = np.cumsum(n), [], 0
        while at_hit < len(n):
            # A phrase that many items share has many places: so many hits are spread out at once, and counts are added up.
            upto = max(at_hit + 1, int(np.searchsorted(ends, (ends[at_hit - 1] if at_hit else 0) + HITS_AT_ONCE, "right")))
            counted.append(self._counted(at[at_hit:upto], slot[at_hit:upto], n[at_hit:upto]))
            if len(counted) > 1 and sum(len(f) for f, _ in counted[1:]) >= HITS_AT_ONCE:
                counted = [_added(counted)]
            at_hit = upto
        found, counts = _added(counted)
        found = found[counts >= self.bound[found >> 32]]
        return found >> 32, found & 0xFFFFFFFF

    def _counted(self, at: np.ndarray, slot: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passage and band, as one number, of the hits of some places, and how many there are of each."""
        every = np.repeat(self.first[slot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        passage = self.passage[every]
        diagonal = np.repeat(at, n) - self.place[every] + SEGMENT
        budget = self.budget[passage]
        band = diagonal // (budget + 1)
        also = diagonal - band * (budget + 1) < budget
        return np.unique(np.concatenate([passage << 32 | band, passage[also] << 32 | (band[also] - 1)]), return_counts=True)

    def close(self, codes: np.ndarray, passage: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Which of the bands also hold enough short grams: what only shares a common phrase with the text mostly does not."""
        here = _grams(codes, SHORT_Q)
        budget, length = self.budget[passage], np.array([len(self.codes[p]) for p in passage.tolist()], np.int64)
        enough = length + 1 - SHORT_Q * (budget + 1)
        low, out = band * (budget + 1) - SEGMENT, np.zeros(len(passage), bool)
        order = np.lexsort((passage, length))
        at = 0
        while at < len(order):
            widest = int(length[order[at]])
            upto = at + max(1, CELLS_AT_ONCE // (widest + 2 * int(budget[order[at]]) + 1))
            some = order[at:upto]
            some = some[length[some] == widest]  # of one length, so of one budget
            k, n = int(budget[some[0]]), widest + 1 - SHORT_Q
            different, own = np.unique(passage[some], return_inverse=True)
            wanted = np.stack([_grams(self.codes[p], SHORT_Q) for p in different.tolist()])[own]
            places = low[some][:, None] + np.arange(n + 2 * k)
            inside = (places >= 0) & (places < len(here))
            window = here[np.clip(places, 0, max(len(here) - 1, 0))]
            shared = np.zeros((len(some), n), bool)
            for d in range(2 * k + 1):
                shared |= (window[:, d:d + n] == wanted) & inside[:, d:d + n]
            out[some] = shared.sum(axis=1) >= enough[some]
            at += len(some)
        return out

    def leaks(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """For each normalised text, ``(item, edits, start, end)`` of the best place of each item within its budget."""
        best: list[dict[int, tuple]] = [{} for _ in texts]
        if self.exact is not None:
            for text, own in zip(texts, best):
                for last, (size, items) in self.exact.iter(text):
                    for item in items:
                        own.setdefault(item, (0, last + 1 - size, last + 1))
        for codes, owners, shifts, starts in _runs(texts) if len(self.keys) else ():
            passage, band = self.bands(codes)
            near = self.close(codes, passage, band)
            passage, band = passage[near], band[near]
            budget = self.budget[passage]
            low = band * (budget + 1) - SEGMENT
            # A passage starts on one of its band's diagonals, in any of the texts that lie there.
            owner = np.searchsorted(starts, np.maximum(low, 0), side="right") - 1
            last = np.searchsorted(starts, np.maximum(low + 2 * budget, 0), side="right") - 1
            for some in (slice(a, a + BANDS_AT_ONCE) for a in range(0, len(passage), BANDS_AT_ONCE)):
                jobs = []
                for p, a, first, final in zip(*(x[some].tolist() for x in (passage, low, owner, last))):
                    for o in range(first, final + 1):
                        k = int(self.budget[p])
                        end = starts[o + 1] - Q if o + 1 < len(starts) else len(codes)
                        left = max(a - k, starts[o])
                        right = min(a + 3 * k + 1 + len(self.codes[p]), end)
                        if right - left >= len(self.codes[p]) - k:
                            jobs.append((p, owners[o], shifts[o] + left - starts[o], codes[left:right]))
                for (p, owner_, shift, _), (edits, start, end) in zip(jobs, self.aligned([(j[0], j[3]) for j in jobs])):
                    if edits <= self.budget[p]:
                        found = (edits, int(shift + start), int(shift + end))
                        item = int(self.items[p])
                        best[owner_][item] = min(best[owner_].get(item, found), found)
        return [[(item, *found) for item, found in sorted(b.items())] for b in best]

    def aligned(self, jobs: list[tuple[int, np.ndarray]]) -> list[tuple[int, int, int]]:
        """Fewest edits of each passage against any part of its text, and that part: one table row for all jobs at once.

        A cell holds edits in its upper and the part's start in its lower half, so a minimum keeps the first start.
        """
        out: list = [None] * len(jobs)
        order = sorted(range(len(jobs)), key=lambda j: (len(self.codes[jobs[j][0]]), len(jobs[j][1])))
        for some in (order[a:a + ALIGNED_AT_ONCE] for a in range(0, len(order), ALIGNED_AT_ONCE)):
            m = np.array([len(self.codes[jobs[j][0]]) for j in some])
            size = np.array([len(jobs[j][1]) for j in some])
            k = np.array([int(self.budget[jobs[j][0]]) for j in some]).max()
            width = int(np.maximum(size - m, 0).max()) + 2 * k + 1
            passages = np.zeros((len(some), m.max()), np.uint32)
            texts = np.full((len(some), m.max() + width + k), 0xFFFFFFFF, np.uint32)
            for row, j in enumerate(some):
                passages[row, :m[row]] = self.codes[jobs[j][0]]
                texts[row, k:k + size[row]] = jobs[j][1]
            place = np.arange(width) - k  # the text's place of a cell, less the passage's
            step = np.arange(width, dtype=np.int64) << 16
            cells = np.where((place >= 0) & (place <= size[:, None]), place, _FAR).astype(np.int64)
            cells = np.broadcast_to(cells, (len(some), width)).copy()
            done = m == 0
            for i in range(1, int(m.max()) + 1):
                across = cells + ((texts[:, i - 1:i - 1 + width] != passages[:, i - 1:i]).astype(np.int64) << 16)
                np.minimum(across[:, :-1], cells[:, 1:] + (1 << 16), out=across[:, :-1])
                cells = np.minimum.accumulate(across - step, axis=1) + step
                for row in np.flatnonzero(m == i):
                    least = int(cells[row].argmin())
                    value = int(cells[row, least])
                    out[some[row]] = (value >> 16, value & 0xFFFF, int(min(max(i + place[least], 0), size[row])))
        return out


def _added(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts of equal keys."""
    if len(counted) == 1:
        return counted[0]
    keys, place = np.unique(np.concatenate([k for k, _ in counted] or [np.zeros(0, np.int64)]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, place, np.concatenate([n for _, n in counted] or [np.zeros(0, np.int64)]))
    return keys, counts


def _runs(texts: list[str]) -> Iterator[tuple[np.ndarray, list[int], list[int], np.ndarray]]:
    """Texts one after another, ``Q`` gaps apart, in runs of bounded length: codes, and each part's text, offset and start.

    Longer texts are cut into parts that overlap by more than an aligned passage.
    """
    held, size = [], 0

    def run():
        joined = (_GAP * Q).join(part for _, _, part in held)
        lengths = np.array([len(part) + Q for _, _, part in held])
        return _codes(joined), [h[0] for h in held], [h[1] for h in held], np.cumsum(lengths) - lengths

    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - 2 * SEGMENT), CHARS_AT_ONCE):
            part = text[at:at + CHARS_AT_ONCE + 2 * SEGMENT]
            held.append((number, at, part))
            size += len(part) + Q
            if size >= CHARS_AT_ONCE:
                yield run()
                held, size = [], 0
    if held:
        yield run()


def indexes(benchmark: DataFrame, rate: float = 0.1, shortest: int = 16, block_chars: int = 1 << 20,
            id_column: str = "item_id", text_column: str = "text") -> Iterator[Index]:
    """Indexes over blocks of the query set, of about ``block_chars`` characters each, one at a time, so each broadcast is bounded.

    Items that repeat count once, since all rows of one would go to the same block.
    """
    items = benchmark.select(F.col(id_column).cast("long").alias("item"), whole_text(F.col(text_column)).alias("text")).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars) or 1
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        yield Index.build([(-1 if r["item"] is None else r["item"], r["text"]) for r in rows], rate, shortest)


def _scan_with(shared) -> Callable[..., Column]:
    def scan(texts: pd.Series) -> pd.Series:
        rows = shared.value.leaks([normalised(t) for t in texts])
        return pd.Series([[dict(zip(("item", "edits", "start", "end"), r)) for r in row] for row in rows])

    return F.pandas_udf(scan, LEAK_TYPE)


def _block_by_block(rows: DataFrame, indexed: Iterator[Index], step: Callable, after: Callable, name: str) -> list[DataFrame]:
    """``step(rows, scan)`` with each block's index. A last block is left to the caller's job; each before it is a job of its own.

    ``after(rows, result)`` gives the rows for the next block. A block's broadcast is taken off the executors once its result
    is written, so executors and driver hold one block, however large the query set.
    """
    context, kept_results, index = rows.sparkSession.sparkContext, [], next(indexed)
    while index is not None:
        following = next(indexed, None)
        shared = context.broadcast(index)
        result = step(rows, _scan_with(shared))
        if following is not None:
            result = written(result, name)
            shared.destroy()
            rows = after(rows, result)
        kept_results.append(result)
        index = following
    return kept_results


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, shortest: int = 16, block_chars: int = 1 << 20,
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, item_id, edits, start, end)``: benchmark items that a document holds with at most ``rate`` edits a character.

    Texts are compared in lower case without marks; ``start`` and ``end`` count characters of that form, of the best
    place. Passages of over ``SEGMENT`` characters are cut and any part counts. Items shorter than ``shortest`` are no
    evidence and not looked for; a smaller ``shortest`` finds them, those of fewer than ``Q`` characters as they are, also inside
    words. Empty or missing items are never found, and an item without id has -1. Missing texts have no leaks, rows that repeat
    give repeated results, and other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(F.col(text_column)).alias("text"))

    def step(some: DataFrame, scan) -> DataFrame:
        each = some.select("doc_id", F.explode(scan(F.col("text"))).alias("leak"))
        return each.select("doc_id", F.col("leak.item").alias("item_id"), "leak.edits", "leak.start", "leak.end")

    found = _block_by_block(rows, indexes(benchmark, rate, shortest, block_chars), step, lambda same, _: same, "leaks")
    return functools.reduce(DataFrame.unionByName, found)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, shortest: int = 16, text_column: str = "text",
          block_chars: int = 1 << 20) -> DataFrame:
    """The rows without any leak, as they are: empty and missing texts have none, and rows that repeat stay or go together.

    What counts as a leak is as in ``leaks``. An empty table gives an empty one, and an empty benchmark leaves every row.
    A block of the benchmark sees only what the blocks before it have left.
    """
    prepare(docs.sparkSession)

    def step(some: DataFrame, scan) -> DataFrame:
        return some.where(F.size(scan(whole_text(F.col(text_column)))) == 0)

    return _block_by_block(docs, indexes(benchmark, rate, shortest, block_chars), step, lambda _, left: left, "uncontaminated")[-1]
