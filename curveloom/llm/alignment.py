"""Alignment of two tokenizers' tokens by byte offsets, and how often their ids are linked across the corpus.

Texts go through Arrow in blocks of a few megabytes: token lists are flattened with their parents, byte lengths summed
within documents, and an Acero join on the document and the end offset finds where tokens of both end. Each block counts in how
many of its documents an id pair is linked; Spark adds these partial counts up and gives each block its pairs' totals back.

A block's documents name their pairs by the block's own numbers, the most frequent first, so no row of a link is ever shuffled:
what is shuffled are the documents, once, and one row for each block and pair it holds.
"""

import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import prepare, written

BLOCK_BYTES = 8 << 20
# What is tokenised and joined at once; a block adds up its parts.
PART_CHARACTERS = 1 << 20
KNOWN_RUNS = 1 << 18
# Links that are expanded at once.
EXPANDED = 1 << 22
# A blank between two visible Latin characters. No token of either vocabulary goes on across it (``Vocabularies`` makes sure).
_CUT = re.compile("(?<=[!-~¡-¬®-ɏ]) (?=[!-~¡-¬®-ɏ])")
_LATIN = re.compile("[!-~¡-¬®-ɏ]+")
# Fixed value: how byte-level vocabularies cut texts before merging.
_PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# How the byte-level alphabet writes bytes: these stand for themselves, the others are numbered from 256 on.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]

DOCUMENT = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())),
    ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int64()))])
DOCUMENT_DDL = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<int>, "
                "times array<long>, pairs array<long>, held array<long>")


class Vocabularies:
    """Both tokenizers, the bytes of each of their ids, and the ids of parts of texts seen lately."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        others = iter(range(256, 512))
        byte = {chr(n if n in _SELF else next(others)): n for n in range(256)}
        special = set(self.a.get_added_tokens_decoder())
        words: list[bytes] = [b""] * self.a.get_vocab_size()
        for word, i in self.a.get_vocab().items():
            words[i] = word.encode() if i in special else bytes(byte[c] for c in word)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = pa.array(words, pa.binary())
        self.b_bytes = pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                 for i, p in enumerate(pieces)], pa.binary())
        self.a_lengths = pc.binary_length(self.a_bytes).to_numpy()
        # The same vocabulary in the library that is quicker on plain Latin text; its ids are the order of its merges.
        self.fast = tiktoken.Encoding("a", pat_str=_PRETOKENS, special_tokens={},
                                      mergeable_ranks={w: i for i, w in enumerate(words) if i not in special})
        # Ids of parts are those of the whole only if no piece has a blank behind another character.
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.misspelled: set[str] = set()

    def encode(self, runs: list[str]) -> tuple[pa.Array, pa.Array]:
        """Lists of ids of each run with a blank before it."""
        if len(self.known) > KNOWN_RUNS:
            self.known, self.misspelled = {}, set()
        found = list(map(self.known.get, runs))
        new = [k for k, ids in enumerate(found) if ids is None]
        for at in range(0, len(new), 4096):
            self._learn([runs[k] for k in new[at:at + 4096]])
        for k in new:
            found[k] = self.known[runs[k]]
        out = []
        for side in (0, 1):
            ids = [f[side] for f in found]
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // 4
            out.append(pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), pa.array(np.frombuffer(b"".join(ids), np.int32))))
        return tuple(out)

    def _learn(self, runs: list[str]) -> None:
        plain = [r for r in runs if _LATIN.fullmatch(r)]
        ids_a = dict(zip(plain, self._latin(plain)))
        rest = [r for r in runs if r not in ids_a]
        for ids, of, spelled in (([e.ids for e in self.a.encode_batch_fast([" " + r for r in rest], add_special_tokens=False)], rest, self.a_bytes),
                                 (self.b.encode(runs, num_threads=1), runs, self.b_bytes)):
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(ends[-1]) if len(ends) else 0)
            said = pc.binary_join(pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), spelled.take(pa.array(flat))), b"")
            right = pc.equal(said, pa.array([" " + r for r in of], pa.string()).cast(pa.binary())).to_numpy(zero_copy_only=False)
            self.misspelled.update(of[k] for k in np.flatnonzero(~right))
            ids_b = dict(zip(of, _slices(flat, ends)))
            if of is rest:
                ids_a |= ids_b
        self.known.update((r, (ids_a[r], ids_b[r])) for r in runs)

    def _latin(self, runs: list[str]) -> Iterator[bytes]:
        """A's ids of runs of visible Latin characters, many at a time: the blank before each keeps them apart."""
        for at in range(0, len(runs), 512):
            some = runs[at:at + 512]
            ids = np.array(self.fast.encode_ordinary(" " + " ".join(some)), np.int32)
            lengths = pc.binary_length(pa.array(some, pa.string()).cast(pa.binary())).to_numpy() + 1
            yield from _slices(ids, np.searchsorted(np.cumsum(self.a_lengths[ids]), np.cumsum(lengths)) + 1)


def _slices(ids: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
    data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
    return (data[a:b] for a, b in itertools.pairwise(cuts))


@cache
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def _tokens(texts: list[str | None], known: Vocabularies) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For A and for B the ids and their documents, without documents whose tokens don't spell the text with a blank before it."""
    lists = pa.array([(_CUT.split(t) if known.separable else [t]) if t else [] for t in texts], pa.list_(pa.string()))
    coded = lists.flatten().dictionary_encode()
    runs = coded.dictionary.to_pylist()
    encoded = known.encode(runs)
    document, wrong = pc.list_parent_indices(lists), np.zeros(len(texts), bool)
    misspelled = [k for k, r in enumerate(runs) if r in known.misspelled] if known.misspelled else []
    for k in np.unique(document.to_numpy()[np.isin(coded.indices.to_numpy(), misspelled)]) if misspelled else ():
        # Rare: parts that are spelled otherwise. Whether the whole text is, its own tokens tell.
        whole = known.encode([texts[k]])
        wrong[k] = any(b"".join(s.take(w.values).to_pylist()) != (" " + texts[k]).encode()
                       for w, s in zip(whole, (known.a_bytes, known.b_bytes)))
    ids, documents = [], []
    for found in encoded:
        taken = found.take(coded.indices)
        own, flat = document.take(pc.list_parent_indices(taken)).to_numpy(), taken.flatten().to_numpy()
        keep = ~wrong[own] if wrong.any() else slice(None)
        ids.append(flat[keep])
        documents.append(own[keep])
    return ids, documents


def _ends(ids: np.ndarray, document: np.ndarray, spelled: pa.Array, n: int) -> np.ndarray:
    """Offset of each token's end in its document: sums of byte lengths that start anew with every document."""
    sums = pc.cumulative_sum(pc.binary_length(spelled).take(pa.array(ids)).cast(pa.int64())).to_numpy()
    first = np.searchsorted(document, np.arange(n))
    before = np.r_[0, sums][first]
    return sums - before[document]


def _expanded(a, b, group_a, start_a, start_b, size_b) -> Iterator[tuple[np.ndarray, ...]]:
    """Groups, A's ids, B's ids and how often they meet, for all links, a bounded number at a time."""
    links = size_b * np.diff(np.r_[start_a, len(a)])
    total = np.cumsum(links)
    at = 0
    while at < len(links):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + EXPANDED, "right")))
        if upto == at + 1 and links[at] > EXPANDED:
            # One group of very many links: its distinct ids and how often each occurs, some of A's at a time.
            ids_a, n_a = np.unique(a[start_a[at]:(start_a[at + 1] if at + 1 < len(start_a) else len(a))], return_counts=True)
            ids_b, n_b = np.unique(b[start_b[at]:start_b[at] + size_b[at]], return_counts=True)
            step = max(1, EXPANDED // len(ids_b))
            for k in range(0, len(ids_a), step):
                yield np.full(len(ids_a[k:k + step]) * len(ids_b), at), np.repeat(ids_a[k:k + step], len(ids_b)), np.tile(
                    ids_b, len(ids_a[k:k + step])), np.outer(n_a[k:k + step], n_b).ravel()
        else:
            low, high = start_a[at], start_a[upto] if upto < len(start_a) else len(a)
            n = size_b[group_a[low:high]]
            ends = np.cumsum(n)
            row = np.repeat(np.arange(low, high), n)
            other = np.arange(ends[-1]) - np.repeat(ends - n, n) + start_b[group_a[row]]
            yield group_a[row], a[row], b[other], np.ones(len(row), np.int64)
        at = upto


def _part(texts: list[str | None], known: Vocabularies) -> tuple[dict[str, np.ndarray | list], pa.Table]:
    """Numbers and hashes of the documents, and ``document, pair, times`` of their links."""
    n, n_pieces = len(texts), len(known.b_bytes)
    (a, b), (doc_a, doc_b) = _tokens(texts, known)
    # Document and end in one number, the key of the join.
    ends = [pa.table({"key": (d << 40) + _ends(ids, d, s, n), name: np.arange(len(ids))})
            for ids, d, s, name in ((a, doc_a, known.a_bytes, "i"), (b, doc_b, known.b_bytes, "j"))]
    cuts = ends[0].join(ends[1], "key", join_type="inner", use_threads=False).sort_by("i")
    last_a, last_b, group_doc = cuts["i"].to_numpy(), cuts["j"].to_numpy(), cuts["key"].to_numpy() >> 40
    start_a, start_b = np.r_[0, last_a + 1][:-1], np.r_[0, last_b + 1][:-1]
    size_a, size_b = last_a + 1 - start_a, last_b + 1 - start_b
    group_a = np.repeat(np.arange(len(cuts)), size_a)

    def joined(ids: np.ndarray, start: np.ndarray) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(np.r_[start, len(ids)].astype(np.int32), pa.array(ids).cast(pa.string())), ",")

    group_at = np.searchsorted(group_doc, np.arange(n + 1))
    named = pc.binary_join_element_wise(joined(a, start_a), joined(b, start_b), "|")
    named = pc.binary_join(pa.ListArray.from_arrays(group_at.astype(np.int32), named), ";").to_pylist()
    n_groups = np.diff(group_at)
    sums = np.r_[0, np.cumsum(size_a * size_b)]
    documents = {
        "n_a": np.bincount(doc_a, minlength=n), "n_b": np.bincount(doc_b, minlength=n), "n_groups": n_groups,
        "n_links": sums[group_at[1:]] - sums[group_at[:-1]],
        "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if g else "" for t, g in zip(named, n_groups)]}
    links = [_summed(pa.table({"document": group_doc[g], "pair": ia.astype(np.int64) * n_pieces + ib, "times": t}))
             for g, ia, ib, t in _expanded(a, b, group_a, start_a, start_b, size_b)]
    return documents, pa.concat_tables(links) if links else pa.table({c: np.zeros(0, np.int64) for c in ("document", "pair", "times")})


def _summed(links: pa.Table) -> pa.Table:
    found = links.group_by(["document", "pair"], use_threads=False).aggregate([("times", "sum")])
    return found.select(["document", "pair", "times_sum"]).rename_columns(["document", "pair", "times"])


def _block(block: int, doc_ids: pa.Array, texts: list[str | None], known: Vocabularies) -> pa.RecordBatch:
    """Rows of a block's documents, and one row without a hash that has its pairs and how many of its documents hold each."""
    n, parts, at = len(texts), [], 0
    for upto in _cuts([len(t or "") for t in texts], PART_CHARACTERS):
        numbers, links = _part(texts[at:upto], known)
        parts.append((numbers, links.set_column(0, "document", pc.add(links["document"], at))))
        at = upto
    # A large group's links may come in several pieces.
    links = _summed(pa.concat_tables([links for _, links in parts])).combine_chunks()
    held = links.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by([("count_all", "descending"), ("pair", "ascending")])
    pairs, counts = held["pair"].to_numpy(), held["count_all"].to_numpy()
    order = np.argsort(pairs)
    codes = order[np.searchsorted(pairs[order], links["pair"].to_numpy())].astype(np.int32)
    by_document = np.lexsort((codes, links["document"].to_numpy()))
    offsets = np.searchsorted(links["document"].to_numpy()[by_document], np.arange(n + 1)).astype(np.int32)

    def with_last(name: str, kind, last=0) -> pa.Array:
        return pa.concat_arrays([*[pa.array(numbers[name], kind) for numbers, _ in parts], pa.array([last], kind)])

    def lists(values, kind) -> pa.Array:
        return pa.concat_arrays([pa.ListArray.from_arrays(offsets, pa.array(values, kind)), pa.array([None], pa.list_(kind))])

    def only_last(values, kind) -> pa.Array:
        return pa.concat_arrays([pa.nulls(n, pa.list_(kind)), pa.array([values], pa.list_(kind))])

    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n + 1, block)), pa.concat_arrays([doc_ids, pa.nulls(1, pa.int64())]),
        *[with_last(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], with_last("groups_sha256", pa.string(), None),
        lists(codes[by_document], pa.int32()), lists(links["times"].to_numpy()[by_document], pa.int64()),
        only_last(pairs, pa.int64()), only_last(counts, pa.int64())], schema=DOCUMENT)


def _cuts(sizes: list[int] | np.ndarray, most: int) -> Iterator[int]:
    """Ends of runs whose sizes add up to ``most`` at most; a larger one is alone."""
    total, at = np.cumsum(sizes), 0
    while at < len(total):
        at = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield at


def blocks(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``DOCUMENT`` rows of all documents and, without a hash, of their blocks. A block is numbered by its task and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = vocabularies(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            # A text longer than a block is a block of its own.
            at = 0
            for upto in _cuts(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64), block_bytes):
                yield _block(number, ids.slice(at, upto - at), texts.slice(at, upto - at).to_pylist(), known)
                number, at = number + 1, upto

    prepare(docs.sparkSession)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, DOCUMENT_DDL)


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, n``: in how many documents each id pair is linked, from the partial counts of the blocks."""
    return _held(found).groupBy("pair").agg(F.sum("held").alias("n"))


def _held(found: DataFrame) -> DataFrame:
    """``block, code, pair, held``: one row for each pair of a block."""
    own = found.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("code", "entry"))
    return own.select("block", "code", F.col("entry.pairs").alias("pair"), F.col("entry.held").alias("held"))


def _scored(documents: pa.Table, totals: pa.Table) -> pa.Table:
    """Counts of one block's documents' links, from the totals of its pairs by their numbers."""
    code = totals["code"].to_numpy()
    n, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    n[code], best[code] = totals["n"].to_numpy(), totals["is_best"].to_numpy().astype(np.int64)
    documents = documents.combine_chunks()
    codes, times = (documents[c].combine_chunks() for c in ("codes", "times"))
    flat, weight = codes.flatten().to_numpy(), times.flatten().to_numpy()
    ends = np.cumsum(np.r_[0, pc.list_value_length(codes).to_numpy().astype(np.int64)])
    out = documents.drop_columns(["codes", "times", "block"])
    for name, values in (("n_best", best), ("count_sum", n)):
        sums = np.cumsum(np.r_[0, values[flat] * weight])
        out = out.append_column(name, pa.array(sums[ends[1:]] - sums[ends[:-1]]))
    return out


def aligned(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` of every row's ``text``.

    A group is a run of bytes between neighbouring offsets where tokens of both vocabularies end; its links are all pairs of
    an A and a B token in it. A pair's count is the number of rows in whose text it is linked, so repeated rows count each time;
    a link is best if no other pair of its A id has a higher count, so all of equal ones are. Missing and empty texts, and
    those that the tokens don't spell, have zeros and an empty hash. Rows without an id are rows like any other. Only
    ``doc_id`` and ``text`` are read, so other columns' names don't matter. An empty table gives an empty one.
    """
    found = written(blocks(docs, a_path, b_path, block_bytes), "aligned")
    n_pieces = len(vocabularies(a_path, b_path).b_bytes)
    # The pairs of one A id are at most as many as B has ids, however large the corpus is.
    highest = F.expr(f"max(n) OVER (PARTITION BY pair DIV {n_pieces})")
    counts = pair_counts(found).withColumn("is_best", F.col("n") == highest)
    totals = _held(found).select("block", "code", "pair").join(counts, "pair").select(F.col("block").alias("of"), "code", "n", "is_best")
    documents = found.where("groups_sha256 IS NOT NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
                                                               "codes", "times")
    return documents.groupBy("block").cogroup(totals.groupBy("of")).applyInArrow(
        _scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
