"""Personal data in texts: fixed patterns, and a skip-chain conditional random field over what they leave.

Nodes are the tokens of a document that hold a digit or an at sign. Neighbouring tokens share a chain potential, and
each token shares a skip potential with the next one that repeats it or is similar, wherever that is (Sutton and
McCallum 2004). Potentials are log ratios of counts over the whole corpus, in which the patterns label the tokens.
Loopy message passing then gives a token that no pattern matches the label of those it repeats.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import fresh, prepare, whole_text
from curveloom.llm.spans import SPANS, in_order

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0 is other
SHAPES = 4096
# Messages are sent until they converge. These only bound rounds that oscillate: so many, and so many a link of the longest
# skip chain, along which a label travels a link every few rounds.
ROUNDS = 1000
ROUNDS_A_LINK = 50
CONVERGED = 1e-4
# A message is sent again only if what goes into it has changed by more.
STILL = 1e-11
SMOOTHING = 0.5
# Linked tokens are taken to agree until the corpus says otherwise: so many pairs of each label count beforehand.
AGREEMENT = 10.0

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only start where a run of digits does, since it would take the digits before it too.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARKED = re.compile(r"[0-9@]+")
_REST = re.compile(r"\S*")
_EDGE = "\"'.,;:!?<>[]{}#$%&*|="


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with the run of local characters before it and the longest domain behind it."""
    least, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > least and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # Without a match here, no later one can take in this at sign.
        least = domain.end() if domain else at + 1
        if domain:
            yield start, least
        at = text.find("@", max(at + 1, least))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind's pattern that pass its test."""
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


class Tokens:
    """The candidate tokens of a text: ranges, shapes, chain neighbours, skip links and labels by the patterns."""

    def __init__(self, text: str, base: list[tuple[str, int, int]]):
        self.start, self.end = [], []
        done = 0
        for m in _MARKED.finditer(text):
            if m.start() < done:
                continue
            start = m.start()
            while start > done and not text[start - 1].isspace():
                start -= 1
            done = end = _REST.match(text, m.start()).end()
            while start < end and text[start] in _EDGE:
                start += 1
            while end > start and text[end - 1] in _EDGE:
                end -= 1
            self.start.append(start)
            self.end.append(end)
        n = len(self.start)
        words = [text[s:e] for s, e in zip(self.start, self.end)]
        self.shape = np.array([_shape(w) for w in words], np.int64)
        self.label = np.zeros(n, np.int64)
        spans, at = sorted((s, e, KINDS.index(k) + 1) for k, s, e in base), 0
        for k in range(n):
            while at < len(spans) and spans[at][1] <= self.start[k]:
                at += 1
            if at < len(spans) and spans[at][0] < self.end[k]:
                self.label[k] = spans[at][2]
        self.chain = [(k, k + 1) for k in range(n - 1) if self.start[k + 1] - self.end[k] == 1]
        last: dict[str, int] = {}
        links = {}
        for k, word in enumerate(words):
            for key in _alike(word):
                if key in last:
                    links[last[key], k] = None
                last[key] = k
        self.skip = list(links)


def _shape(word: str) -> int:
    """A hash of the word with letters as one ``a`` and each run of digits as its length."""
    letters = re.sub(r"[^\W\d_]+", "a", word)
    return zlib.crc32(re.sub(r"[0-9]+", lambda m: str(min(len(m[0]), 20)), letters).encode()) % SHAPES


def _alike(word: str) -> set[str]:
    """Keys that repeated or similar words share: letters and digits alone, the last seven digits, and a mail's local part."""
    plain = "".join(c for c in word.lower() if c.isalnum())
    digits = "".join(c for c in plain if "0" <= c <= "9")
    keys = {plain} if len(plain) >= 6 else set()
    if len(digits) >= 7:
        keys.add(digits[-7:])
    if "@" in word and len(word.split("@")[0]) >= 4:
        keys.add(word.lower().split("@")[0] + "@")
    return keys


# -- Potentials ------------------------------------------------------------------------------------------------

NODE, CHAIN, SKIP = 0, SHAPES * LABELS, SHAPES * LABELS + LABELS * LABELS
SIZE = SKIP + LABELS * LABELS


def potentials(docs: DataFrame, text_column: str = "text") -> dict[str, np.ndarray]:
    """Log potentials from counts over all documents: a fixed number of them, so they can be broadcast."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIZE, np.int64)
        for batch in batches:
            for text in batch["text"]:
                tokens = Tokens(text, base_spans(text))
                np.add.at(total, NODE + tokens.shape * LABELS + tokens.label, 1)
                for offset, pairs in ((CHAIN, tokens.chain), (SKIP, tokens.skip)):
                    for a, b in pairs:
                        total[offset + tokens.label[a] * LABELS + tokens.label[b]] += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"feature": at, "n": total[at]})

    rows = docs.select(whole_text(F.col(text_column)).alias("text")).mapInPandas(count, "feature long, n long")
    counts = np.zeros(SIZE)
    for feature, n in rows.groupBy("feature").agg(F.sum("n")).collect():
        counts[feature] = n
    return from_counts(counts)


def from_counts(counts: np.ndarray) -> dict[str, np.ndarray]:
    node = counts[NODE:CHAIN].reshape(SHAPES, LABELS) + SMOOTHING

    def ratios(square: np.ndarray) -> np.ndarray:
        joint = (square + square.T + 2 * SMOOTHING)
        joint /= joint.sum()
        side = joint.sum(axis=0)
        return np.log(joint / np.outer(side, side))

    return {"node": np.log(node / node.sum(axis=1, keepdims=True)),
            "chain": ratios(counts[CHAIN:SKIP].reshape(LABELS, LABELS)),
            "skip": ratios(counts[SKIP:].reshape(LABELS, LABELS) + AGREEMENT * np.eye(LABELS))}


def _longest(links: list[tuple[int, int]]) -> int:
    """Links of the longest path; links lead to later tokens and come in their order."""
    depth: dict[int, int] = {}
    for a, b in links:
        depth[b] = max(depth.get(b, 0), depth.get(a, 0) + 1)
    return max(depth.values(), default=0)


def beliefs(tokens: Tokens, model: dict[str, np.ndarray], rounds: int | None = None) -> np.ndarray:
    """Label probabilities of the tokens by loopy sum-product messages; tokens that a pattern labels stay."""
    unary = model["node"][tokens.shape].copy()
    fixed = tokens.label > 0
    unary[fixed] = -50.0
    unary[fixed, tokens.label[fixed]] = 0.0
    pairs = np.array(tokens.chain + tokens.skip, np.int64).reshape(-1, 2)
    if len(pairs):
        source, target = np.r_[pairs[:, 0], pairs[:, 1]], np.r_[pairs[:, 1], pairs[:, 0]]
        # The potentials are symmetric, so a link has the same table both ways.
        is_chain = np.tile(np.arange(len(pairs)) < len(tokens.chain), 2)
        chain, skip = np.exp(model["chain"]), np.exp(model["skip"])
        reverse = np.r_[np.arange(len(pairs), 2 * len(pairs)), np.arange(len(pairs))]
        leaving = np.argsort(source, kind="stable")  # the links that leave each token
        first = np.searchsorted(source[leaving], np.arange(len(unary) + 1))
        messages, gathered = np.zeros((2 * len(pairs), LABELS)), unary.copy()
        todo = np.arange(len(source))
        for _ in range(rounds or max(ROUNDS, ROUNDS_A_LINK * _longest(tokens.skip))):
            cavity = gathered[source[todo]] - messages[reverse[todo]]
            cavity = np.exp(cavity - cavity.max(axis=1, keepdims=True))
            sent = np.log(np.where(is_chain[todo, None], cavity @ chain, cavity @ skip))
            sent -= sent.max(axis=1, keepdims=True)
            change = sent - messages[todo]
            size = np.abs(change).max(axis=1)
            messages[todo] += 0.5 * change  # damped
            np.add.at(gathered, target[todo], 0.5 * change)
            if size.max() < CONVERGED:
                break
            moved = todo[size > STILL]
            stirred = np.unique(target[moved])
            n = first[stirred + 1] - first[stirred]
            out = leaving[np.repeat(first[stirred], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            todo = np.union1d(moved, out)
        unary = gathered
    out = np.exp(unary - unary.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def added_spans(text: str, base: list[tuple[str, int, int]], model: dict[str, np.ndarray], least: float = 0.5) -> list[tuple[str, int, int]]:
    """Runs of neighbouring tokens that get a kind from those they repeat, and that no base span touches."""
    if not base:
        return []
    tokens = Tokens(text, base)
    if not (tokens.label == 0).any() or not tokens.skip:
        return []
    belief = beliefs(tokens, model)
    best = belief.argmax(axis=1)
    free = (tokens.label == 0) & (best > 0) & (belief.max(axis=1) >= least)
    # Evidence is a skip path to a token that a pattern labels so; chain neighbours alone are not enough.
    evident = tokens.label.copy()
    links = [(a, b) for a, b in tokens.skip] + [(b, a) for a, b in reversed(tokens.skip)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if evident[a] and free[b] and not evident[b] and best[b] == evident[a]:
                evident[b] = evident[a]
                changed = True
    near = set(tokens.chain)
    found, run = [], []
    for k in range(len(best) + 1):
        goes_on = k < len(best) and free[k] and (not run or (best[k] == best[run[-1]] and (k - 1, k) in near))
        if not goes_on:
            if any(evident[r] for r in run):
                found.append((KINDS[best[run[0]] - 1], tokens.start[run[0]], tokens.end[run[-1]]))
            run = []
        if k < len(best) and free[k]:
            run.append(k)
    return found


def private_in(text: Column, model: dict[str, np.ndarray]) -> Column:
    """Struct of ``base`` and ``spans`` (base and added), arrays of ``kind, start, end`` by start, then kind."""

    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            base = base_spans(value)
            rows.append((in_order(base, KINDS), in_order(base + added_spans(value, base, model), KINDS)))
        return pd.DataFrame(rows, columns=["base", "spans"])

    return F.pandas_udf(scan, f"base {SPANS}, spans {SPANS}")(whole_text(text))


def found(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Every row with ``base`` and ``spans``, after a pass over all rows for the potentials.

    Missing and empty texts have none, repeated rows get repeated results; the added columns get underscores in front if
    the input has columns of their names. Positions count code points; a kind's own matches don't overlap,
    those of different kinds may.
    """
    prepare(docs.sparkSession)
    names = fresh(docs, "base", "spans", "_private")
    marked = docs.withColumn(names[2], private_in(F.col(text_column), potentials(docs, text_column)))
    return marked.select(*docs.columns, F.col(f"{names[2]}.base").alias(names[0]), F.col(f"{names[2]}.spans").alias(names[1]))
