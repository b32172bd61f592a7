"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts by spectral bisection, and a small network learns which
part a vector belongs to (after Dong et al. 2020): it lays every vector into one partition, or a border vector into two. A
second one learns in which partitions a vector's neighbours lie, and sends each query to the most probable ones. How wide
the border is and how far down the partitions a query goes is measured on vectors of the sample that were kept from both
networks: what reaches the recall asked for with the fewest rows compared is taken. There, cosines are exact.
"""

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import in_share, prepare, written

SHORTLIST = 16
FEWEST_PARTS = 32
#: Sampled vectors a partition is learned from.
LEARNED_FROM = 32
#: How much less likely (in log odds) a vector's second partition may be for it to lie there too.
BORDERS = (0.0, 0.5, 1.5)


def _neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """For each row of unit vectors the numbers of its ``k`` nearest others."""
    k, out = min(k, len(x) - 1), []
    for at in range(0, len(x), 256):
        near = x[at:at + 256] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -2.0
        out.append(np.argpartition(-near, k - 1, axis=1)[:, :k].copy() if k else np.zeros((len(near), 0), np.int64))
    return np.concatenate(out)


def _halves(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, rng, steps: int = 40) -> np.ndarray:
    """True for the upper half of a graph's nodes along its second eigenvector: two parts of equal size, few links cut."""
    n = len(nodes)
    degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1e-3
    root = np.sqrt(degree)
    first = root / np.linalg.norm(root)
    v = rng.standard_normal(n)
    for _ in range(steps):
        v -= first * (first @ v)
        w = v / root
        v = v + (np.bincount(a, w[b], n) + np.bincount(b, w[a], n)) / root  # shifted, so the largest eigenvalue leads
        v /= np.linalg.norm(v) + 1e-30
    upper = np.zeros(n, bool)
    upper[np.argsort(v / root, kind="stable")[n // 2:]] = True
    # Swaps of the pairs that cut most links keep the balance (Kernighan and Lin 1970).
    for _ in range(4):
        across = upper[a] != upper[b]
        gain = np.bincount(a, 2.0 * across - 1, n) + np.bincount(b, 2.0 * across - 1, n)
        up, down = np.flatnonzero(upper), np.flatnonzero(~upper)
        up, down = up[np.argsort(-gain[up])], down[np.argsort(-gain[down])]
        m = min(len(up), len(down))
        swap = np.flatnonzero(gain[up[:m]] + gain[down[:m]] > 2)[: max(1, m // 20)]
        if not len(swap):
            break
        upper[up[swap]], upper[down[swap]] = False, True
    return upper


def balanced_parts(x: np.ndarray, parts: int, k: int = 10, seed: int = 7) -> np.ndarray:
    """A part from 0 to ``parts`` - 1 (a power of two) for each vector, all of about equal size."""
    rng, near = np.random.default_rng(seed), _neighbours(x, k)
    a, b = np.repeat(np.arange(len(x)), near.shape[1]), near.ravel()
    part = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        after = []
        for nodes in groups:
            place = np.full(len(x), -1)
            place[nodes] = np.arange(len(nodes))
            inside = (place[a] >= 0) & (place[b] >= 0)
            upper = _halves(nodes, place[a[inside]], place[b[inside]], rng)
            after += [nodes[~upper], nodes[upper]]
        groups = after
    for number, nodes in enumerate(groups):
        part[nodes] = number
    return part


@dataclass
class Router:
    """A network with one hidden layer that gives the probability of each partition."""

    layers: list[tuple[np.ndarray, np.ndarray]]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        (w1, b1), (w2, b2) = self.layers
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2

    @staticmethod
    def train(x: np.ndarray, share: np.ndarray, hidden: int = 128, epochs: int = 40, seed: int = 7) -> "Router":
        """``share`` has the probabilities that the network is to give for each vector."""
        parts = share.shape[1]
        rng, d = np.random.default_rng(seed), x.shape[1]
        scale = np.sqrt(d)  # unit vectors have entries of about 1 / sqrt(d)
        weights = [rng.standard_normal((d, hidden)) * np.sqrt(2 / d), np.zeros(hidden),
                   rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
        means, squares, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        x = x * scale
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 256):
                rows = order[at:at + 256]
                h = np.maximum(x[rows] @ weights[0] + weights[1], 0)
                z = h @ weights[2] + weights[3]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p = (p - share[rows]) / len(rows)
                back = (p @ weights[2].T) * (h > 0)
                t += 1
                for i, g in enumerate((x[rows].T @ back, back.sum(axis=0), h.T @ p, p.sum(axis=0))):
                    g = g + 1e-5 * weights[i]
                    means[i] = 0.9 * means[i] + 0.1 * g
                    squares[i] = 0.99 * squares[i] + 0.01 * g * g
                    weights[i] = weights[i] - 3e-3 * (means[i] / (1 - 0.9 ** t)) / (np.sqrt(squares[i] / (1 - 0.99 ** t)) + 1e-8)
        return Router([(weights[0] * scale, weights[1]), (weights[2], weights[3])])


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part: an id, no missing, infinite or NaN component, not all zero."""
    values = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), values.alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    fine = "NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(vector, x -> x <> 0)"
    return rows.where(F.coalesce(F.expr(fine), F.lit(False)))


def _unit(rows: list | pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Partitions:
    """The network that places vectors, and the one that tells where a vector's neighbours are.

    Vectors of another ``length`` than these networks know have a partition of their own for each length, below zero.
    """

    parts: int
    home: Router | None = None
    around: Router | None = None
    length: int | None = None
    border: float = 0.0
    coverage: float = 1.0

    def homes(self, x: np.ndarray) -> np.ndarray:
        """Whether a row lies in a partition: the most probable one, and the next if it is about as probable."""
        out = np.zeros((len(x), self.parts), bool)
        if self.home is None:
            out[:, 0] = True
            return out
        odds, rows = self.home.log_odds(x), np.arange(len(x))
        first = odds.argmax(axis=1)
        out[rows, first] = True
        if self.border and self.parts > 1:
            highest = odds[rows, first]
            odds[rows, first] = -np.inf
            second = odds.argmax(axis=1)
            near = np.flatnonzero(highest - odds[rows, second] < self.border)
            out[near, second[near]] = True
        return out

    def before(self, x: np.ndarray) -> np.ndarray:
        """For each row and partition, the share of neighbours expected in the partitions that are more probable."""
        odds = self.around.log_odds(x)
        share = np.exp(odds - odds.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        order = np.argsort(-share, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(share, order, axis=1), axis=1) - np.take_along_axis(share, order, axis=1)
        out = np.empty_like(sums)
        np.put_along_axis(out, order, sums, axis=1)
        return out

    def probed(self, x: np.ndarray) -> np.ndarray:
        """Whether a row asks a partition: the most probable ones, up to ``coverage`` of the neighbours expected."""
        return np.ones((len(x), self.parts), bool) if self.around is None else self.before(x) < self.coverage


def learned(x: np.ndarray, parts: int, neighbours: int = 20, k: int = 5, recall: float = 0.95, held_out: int = 1024,
            seed: int = 7) -> Partitions:
    """Partitions of different unit vectors, with the border and coverage that compare fewest rows at that recall.

    An eighth of the vectors, ``held_out`` at most, is kept from the networks; the ``k`` nearest of the others are what has to be found
    for them. Those others are fewer than a whole table's rows, so its neighbours are nearer and easier to find.
    """
    order = np.random.default_rng(seed).permutation(len(x))
    asked = x[order[:min(held_out, len(x) // 8)]]
    x = x[np.sort(order[len(asked):])]
    wanted = np.concatenate([np.argpartition(-(q @ x.T), k - 1, axis=1)[:, :k] for q in np.array_split(asked, -(-len(asked) // 256))])
    near = _neighbours(x, neighbours)
    home, best, least = Router.train(x, np.eye(parts)[balanced_parts(x, parts)]), None, np.inf
    for border in BORDERS:
        tried = Partitions(parts, home, None, x.shape[1], border)
        homes = tried.homes(x)
        share, around = homes / homes.sum(axis=1, keepdims=True), np.zeros((len(x), parts))
        for column in near.T:
            around += share[column] / near.shape[1]
        tried = replace(tried, around=Router.train(x, around, epochs=10))
        before = tried.before(asked)
        # A neighbour is found as soon as one of its partitions is asked.
        reached = np.stack([np.where(homes[column], before, np.inf).min(axis=1) for column in wanted.T]).ravel()
        found = np.sort(reached)[max(0, int(np.ceil(recall * len(reached))) - 1)]
        tried = replace(tried, coverage=float(np.nextafter(found, 2.0)))
        compared = ((before < tried.coverage) @ homes.sum(axis=0)).mean()
        if compared < least:
            best, least = tried, compared
    return best


def fit(vectors: DataFrame, sample: int = 8192, most_parts: int = 1024, part_rows: int = 512, k: int = 5, recall: float = 0.95,
        length: int | None = None) -> Partitions:
    """Partitions of about ``part_rows`` vectors, ``most_parts`` at most, learned from about ``sample`` vectors, or ``LEARNED_FROM`` for each
    partition if that is more. They are picked by a hash of their id. Small tables have fewer partitions.

    An id counts once however many rows have it, so no id makes the sample larger than that.
    """
    total = vectors.count()
    parts = FEWEST_PARTS
    while parts < most_parts and parts * part_rows < total:
        parts *= 2
    share = min(1.0, max(sample, LEARNED_FROM * parts) / max(total, 1))
    picked = vectors.where(in_share(F.xxhash64("vec_id"), share))
    rows = picked.groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id").select("vector").collect()
    x = np.unique(_unit([r["vector"] for r in rows]), axis=0) if rows else np.zeros((0, 1))  # equal vectors count once
    while parts > 1 and len(x) < LEARNED_FROM * parts:
        parts //= 2
    return Partitions(1, length=length) if parts == 1 else learned(x, parts, k=k, recall=recall)


def _routed(vectors: DataFrame, partitions: Partitions, asking: bool) -> DataFrame:
    """Each vector with the partitions that it lies in, or asks; ``row`` is one number in all partitions of a row."""
    shared = vectors.sparkSession.sparkContext.broadcast(partitions)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, number = shared.value, TaskContext.get().partitionId() << 36
        for batch in batches:
            rows = np.arange(number, number + len(batch))
            number += len(batch)
            lengths = batch["vector"].map(len).to_numpy(np.int64)
            usual = lengths == known.length if known.length is not None else np.ones(len(batch), bool)
            at, part = np.flatnonzero(~usual), -lengths[~usual]
            if usual.any():
                x = _unit(batch["vector"][usual])
                of, to = np.nonzero(known.probed(x) if asking else known.homes(x))
                at, part = np.r_[at, np.flatnonzero(usual)[of]], np.r_[part, to]
            yield pd.DataFrame({"row": rows[at], "vec_id": batch["vec_id"].to_numpy()[at], "vector": batch["vector"].to_numpy()[at],
                                "part": part})

    return vectors.mapInPandas(run, "row long, vec_id long, vector array<double>, part int")


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's ``k`` nearest of these rows other than itself, ties to the smaller id."""
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0),)]
    if len(queries) and len(rows):
        rows = rows.sort_values(["vec_id", "row"], kind="stable")
        ids, numbers, x = rows["vec_id"].to_numpy(), rows["row"].to_numpy(), _unit(rows["vector"])
        for at in range(0, len(queries), 512):
            some = queries.iloc[at:at + 512]
            own, q = some["vec_id"].to_numpy(), _unit(some["vector"])
            near = np.round(q @ x.T, 12)
            near[own[:, None] == ids[None, :]] = -np.inf
            take = min(SHORTLIST + k, len(ids))
            # Rows are in the order of their ids, so a stable sort keeps the smaller ones of equals.
            short = np.argsort(-near, axis=1, kind="stable")[:, :take] if len(ids) <= 4 * take else _leading(near, take)
            for row in range(len(own)):
                picked = short[row][np.isfinite(near[row, short[row]])]
                exact = (x[picked] * q[row]).sum(axis=1)
                order = np.lexsort((numbers[picked], ids[picked], -exact))[:k]
                found.append((np.full(len(order), own[row]), ids[picked][order], numbers[picked][order], exact[order]))
    return pd.DataFrame({name: np.concatenate(of) for name, of in zip(("query_id", "vec_id", "row", "score"), zip(*found))})


def _leading(near: np.ndarray, take: int) -> np.ndarray:
    """Columns of the ``take`` largest of each row, of equal ones the first."""
    edge = -np.partition(-near, take - 1, axis=1)[:, take - 1]
    out = np.empty((len(near), take), np.int64)
    for row in range(len(near)):
        above = np.flatnonzero(near[row] > edge[row])
        out[row] = np.r_[above, np.flatnonzero(near[row] == edge[row])[: take - len(above)]]
    return out


def nearest(vectors: DataFrame, queries: DataFrame, partitions: Partitions, k: int = 5, block_rows: int = 20_000,
            block_queries: int = 20_000) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest of the vectors in the partitions that it asks.

    A partition of more than ``block_rows`` vectors or ``block_queries`` queries is a grid of blocks, so a partition that
    holds most of the rows (of one repeated vector, say) is searched by many tasks, each with a block in memory.
    """
    indexed = written(_routed(vectors, partitions, False), "indexed")
    asked = written(_routed(queries, partitions, True), "asked")

    def sized(rows: DataFrame, block: int, name: str) -> DataFrame:
        return rows.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias(name))

    # One row for each partition that has both vectors and queries.
    grid = written(sized(indexed, block_rows, "across").join(sized(asked, block_queries, "down"), "part"), "grid")

    def own(blocks: str):
        return F.pmod(F.xxhash64("row"), F.col(blocks)).cast("int")

    def every(blocks: str):
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    left = indexed.join(grid, "part").withColumn("i", own("across")).withColumn("j", every("down"))
    right = asked.join(grid, "part").withColumn("j", own("down")).withColumn("i", every("across"))
    left, right = (side.select("row", "vec_id", "vector", "part", "i", "j") for side in (left, right))
    found = right.groupBy("part", "i", "j").cogroup(left.groupBy("part", "i", "j")).applyInPandas(
        lambda q, v: _best(q, v, k), "query_id long, vec_id long, row long, score double")
    # A border vector may be found in both of its partitions, with the same rank.
    rank = F.expr("dense_rank() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id, row)").cast("int")
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k).dropDuplicates(["query_id", "rank"])
    return ranked.select("query_id", "rank", "vec_id", "score")


def search(embeddings: DataFrame, every_nth: int = 50, k: int = 5, sample: int = 8192, most_parts: int = 1024, part_rows: int = 512,
           recall: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Queries are the rows whose id is divisible by ``every_nth``; all other rows of the same length are a query's candidates.

    Rows without an id, and vectors that are missing, zero or hold a missing or non-finite component, take no part. Vectors of
    another length than most have are compared with all of their length. Rows that repeat a query's id are the query's own;
    a repeated query asks once. Queries that their partitions give fewer than ``k`` neighbours are asked of all partitions, so
    they get ``k`` unless there are fewer candidates. An empty table gives an empty one. Other columns are ignored.
    """
    prepare(embeddings.sparkSession)
    rows = usable(embeddings, id_column, vector_column)
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    length = lengths["n"] if lengths else None
    usual = rows.where(F.size("vector") == length) if lengths else rows
    partitions = fit(usual, sample, most_parts, part_rows, k, recall, length)
    queries = rows.where(F.col("vec_id") % every_nth == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    first = written(nearest(rows, queries, partitions, k), "nearest")
    if partitions.parts == 1:
        return first
    short = queries.join(first.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k).select(
        F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    short = written(short, "short")
    if short.isEmpty():
        return first
    again = nearest(rows, short, replace(partitions, around=None), k)
    return first.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(*again.columns).unionByName(again)
