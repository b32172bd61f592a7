"""Hard negatives by anchor clusters that share one sorted candidate list each (after MAXIMUS, Abuzaid et al. 2019).

A candidate v at the angle b from a cluster's centre scores at most |a| |v| cos(max(0, b - r)) with any anchor a of the cluster,
all of which are within the angle r of it. A cluster sorts its candidates by |v| cos(max(0, b - r)) once; every anchor walks that
one list until the bound of what is left is under what it has found, so its result is certified to be that of a full scan.

Rows lie in the cells of a bounded number of centres. An anchor first meets its own cell, then only those cells that what it has
found, or the least score it accepts, can't rule out. A cell of many rows is split and so are its anchors, so no task holds
more than a block of each, whichever cell, label or vector most rows have.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import in_share, prepare, written

CHUNK = 512
MARGIN = 1e-6  # of an angle; far more than cosines near one lose by rounding
LEAST, MOST = -2 ** 63, 2 ** 63 - 1
FOUND = "row long, slot int, found long, score long"
# Numbers in a block of rows, and of anchors: 32,768 and 2,048 vectors of 64 components.
ROW_BLOCK, ANCHOR_BLOCK = 1 << 21, 1 << 17


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
           scale: float = 256, relabelled: int = 7, labels: int = 10) -> DataFrame:
    """``vec_id, label, vector`` of the distinct rows that take part, with noisy labels and whole-number components.

    An id, a label, and a vector without missing or non-finite components are needed. Where the id is divisible by
    ``relabelled`` the label becomes the next one of ``labels``. Components are ``floor(scale * x)``.
    """
    values, label = F.col(vector_column).cast("array<double>"), F.col(label_column).cast("long")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # Beyond 2 ^ 52 a double is whole, and its floor may not fit a long.
    whole = F.transform(values, lambda x: F.when(F.abs(x * float(scale)) < 2.0 ** 52, F.floor(x * float(scale)).cast("double")).otherwise(
        x * float(scale)))
    shifted = F.when(F.col(id_column) % relabelled == 0, (label + 1) % labels).otherwise(label)
    rows = vectors.where(F.col(id_column).isNotNull() & label.isNotNull() & F.coalesce(~bad, F.lit(False)))
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), shifted.alias("label"), whole.alias("vector")).distinct()


# -- Cells ---------------------------------------------------------------------------------------------------

@dataclass
class Cells:
    """Unit centres of the commonest vector length; vectors of another length are all in one cell of their own, -1 - length."""

    centres: np.ndarray
    farthest: np.ndarray | None = None  # angle and norm of each cell's rows, at most
    longest: np.ndarray | None = None

    def angles(self, x: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(_unit(x) @ self.centres.T, -1, 1))

    def others(self, x: np.ndarray, home: np.ndarray, least: np.ndarray) -> list[np.ndarray]:
        """For each anchor the cells but its own that may hold a score of ``least`` or more."""
        best = np.cos(np.maximum(0, self.angles(x) - self.farthest - MARGIN)) * self.longest * _norms(x)[:, None]
        open_ = _at_most(best) >= least[:, None]
        open_[np.arange(len(x)), home] = False
        return [np.flatnonzero(row) for row in open_]


def _norms(x: np.ndarray) -> np.ndarray:
    return np.linalg.norm(x, axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; a zero vector stays one and counts as at a right angle to all, which only its norm of zero uses."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)  # so that squares neither overflow nor vanish
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _at_most(bound: np.ndarray) -> np.ndarray:
    """The bound with room for rounding. Not a number means nothing is known."""
    return np.nan_to_num(bound + np.abs(bound) * 1e-9 + 1, nan=np.inf, posinf=np.inf, neginf=-np.inf)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def centres_of(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Unit centres by spherical k-means from ``k`` different vectors."""
    x = np.unique(_unit(x), axis=0)
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        held = np.abs(sums).max(axis=1) > 0
        centres = np.where(held[:, None], _unit(sums), centres)
    return centres


def fit(rows: DataFrame, is_anchor: Column, clusters: int | None = None, sample: int = 4096, per_cluster: int = 512,
        most: int = 256) -> tuple[Cells, int]:
    """Centres learned from about ``sample`` anchors, picked by a hash, and the commonest vector length.

    There is a centre for each ``per_cluster`` anchors, up to ``most``; they decide what is skipped, never what is found.
    """
    lengths = rows.where(is_anchor).groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    if lengths is None or lengths["n"] == 0:
        return Cells(np.zeros((1, 1))), -1
    share = min(1.0, sample / lengths["rows"])
    picked = rows.where(is_anchor & (F.size("vector") == lengths["n"]) & in_share(F.xxhash64("vec_id", "label"), share))
    # The hash leaves about ``sample`` rows; the limit keeps repeated ids from making the sample larger.
    found = picked.select("vector").limit(4 * sample).toPandas()
    k = clusters or min(most, -(-lengths["rows"] // per_cluster))
    if k == 1 or found.empty:
        return Cells(np.eye(1, lengths["n"])), lengths["n"]
    return Cells(centres_of(_matrix(found["vector"]), k)), lengths["n"]


def _placed(rows: DataFrame, cells: Cells, length: int) -> DataFrame:
    """Rows with their cell, and their angle to its centre and norm."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["vector"].map(len).to_numpy()
            cell, angle, norm = -1 - size, np.full(len(batch), np.pi), np.zeros(len(batch))
            own = np.flatnonzero(size == length)
            if len(own) and length > 0:
                x = _matrix(batch["vector"].iloc[own])
                angles = shared.value.angles(x)
                cell[own], angle[own], norm[own] = angles.argmin(axis=1), angles.min(axis=1), _norms(x)
            yield batch.assign(cell=cell, angle=angle, norm=norm)

    return rows.mapInPandas(run, "vec_id long, label long, vector array<double>, cell int, angle double, norm double")


# -- Walks ---------------------------------------------------------------------------------------------------

def _products(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond the longs, the nearest long."""
    if np.abs(a).max(initial=0) * np.abs(v).max(initial=0) * a.shape[1] < 2.0 ** 53:
        return (a @ v.T).astype(np.int64)
    whole = [[int(c) for c in row] for row in v]
    return np.array([[min(max(sum(int(c) * w for c, w in zip(row, other)), LEAST), MOST) for other in whole] for row in a], np.int64).reshape(
        len(a), len(v))


def _best(pool: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The first ``k`` of each slot: higher scores first, ties by smaller id. In order of slot and place."""
    slot, found, score = pool
    order = np.lexsort((found, ~score, slot))  # ~ turns the order round without overflow
    slot, found, score = slot[order], found[order], score[order]
    keep = np.arange(len(slot)) - np.searchsorted(slot, slot) < k
    return slot[keep], found[keep], score[keep]


def walk(asked: pd.DataFrame, rows: pd.DataFrame, k: int, same: bool, chunk: int = CHUNK) -> tuple[pd.DataFrame, int]:
    """Each asked slot's first ``k`` of the rows, and how many inner products that took.

    ``asked`` are anchors of one cluster: ``row, vec_id, label, vector`` and ``slots`` with the scores that a slot accepts
    (``lower`` to ``upper``) and the ``least`` that it has use for. Rows of the anchor's own id are no partners.
    """
    empty = pd.DataFrame({"row": np.zeros(0, np.int64), "slot": np.zeros(0, np.int32), "found": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
    if asked.empty or rows.empty:
        return empty, 0
    a, v = _matrix(asked["vector"]), _matrix(rows["vector"])
    if not a.shape[1]:
        a, v = np.zeros((len(a), 1)), np.zeros((len(v), 1))
    centre = _unit(_unit(a).sum(axis=0, keepdims=True))
    def angle(x):
        return np.arccos(np.clip(_unit(x) @ centre.T, -1, 1)).ravel()
    radius = angle(a).max()
    bound = np.nan_to_num(_norms(v) * np.cos(np.maximum(0, angle(v) - radius - MARGIN)), nan=np.inf)
    order = np.argsort(-bound, kind="stable")
    v, bound = v[order], bound[order]
    ids, labels = rows["vec_id"].to_numpy()[order], rows["label"].to_numpy()[order]
    own, own_label, length = asked["vec_id"].to_numpy(), asked["label"].to_numpy(), _norms(a)
    member = np.repeat(np.arange(len(asked)), asked["slots"].map(len))
    slots = [s for some in asked["slots"] for s in some]
    lower, upper, least = (np.array([s[c] for s in slots], np.int64) for c in ("lower", "upper", "least"))
    least = np.maximum(lower, least)
    pool, compared = tuple(np.zeros(0, np.int64) for _ in range(3)), 0
    for at in range(0, len(v), chunk):
        live = np.flatnonzero(_at_most(length[member] * bound[at]) >= least)
        if not len(live):
            break
        members, place = np.unique(member[live], return_inverse=True)
        scores = _products(a[members], v[at:at + chunk])
        compared += scores.size
        fits = (own_label[members][:, None] == labels[at:at + chunk]) == same
        fits &= own[members][:, None] != ids[at:at + chunk]
        wanted = fits[place] & (scores[place] >= least[live][:, None]) & (scores[place] <= upper[live][:, None])
        s, c = np.nonzero(wanted)
        if not len(s):
            continue
        new = (live[s], ids[at + c], scores[place[s], c])
        pool = _best(tuple(np.concatenate(two) for two in zip(pool, new)), k)
        full = np.flatnonzero(np.bincount(pool[0], minlength=len(member))[pool[0]] >= k)
        np.maximum.at(least, pool[0][full[k - 1::k]], pool[2][full[k - 1::k]])
    slot, found, score = pool
    return pd.DataFrame({"row": asked["row"].to_numpy()[member[slot]], "slot": np.array([s["slot"] for s in slots], np.int32)[slot],
                         "found": found, "score": score}), compared


def _blocks(rows: DataFrame, keys: list[str], numbers: int, block: str) -> DataFrame:
    """Rows with the number of their block; blocks of a key are as many as its rows need."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.count("*") * F.greatest(F.max(F.size("vector")), F.lit(1)) / numbers).alias("_blocks"))
    return rows.join(counts, keys).withColumn(block, F.pmod(F.xxhash64("row"), F.col("_blocks")).cast("int")).drop("_blocks")


def _met(asked: DataFrame, visits: DataFrame, rows: DataFrame, k: int, same: bool, name: str) -> DataFrame:
    """Walks of every asked anchor through the cells that it visits (``row, home, i, kind, cell``)."""
    # A cell's blocks, met by each block of anchors that visits the cell: keys, not rows.
    parts = rows.select("cell", "kind", "j").distinct()
    meetings = visits.select("home", "i", "kind", "cell").distinct().join(parts, ["cell", "kind"])
    left = rows.select("cell", "kind", "j", "vec_id", "label", "vector").join(meetings, ["cell", "kind", "j"])
    right = asked.join(visits.select("row", "cell"), "row").join(parts, ["cell", "kind"])
    keys = ["cell", "kind", "j", "home", "i"]
    to = right.select(*[F.col(c).alias(f"_{c}") for c in keys], "row", "vec_id", "label", "vector", "slots")
    return written(to.groupBy(*[f"_{c}" for c in keys]).cogroup(left.groupBy(*keys)).applyInPandas(
        lambda q, v: walk(q, v, k, same)[0], FOUND), name)


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.expr("row_number() OVER (PARTITION BY row, slot ORDER BY score DESC, found)").cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(asked: DataFrame, rows: DataFrame, cells: Cells, k: int, same: bool) -> DataFrame:
    """``row, slot, found, score, rank``: each slot's first ``k`` rows of the anchor's own label, or of all others.

    ``asked`` has ``row, vec_id, label, vector, home`` (the anchor's cell) and ``slots``; ``rows`` are the placed ones.
    """
    kind = F.col("label") if same else F.lit(0).cast("long")  # rows of one label are blocks of their own where only they matter
    rows = _blocks(rows.withColumn("kind", kind), ["cell", "kind"], ROW_BLOCK, "j")
    asked = written(_blocks(asked.withColumn("kind", kind), ["home", "kind"], ANCHOR_BLOCK, "i"), "asked")
    near = _met(asked, asked.select("row", "home", "i", "kind", F.col("home").alias("cell")), rows, k, same, "near")
    if len(cells.centres) == 1:
        return _first(near, k)
    # What a slot has use for now: scores that reach the last of its k, if it has as many.
    known = _first(near, k).where(F.col("rank") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("_known"))
    better = F.transform("slots", lambda s: s.withField("least", F.greatest(s["least"], F.coalesce(F.try_element_at(F.col("_known"), s["slot"]), s["least"]))))
    again = asked.where("home >= 0").join(known, "row", "left").withColumn("slots", better).drop("_known")
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def open_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            least = np.array([min(max(s["lower"], s["least"]) for s in some) for some in batch["slots"]], np.float64)
            visits = shared.value.others(_matrix(batch["vector"]), batch["home"].to_numpy(), least)
            n = [len(x) for x in visits]
            yield pd.DataFrame({c: np.repeat(batch[c].to_numpy(), n) for c in ("row", "home", "i", "kind")} | {"cell": np.concatenate(visits)})

    again = written(again, "again")
    visits = written(again.select("row", "home", "i", "kind", "vector", "slots").mapInPandas(open_cells, "row long, home int, i int, kind long, cell int"), "visits")
    return _first(near.unionByName(_met(again, visits, rows, k, same, "far")), k)


def mined(vectors: DataFrame, every_nth: int = 50, positives: int = 5, negatives: int = 3, clusters: int | None = None,
          id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are rows whose id is divisible by ``every_nth``. An anchor's positives are the first ``positives`` other rows of
    its label by their inner product with it, ties by smaller id. For each, the first ``negatives`` rows of other labels that score
    from half to 95 hundredths of the positive's score are returned; a positive under zero has none. Rows that take part are
    those of ``usable``; repeated rows count once, and rows that differ under one id are rows of their own, though never
    partners of each other. Vectors have no product with those of another length. Products beyond the longs count as the
    nearest long. An empty table gives an empty one; other columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = written(usable(vectors, id_column, vector_column, label_column), "rows")
    is_anchor = F.col("vec_id") % every_nth == 0
    cells, length = fit(rows, is_anchor, clusters)
    placed = written(_placed(rows, cells, length).withColumn("row", F.monotonically_increasing_id()), "placed")
    if len(cells.centres) > 1:
        # A row for each cell with a centre, so no more than there are centres.
        edges = {r["cell"]: r for r in placed.where("cell >= 0").groupBy("cell").agg(
            F.max("angle").alias("angle"), F.max("norm").alias("norm")).collect()}
        cells.farthest = np.array([edges[c]["angle"] if c in edges else 0.0 for c in range(len(cells.centres))])
        cells.longest = np.array([edges[c]["norm"] if c in edges else 0.0 for c in range(len(cells.centres))])
    anchors = placed.where(is_anchor).select("row", "vec_id", "label", "vector", F.col("cell").alias("home"))

    def slots(number: Column | str, lower: Column, upper: Column) -> Column:
        return F.struct(F.col(number).alias("slot") if isinstance(number, str) else number.alias("slot"), lower.alias("lower"),
                        upper.alias("upper"), F.lit(LEAST).cast("long").alias("least"))

    any_score = slots(F.lit(0), F.lit(LEAST).cast("long"), F.lit(MOST).cast("long"))
    near = written(search(anchors.withColumn("slots", F.array(any_score)), placed, cells, positives, True), "positives")
    # 50 p <= 100 n <= 95 p in whole numbers, without products that overflow.
    score = F.col("score")
    lower = F.expr("score DIV 2 + score % 2")
    upper = F.expr("score DIV 20 * 19 + score % 20 * 19 DIV 20")
    wanted = near.where(score >= 0).groupBy("row").agg(F.sort_array(F.collect_list(slots("rank", lower, upper))).alias("slots"))
    hard = search(anchors.join(wanted, "row"), placed, cells, negatives, False)
    chosen = near.select("row", F.col("rank").alias("slot"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return hard.join(chosen, ["row", "slot"]).join(named, "row").select(
        "anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
