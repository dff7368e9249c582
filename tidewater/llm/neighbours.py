"""Approximate nearest neighbours by collision-counting hashing.

Every vector is projected on ``PROJECTIONS`` random lines. A block of vectors
keeps, for each line, an array sorted by projection. A query opens a window
around its own projection on every line; a vector inside collides. Vectors that
collide on ``COLLIDING`` of all lines are verified by their inner products in
double precision.

Largest inner product becomes smallest distance by the usual extension: vectors
are divided by a largest norm and get one more component that makes them unit
vectors; a query is scaled to unit length and gets a zero. Norms of any spread
keep their differences, since a block is made of shells of like norms
(``NORM_RATIO``), each divided by its own largest norm. Shells come from the
largest norms down; one whose largest norm can't reach the k-th best score yet
is passed over, and a shell of few vectors is verified whole.

Windows widen by ``GROWTH`` (virtual rehashing: the arrays stay as they are)
until there are k verified scores, then at once to the width at which a vector
as far as the k-th best would collide on enough lines with probability
``CONFIDENCE``. A projected difference is normal with the distance as its
deviation, so ``REACH`` times that distance is wide enough, whatever lies there:
each true neighbour is verified with that probability or a larger one.

Equal vectors of a block are one vector with several ids, so copies neither
fill a window nor hide what lies behind them.

Blocks are sets of at most about ``BLOCK_ROWS`` rows, by a hash of the row, so
equal vectors or ids spread. The stated queries meet all blocks: they are sent
to every block in groups of bounded size, the 20 best of each block are merged
for each query. All vectors are in the index.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do null ids; rows that repeat id and vector count
once; a repeated id with another vector is another candidate; only vectors of
the query's dimension are its candidates; ties go to the smaller id; with fewer
candidates than asked for, all of them are returned; an empty table gives an
empty result.
"""

from __future__ import annotations

from math import comb
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 96  # below 256
COLLIDING = 0.55
GROWTH = 1.12
FIRST_WINDOW = 0.9  # half width, in standard deviations of a projection
CONFIDENCE = 0.95  # that a vector as near as the k-th best is verified
NORM_RATIO = 1.25  # of the largest and the smallest norm of a shell
BLOCK_ROWS = 4096
QUERY_ROWS = 32_768


def takes_part(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    nonzero = lambda x: x != 0
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, nonzero), F.lit(False))


def _lines(dim: int) -> np.ndarray:
    return np.random.default_rng(20_240_602).standard_normal((dim + 1, PROJECTIONS))


NEEDED = int(np.ceil(COLLIDING * PROJECTIONS))


def _reach() -> float:
    """Half width of a window, in distances, in which ``NEEDED`` lines collide with ``CONFIDENCE``."""
    low, high = 0.0, 1.0
    for _ in range(60):
        p = (low + high) / 2
        missed = sum(comb(PROJECTIONS, i) * p**i * (1 - p) ** (PROJECTIONS - i) for i in range(NEEDED))
        low, high = (p, high) if missed > 1 - CONFIDENCE else (low, p)
    return NormalDist().inv_cdf((1 + high) / 2)


REACH = _reach()


class Shell:
    """Sorted projections of distinct vectors of like norms; ``numbers`` are theirs in the block."""

    def __init__(self, numbers: np.ndarray, vectors: np.ndarray, largest_norm: float, lines: np.ndarray):
        self.numbers, self.largest_norm, self.lines = numbers, largest_norm, lines
        scaled = vectors / largest_norm
        more = np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))
        projected = np.hstack([scaled, more[:, None]]) @ lines
        order = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(projected, order, axis=0).T)
        # place of each vector in each sorted array: it lies in a window when its place does
        self.places = np.empty((PROJECTIONS, len(numbers)), dtype=np.uint32 if len(numbers) > 65_000 else np.uint16)
        np.put_along_axis(self.places, order.T, np.arange(len(numbers), dtype=self.places.dtype)[None, :], axis=1)
        self.unit = float(projected.std()) or 1.0

    def colliding(self, centres: np.ndarray, half: np.ndarray):
        """For each centre the mask of the vectors that collide on enough lines, and whether all do on all lines."""
        low = np.empty(centres.shape, dtype=np.int64)
        high = np.empty(centres.shape, dtype=np.int64)
        for j in range(PROJECTIONS):
            low[:, j] = np.searchsorted(self.sorted[j], centres[:, j] - half, "left")
            high[:, j] = np.searchsorted(self.sorted[j], centres[:, j] + half, "right")
        low, high = (w.astype(self.places.dtype)[:, :, None] for w in (low, high))
        for a, b in zip(low, high, strict=True):
            # unsigned: a place below the window wraps round to a large number
            inside = (self.places - a) < (b - a)
            yield inside.sum(axis=0, dtype=np.uint8) >= NEEDED, bool(inside.all())


class Block:
    """The distinct vectors among some rows, in shells, and a search among them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        vectors = vectors + 0.0  # one zero only
        of, _ = pd.factorize(np.array([v.tobytes() for v in vectors], dtype=object))
        order = np.lexsort((ids, of))
        self.ids = ids[order]
        self.starts = np.searchsorted(of[order], np.arange(of.max() + 2))
        self.vectors = vectors[order[self.starts[:-1]]]
        norms = np.linalg.norm(self.vectors, axis=1)
        lines = _lines(vectors.shape[1])
        by_norm = np.argsort(-norms, kind="stable")
        self.shells, a = [], 0
        while a < len(by_norm):
            b = int(np.searchsorted(-norms[by_norm], -norms[by_norm[a]] / NORM_RATIO, "right"))
            mine = by_norm[a:b]
            self.shells.append(Shell(mine, self.vectors[mine], float(norms[mine[0]]), lines))
            a = b

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """For each query its ``k`` best verified rows: index of the query, ids, scores."""
        norms = np.linalg.norm(queries, axis=1)
        best = [(np.empty(0, dtype=np.int64), np.empty(0)) for _ in queries]
        last = np.full(len(queries), -np.inf)  # the k-th best scores

        def add(q: int, found: np.ndarray) -> None:
            ids, scores = (np.concatenate(x) for x in zip(best[q], self.verify(found, query_ids[q], queries[q], k), strict=True))
            order = np.lexsort((ids, -scores))[:k]
            best[q] = ids[order], scores[order]
            if len(order) == k:
                last[q] = scores[order[-1]]

        for shell in self.shells:
            limits = norms * shell.largest_norm  # no score of the shell is larger
            asking = np.flatnonzero(last <= limits * (1 + 1e-9))  # equal ones may have smaller ids
            n = len(shell.numbers)
            if n <= 10 * k:
                for q in asking:
                    add(q, shell.numbers)
                continue
            centres = (queries / norms[:, None]) @ shell.lines[:-1]
            half = np.zeros(len(queries))
            verified = {}
            waiting, width = asking[np.isneginf(last[asking])], FIRST_WINDOW * shell.unit
            while len(waiting):
                still = []
                for q, (mask, everything) in zip(waiting, shell.colliding(centres[waiting], np.full(len(waiting), width)), strict=True):
                    if mask.sum() < 10 * k and not everything:
                        still.append(q)
                        continue
                    add(q, shell.numbers[mask])
                    verified[q], half[q] = mask, np.inf if everything else width
                waiting, width = np.array(still, dtype=np.int64), width * GROWTH
            wide = REACH * np.sqrt(np.maximum(0.0, 2 - 2 * np.maximum(last / limits, -1))) + 1e-6
            again = asking[half[asking] < wide[asking]]
            for q, (mask, _) in zip(again, shell.colliding(centres[again], wide[again]), strict=True):
                add(q, shell.numbers[mask & ~verified[q] if q in verified else mask])
        for q, (ids, scores) in enumerate(best):
            yield q, ids, scores

    def verify(self, found: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows, at least, of the vectors ``found``."""
        vectors = self.vectors[found]
        if len(found) > k + 1:  # one of them may be the query's own
            rough = vectors @ query
            near = rough >= np.partition(rough, -k - 1)[-k - 1] - 1e-9 * (1 + np.abs(rough).max())
            found, vectors = found[near], vectors[near]
        # summed row by row, so that equal vectors get equal scores wherever they stand
        scores = (vectors * query).sum(axis=1)
        counts = np.minimum(self.starts[found + 1] - self.starts[found], k + 1)
        ids = np.concatenate([self.ids[a : a + n] for a, n in zip(self.starts[found], counts, strict=True)] or [self.ids[:0]])
        other = ids != query_id
        return ids[other], np.repeat(scores, counts)[other]


def nearest(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for the rows of
    ``vectors`` (``vec_id``, ``embedding``) that ``is_query`` holds for."""
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), is_query.alias("q"))
        .filter(F.col("vec_id").isNotNull() & takes_part(F.col("v")))
        .dropDuplicates(["vec_id", "v"])
        .withColumn("dim", F.size("v"))
    )
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q")).first()
    blocks = max(1, -(-sizes["n"] // BLOCK_ROWS))
    groups = max(1, -(-sizes["q"] // QUERY_ROWS))

    place = F.xxhash64("vec_id", "v")
    base = rows.select("dim", "vec_id", "v", F.pmod(place, F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    asked = rows.filter("q").select(
        "dim", "vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block"), F.pmod(place, F.lit(groups)).cast("int").alias("g")
    )

    def search(mine: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if not len(mine) or not len(queries):
            return out
        block = Block(mine["vec_id"].to_numpy(), np.stack(mine["v"].to_list()))
        ids = queries["vec_id"].to_numpy()
        found = list(block.search(ids, np.stack(queries["v"].to_list()), k))
        return pd.DataFrame(
            {
                "query_id": np.repeat([ids[q] for q, *_ in found], [len(i) for _, i, _ in found]).astype("int64"),
                "vec_id": np.concatenate([i for _, i, _ in found]),
                "score": np.concatenate([s for *_, s in found]),
            }
        )

    keys = ["dim", "block", "g"]
    best = base.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
