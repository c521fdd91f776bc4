"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut in two halves, each half has a codebook of its own, and the
pairs of codewords form a grid of cells.  Each vector lies in the cell of its two
nearest codewords and visits cells in the order of their distance, by a
multi-sequence traversal of the two codebooks, as far as the target recall asks
for; all pairs met are verified by cosine.  A vector visits its own cell and
later cells only, so a pair meets once.

The distance of a cell is how far the vector is from the planes that part it from
the cell.  Two unit vectors with a cosine of at least c differ by sqrt(2 - 2c) at
most; at a target recall of 1 cells are visited up to this distance, and no link
can be missed.  Below 1 the distance is the quantile found for links that are
made up from the sample.

Vectors of each length have an index of their own.  How many codewords it has is
chosen on the sample, by what visits and comparisons would cost: few where a
vector would have to visit most cells anyway.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import bounded, list_array, release, stored
from .graph import components

#: Vectors that the codebooks are fitted on at most, and those of them on which costs and distances are measured.
SAMPLE_ROWS, MEASURED_ROWS = 20_000, 400
#: Codewords of a half at most; a sample of SAMPLE_ROWS vectors supports no more.
MOST_CODES = 2048
#: Microseconds that a row in a cell costs, and a comparison of two vectors.
ROW_COST, PAIR_COST = 10.0, 0.03
#: Vectors of a cell compared in one block at a time.
BLOCK = 1024
#: What rounding may add to a distance.
_SLACK = 1e-6


def fit_codebook(points: np.ndarray, size: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Lloyd's method from a seeded start."""
    centres = points[np.random.default_rng(seed).choice(len(points), size, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(points, centres).argmin(axis=1)
        count = np.bincount(near, minlength=size)
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)


def _margins(points: np.ndarray, centres: np.ndarray, tight: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, and a lower bound of the squared distance to each other centre's cell.

    The bound is the distance to the plane between the other centre and the
    nearest one or, with up to ``tight`` centres, any that is nearer than it.
    """
    d = _distances(points, centres)
    near = d.argmin(axis=1)
    apart = np.sqrt(np.maximum(_distances(centres, centres), 0))
    apart[apart < 1e-12] = np.inf
    if len(centres) > tight:
        return near, (np.maximum(0, d - d.min(axis=1, keepdims=True)) / (2 * apart[near])) ** 2
    out = np.zeros_like(d)
    for k in range(len(centres)):
        np.maximum(out, (d - d[:, k : k + 1]) / (2 * apart[k]), out=out)
    return near, out**2


def visited(first: np.ndarray, second: np.ndarray, most: float) -> list[tuple[int, int]]:
    """Cells (i, j) in ascending order of first[i] + second[j] up to ``most``: the multi-sequence traversal."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    u, v = first[a].tolist(), second[b].tolist()
    heap, out, seen = [(u[0] + v[0], 0, 0)], [], {(0, 0)}
    while heap:
        cost, i, j = heapq.heappop(heap)
        if cost > most:
            break
        out.append((int(a[i]), int(b[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(u) and y < len(v) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (u[x] + v[y], x, y))
    return out


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision, without overflow."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


class Index:
    """The two codebooks for vectors of one length, and how far cells are visited."""

    def __init__(self, points: np.ndarray, rows: float, least: float, recall: float):
        """``points``: a sample of unit vectors; ``rows``: vectors that are compared with each other, about."""
        self.half = max(1, points.shape[1] // 2)
        most, some = 2 - 2 * least + _SLACK, points[:: max(1, len(points) // MEASURED_ROWS)]
        best, size = None, 1
        while size <= min(MOST_CODES, len(points) // 4 or 1):
            self.books = tuple(fit_codebook(x, size) for x in self.halves(points))
            self.size, limit = size, most if recall >= 1 else min(most, self.reach(some, least, recall))
            (_, first), (_, second) = self.margins(some)
            visits = 1 + float(np.mean([(np.add.outer(u, v) <= limit).sum() for u, v in zip(first, second, strict=True)])) / 2
            cost = visits * (ROW_COST + PAIR_COST * rows / size**2)
            if best is not None and cost > best[0]:
                break
            best, size = (cost, self.books, size, limit), 2 * size
        _, self.books, self.size, self.limit = best

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unit[:, : self.half], unit[:, self.half :] if unit.shape[1] > 1 else unit * 0

    def margins(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return [_margins(x, book) for x, book in zip(self.halves(unit), self.books, strict=True)]

    def reach(self, some: np.ndarray, least: float, recall: float) -> float:
        """The squared distance within which this share of links lies: from sample vectors to others at the least cosine, in the directions in which sample vectors differ."""
        rng = np.random.default_rng(5)
        side = some[rng.permutation(len(some))] - some[rng.permutation(len(some))]
        side -= (side * some).sum(axis=1, keepdims=True) * some
        size = np.linalg.norm(side, axis=1, keepdims=True)
        other = least * some + np.sqrt(1 - least**2) * np.divide(side, size, out=np.zeros_like(side), where=size > 1e-9)
        there = [near for near, _ in self.margins(other)]
        at = np.arange(len(some))
        return float(np.quantile(sum(m[at, k] for (_, m), k in zip(self.margins(some), there, strict=True)), recall)) + _SLACK

    def cells(self, unit: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Each vector's own cell and the cells that it visits, its own first, later ones only."""
        (near1, margin1), (near2, margin2) = self.margins(unit)
        for k in range(len(unit)):
            home = int(near1[k]) * self.size + int(near2[k])
            yield home, [home, *sorted(c for c in (i * self.size + j for i, j in visited(margin1[k], margin2[k], self.limit)) if c > home)]


def compare_block(ids: np.ndarray, vectors: np.ndarray, weights: np.ndarray, probe: np.ndarray, own: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids with links in this block, the weight of their links, and the smallest id each is joined to here.

    Probes (``probe`` true) are compared with the index rows; ``own`` probes lie in
    this cell and so meet each index row from both sides.
    """
    p, i = np.flatnonzero(probe), np.flatnonzero(~probe)
    hit = (vectors[p] @ vectors[i].T >= least) & (ids[p][:, None] != ids[i][None, :])
    some_p, some_i = hit.any(axis=1), hit.any(axis=0)
    p, i, hit = p[some_p], i[some_i], hit[np.ix_(some_p, some_i)]
    label = ids.copy()
    count = np.zeros(len(ids))
    count[p] = hit @ weights[i]
    count[i] = hit[~own[p]].T @ weights[p][~own[p]]
    top = np.iinfo(np.int64).max
    while hit.any():
        low_i = np.where(hit, label[p][:, None], top).min(axis=0)
        low_p = np.where(hit, np.minimum(label[i], low_i)[None, :], top).min(axis=1)
        new = label.copy()
        new[i], new[p] = np.minimum(label[i], low_i), np.minimum(label[p], low_p)
        if (new == label).all():
            break
        label = new
    some = np.zeros(len(ids), bool)
    some[p] = some[i] = True
    return ids[some], count[some].astype(np.int64), label[some]


def embedding_duplicates(rows: DataFrame, least: float = 0.98, recall: float = 1.0) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding, label): vec_id, n_links, component_id and kept.

    Vectors of equal, non-null label and equal length are linked if their cosine
    in double precision is at least ``least``.  A vector that is null, empty or
    zero or has a null or non-finite component links with nothing.  Equal vectors
    are compared once, and each counts as a link of the others.  Rows that share
    a vec_id count as one vector with several values; a null vec_id links with
    nothing.  An empty table gives no row; other columns are left out.  With
    ``recall`` 1 all links are found, below it about that share of those at the
    least cosine and more of the others.
    """
    single = isinstance(rows.schema["embedding"].dataType.elementType, FloatType)  # travels as it is; computed in double precision
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("k", F.when(sound, F.xxhash64("label", "embedding")))
    classes = stored(rows.where("k IS NOT NULL").groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")), "vectors")
    # A number for each length; and of the sample, SAMPLE_ROWS vectors at most, the same at every run.
    lengths = {r["d"]: r["n"] / r["labels"] for r in classes.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.count_distinct("label").alias("labels")).collect()}
    sample = classes.select("embedding", F.xxhash64("id", "label", "embedding").alias("h")).orderBy("h").limit(SAMPLE_ROWS).toArrow()
    size = pc.list_value_length(sample["embedding"]).to_numpy()
    points = {d: normalised(np.array(sample["embedding"].filter(pa.array(size == d)).to_pylist() or [[1.0] * d], float)) for d in lengths}
    index = {d: Index(points[d], n, least, recall) for d, n in lengths.items()}
    kind = pa.float32() if single else pa.float64()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = pc.list_value_length(batch.column(1)).to_numpy()
            for d in np.unique(length).tolist():
                of = batch.filter(pa.array(length == d))
                for at in range(0, of.num_rows, 2000):
                    part = of.slice(at, 2000)
                    vectors = part.column(1).flatten().to_numpy().reshape(-1, d)
                    which, cell, is_probe, is_own = [], [], [], []
                    for k, (home, cells) in enumerate(index[d].cells(normalised(vectors.astype(float)))):
                        which += [k] * (1 + len(cells))
                        cell += [home, *cells]
                        is_probe += [False, *[True] * len(cells)]
                        is_own += [True, True, *[False] * (len(cells) - 1)]
                    take = pa.array(which, pa.int64())
                    names = ["id", "label", "weight", "d", "cell", "probe", "own", "vector"]
                    yield pa.record_batch([part.column(0).take(take), part.column(2).take(take), part.column(3).take(take), pa.array(np.full(len(which), d, np.int32)), pa.array(cell, pa.int32()), pa.array(is_probe), pa.array(is_own), list_array(vectors[which].ravel(), np.full(len(which), d), kind)], names)

    probes = stored(classes.select("id", "embedding", "label", "weight").mapInArrow(probe, f"id long, label string, weight long, d int, cell int, probe boolean, own boolean, vector array<{'float' if single else 'double'}>"), "probes")
    # A large cell is compared block by block: its index rows in `down` parts, its probes in `across` parts.
    parts = probes.groupBy("label", "d", "cell").agg(F.count_if(~F.col("probe")).alias("indexed"), F.count("*").alias("n")).where("indexed > 0 AND n > 2")
    parts = stored(parts.select("label", "d", "cell", F.ceil(F.col("indexed") / BLOCK).cast("int").alias("down"), F.ceil((F.col("n") - F.col("indexed")) / BLOCK).cast("int").alias("across")), "cells")
    dealt = probes.join(bounded(parts), ["label", "d", "cell"])
    mine = F.when(F.col("probe"), F.pmod(F.xxhash64("id"), F.col("across"))).otherwise(F.pmod(F.xxhash64("id"), F.col("down"))).cast("int")
    dealt = dealt.withColumn("mine", mine).withColumn("theirs", F.explode(F.sequence(F.lit(0), F.when(F.col("probe"), F.col("down")).otherwise(F.col("across")) - 1)))
    block = F.when(F.col("probe"), F.struct(F.col("theirs").alias("i"), F.col("mine").alias("p"))).otherwise(F.struct(F.col("mine").alias("i"), F.col("theirs").alias("p")))
    dealt = dealt.withColumn("block", block).select("label", "d", "cell", F.col("block.i").alias("i"), F.col("block.p").alias("p"), "id", "weight", "probe", "own", "vector")

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        vectors = np.concatenate([c.flatten().to_numpy() for c in group["vector"].chunks]).reshape(-1, group["d"][0].as_py())
        probe, own = (group[c].to_numpy(zero_copy_only=False) for c in ("probe", "own"))
        if probe.all() or not probe.any():
            return pa.table({c: pa.array([], pa.int64()) for c in ("id", "n", "to")})
        ids, n, to = compare_block(group["id"].to_numpy(), normalised(vectors.astype(float)), group["weight"].to_numpy().astype(float), probe, own, least)
        return pa.table({"id": ids, "n": n, "to": to})

    found = stored(dealt.groupBy("label", "d", "cell", "i", "p").applyInArrow(compare, "id long, n long, to long"), "found")
    release(probes, parts)
    label = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    result = classes.select("label", "embedding", "id", "weight").join(counts, "id", "left").join(label, "id", "left")
    result = result.select(F.xxhash64("label", "embedding").alias("k"), F.col("label").alias("_label"), F.col("embedding").alias("_embedding"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    out = rows.join(result, (rows["k"] == result["k"]) & (rows["label"] == result["_label"]) & (rows["embedding"] == result["_embedding"]), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
