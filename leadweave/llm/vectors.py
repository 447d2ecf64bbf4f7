"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in two halves; each half has a codebook of its own, and the pairs of codewords form a grid of
cells. Every vector lies in the cell of its nearest codewords and visits, as a query, the cells nearest to it in
multi-sequence order (by the sum of both distances): the t nearest, where t is the least number with which sample
queries reach the target recall against brute force over all rows, and at least 16. Visitors and residents of a cell are compared by
cosine in double precision. Both codebooks are fitted on a bounded sample; every vector is indexed.

Equal vectors collapse first and count by their number. Cells are cut into blocks of about 512 visitors and residents,
so a crowded cell is a grid of tasks; a task gives sums of links and a spanning forest of them, never the pairs. A pair
that visits both ways is counted once for each side: a task counts for its visitor, and for the resident only if the
resident does not visit back.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, or whose label or id is null,
link with nothing and are components of their own (null for a null id); vectors of different lengths never link; rows
that repeat an id with other values are one node; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadweave.llm.components import components
from leadweave.llm.neardup import forest_of
from leadweave.session import cut

COSINE, RECALL = 0.98, 0.999
SAMPLE, QUERIES, PER_CELL, WORDS, BLOCK = 20_000, 400, 32, 256, 512
LEAST_VISITS = 16


def distances(half: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each codeword, with the same rounding whatever rows stand together."""
    out = np.empty((len(half), len(book)))
    for k, word in enumerate(book):
        out[:, k] = ((half - word) ** 2).sum(axis=1)
    return out


def codebook(rows: np.ndarray, k: int, seed: int = 5, rounds: int = 12) -> np.ndarray:
    """k-means centres of bounded sample rows."""
    random = np.random.default_rng(seed)
    book = rows[random.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        near = (rows @ book.T - 0.5 * (book**2).sum(axis=1)).argmax(axis=1)
        for i in range(len(book)):
            if (near == i).any():
                book[i] = rows[near == i].mean(axis=0)
    return book


@dataclass
class Index:
    books: tuple[np.ndarray, np.ndarray]
    visits: int

    def halves(self, unit: np.ndarray):
        at = self.books[0].shape[1]
        return distances(unit[:, :at], self.books[0]), distances(unit[:, at:], self.books[1])

    def cells(self, unit: np.ndarray, visits: int):
        """(home cell, cost of the last visited cell, visited cells) of each unit vector; a cell is i * K2 + j."""
        d1, d2 = self.halves(unit)
        o1, o2 = np.argsort(d1, axis=1, kind="stable"), np.argsort(d2, axis=1, kind="stable")
        k1, k2 = d1.shape[1], d2.shape[1]
        # among the t cheapest pairs, the one of ranks (a, b) has (a + 1) * (b + 1) - 1 pairs before it
        ranks = [(a, b) for a in range(k1) for b in range(k2) if (a + 1) * (b + 1) <= visits]
        a, b = (np.array(x) for x in zip(*ranks))
        rows = np.arange(len(unit))[:, None]
        i, j = o1[:, a], o2[:, b]
        cost = d1[rows, i] + d2[rows, j]
        order = np.argsort(cost, axis=1, kind="stable")[:, :visits]
        cell = np.take_along_axis(i * k2 + j, order, axis=1)
        return o1[:, 0] * k2 + o2[:, 0], np.take_along_axis(cost, order, axis=1)[:, -1], cell

    def cost(self, unit: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Cost of one given cell for each row, rounded as in `halves`."""
        at, k2 = self.books[0].shape[1], len(self.books[1])
        return ((unit[:, :at] - self.books[0][cell // k2]) ** 2).sum(axis=1) + ((unit[:, at:] - self.books[1][cell % k2]) ** 2).sum(axis=1)


def _units(column: pa.Array, dim: int) -> np.ndarray:
    rows = np.asarray(column.flatten()).astype(np.float64).reshape(-1, dim)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def _vectors(table: DataFrame) -> DataFrame:
    values = F.col("v")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0)
    return table.select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v")).withColumn(
        "ok", F.coalesce(sound & F.col("label").isNotNull() & F.col("id").isNotNull(), F.lit(False)))


def _fit(nodes: DataFrame, dim: int, number: int, labels: int, cosine: float, recall: float) -> Index:
    spark = nodes.sparkSession
    sample = nodes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    unit = _units(sample["v"].combine_chunks(), dim)
    k = int(min(WORDS, max(2, (number / (PER_CELL * max(labels, 1))) ** 0.5)))
    at = max(1, dim // 2)
    index = Index((codebook(unit[:, :at], k), codebook(unit[:, at:], k) if dim > 1 else np.zeros((1, 0))), 1)
    cells = len(index.books[0]) * len(index.books[1])
    # rank of the partner's cell for each pair of sample queries with any row, by brute force
    queries = nodes.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(QUERIES).select("id", "label", "v").toArrow()
    asked = (np.asarray(queries["id"]), np.asarray(queries["label"].to_pylist()), _units(queries["v"].combine_chunks(), dim))
    shared = spark.sparkContext.broadcast((index, asked))

    def ranks(batches):
        index, (ids, labels, unit) = shared.value
        d1, d2 = index.halves(unit)
        cost = (d1[:, :, None] + d2[:, None, :]).reshape(len(unit), -1)
        for batch in batches:
            rows = _units(batch.column(2), dim)
            same = (labels[:, None] == np.asarray(batch.column(1).to_pylist())[None, :]) & (ids[:, None] != np.asarray(batch.column(0))[None, :])
            q, x = np.nonzero(same & (unit @ rows.T >= cosine))
            home = index.cells(rows, 1)[0] if len(x) else np.zeros(len(rows), int)
            rank = (cost[q] < cost[q, home[x]][:, None]).sum(axis=1) + 1
            yield pa.RecordBatch.from_arrays([pa.array(rank.astype(np.int64))], ["rank"])

    found = nodes.select("id", "label", "v").mapInArrow(ranks, "rank long").groupBy("rank").count().toArrow().sort_by("rank")  # at most one row a cell
    reached = np.cumsum(np.asarray(found["count"])) if found.num_rows else np.zeros(0)
    needed = np.asarray(found["rank"])[np.searchsorted(reached, recall * reached[-1])] if len(reached) else 1
    index.visits = int(min(cells, max(needed, LEAST_VISITS)))
    return index


def _tasks(nodes: DataFrame, index: Index, dim: int, block: int) -> DataFrame:
    """Rows of the comparison tasks: residents (side 0) and visitors (side 1) of a block pair of a cell."""
    shared = nodes.sparkSession.sparkContext.broadcast(index)

    def place(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                home, reach, cell = shared.value.cells(_units(part.column(3), dim), shared.value.visits)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, cell.size + 1, cell.shape[1], dtype=np.int32)), pa.array(cell.reshape(-1).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home.astype(np.int64)), pa.array(reach), lists], [*part.schema.names, "home", "reach", "visit"])

    base = nodes.select("id", "label", "m", "v")
    placed = cut(base.mapInArrow(place, "id long, label string, m long, v array<double>, home long, reach double, visit array<long>"), "placed")
    common = ["id", "label", "m", "v", "home", "reach"]
    residents = placed.select(*common, F.col("home").alias("cell"), F.lit(0).alias("side"))
    visitors = placed.select(*common, F.explode("visit").alias("cell"), F.lit(1).alias("side"))
    blocks = lambda rows, name: rows.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))
    sizes = blocks(residents, "rb").join(blocks(visitors, "vb"), ["label", "cell"])
    rows = residents.unionByName(visitors).join(sizes, ["label", "cell"])
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    is_resident = F.col("side") == 0
    rows = rows.withColumn("x", F.explode(F.when(is_resident, F.array(own("rb"))).otherwise(every("rb"))))
    rows = rows.withColumn("y", F.explode(F.when(is_resident, every("vb")).otherwise(F.array(own("vb")))))
    return rows.drop("rb", "vb")


def links(nodes: DataFrame, index: Index, dim: int, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(id, other, n): n linked vectors of `id` found in a task (other null), or an edge of its forest (other set)."""
    shared = nodes.sparkSession.sparkContext.broadcast(index)

    def compare(table: pa.Table) -> pa.Table:
        side = np.asarray(table["side"])
        unit = _units(table["v"].combine_chunks(), dim)
        ids, m, home, reach = (np.asarray(table[c]) for c in ("id", "m", "home", "reach"))
        res, vis = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(res) or not len(vis):
            return pa.table({"id": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        linked = (unit[vis] @ unit[res].T >= cosine) & (ids[vis][:, None] != ids[res][None, :])
        q, x = np.nonzero(linked)
        lone = shared.value.cost(unit[res[x]], home[vis[q]]) > reach[res[x]]  # the resident does not visit back
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, vis[q], m[res[x]])
        np.add.at(n, res[x][lone], m[vis[q]][lone])
        edges = forest_of(linked)
        some = np.flatnonzero(n)
        return pa.table({"id": np.concatenate([ids[some], [ids[vis[a]] for a, _ in edges]]).astype(np.int64),
                         "other": pa.array([None] * len(some) + [int(ids[res[b]]) for _, b in edges], pa.int64()),
                         "n": np.concatenate([n[some], np.zeros(len(edges), np.int64)])})

    tasks = _tasks(nodes, index, dim, block)
    return tasks.groupBy("label", "cell", "x", "y").applyInArrow(compare, "id long, other long, n long")


def near_vectors(table: DataFrame, cosine: float = COSINE, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = _vectors(table)
    same = cut(rows.filter("ok").groupBy("label", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("m")), "vectors")
    sums, edges = None, None
    for r in same.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("label").alias("labels")).collect():
        nodes = same.filter(F.size("v") == r["dim"])  # vector lengths are few; most tables have one
        index = _fit(nodes, r["dim"], r["n"], r["labels"], cosine, recall)
        found = cut(links(nodes, index, r["dim"], cosine, block), "vector-links")
        n, e = found.filter("other IS NULL").groupBy("id").agg(F.sum("n").alias("n")), found.filter("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))
        sums, edges = (n, e) if sums is None else (sums.unionByName(n), edges.unionByName(e))
    base = rows.select("id", "label", "v", "ok")
    single = base.filter("NOT ok").select(F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    if sums is None:
        return single.withColumn("kept", F.lit(True))
    nodes = same.join(sums.groupBy("id").agg(F.sum("n").alias("n")), "id", "left").join(components(edges), "id", "left")
    nodes = nodes.select("label", "v", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    found = base.filter("ok").join(nodes, ["label", "v"]).select(F.col("id").alias("vec_id"), "n_links", "component_id")
    return found.unionByName(single).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
