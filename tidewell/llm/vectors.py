"""Near-duplicate embeddings by product quantisation: inverted lists, residual codes, exact cosine at the end."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import components, small_sample, union
from tidewell.session import stage

THRESHOLD = 0.98
#: The quantiser is fitted on a sample of a length's vectors, so many per list but no fewer than SAMPLE; every vector is indexed.
SAMPLE, PER_LIST = 8192, 16
#: Lists grow with the square root of the number of vectors; LISTS bounds the sample and the tables in a worker.
SUBSPACES, CODES, LISTS = 8, 64, 4096
#: Members of one list part at most; larger lists are cut by hash and their queries visit all parts.
PART = 8192


def _means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spaced rows; an empty cell keeps its centre."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])


class Quantiser:
    """Coarse lists and residual subspace codes for unit vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float) -> None:
        x = sample / np.linalg.norm(sample, axis=1)[:, None]
        self.radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        self.lists = _means(x, max(1, min(lists, len(x))))
        rest = x - self.lists[_nearest(x, self.lists)]
        self.parts = np.array_split(np.arange(x.shape[1]), min(SUBSPACES, x.shape[1]))
        self.books = [_means(rest[:, p], min(CODES, len(x))) for p in self.parts]

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Home list, codes, error of the codes, and which lists to probe."""
        far = _squares(unit, self.lists)
        home = far.argmin(1)
        rest = unit - self.lists[home]
        codes = np.stack([_nearest(rest[:, p], b) for p, b in zip(self.parts, self.books)], 1).astype(np.uint8)
        guess = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], 1)
        error = np.linalg.norm(rest - guess, axis=1)
        # A vector whose home is list L is at least as near to L as to this one's home H. With |a - b| <= radius,
        # |a - L|^2 - |a - H|^2 <= 2 * radius * |L - H| follows, so no link lies in a list that is not probed.
        gaps = np.sqrt(_squares(self.lists[home], self.lists))
        probes = far - far.min(1)[:, None] <= 2 * gaps * self.radius + 1e-9
        probes[np.arange(len(unit)), home] = True
        return home, codes, error, probes

    def candidates(self, queries: np.ndarray, at: int, codes: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose table distance, less the member's code error, is within the radius: none is lost."""
        rest = queries - self.lists[at]
        total = np.zeros((len(queries), len(codes)))
        for i, (p, book) in enumerate(zip(self.parts, self.books)):
            total += _squares(rest[:, p], book)[:, codes[:, i]]
        return np.nonzero(np.sqrt(total) <= self.radius + error + 1e-6)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _link(visits: DataFrame, quantiser: Quantiser, threshold: float) -> DataFrame:
    """Per visit the links found (cid, n), and edges (cid, other) that span them."""
    names = ["cid", "n", "other"]

    def out(cid: list, n: list, other: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (cid, n, other)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, None
        for batch in batches:
            spread = batch.column("spread").to_numpy()
            edges = np.flatnonzero(np.diff(spread)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(spread)]):
                part = batch.slice(lo, hi - lo)
                vectors, ids = _matrix(part.column("v")), part.column("cid").to_numpy()
                unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
                copies, at = part.column("copies").to_numpy(), int(part.column("list")[0].as_py())
                own = part.column("member").to_numpy(zero_copy_only=False)
                if spread[lo] != key:
                    key, members = spread[lo], None
                if own.any():  # members come first in their group
                    _, codes, error, _ = quantiser.encode(unit[own])
                    new = (ids[own], unit[own], copies[own], codes, error)
                    members = new if members is None else tuple(np.concatenate(x) for x in zip(members, new))
                asks = np.flatnonzero(~own)
                if members is None or not len(asks):
                    continue
                m_ids, m_unit, m_copies, m_codes, m_error = members
                ends = np.unique(np.concatenate((ids[asks], m_ids)))
                label, found = np.arange(len(ends)), np.zeros(len(asks), np.int64)
                for b in range(0, len(asks), 256):
                    q = asks[b : b + 256]
                    i, j = quantiser.candidates(unit[q], at, m_codes, m_error)
                    for c in range(0, len(i), 1 << 16):  # exact cosine of the candidates, in bounded pieces
                        x, y = i[c : c + (1 << 16)], j[c : c + (1 << 16)]
                        close = (np.einsum("ij,ij->i", unit[q[x]], m_unit[y]) >= threshold) & (ids[q[x]] != m_ids[y])
                        x, y = x[close], y[close]
                        np.add.at(found, b + x, m_copies[y])
                        union(label, np.searchsorted(ends, ids[q[x]]), np.searchsorted(ends, m_ids[y]))
                hit = np.flatnonzero(found)
                child = np.flatnonzero(label != np.arange(len(ends)))
                if len(hit):
                    yield out(ids[asks[hit]].tolist(), found[hit].tolist(), [None] * len(hit))
                    yield out(ends[child].tolist(), [0] * len(child), ends[label[child]].tolist())

    ordered = visits.repartition("spread").sortWithinPartitions("spread", F.desc("member"))
    return ordered.mapInArrow(run, "cid long, n long, other long")


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Two vectors link where their labels are equal and not null, their lengths agree and their cosine
    is at least ``threshold``. Null or zero vectors, and those with null or non-finite components,
    link with nothing and stay alone. Equal vectors of a label are one class, linked among
    themselves. ``n_links`` counts rows, ``component_id`` is the smallest vec_id reachable, and
    ``kept`` marks the row that has it. Probing reaches as far as a link can, so all links are found, and
    no link is reported whose exact cosine is below the threshold. Rows that repeat a vec_id count
    each; an empty table gives no rows; columns other than these three are not read.
    """
    rows = vectors.select(
        vectors[id_col].cast("long").alias("vec_id"),
        vectors[vector_col].cast("array<float>").alias("v"),
        vectors[label_col].cast("string").alias("label"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("v").isNotNull() & finite, F.lit(False))
    classes = rows.where(usable).groupBy("label", "v").agg(F.min("vec_id").alias("smallest"), F.count("*").alias("copies"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")

    spark, found = vectors.sparkSession, None
    dims = [r["dim"] for r in classes.groupBy(F.size("v").alias("dim")).count().collect()]
    for dim in sorted(dims):
        same = classes.where(F.size("v") == dim)
        lists = min(LISTS, int(np.sqrt(same.count()) / 4))
        fit = small_sample(same, F.xxhash64("label", "v"), max(SAMPLE, PER_LIST * lists))
        quantiser = Quantiser(np.array([r.v for r in fit.collect()], np.float64), lists, threshold)

        def assign(batches: Iterable[pa.RecordBatch], quantiser=quantiser) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 2048):
                    part = batch.slice(at, 2048)
                    x = _matrix(part.column("v"))
                    home, _, _, probes = quantiser.encode(x / np.linalg.norm(x, axis=1)[:, None])
                    lists = [np.flatnonzero(p) for p in probes]
                    extra = [pa.array(home.astype(np.int32)), pa.array(lists, pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays([*part.columns, *extra], [*part.schema.names, "home", "probes"])

        indexed = same.select("cid", "label", "v", "copies").mapInArrow(
            assign, "cid long, label string, v array<float>, copies long, home int, probes array<int>"
        )
        indexed = stage(indexed, "vector-lists")
        parts = indexed.groupBy("label", F.col("home").alias("list")).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        one = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
        asking = indexed.select("cid", "label", "v", "copies", F.explode("probes").alias("list")).join(parts, ["label", "list"])
        asking = asking.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("member", F.lit(False))
        members = indexed.withColumnRenamed("home", "list").join(parts, ["label", "list"]).withColumn("part", one).withColumn("member", F.lit(True))
        cells = [F.xxhash64("label", "list", "part").alias("spread"), "cid", "v", "copies", "list", "member"]
        linked = _link(members.select(*cells).unionByName(asking.select(*cells)), quantiser, threshold)
        found = linked if found is None else found.unionByName(linked)
    if found is None:
        found = spark.createDataFrame([], "cid long, n long, other long")
    found = stage(found, "vector-links")

    near = found.groupBy("cid").agg(F.sum("n").alias("near"))
    member = components(found.where("other is not null").select(F.col("cid").alias("a"), F.col("other").alias("b")), "vector-edges")
    owner = classes.join(member, classes.cid == member.node, "left").select("cid", "label", "v", "smallest", "copies", F.coalesce("component", "cid").alias("component"))
    lowest = owner.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = owner.join(lowest, "component").join(near, "cid", "left").select(
        "label", "v", "component_id", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links")
    )
    linked = rows.where(usable).join(named, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
