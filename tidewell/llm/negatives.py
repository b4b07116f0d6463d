"""Hard negatives by a vertical scan: vectors are stored by dimension, and each anchor reads its largest dimensions first."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.session import stage

POSITIVES, NEGATIVES = 5, 5
#: Rows of a fragment, dimensions read between two looks at the bounds, and anchors searched at a time.
FRAGMENT, STRIDE, ANCHORS = 2048, 8, 4096
#: Rows that a task packs, in fragments.
SPAN = 4 * FRAGMENT
#: A negative scores between FLOOR and 100 percent of the positive.
FLOOR = 80
FRAGMENTS = "label string, dim int, uid binary, ids binary, named binary, columns array<binary>, low binary, high binary"


def _longs(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, np.int64).tobytes()


def fragments(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """Rows (uid, vec_id, label, v) packed by label and dimension: one binary per dimension, with its least and greatest value.

    A label is cut into as many fragments as it needs; none holds more than ``FRAGMENT`` rows.
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def packed() -> pa.RecordBatch:
            v = np.array([r[3] for r in held], np.int64).T
            named = np.array([r[1] is not None for r in held])
            ids = np.array([r[1] or 0 for r in held], np.int64)
            cells = [key[0], key[1], _longs(np.array([r[0] for r in held])), _longs(ids), named.tobytes(), [_longs(c) for c in v], _longs(v.min(1)), _longs(v.max(1))]
            types = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.binary()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], NAMES)

        for batch in batches:
            for at in range(0, batch.num_rows, FRAGMENT):
                part = batch.slice(at, FRAGMENT)
                for row in zip(*(part.column(c).to_pylist() for c in ("uid", "vec_id", "label", "v"))):
                    if held and ((row[2], len(row[3])) != key or len(held) == FRAGMENT):
                        yield packed()
                    key = (row[2], len(row[3]))
                    held.append(row)
        if held:
            yield packed()

    # Neighbouring ranges may share a label: a large label is spread over tasks.
    tasks = 1 + rows.count() // span
    ordered = rows.repartitionByRange(tasks, "label", "dim", "uid").sortWithinPartitions("label", "dim", "uid")
    return ordered.select("uid", "vec_id", "label", "v").mapInArrow(pack, FRAGMENTS)


NAMES = [f.split()[0] for f in FRAGMENTS.split(", ")]


class Fragment:
    """The rows of one label and dimension, by column."""

    def __init__(self, row: dict) -> None:
        self.label, self.dim = row["label"], row["dim"]
        self.uid, self.ids = (np.frombuffer(row[c], np.int64) for c in ("uid", "ids"))
        self.named = np.frombuffer(row["named"], bool)
        self.columns = np.stack([np.frombuffer(c, np.int64) for c in row["columns"]]) if row["columns"] else np.zeros((0, len(self.ids)), np.int64)
        self.low, self.high = (np.frombuffer(row[c], np.int64) for c in ("low", "high"))

    def scan(self, anchor: np.ndarray, useful) -> tuple[np.ndarray, np.ndarray]:
        """Rows that ``useful(lower, upper)`` keeps to the end, and their exact scores.

        Dimensions are read in descending magnitude of the anchor. What is still unread adds between
        the sums of its least and greatest contributions, which bounds every candidate's score.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        q = anchor[order]
        a, b = q * self.low[order], q * self.high[order]
        least = np.append(np.cumsum(np.minimum(a, b)[::-1])[::-1], 0)
        most = np.append(np.cumsum(np.maximum(a, b)[::-1])[::-1], 0)
        every = np.arange(len(self.ids))
        live = np.flatnonzero(useful(np.full(len(every), least[0]), np.full(len(every), most[0]), every))
        score = np.zeros(len(live), np.int64)
        for at in range(0, len(q), STRIDE):
            if not len(live):
                break
            dims = order[at : at + STRIDE]
            read = self.columns[dims] if len(live) == len(self.ids) else self.columns[dims][:, live]
            score = score + q[at : at + STRIDE] @ read
            upto = min(at + STRIDE, len(q))
            keep = useful(score + least[upto], score + most[upto], live)
            live, score = live[keep], score[keep]
        return live, score


def _best(score: np.ndarray, ids: np.ndarray, named: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by descending score, then ascending id, null last."""
    return np.lexsort((ids, ~named, -score))[:k]


def _kth(values: np.ndarray, k: int) -> int | None:
    return None if len(values) < k else int(np.partition(values, len(values) - k)[len(values) - k])


class Top:
    """The first k rows of each key, over the fragments that a task sees."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, {}

    def least(self, key) -> int | None:
        """The score below which nothing counts any more."""
        held = self.rows.get(key, ())
        return held[-1][0] if len(held) == self.k else None

    def add(self, key, score: np.ndarray, fragment: Fragment, places: np.ndarray) -> None:
        ids, named = fragment.ids[places], fragment.named[places]
        some = _best(score, ids, named, self.k)
        new = [(int(score[i]), bool(named[i]), int(ids[i]), int(fragment.uid[places[i]])) for i in some]
        if new:
            self.rows[key] = sorted(self.rows.get(key, []) + new, key=lambda r: (-r[0], not r[1], r[2]))[: self.k]

    def table(self) -> pa.RecordBatch:
        flat = [(*key, s, i if named else None) for key, rows in self.rows.items() for s, named, i, _ in rows]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in flat], pa.int64()) for c in range(4)], ["anchor", "window", "score", "id"])


def _scan(packed: DataFrame, k: int, visit) -> DataFrame:
    """Apply ``visit(fragment, top)`` to all fragments; the first k rows of each key and task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Top(k)
        for batch in batches:
            for row in range(batch.num_rows):
                visit(Fragment(batch.slice(row, 1).to_pylist()[0]), top)
        yield top.table()

    found = packed.mapInArrow(run, "anchor long, window long, score long, id long")
    first = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _positives(packed: DataFrame, anchors: list, k: int) -> DataFrame:
    vectors = [(a.uid, a.label, np.array(a.v, np.int64)) for a in anchors]

    def visit(fragment: Fragment, top: Top) -> None:
        for uid, label, v in vectors:
            if label != fragment.label or len(v) != fragment.dim:
                continue

            def useful(lower, upper, live, uid=uid):
                others = fragment.uid[live] != uid
                bound, here = top.least((uid, 0)), _kth(lower[others], k)
                bounds = [b for b in (bound, here) if b is not None]
                return others & (upper >= max(bounds)) if bounds else others

            live, score = fragment.scan(v, useful)
            top.add((uid, 0), score, fragment, live)

    return _scan(packed, k, visit)


def _negatives(packed: DataFrame, anchors: list, windows: dict[int, list[int]], k: int, floor: int) -> DataFrame:
    """Per anchor and window (a positive's score) the first k rows of other labels in it."""
    vectors = [(a.uid, a.label, np.array(a.v, np.int64), [(p, -(-floor * p // 100)) for p in windows[a.uid] if p >= 0]) for a in anchors if a.uid in windows]

    def visit(fragment: Fragment, top: Top) -> None:
        for uid, label, v, spans in vectors:
            if label == fragment.label or len(v) != fragment.dim or not spans:
                continue

            def useful(lower, upper, live, uid=uid, spans=spans):
                wanted = np.zeros(len(lower), bool)
                for high, low in spans:
                    here = _kth(lower[(lower >= low) & (upper <= high)], k)  # these lie in the window for certain
                    least = max(b for b in (low, here, top.least((uid, high))) if b is not None)
                    wanted |= (upper >= least) & (lower <= high)
                return wanted

            live, score = fragment.scan(v, useful)
            for high, low in spans:
                inside = np.flatnonzero((score >= low) & (score <= high))
                top.add((uid, high), score[inside], fragment, live[inside])

    return _scan(packed, k, visit)


def mine(
    vectors: DataFrame, is_anchor, label, positives: int = POSITIVES, negatives: int = NEGATIVES, floor: int = FLOOR,
    scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", block: int = ANCHORS,
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` and ``label`` are columns over ``vectors``. Components become ``floor(scale * x)``;
    scores are integer inner products. An anchor's positives are its first other rows of its label by
    descending score, then ascending id (null last); for each, the first rows of other labels that score
    from ``floor`` to 100 percent of it. Rows with a null label, a null or empty vector, or a null or
    non-finite component take no part. Only vectors of one length are compared. Rows that repeat an
    id are rows of their own. Without anchors, positives or rows nothing is returned; columns that are not
    named stay behind. Components so large that a score exceeds 64 bits fail the job.

    Anchors are searched in blocks of ``block``, each against all fragments, so that what a task gets is bounded.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("v"),
        label.cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & (F.size("v") > 0)
    rows = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    limit = float(1 << 62)  # keeps each score, and each sum of bounds, within 64 bits
    whole = F.transform("v", lambda x: F.floor(x * scale))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1))
    fits = F.when(square * F.size("v") < limit, whole).otherwise(F.raise_error(F.lit("a vector is too large for whole scores of 64 bits")).cast("array<bigint>"))
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", fits.alias("v"), F.size("v").alias("dim"), "anchor")
    rows = stage(rows, "negatives-rows")
    packed = stage(fragments(rows), "negatives-fragments")

    asked = rows.where("anchor").select("uid", "vec_id", "label", "v", (F.pmod(F.xxhash64("uid"), F.lit(1 << 20))).alias("place"))
    blocks = -(-asked.count() // block)
    found = None
    for n in range(blocks):
        low, high = n * (1 << 20) // blocks, (n + 1) * (1 << 20) // blocks
        anchors = asked.where(F.col("place").between(low, high - 1)).collect()
        chosen = stage(_positives(packed, anchors, positives), "negatives-positives")
        windows: dict[int, set[int]] = {}
        for r in chosen.select("anchor", "score").distinct().collect():
            windows.setdefault(r.anchor, set()).add(r.score)
        hard = _negatives(packed, anchors, {a: sorted(w) for a, w in windows.items()}, negatives, floor)
        names = asked.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        pairs = chosen.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("window"))
        joined = hard.join(pairs, ["anchor", "window"]).join(names, "anchor")
        some = joined.select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("window").alias("positive_score"), F.col("score").alias("negative_score")
        )
        found = some if found is None else found.unionByName(some)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return found
