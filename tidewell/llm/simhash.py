"""SimHash near-duplicates: an exact Hamming join by hierarchical indexes over Gray-ordered fingerprints."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import components, id_and_text, per_slice, union
from tidewell.session import stage

WORDS, RADIUS, SEED = 4, 4, 42
#: Members and children of an index node.
FANOUT = 16
#: Members of one index at most; larger key groups are dealt to several, which all their queries visit.
GROUP = 4096


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit SimHash of the shingles of a text, repeats included; 0 without words."""
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    first, last = starts[:n].tolist(), (ends[words - 1 :] if len(parts) >= words else ends[-1:]).tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        h = [digest(line[s:e], SEED) for s, e in zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)])]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(per_slice(run), "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A hierarchy over fingerprints in Gray order.

    Neighbours in Gray order share many bits. A node holds the bits that all fingerprints below it
    share and that no node above it holds (``mask``, ``bits``). On the way down a query adds up its
    differences from the shared bits; once they exceed the radius the whole group is left out. At the
    bottom only the bits that no node holds are still to be compared.
    """

    def __init__(self, codes: np.ndarray) -> None:
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        ones, zeros = self.codes, ~self.codes
        levels = []
        while True:
            first = np.arange(0, len(ones), FANOUT)
            ones, zeros = np.bitwise_and.reduceat(ones, first), np.bitwise_and.reduceat(zeros, first)
            levels.append((ones, zeros))
            if len(ones) <= FANOUT:
                break
        self.levels, above = [], np.zeros(1, np.uint64)
        for ones, zeros in reversed(levels):  # from the top
            whole = ones | zeros
            mask = whole & ~(above[np.arange(len(whole)) // FANOUT] if len(above) > 1 or self.levels else above[0])
            self.levels.append((mask, ones & mask))
            above = whole
        self.rest = ~above[np.arange(len(self.codes)) // FANOUT]

    def search(self, queries: np.ndarray, radius: int, block: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place of the query, place of the member) within the radius, block by block."""
        for at in range(0, len(queries), block):
            part = queries[at : at + block]
            mask, bits = self.levels[0]
            q = np.repeat(np.arange(len(part)), len(mask))
            node, far = np.tile(np.arange(len(mask)), len(part)), np.zeros(len(q), np.uint8)
            for depth, (mask, bits) in enumerate([*self.levels, (self.rest, self.codes & self.rest)]):
                if depth:
                    below = np.minimum(len(mask) - node * FANOUT, FANOUT)
                    ends = np.cumsum(below)
                    q, far = np.repeat(q, below), np.repeat(far, below)
                    node = np.repeat(node * FANOUT - (ends - below), below) + np.arange(len(q))
                far = far + np.bitwise_count((part[q] & mask[node]) ^ bits[node])
                near = far <= radius
                q, node, far = q[near], node[near], far[near]
            yield q + at, self.order[node]


def _joined(members: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all that links between queries and members join: a forest, no pair list."""
    codes = np.unique(np.concatenate((members, queries)))
    of_query, of_member, label = np.searchsorted(codes, queries), np.searchsorted(codes, members), np.arange(len(codes))
    for q, m in GrayIndex(members).search(queries, radius):
        union(label, of_query[q], of_member[m])
    child = np.flatnonzero(label != np.arange(len(codes)))
    return codes[child], codes[label[child]]


def dealing_masks(fingerprints: int, radius: int, group: int) -> list[int]:
    """Bit masks by whose masked values fingerprints are dealt out: any two within the radius agree under one.

    The 64 bits are cut into radius + m blocks. Two fingerprints within the radius differ in at most
    ``radius`` of them and agree in m others, so that the masks are all choices of m blocks. The least
    m is taken whose values split that many fingerprints into groups of ``group`` on average: 5 masks
    of 13 bits for few, 15 of 21 bits, then 35 of 27 and 70 of 32 as the table grows (radius 4).
    """
    for m in range(1, 65 - radius):
        cuts = [round(i * 64 / (radius + m)) for i in range(radius + m + 1)]
        blocks = [(1 << high) - (1 << low) for low, high in zip(cuts, cuts[1:])]
        masks = [sum(chosen) for chosen in combinations(blocks, m)]
        if m == 4 or fingerprints <= group << min(mask.bit_count() for mask in masks):
            return masks
    return [(1 << 64) - 1]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that span all links within the radius.

    Two fingerprints within the radius agree under one of the ``dealing_masks``, so that each is dealt
    out by its value under each mask and meets all its partners. A group larger than ``GROUP`` is
    dealt to several indexes by hash, and each of its queries goes to all of them.
    """
    keys = [
        F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(mask - (mask >> 63 << 64))).alias("value"))
        for i, mask in enumerate(dealing_masks(distinct.count(), radius, GROUP))
    ]
    dealt = distinct.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.block", "key.value")
    sizes = dealt.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / GROUP).cast("int")
    sized = dealt.join(sizes, ["block", "value"]).withColumn("parts", parts)
    home = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # A query meets the members of its own and of later parts, the others meet it: each pair once.
    visits = sized.withColumn("home", home).select(
        "fp", "block", "value", "home", F.explode(F.sequence(F.col("home"), F.col("parts") - 1)).alias("part")
    )
    spread = F.xxhash64("block", "value", "part")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(group: np.ndarray) -> Iterator[pa.RecordBatch]:
            members = group["fp"][group["home"] == group["part"]]
            if len(members) and len(group) > 1:
                a, b = _joined(members, group["fp"], radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        kind = np.dtype([("spread", "<i8"), ("fp", "<u8"), ("home", "<i4"), ("part", "<i4")])
        held = np.zeros(0, kind)
        for batch in batches:
            rows = np.zeros(batch.num_rows, kind)
            for c in ("spread", "home", "part"):
                rows[c] = batch.column(c).to_numpy()
            rows["fp"] = batch.column("fp").to_numpy().view(np.uint64)
            held = np.concatenate((held, rows))
            cut = np.flatnonzero(np.diff(held["spread"])) + 1
            for group in np.split(held, cut)[:-1]:
                yield from out(group)
            held = held[cut[-1] :] if len(cut) else held
        yield from out(held)

    ordered = visits.select(spread.alias("spread"), "fp", "home", "part").repartition("spread").sortWithinPartitions("spread")
    return ordered.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id.

    Documents link where their fingerprints differ in ``radius`` bits or fewer; ``component_id`` is
    the smallest doc_id reachable. A text without words, also null or empty, has fingerprint 0 and
    links like any other. Rows with equal fingerprints are one node. A null doc_id keeps its row; it
    is never a component_id unless all ids reachable are null. Texts of any length are read whole; an
    empty table gives no rows; other columns, whatever their names, are not read.
    """
    stored = stage(fingerprints(docs, words, id_col, text_col), "simhash")
    nodes = stage(stored.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "simhash-nodes")
    member = components(links(nodes.select("fp"), radius), "simhash-edges")
    owner = nodes.join(member, nodes.fp == member.node, "left").select("fp", "smallest", F.coalesce("component", "fp").alias("component"))
    lowest = owner.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = owner.join(lowest, "component").select("fp", "component_id")
    return stored.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
