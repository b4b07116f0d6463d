"""Ranked lexical search: documents that no query can tell apart are scored once, as a class."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import id_and_text
from tidewell.session import stage

TOP = 50
#: Bytes of the items searched at a time; more items are searched in further blocks.
BLOCK_BYTES = 2 << 20
#: Bytes of terms (ASCII letters and digits, all of other characters), A-Z in lower case.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size: what is between other ASCII characters than letters and digits."""
    data = (text or "").encode().translate(TERM_BYTES)
    at = 0
    while at < len(data):
        cut = data.find(b" ", at + PIECE)
        cut = len(data) if cut < 0 else cut
        yield data[at:cut].split()
        at = cut


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, set[bytes]]]]:
    """Items with their sets of terms, in blocks of about ``BLOCK_BYTES`` of text; rows of one id are one item."""
    size = F.octet_length("text")
    total = items.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first().n
    blocks = 1 + int(total) // BLOCK_BYTES
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == block)
        found: dict[int | None, set[bytes]] = {}
        for row in mine.collect():
            words = found.setdefault(row.doc_id, set())
            for some in terms(row.text):
                words.update(some)
        yield [(i, w) for i, w in found.items() if w]


def _bags(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """Per document its number of terms and, of the terms in ``number``, the ascending numbers and their occurrences."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column("text"):
                total, counts = 0, {}
                for some in terms(text.as_py()):
                    total += len(some)
                    for i in filter(None, map(number.get, some)):
                        counts[i] = counts.get(i, 0) + 1
                mine = sorted(counts)
                n.append(total)
                ids.append(mine)
                tfs.append([counts[i] for i in mine])
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "ids", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<long>")


class Scorer:
    """Scores of classes for all items of a block, and the best documents of each item seen so far."""

    def __init__(self, of_item: list[list[int]], weights: np.ndarray, top: int) -> None:
        self.items, self.weights, self.top = len(of_item), weights, top
        pairs = sorted((t, i) for i, ts in enumerate(of_item) for t in ts)
        self.of_term = np.array([i for _, i in pairs], np.int64)
        self.starts = np.searchsorted([t for t, _ in pairs], np.arange(len(weights) + 1))
        self.best: list[list[tuple]] = [[] for _ in of_item]  # (-score, id is null, id)
        self.least = np.ones(len(of_item), np.int64)  # lower scores no longer count

    def add(self, m: np.ndarray, sizes: np.ndarray, ids: np.ndarray, tfs: np.ndarray, members: list[list[int | None]]) -> None:
        of = np.repeat(np.arange(len(m)), sizes)
        worth = self.weights[ids] * (1_000_000_000 * tfs // (1000 * tfs + 20 * m[of]))
        wide = self.starts[ids + 1] - self.starts[ids]
        ends = np.cumsum(wide)
        place = np.repeat(self.starts[ids] - (ends - wide), wide) + np.arange(ends[-1] if len(ends) else 0)
        scores = np.zeros((self.items, len(m)), np.int64)
        np.add.at(scores.reshape(-1), self.of_term[place] * len(m) + np.repeat(of, wide), np.repeat(worth, wide))
        for i in np.flatnonzero((scores >= self.least[:, None]).any(1)):
            row, best = scores[i], self.best[i]
            hits = np.flatnonzero(row >= self.least[i])
            if len(hits) > self.top:  # the lowest score that can still count, ties included
                hits = hits[row[hits] >= np.partition(row[hits], -self.top)[-self.top]]
            best += [(-int(row[c]), d is None, d or 0) for c in hits for d in members[c]]
            best.sort()
            del best[self.top :]
            if len(best) == self.top:
                self.least[i] = -best[-1][0]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, doc_id, score (above 0).

    Terms, weights and scores are integers as in the contract of the query; equal scores come by
    ascending doc_id, null last. Documents are reduced to the items' terms; those with equal term
    frequencies and equal length norm ``m`` are one class (grouped by hash, then by the values
    themselves), which is scored once and stands for its ``top`` smallest ids. Null and empty texts
    have no terms and are never found; they do not count as documents. Rows that repeat an id are
    documents of their own; items that share an id (null too) are one item with the terms of all. Items without
    terms and empty tables give no rows. Long texts are read in pieces; other columns stay behind.
    """
    rows = id_and_text(docs, id_col, text_col)
    asked = items.select(items[item_col].cast("long").alias("doc_id"), items[text_col].cast("string").alias("text"))
    found = None
    for block in _item_blocks(asked):
        if not block:
            continue
        ranked = _search_block(rows, block, top)
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


def _search_block(rows: DataFrame, block: list[tuple[int | None, set[bytes]]], top: int) -> DataFrame:
    words = sorted(set().union(*(w for _, w in block)))
    number = {w: i for i, w in enumerate(words, 1)}
    bags = stage(_bags(rows, number).where("n > 0"), "search-bags")
    totals = bags.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals.docs, int(totals.terms or 0)
    weights = np.zeros(len(words) + 1, np.int64)
    for t, df in bags.select(F.explode("ids").alias("t")).groupBy("t").count().collect():  # at most the block's terms
        weights[t] = weight(n_docs, df)

    # decimal keeps 50*n*N whole however large; div is exact on it.
    m = (F.lit(50) + F.expr(f"(50BD * n * {n_docs}BD) div {max(1, n_terms)}BD")).cast("long")
    same = [F.xxhash64("ids", "tfs", "m").alias("hash"), "ids", "tfs", "m", "doc_id"]
    keyed = bags.where(F.size("ids") > 0).withColumn("m", m).select(*same)
    by_class = Window.partitionBy("hash", "ids", "tfs", "m")
    first = F.row_number().over(by_class.orderBy(F.col("doc_id").asc_nulls_last()))
    few = keyed.withColumn("place", first).where(F.col("place") <= top)
    # collect_list drops nulls, so ids are wrapped; a class has at most ``top`` of them.
    classes = few.groupBy("hash", "ids", "tfs", "m").agg(F.collect_list(F.struct("doc_id")).alias("members"))

    of_item = [sorted(number[w] for w in ws) for _, ws in block]
    names = [i for i, _ in block]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(of_item, weights, top)
        step = max(1, (1 << 20) // max(1, len(of_item)))
        for batch in batches:
            for at in range(0, batch.num_rows, min(step, 1024)):
                part = batch.slice(at, min(step, 1024))
                ids, tfs = part.column("ids"), part.column("tfs")
                sizes = np.diff(ids.offsets.to_numpy())
                members = [[x["doc_id"] for x in row] for row in part.column("members").to_pylist()]
                scorer.add(part.column("m").to_numpy(), sizes, ids.flatten().to_numpy(), tfs.flatten().to_numpy(), members)
        out = [(names[i], None if null else d, -s) for i, best in enumerate(scorer.best) for s, null, d in best]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["item_id", "doc_id", "score"])

    scored = classes.select("m", "ids", "tfs", "members").mapInArrow(score, "item_id long, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
