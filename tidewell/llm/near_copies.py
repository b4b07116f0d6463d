"""Near copies: all pairs of texts whose sets of word shingles have a Jaccard similarity of 0.8 or more, joined to components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import simhash
from tidewell.llm.common import components, per_slice
from tidewell.session import stage, staged

WORDS = 5
#: Documents in the sample that tells common shingles; those in so many of them, and so many of those at most, come last.
SAMPLE_DOCS, COMMON_IN, COMMON = 10_000, 4, 50_000
#: Shingles are counted in so many buckets by their last bits, and only whether a count is odd is kept. Where two sets
#: differ in a bucket, one of them holds a shingle there that the other lacks. Sets of more shingles than buckets get
#: a second, longer row of at least as many buckets as shingles.
BUCKETS = 1024
#: A prefix shingle of a node: its place in the node's order and the number of shingles the node has.
POSTING = ["shingle", "place", "node", "size"]


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct 64-bit shingle hashes of a text in ascending order; the whole text is one where it is shorter."""
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # as in simhash.fingerprint
    if not parts:
        return np.zeros(0, np.uint64)
    words = min(words, len(parts))
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    n, total = len(parts) - words + 1, np.uint64(words)
    total = np.full(n, total)
    for i in range(words):
        total = (total ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return np.unique(total)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets have a Jaccard similarity of 0.8 or more, without rounding."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 9 * shared >= 4 * (len(a) + len(b))


def prefix(of: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles in the order that all texts share: any two similar sets have one of them in common.

    Similar sets share at least 0.8 of either. If the first a - ceil(0.8 a) + 1 of both had nothing
    in common, too few would be left. Common shingles are last in the order, which keeps groups small.
    """
    last = np.isin(of, common)
    return np.concatenate((of[~last], of[last]))[: len(of) - (4 * len(of) + 4) // 5 + (len(of) > 0)]


def bucket_counts(of: np.ndarray, buckets: int = BUCKETS) -> bytes:
    """Whether the number of shingles of a set in each bucket, a power of two of them, is odd: a bit each."""
    return np.packbits(np.bincount((of & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets) % 2 == 1).tobytes()


def long_counts(of: np.ndarray) -> bytes | None:
    """Bucket counts of a large set in at least as many buckets as it has shingles; None where ``BUCKETS`` are enough."""
    return bucket_counts(of, 1 << (len(of) - 1).bit_length()) if len(of) > BUCKETS else None


def may_be_similar(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets with these bucket counts (rows) and sums of sizes can be similar: no similar pair is refused.

    Similar sets hold at most a ninth of the sum of their sizes in only one of them.
    """
    return 9 * np.bitwise_count(a ^ b).sum(1, dtype=np.int64) <= sizes


def may_be_similar_long(a: bytes, b: bytes, sizes: int) -> bool:
    """The same for long bucket counts of two sets; the longer ones are folded to the length of the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, n), 0) for v in (x, y))
    return bool(may_be_similar(x[None], y[None], np.array([sizes]))[0])


def _common(docs: DataFrame, words: int) -> np.ndarray:
    """Shingles that many texts of a sample hold. They only set the order; no result depends on them."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    some = docs.where(F.pmod("hash", F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["hash"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t, words) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64))], ["shingle"])

    counted = some.select("text").mapInArrow(per_slice(run), "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    most = counted.where(F.col("n") >= COMMON_IN).orderBy(F.desc("n"), "shingle").limit(COMMON)
    # Written first: a collected limit would bring as many rows of every partition to the driver.
    found = stage(most.select("shingle"), "copies-common").collect()
    return np.array([r["shingle"] for r in found], np.int64).view(np.uint64)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, hash, fp (the SimHash), node (a hash of the shingle set), its size, prefix and both bucket counts, of every row."""
    common = _common(docs, words)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        import xxhash

        found = [shingles(t, words) for t in batch.column("text").to_pylist()]
        first = [prefix(s, common) for s in found]
        node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in found], np.uint64).view(np.int64)
        ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*first, np.zeros(0, np.uint64)]).view(np.int64)))
        size = pa.array(np.fromiter(map(len, found), np.int32, len(found)))
        counts, long = (pa.array(list(map(f, found)), pa.binary()) for f in (bucket_counts, long_counts))
        fp = np.array([simhash.fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        columns = [batch.column("doc_id"), batch.column("hash"), pa.array(fp), pa.array(node), size, lists, counts, long]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "fp", "node", "size", "prefix", "counts", "long"])

    return docs.mapInArrow(per_slice(run), "doc_id long, hash long, fp long, node long, size int, prefix array<long>, counts binary, long binary")


def by_fingerprint(sets: DataFrame, radius: int = simhash.RADIUS) -> DataFrame:
    """Pairs (a, b) of nodes that span all SimHash links: nodes of one fingerprint, and owners of fingerprints within the radius."""
    seen = sets.select("node", "fp").distinct()
    owners = stage(seen.groupBy("fp").agg(F.min("node").alias("owner")), "copies-fingerprints")
    same = seen.join(owners, "fp").select(F.least("node", "owner").alias("a"), F.greatest("node", "owner").alias("b"))
    edges = simhash.links(owners.select("fp"), radius)
    for end in ("a", "b"):
        edges = edges.join(owners.select(F.col("fp").alias(end), F.col("owner").alias(f"of_{end}")), end)
    linked = edges.select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b"))
    return same.unionByName(linked).where("a <> b").distinct()


def _values(column: pa.Array) -> np.ndarray:
    """A column as an array; bucket counts with a row for each value."""
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BUCKETS // 8)
    return column.to_numpy()


def _by_shingle(rows: DataFrame, names: list[str], f: Callable[[dict[str, np.ndarray]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``f`` to whole groups of equal shingles, several at a time, sorted by shingle, place and node; groups of one are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(r: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
            same = r["shingle"][1:] == r["shingle"][:-1]
            if (many := np.append(same, False) | np.append(False, same)).any():
                yield from f({c: x[many] for c, x in r.items()})

        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            rows = {c: _values(batch.column(c)) for c in names}
            if not batch.num_rows:
                continue
            if rows["shingle"][-1] == (held[0]["shingle"][-1] if held else rows["shingle"][0]):
                held.append(rows)  # one group goes on
                continue
            whole = {c: np.concatenate([h[c] for h in (*held, rows)]) for c in names}
            cut = int(np.searchsorted(whole["shingle"], whole["shingle"][-1]))
            yield from out({c: x[:cut] for c, x in whole.items()})
            held = [{c: x[cut:] for c, x in whole.items()}]
        if held:
            yield from out({c: np.concatenate([h[c] for h in held]) for c in names})

    return rows.select(*names).repartition("shingle").sortWithinPartitions("shingle", "place", "node").mapInArrow(run, schema)


def _possible(r: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether two rows of a group can be similar if this is the first shingle in the order that both have.

    Then they share at most what either has from here on. A similar pair passes in the group of its first one.
    """
    a, b = r["size"][i], r["size"][j]
    return 9 * np.minimum(a - r["place"][i], b - r["place"][j]) >= 4 * (a + b)


def _pivots(r: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Each row's pivot: the first of its group, that with the fewest rarer shingles; the row itself if they cannot be similar."""
    at = np.arange(len(r["size"]))
    first = np.maximum.accumulate(np.where(np.append(True, r["shingle"][1:] != r["shingle"][:-1]), at, 0))
    pivot = np.where(_possible(r, at, first), first, at)
    yield pa.RecordBatch.from_arrays([pa.array(r[c]) for c in POSTING] + [pa.array(r["node"][pivot])], [*POSTING, "pivot"])


def _apart(r: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """All pairs of a group that are not joined yet, were not compared, and can be similar by place and bucket counts."""
    ends = np.flatnonzero(np.append(r["shingle"][1:] != r["shingle"][:-1], True)) + 1
    lefts, rights, held = [], [], 0
    for start, end in zip([0, *ends[:-1]], ends):
        label = r["label"][start:end]
        if (label == label[0]).all():
            continue
        for i in range(start, end - 1):
            j = np.arange(i + 1, end)
            j = j[(r["label"][j] != r["label"][i]) & (r["pivot"][j] != r["node"][i]) & _possible(r, np.full(len(j), i), j)]
            if len(j):
                j = j[may_be_similar(r["counts"][i : i + 1], r["counts"][j], r["size"][i].astype(np.int64) + r["size"][j])]
            if len(j):
                lefts.append(np.full(len(j), r["node"][i])), rights.append(r["node"][j])
                held += len(j)
            if held > 1 << 16:
                yield _pairs(lefts, rights)
                lefts, rights, held = [], [], 0
    if held:
        yield _pairs(lefts, rights)


def _pairs(lefts: list[np.ndarray], rights: list[np.ndarray]) -> pa.RecordBatch:
    both = np.unique(np.stack((np.concatenate(lefts), np.concatenate(rights)), 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(*both.T)), pa.array(np.maximum(*both.T))], ["a", "b"])


def _plausible(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs (a, b) of different nodes that both bucket counts allow to be similar."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = batch.column("sizes").to_numpy()
                keep = may_be_similar(_values(batch.column("counts_a")), _values(batch.column("counts_b")), sizes)
                for i in np.flatnonzero(keep):
                    x, y = batch.column("long_a")[i].as_py(), batch.column("long_b")[i].as_py()
                    keep[i] = x is None or y is None or may_be_similar_long(x, y, int(sizes[i]))
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    def side(name: str) -> DataFrame:
        return about.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("size", "counts", "long")])

    asked = pairs.where("a <> b").distinct().join(side("a"), "a").join(side("b"), "b")
    asked = asked.select("a", "b", "counts_a", "counts_b", "long_a", "long_b", (F.col("size_a") + F.col("size_b")).alias("sizes"))
    return asked.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, about: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets are similar. Only texts of plausible pairs are moved."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        found: dict[int, np.ndarray] = {}
        near = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(a, b)):
            for node, text in ((x, "text"), (y, "other")):
                if node not in found:
                    found[node] = shingles(batch.column(text)[i].as_py(), words)
            near[i] = similar(found[x], found[y])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]).filter(pa.array(near))

    # Both written before texts come in: where few are asked for, Spark then knows it and moves them, not the texts.
    asked = stage(_plausible(pairs, about), "copies-plausible")
    ends = asked.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stage(about.select("node", "key", "hash").join(ends, "node", "left_semi"), "copies-wanted")
    texts = rows.select(_key(), "hash", "text").join(wanted, ["key", "hash"]).select("node", "text").dropDuplicates(["node"])
    with staged(texts, "copies-texts") as texts:
        both = asked.join(texts.withColumnRenamed("node", "a"), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("other")), "b")
        return stage(both.select("a", "b", "text", "other").mapInArrow(per_slice(run), "a long, b long"), "copies-near")


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key")


def near_copies(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, hash (of its text, ``xxhash64``) and component.

    Texts link where the Jaccard similarity of their distinct word shingles is 0.8 or more, and where
    their sets are equal; so do texts without words. The join is exact but for equal 64-bit hashes:
    SimHash links (``simhash.links``, over the same shingles) are found first and checked. Then each set is
    dealt out by its prefix, and texts that share a prefix shingle are compared: each with the one text that
    comes first in most of its groups, and all those of a group that are still in different components. Texts
    of a pair are read, and pairs within a group made, only where bucket counts allow them to be similar.
    """
    text = docs[text_col].cast("string")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    sets = stage(_sets(rows, words), "copies-sets")
    nodes = sets.groupBy("node").agg(F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    dealt = nodes.select("node", "size", F.posexplode("prefix").alias("place", "shingle"))
    with staged(_by_shingle(dealt, POSTING, _pivots, "shingle long, place int, node long, size int, pivot long"), "copies-groups") as groups:
        # One row stands for each node that has company; its text is what is compared.
        needed = sets.join(groups.select("node").distinct(), "node", "left_semi").groupBy("node")
        needed = needed.agg(F.min(F.struct(_key(), "hash")).alias("row"), *[F.first(c).alias(c) for c in ("size", "counts", "long")])
        with staged(needed.select("node", "size", "counts", "long", "row.key", "row.hash"), "copies-about") as about:
            met = groups.where("pivot <> node").groupBy("node", "pivot").agg(F.count("*").alias("n"))
            chosen = stage(met.groupBy("node").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("pivot")), "copies-chosen")
            first = chosen.select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b"))
            near = _confirmed(by_fingerprint(sets).unionByName(first), about, rows, words)
            label = stage(components(near, "copies-first"), "copies-label")
            label_of = F.coalesce("component", "node").alias("label")
            # Only groups that still hold two components go on, with the counts of their texts.
            tags = groups.select("shingle", "node").join(label, "node", "left").select("shingle", label_of)
            apart = tags.groupBy("shingle").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
            still = stage(groups.drop("pivot").join(apart.select("shingle"), "shingle", "left_semi"), "copies-open")
            of = about.select("node", "counts").join(chosen, "node", "left").join(label, "node", "left")
            of = of.select("node", "counts", F.coalesce("pivot", "node").alias("pivot"), label_of)
            open_pairs = _by_shingle(still.join(of, "node"), [*POSTING, "pivot", "label", "counts"], _apart, "a long, b long")
            more = _confirmed(open_pairs, about, rows, words)
    member = components(near.unionByName(more), "copies-edges")
    return sets.select("doc_id", "hash", "node").join(member, "node", "left").select("doc_id", "hash", F.coalesce("component", "node").alias("component"))
