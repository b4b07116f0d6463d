"""The pipeline's near-copy stage against brute force over all pairs of five-word shingle sets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidewell.llm import common, near_copies, simhash
from tidewell.session import stage

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def edited(base, r, n):
    words = list(base)
    for at in r.choice(len(words), n, replace=False):
        words[at] = f"x{r.integers(1 << 40)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def docs(spark):
    r = np.random.default_rng(3)
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  TWO"), (905, "one"), (None, "one two")]
    line = " ".join(f"l{i}" for i in range(12))
    for k in range(40):
        base = [f"w{k}x{i}" for i in range(int(r.integers(40, 200)))]
        rows.append((k * 20, " ".join(base)))
        rows += [(k * 20 + j, edited(base, r, 1 + j % 6)) for j in range(1, 8)]
        rows += [(k * 20 + 9, line + " " + " ".join(f"v{k}y{i}" for i in range(12)))]
    base = [f"h{i}" for i in range(150)]  # a large group of near copies, many of which are not near each other
    rows += [(2000 + j, edited(base, r, 1 + j % 5)) for j in range(150)]
    rows += [(rows[20][0], rows[30][1]), rows[25], rows[25], (None, rows[40][1])]  # an id with two texts, repeated rows
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(4).cache()


def components(rows):
    """Component of each row by comparing all pairs."""

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a == sets[j] or n and n / (len(a) + len(sets[j]) - n) >= 0.8:
                label[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(rows))]


def test_stage_keeps_one_of_each_component(spark, docs, monkeypatch):
    for common in (near_copies.COMMON_IN, 1 << 40):  # the order of the shingles changes no result
        monkeypatch.setattr(near_copies, "COMMON_IN", common)
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        groups = {}
        for row, c in zip(rows, components(rows)):
            groups.setdefault(c, []).append(row)
        got = [(r.doc_id, r.text) for r in pipeline.keep_one_of_each(spark, docs, "").collect()]
        assert len(got) == len(groups) and len(set(got)) == len(got)
        for group in groups.values():
            kept = [x for x in group if x in got]
            assert len(set(kept)) == 1
            ids = [i for i, _ in group if i is not None]
            assert kept[0][0] == (min(ids) if ids else None)
    assert pipeline.keep_one_of_each(spark, docs.where("false"), "").count() == 0


def test_prefixes_of_similar_sets_meet():
    r = np.random.default_rng(4)
    for n in (1, 2, 4, 5, 9, 50, 333):
        for _ in range(200):
            a = r.integers(0, 1 << 60, n).astype(np.uint64)
            b = np.unique(np.concatenate((a[int(r.integers(0, n // 8 + 1)) :], r.integers(0, 1 << 60, int(r.integers(0, n // 8 + 1))).astype(np.uint64))))
            a = np.unique(a)
            if near_copies.similar(a, b):
                common = a[::2]
                assert len(np.intersect1d(near_copies.prefix(a, common), near_copies.prefix(b, common)))


def test_bucket_counts_refuse_no_similar_pair():
    r = np.random.default_rng(5)
    refused = 0
    for n in (1, 3, 40, 400, 60_000):
        for _ in range(60 if n < 1000 else 4):
            a = np.unique(r.integers(0, 1 << 64, n, dtype=np.uint64))
            for part in (0, 0.05, 0.1, 0.9):
                b = a.copy()
                b[: int(part * len(a))] = r.integers(0, 1 << 64, int(part * len(a)), dtype=np.uint64)
                b = np.unique(b)
                x, y = (np.frombuffer(near_copies.bucket_counts(s), np.uint8)[None] for s in (a, b))
                may = bool(near_copies.may_be_similar(x, y, np.array([len(a) + len(b)]))[0])
                assert may or not near_copies.similar(a, b)
                refused += not may
    assert refused > 100


def test_simhash_links_are_found_and_named_by_nodes(spark, docs):
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    sets = near_copies._sets(rows, near_copies.WORDS).cache()
    held = sets.select("node", "fp").distinct().collect()
    label = {r.node: r.node for r in held}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    def join(a, b):
        label[max(top(a), top(b))] = min(top(a), top(b))

    for i, a in enumerate(held):
        for b in held[:i]:
            if ((a.fp ^ b.fp) & ((1 << 64) - 1)).bit_count() <= simhash.RADIUS:
                join(a.node, b.node)
    want = {n: top(n) for n in label}
    assert len(set(want.values())) < len(want)
    label = {n: n for n in label}
    for a, b in near_copies.by_fingerprint(sets).collect():
        assert want[a] == want[b]
        join(a, b)
    assert {n: top(n) for n in label} == want
    assert {r.fp & ((1 << 64) - 1) for r in held} == {simhash.fingerprint(r.text, near_copies.WORDS) for r in docs.collect()}


def test_pairs_refused_by_counts_are_not_made():
    r = np.random.default_rng(6)
    base = r.integers(0, 1 << 64, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[: int(r.integers(40, 100))], r.integers(0, 1 << 64, 30, dtype=np.uint64)))) for _ in range(60)]
    n = len(sets)
    rows = {"shingle": np.zeros(n, np.int64), "place": np.zeros(n, np.int32), "node": np.arange(n), "size": np.array([len(s) for s in sets], np.int32),
            "pivot": np.arange(n), "label": np.arange(n), "counts": np.stack([np.frombuffer(near_copies.bucket_counts(s), np.uint8) for s in sets])}
    got = {(a, b) for batch in near_copies._apart(rows) for a, b in zip(*[batch.column(c).to_pylist() for c in "ab"])}
    similar = {(i, j) for j in range(n) for i in range(j) if near_copies.similar(sets[i], sets[j])}
    assert similar <= got and len(got) < n * (n - 1) // 4


def test_large_sets_are_told_apart_by_long_counts():
    r = np.random.default_rng(7)
    for n in (1025, 2048, 9000, 40_000):
        a = np.unique(r.integers(0, 1 << 64, n, dtype=np.uint64))
        for m in (n, n * 9 // 10, n * 2):
            apart = np.unique(r.integers(0, 1 << 64, m, dtype=np.uint64))
            x, y = near_copies.long_counts(a), near_copies.long_counts(apart)
            assert x is None or y is None or not near_copies.may_be_similar_long(x, y, len(a) + len(apart))
        for part in (0, 0.05, 0.1):  # around the bound
            b = np.unique(np.concatenate((a[int(part * len(a)) :], r.integers(0, 1 << 64, int(part * len(a)), dtype=np.uint64))))
            assert near_copies.may_be_similar_long(near_copies.long_counts(a), near_copies.long_counts(b), len(a) + len(b)) or not near_copies.similar(a, b)
        b = a[: n - n // 8]  # of fewer shingles, perhaps with fewer buckets
        if near_copies.long_counts(b):
            assert near_copies.may_be_similar_long(near_copies.long_counts(a), near_copies.long_counts(b), len(a) + len(b))
    assert near_copies.long_counts(a[:1024]) is None


def test_only_plausible_pairs_are_confirmed(spark, monkeypatch):
    r = np.random.default_rng(8)
    phrase = " ".join(f"p{i}" for i in range(600))  # in all texts, which are not near each other
    rows = [(k, phrase + " " + " ".join(f"u{k}x{i}" for i in range(5000))) for k in range(12)]
    rows += [(100 + k, edited(rows[k][1].split(), r, 20)) for k in range(3)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    seen, staged = [], near_copies.staged

    def watched(df, purpose):
        seen.append(df.select("node").distinct().count()) if purpose == "copies-texts" else None
        return staged(df, purpose)

    monkeypatch.setattr(near_copies, "staged", watched)
    assert pipeline.keep_one_of_each(spark, docs, "").count() == 12
    assert seen and sum(seen) <= 6


def test_component_rounds_are_small_plans(spark, monkeypatch):
    """One join to a plan and nothing broadcast: the driver's memory does not grow with the partitions of a round."""
    plans = []

    def noted(df, purpose):
        copy = stage(df, purpose)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return copy

    monkeypatch.setattr(common, "stage", noted)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (201, 200), (300, 300)] + [(500, 500 + i) for i in range(1, 30)]
    found = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    want = {i: 0 for i in [*range(41), 100]} | {200: 200, 201: 200} | {500 + i: 500 for i in range(30)}
    assert found == want
    joined = [p for p in plans if "Join" in p]
    assert joined and all(p.count("Join") == 1 and "strategy=merge" in p for p in joined)


def test_common_shingles_are_chosen_on_executors(spark, docs, monkeypatch):
    """The driver collects the chosen shingles only, not the candidates of every partition."""
    written = {}

    def noted(df, purpose):
        written[purpose] = stage(df, purpose)
        return written[purpose]

    monkeypatch.setattr(near_copies, "stage", noted)
    monkeypatch.setattr(near_copies, "COMMON", 5)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    found = near_copies._common(rows, 5).view(np.int64).tolist()
    assert len(found) == 5 and [r["shingle"] for r in written["copies-common"].collect()] == found
