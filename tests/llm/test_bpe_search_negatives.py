"""The transducer, lexical search and hard negatives against the library, SQL and brute force, and on odd tables."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidewell.llm import lexical, negatives, queries, transducer
from workload.check import compare, oracle

RANKS = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, ids string, n string, score string, rank int"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=transducer.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return transducer.TextEncoder(transducer.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["the red fox", "the red fox", "The RED fox!", "fox fox fox", None, "", " .;\n", "café Été x", "a-b 10 red", "日本 red 🙂 fox's", "the " * 3000 + "red"]
    rows = [(i if i != 9 else None, t, "x", None, "y", 0) for i, t in enumerate(texts)] + [(1, "the red fox", "x", None, "y", 0), (1, "the blue fox", "x", None, "y", 0)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def encoded(encoder, texts):
    ids, counts = encoder.encode(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("letters", ["aeinorst", "ab ", " \n\t1", "é日x", "_-=.!", "the's 'll"])
def test_transducer_equals_the_library(encoder, library, letters):
    r = random.Random(letters)
    texts = ["".join(r.choices(letters, k=r.randint(0, 60))) for _ in range(1500)] + [letters[0] * n for n in range(200)]
    assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_forgetting_changes_nothing(library):
    small = transducer.TextEncoder(transducer.read_ranks(RANKS), public_tokenizers.PATTERN)
    small.transducer.limit = 50
    texts = [f"some wordy text {i} forgetfulness" for i in range(200)]
    assert encoded(small, texts) == [library.encode_ordinary(t) for t in texts]


def test_stream_writes_after_bounded_lookahead(encoder):
    piece = "".join(random.Random(5).choices("etaoinshr", k=3000)).encode()
    taken, out, behind = 0, [], []

    def chunks():
        nonlocal taken
        for at in range(0, len(piece), 7):
            taken = at + 7
            yield piece[at : at + 7]

    longest = max(map(len, encoder.transducer.ranks))
    for some in encoder.transducer.stream(chunks()):
        out += some
        behind.append(taken - sum(encoder.transducer.size[t] for t in out))
    assert out == encoder.transducer.encode(piece) and max(behind) <= longest
    assert list(encoder.transducer.stream([])) == []


def test_tokens_that_no_merge_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 257}
    lib = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    own = transducer.TextEncoder(ranks, r"\S+")
    texts = ["xyz", "xyzab", "ab xyz", "xy"]
    assert encoded(own, texts) == [lib.encode_ordinary(t) for t in texts]
    with pytest.raises(ValueError):
        transducer.Transducer({b"a": 0})


def test_streamed_decoding(encoder):
    words, g = transducer.Vocabulary(encoder.transducer.ranks), np.random.default_rng(3)
    for k in range(600):
        ids = g.integers(0, 300 if k % 2 else 50256, g.integers(1, 40)).astype(np.int32)
        decoder, out, at = transducer.StreamDecoder(words), "", 0
        while at < len(ids):
            step = int(g.integers(1, 6))
            out += decoder.feed(ids[at : at + step])
            at += step
        out += decoder.finish()
        data = b"".join(words.spelled[i] for i in ids)
        assert out == data.decode("utf-8", "replace")
        assert decoder.intact == (data.decode("utf-8", "ignore").encode() == data)
    with pytest.raises(ValueError):
        transducer.StreamDecoder(words).feed(np.array([60000]))


def test_encode_and_decode_tables(spark, docs, library):
    got = transducer.encode_texts(docs, RANKS, public_tokenizers.PATTERN)
    want = [(r.doc_id, tuple(library.encode_ordinary(r.text or ""))) for r in docs.collect()]
    assert sorted(((r.doc_id, tuple(r.ids)) for r in got.collect()), key=str) == sorted(want, key=str)
    back = transducer.decode_ids(got, RANKS, block=2).collect()
    assert sorted(((r.doc_id, r.text, r.intact) for r in back), key=str) == sorted(((r.doc_id, r.text or "", True) for r in docs.collect()), key=str)
    assert transducer.decode_ids(got.limit(0), RANKS).count() == 0 and transducer.encode_texts(docs.limit(0), RANKS, "x").count() == 0
    odd = spark.createDataFrame([(1, None), (2, [None, 64])], "doc_id long, ids array<int>")
    assert sorted(r.text for r in transducer.decode_ids(odd, RANKS).collect()) == ["", "a"]


def test_long_texts_go_in_runs(encoder, library, monkeypatch):
    monkeypatch.setattr(transducer, "RUN", 100)
    texts = ["word, " * 500 + " end", "", "x" * 5000, "short"]
    assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_op11(spark, sf_dir, library):
    got = {r.doc_id: r for r in queries.op11_transducer(spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for r in texts:
        ids, row = library.encode_ordinary(r.text or ""), got[r.doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def found_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def searched(docs, items, top=50):
    bags = [(i, found_terms(t)) for i, t in docs]
    bags = [(i, w) for i, w in bags if w]
    n_docs, total = len(bags), sum(len(w) for _, w in bags)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(found_terms(t))
    out = []
    for item, words in asked.items():
        scored = []
        for i, w in bags:
            m, score = 50 + (50 * len(w) * n_docs) // total, 0
            for t in words & set(w):
                df = sum(t in x for _, x in bags)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("top", [1, 3, 50])
def test_search(spark, docs, top):
    items = [(1, "red fox"), (2, "FOX's 10"), (2, "été"), (None, "blue"), (3, None), (4, "..."), (5, "unheard"), (6, "the the 日本")]
    table = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, score int")
    got = [tuple(r) for r in lexical.search(docs, table, top=top).collect()]
    assert sorted(got, key=str) == searched([(r.doc_id, r.text) for r in docs.collect()], items, top)


def test_search_in_blocks_and_pieces(spark, docs, monkeypatch):
    items = [(i, w) for i, w in enumerate(["red", "fox", "the blue", "10 a b", "x"])]
    table = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 4)
    monkeypatch.setattr(lexical, "PIECE", 3)
    assert [len(x) for x in lexical.terms("ab cdefgh, i")] == [2, 1]
    got = [tuple(r) for r in lexical.search(docs, table).collect()]
    assert sorted(got, key=str) == searched([(r.doc_id, r.text) for r in docs.collect()], items)


def test_search_scores_equal_texts_once(spark, monkeypatch):
    rows = [(i, "one two three" if i % 3 else f"one two four n{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, "two three four")], "item_id long, text string")
    assert sorted([tuple(r) for r in lexical.search(docs, items).collect()], key=str) == searched(rows, [(1, "two three four")])
    scorer = lexical.Scorer([[1]], np.array([0, 10]), 2)
    scorer.add(np.array([50, 50]), np.array([1, 1]), np.array([1, 1]), np.array([1, 1]), [[5, None], [4, 6]])
    assert [i for _, _, i in scorer.best[0]] == [4, 5]


def test_search_of_nothing(spark, docs):
    items = spark.createDataFrame([(1, "red")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


def mined(rows, positives=5, negatives_=5, floor=80):
    """Brute force over (vec_id, vector, label)."""
    use = [(k, i, [math.floor(256 * x) for x in v], l) for k, (i, v, l) in enumerate(rows) if l is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    use = [(k, i, v, (l + 1) % 10 if i is not None and i % 7 == 0 else l) for k, i, v, l in use]
    out = []
    for k, i, v, l in use:
        if i is None or i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m) for n, j, w, m in use if n != k and len(w) == len(v))
        for s, null, p, _ in [x for x in scored if x[3] == l][:positives]:
            hard = [x for x in scored if x[3] != l and floor * -s <= 100 * -x[0] <= 100 * -s][:negatives_]
            out += [(i, None if null else p, r, None if hn else h, -s, -hs) for r, (hs, hn, h, _) in enumerate(hard, 1)]
    return sorted(out, key=str)


def mine(df, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted((tuple(r) for r in negatives.mine(df, F.col("vec_id") % 100 == 0, label, **more).collect()), key=str)


VECTORS = "vec_id long, embedding array<float>, label int, score string, uid long"


@pytest.mark.parametrize("dim, near, block", [(3, 0.1, 4096), (10, 0.3, 2), (1, 0.5, 3), (24, 0.05, 4096)])
def test_mining(spark, monkeypatch, dim, near, block):
    monkeypatch.setattr(negatives, "FRAGMENT", 64)
    g = np.random.default_rng(dim)
    centres = g.normal(size=(4, dim))
    rows = [(i, (centres[g.integers(4)] + near * g.normal(size=dim)).round(2).tolist(), int(g.integers(4))) for i in range(500)]
    rows += [(100, rows[100][1], 1), (100, rows[7][1], 2), (None, rows[100][1], rows[100][2]), (None, rows[3][1], 0)]
    rows += [(600, None, 1), (700, [0.0] * dim, 1), (701, [0.0] * dim, 2), (702, [0.0] * dim, 1), (703, [float("nan")] * dim, 1), (704, [None] * dim, 1)]
    rows += [(705, [float("inf")] * dim, 1), (800, [1.0] * (dim + 1), 1), (801, [1.0] * (dim + 1), 1), (802, [1.0] * (dim + 1), 2), (706, [], 1), (900, [1.0] * dim, None)]
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    df = spark.createDataFrame([(i, v, l, "s", 0) for i, v, l in rows], VECTORS).repartition(3)
    assert mine(df, block=block) == mined(exact)


def test_a_scan_drops_rows_before_its_end():
    g = np.random.default_rng(1)
    columns = g.integers(-256, 256, (64, 2000)) // (1 + np.arange(64)[:, None])
    f = negatives.Fragment.__new__(negatives.Fragment)
    f.columns, f.low, f.high, f.ids = columns, columns.min(1), columns.max(1), np.arange(2000)
    looked = []

    def useful(lower, upper, live):
        looked.append(len(live))
        return upper >= np.sort(lower)[-5]

    live, score = f.scan(columns[:, 0], useful)
    want = columns[:, 0] @ columns
    assert np.array_equal(score, want[live]) and set(np.argsort(-want)[:5]) <= set(live)
    assert looked[-1] < 200 and looked == sorted(looked, reverse=True)


def test_mining_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert mine(empty) == []
    alone = spark.createDataFrame([(100, [1.0], 1, "", 0), (1, [1.0], 2, "", 0)], VECTORS)
    assert mine(alone) == []
    with pytest.raises(Exception, match="too large"):
        mine(spark.createDataFrame([(100, [1e30], 1, "", 0)], VECTORS))


@pytest.mark.parametrize("name", ["op12_lexical", "op13_negatives"])
def test_queries_match_duckdb(spark, sf_dir, name):
    run, sql = queries.QUERIES[name]
    assert compare(run(spark, sf_dir), oracle(sf_dir), sql) is None
