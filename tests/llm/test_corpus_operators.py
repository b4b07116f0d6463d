"""Each operator against a brute-force version, and on nulls, empty texts, ties, repeated rows and empty tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewell.llm import contamination, language, mixing, queries, secrets, simhash, substrings, token_counts, token_store, vectors, warc
from tidewell.session import scratch_path
from workload.check import compare, oracle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


def passage(seed, n):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abcdeghilmnorstu"), r.integers(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    shared, long = passage(1, 40), passage(2, 6000)
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, passage(3, 60)), (6, passage(3, 60)), (6, passage(3, 60)),
        (7, passage(4, 30) + " " + shared + " " + passage(5, 30)), (8, shared + " " + passage(6, 25)), (None, passage(7, 50)),
        (9, long + " " + shared), (10, "a b " * 40), (11, passage(3, 60) + " end"), (12, "日本語 テキスト 🙂 é́  x"), (13, "1 2 3 !!"),
    ]
    data = [(i, t, "en" if k % 2 else None, [None, "s1", "s2"][k % 3], 0, "clash") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def texts_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_token_store(spark, docs, nothing):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    manifest, dictionary = token_store.write_token_store(docs, scratch_path(spark, "t"), path, shard_bytes=500)
    got = token_store.id_checksums(token_store.read_token_store(manifest, dictionary)).collect()
    want = [(i, plain.encode(t, add_special_tokens=False).ids + [0]) for i, t in texts_of(docs)]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(
        ((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want), key=str
    )
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == np.cumsum([0] + [r.n_tokens for r in order])[:-1].tolist()
    assert [-1 if r.doc_id is None else r.doc_id for r in order] == sorted(-1 if i is None else i for i, _ in want)
    assert token_store.read_document(manifest.collect(), dictionary, 4)[0].tolist() == dict(want)[4]
    empty, dictionary = token_store.write_token_store(nothing, scratch_path(spark, "t"), path)
    assert token_store.read_token_store(empty, dictionary).count() == 0


def test_encoder_equals_the_library():
    odd = ["", " ", "a  b", "x <|endoftext|> y", "a\x1c b", "a \x85 b", "it's we'll ' s", "a \n b", "word, word. no.1 x", "　 q  ", "ab,,. c!?"]
    enc = token_store.Encoder(queries.tokenizer_path("byte_bpe_50k.json"), 0, memory=5)
    for _ in range(3):
        want = [e.ids + [0] for e in enc.tokenizer.encode_batch(odd, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u2").tolist() for x in enc.encode(odd)] == want


def removed_words(texts, window):
    """Brute force over (id, words); a null id comes first."""
    keyed = [(float("-inf") if i is None else i, t.encode().split()) for i, t in texts]
    first = {}
    for i, w in keyed:
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, (i, s)), (i, s))
    out = []
    for i, w in keyed:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (i, s):
                gone[s : s + window] = [True] * window
        out.append((None if i == float("-inf") else i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block,lengthen,group", [(1 << 20, 256, 1 << 17), (400, 0, 1 << 17), (400, 2, 1), (1 << 20, 0, 30)])
def test_substrings(docs, nothing, monkeypatch, block, lengthen, group):
    monkeypatch.setattr(substrings, "LENGTHEN", lengthen)
    monkeypatch.setattr(substrings, "GROUP", group)
    got = substrings.drop_repeats(docs, block_bytes=block)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept") == removed_words(texts_of(docs), 20)
    assert substrings.drop_repeats(nothing).count() == 0


@pytest.mark.parametrize("window,prefix,lengthen", [(20, 8, 4096), (20, 8, 0), (6, 2, 3)])
def test_substrings_of_few_words(spark, monkeypatch, window, prefix, lengthen):
    """Few different words, long ones among them, repeated ids, shared passages and null ids, against brute force."""
    monkeypatch.setattr(substrings, "LENGTHEN", lengthen)
    r, shared, huge = np.random.default_rng(window + lengthen), passage(31, 90).split(), "w" * 70_000
    rows = []
    for i in range(60):
        w = r.choice(["a", "b", "é", huge, huge + "x", "\x1f", "日本"], r.integers(0, 60), p=[0.5, 0.3, 0.1, 0.02, 0.02, 0.03, 0.03]).tolist()
        at = int(r.integers(0, 60))
        rows.append((None if i % 13 == 5 else int(r.integers(0, 40)), " ".join(w + shared[at : at + 30] + passage(i, 8).split()) + "\n"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.drop_repeats(docs, window, prefix, block_bytes=3000)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept") == removed_words(texts_of(docs), window)


def test_repeats_longer_than_the_window(spark):
    long, short = passage(41, 300), passage(42, 25)
    rows = [(1, long), (2, passage(43, 9) + " " + long + " " + passage(44, 9) + " " + short), (3, short), (4, passage(45, 400)), (5, None)]
    got = substrings.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_removed", "n_repeats", "longest_repeat") == [(1, 0, 0, 0), (2, 300, 1, 300), (3, 25, 1, 25), (4, 0, 0, 0), (5, 0, 0, 0)]


def test_subtree_gives_common_prefixes():
    r = np.random.default_rng(7)
    symbols, starts = r.integers(0, 3, 400), np.arange(380)
    sizes = np.minimum(40, 400 - starts)
    order, depth = substrings.subtree(symbols, starts, sizes, 40)
    suffixes = [symbols[s : s + n].tolist() for s, n in zip(starts[order], sizes[order])]
    assert suffixes == sorted(suffixes) and depth[0] == 0
    for a, b, d in zip(suffixes, suffixes[1:], depth[1:]):
        assert a[:d] == b[:d] and (d == min(len(a), len(b)) or a[d] != b[d])
    none = np.zeros(0, np.int64)
    assert [len(x) for x in substrings.subtree(symbols, none, none, 40)] == [0, 0]


def test_leaks_among_rows_without_id(spark):
    """Many rows without an id are not one key: each is checked against the items that its own text may hold."""
    items = spark.createDataFrame([(i, passage(500 + i, 20)) for i in range(6)] + [(None, passage(520, 20))], "item_id long, text string")
    rows = [(None, f"{passage(600 + i, 10)} {passage(500 + i % 12, 20)}") for i in range(120)] + [(4, None), (4, passage(520, 20)), (4, passage(520, 18))]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, item_id int, digest string").repartition(4)
    got = rows_of(contamination.find_leaks(docs, items), "doc_id", "item_id", "n_shared", "n_item")
    assert got == sorted([*((None, i, 16, 16) for i in range(6)), (4, None, 16, 16)], key=str)


def test_language(spark, sf_dir, docs, nothing):
    found = queries.op3_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert held > 0.97
    training = (("aa", (passage(3, 60),)), ("bb", ("zzz qqq xxx yyy",)))
    got = {r.doc_id: r for r in language.identify(docs, training).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 13)] == ["und"] * 4 and got[5].lang_pred == "aa" and 0 <= got[5].score <= 1
    assert language.learn(nothing) == () and {r.lang_pred for r in language.identify(docs, ()).collect()} == {"und"}
    assert language.identify(nothing, training).count() == 0


def test_cross_parse_equals_longest_matches():
    training = (("aa", ("the cat sat on the mat",)), ("bb", ("der hund und die katze",)))
    p = language.Parser(training)
    texts = ["the hund sat", "katze on mat xyz", "q"]
    rate, _ = p.phrases(texts)
    for k, (_, (source,)) in enumerate(training):
        for i, t in enumerate(texts):
            at = n = 0
            while at < len(t):
                size = max((s for s in range(len(t) - at + 1) if t[at : at + s] in source), default=0)
                at, n = at + max(1, size), n + 1
            assert rate[k, i] == pytest.approx(n / len(t))


def test_leaks(spark, docs, nothing):
    items = spark.createDataFrame([(1, passage(1, 40)), (2, passage(9, 30)), (3, None), (4, "one"), (5, passage(3, 12).upper())], "item_id long, text string")

    def words(t):
        return re.findall(r"[^\W_]+", t.lower())

    want = []
    for i, t in set(texts_of(docs)):
        for k, it in [(r.item_id, words(r.text or "")) for r in items.collect()]:
            n = min(5, len(it))
            have = {tuple(words(t)[s : s + n]) for s in range(len(words(t)) - n + 1)}
            need = {tuple(it[s : s + n]) for s in range(len(it) - n + 1)} if n else set()
            if need and len(have & need) >= 0.8 * len(need) - 1e-9:
                want.append((i, k, len(have & need), len(need)))
    got = contamination.find_leaks(docs, items)
    assert rows_of(got, "doc_id", "item_id", "n_shared", "n_item") == sorted(want, key=str) and len(want) > 5
    assert contamination.find_leaks(docs, items.where("false")).count() == 0
    assert contamination.find_leaks(nothing, items).count() == 0


def test_token_counts(docs, nothing):
    from sentencepiece import SentencePieceProcessor

    model = queries.tokenizer_path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=model)
    got = token_counts.count_tokens(docs, model, limit=100)
    want = [(i, len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 100) for i, t in texts_of(docs)]
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=str)
    odd = ["", " ", "  a ", "▁x ▁▁y", "<s> </s> <0x0A>", "a" * 500, "ab" * 99, "\r\n\x00", "=====----", "日本🙂 é́"]
    counter = token_counts.PieceCounter(model, memory=3)
    for _ in range(2):
        assert counter.count(odd) == [len(x) for x in library.encode(odd)]
    assert token_counts.count_tokens(nothing, model).count() == 0


def test_mixing(docs, nothing):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and mixing.mix(nothing).count() == 0
    per = {}
    for r in got:
        per.setdefault(r.source, []).append(r)
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
    assert sum(p[0].target for p in per.values()) == pytest.approx(sum(r.size for r in got))
    for p in per.values():
        assert sum(r.size for r in p) == p[0].source_size and p[0].target <= 3 * p[0].source_size + 1e-9
        assert abs(sum(r.taken for r in p) - p[0].target) <= max(sum(r.size for r in p if r.hash == q.hash) for q in p) / 2 + 1e-9
    assert sorted(got, key=str) == sorted(mixing.mix(docs.repartition(5)).collect(), key=str)


def test_warc(spark, nothing):
    big, other = "<p>" + passage(1, 300), "<b>" + passage(2, 300)
    pages = [(1, "http://a", big), (2, "http://b", big), (3, None, None), (4, "u\r\nv", ""), (5, "x", "small"), (6, "y", "small"), (7, "z", other), (None, "n", big), (2, "r", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    decided = warc.decide(df)
    read = warc.read_archives(warc.write_archives(decided, scratch_path(spark, "w"), file_bytes=2000))
    want = []
    for i, _, h in pages:
        revisit = h == big and i != 2
        want.append((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None))
    assert rows_of(read, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=str)
    bodies = {bytes(r.payload).decode() for r in read.where("record_type = 'response'").collect()}
    assert bodies == {big, other, "small", ""}
    assert warc.read_archives(warc.write_archives(warc.decide(df.where("false")), scratch_path(spark, "w"))).count() == 0


def test_vectors(spark):
    r = np.random.default_rng(5)
    base = r.normal(size=(400, 32))
    x = np.concatenate((base, base[:150] + r.normal(size=(150, 32)) * 0.12, np.repeat(base[:1], 40, 0), base[:1] + r.normal(size=(60, 32)) * 0.05)).astype(np.float32)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    for i in range(len(rows)):  # near copies share the label of their base
        if i >= 400:
            rows[i] = (i, rows[i][1], (i - 400) % 2 if i < 550 else 0)
    odd = [(900, None, 0), (901, [0.0] * 32, 0), (902, [float("nan")] * 32, 0), (903, [None] + [1.0] * 31, 0), (904, rows[0][1], None), (905, [1.0, 2.0], 0), (906, [2.0, 4.0], 0), (907, [], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    assert len(got) == len(rows) + len(odd)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    label = np.array([q[2] for q in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want, have = near.sum(1), np.array([got[i].n_links for i in range(len(rows))])
    assert (have <= want).all() and have.sum() >= 0.97 * want.sum() and want.sum() > 5000
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (900, 901, 902, 903, 904, 907))
    assert got[905].n_links == got[906].n_links == 1 and got[906].component_id == 905 and not got[906].kept
    assert vectors.near_vectors(df.where("false")).count() == 0


KEY = "MC4CAQAwBQYDK2VwBCIEI" + "A" * 43  # a PKCS#8 key of zeros in 48 bytes


def test_secrets(docs, nothing, spark):
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.c2ln"
    texts = ["Password = 'hunter2hunter2'", "password: token: abcdefgh12", "AKIA" + "A" * 12 + " AKIAB", "é deadbeef" * 3 + "0123456789abcdef" * 2, f"see {token} and eyJx.eyJ.z", f"key {KEY} x {KEY[:-4]}", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.scan_secrets(df).collect()}
    assert got[0] == [("assign", 0, 27)] or got[0][0][:2] == ("assign", 0)
    assert got[1] == [] and got[2] == [("access", 0, 16)] and got[6] == got[7] == []
    assert [k for k, _, _ in got[3]] == ["hex"] and got[4] == [("jwt", 4, 4 + len(token))] and got[5] == [("der", 4, 4 + len(KEY))]
    assert secrets.scan_secrets(docs).count() == docs.count() and secrets.scan_secrets(nothing).count() == 0


def test_simhash(docs, nothing):
    got = simhash.near_duplicates(docs).collect()
    fps = [(r.doc_id, int(r.fingerprint, 16)) for r in got]
    assert sorted(fps, key=str) == sorted(((i, simhash.fingerprint(t)) for i, t in texts_of(docs)), key=str)
    for r in got:
        reach, grown = {int(r.fingerprint, 16)}, True
        while grown:
            more = {f for _, f in fps if any(bin(f ^ g).count("1") <= 4 for g in reach)}
            grown, reach = more != reach, more
        assert r.component_id == min(i for i, f in fps if f in reach and i is not None) if any(i is not None and f in reach for i, f in fps) else r.component_id is None
    assert simhash.near_duplicates(nothing).count() == 0


def plain_fingerprint(text):
    """Bit by bit, from the definition."""
    words = [w for w in re.split("[\\x20\\x09-\\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_by_definition(spark):
    r = np.random.default_rng(3)
    texts = [None, "", " \n", "Ab", "ÀÉ Ab\x0bcd \x1cx", "a b c d " * 50, *(passage(i, int(r.integers(1, 40))).title() for i in range(60))]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, fp string, component_id string")
    got = {r.doc_id: int(r.fingerprint, 16) for r in simhash.near_duplicates(df).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_copies_by_the_thousand_and_rows_without_id(spark):
    text = passage(77, 30)
    many = spark.range(3000).select(F.when(F.col("id") % 2 == 0, F.col("id") + 5).alias("doc_id"), F.lit(text).alias("text"))
    assert {r.component_id for r in simhash.near_duplicates(many).select("component_id").distinct().collect()} == {5}
    none = many.select(F.lit(None).cast("long").alias("doc_id"), "text")
    assert simhash.near_duplicates(none).groupBy("component_id").count().collect() == [(None, 3000)]


@pytest.mark.parametrize("group,doublings,masks", [(4096, 0, 5), (1, 0, 5), (4096, 13, 15), (4096, 22, 35), (4, 40, 70)])
def test_links_by_any_choice_of_blocks(spark, monkeypatch, group, doublings, masks):
    """All links are found whatever the masks, and a tenfold table has no larger groups."""
    r = np.random.default_rng(9)
    codes = [int(c) for c in r.integers(0, 1 << 63, 120, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]
    codes += [c ^ sum(1 << int(b) for b in r.choice(64, k % 7, replace=False)) for k, c in enumerate(codes * 2)]
    codes = sorted(set(codes))
    plain = simhash.dealing_masks
    chosen = plain(4096 << doublings, 4, 4096)
    assert len(chosen) == masks
    monkeypatch.setattr(simhash, "dealing_masks", lambda *_: chosen)
    monkeypatch.setattr(simhash, "GROUP", group)
    signed = [(c - (c >> 63 << 64),) for c in codes]
    edges = simhash.links(spark.createDataFrame(signed, "fp long").repartition(3), 4).collect()
    parent = {c: c for (c,) in signed}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for a, b in edges:
        parent[root(a)] = root(b)
    label = {c: c for (c,) in signed}
    grown = True
    while grown:
        grown = False
        for (a,) in signed:
            for (b,) in signed:
                if label[a] != label[b] and bin((a ^ b) & (1 << 64) - 1).count("1") <= 4:
                    low, high = sorted((label[a], label[b]))
                    label, grown = {c: low if v == high else v for c, v in label.items()}, True
    assert len({root(c) for c in parent}) == len(set(label.values()))
    for n in (10**6, 10**9, 5 * 10**10):
        assert n / (1 << min(m.bit_count() for m in plain(n, 4, 4096))) <= 4096


def test_gray_index():
    r = np.random.default_rng(1)
    codes = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    flips = [codes.copy() for _ in range(6)]
    for k, f in enumerate(flips):
        for _ in range(k):
            f ^= np.uint64(1) << r.integers(0, 64, len(f)).astype(np.uint64)
    codes = np.unique(np.concatenate(flips))
    for n in (1, 16, 17, len(codes)):
        found = [p for q, m in simhash.GrayIndex(codes[:n]).search(codes, 4) for p in zip(q.tolist(), m.tolist())]
        want = np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :n]) <= 4)
        assert sorted(found) == sorted(zip(*(x.tolist() for x in want)))


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_matches_duckdb(spark, sf_dir, name):
    run, sql = queries.QUERIES[name]
    assert compare(run(spark, sf_dir), oracle(sf_dir), sql) is None


def near_components(rows):
    """How many groups of texts with a five-word Jaccard similarity of 0.8 or more, by comparing all pairs."""
    sets = []
    for t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if label[i] != label[j] and (a == sets[j] or 9 * n >= 4 * (len(a) + len(sets[j])) and n):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return len(set(label))


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = pipeline.keep_known_language(spark, docs, sf_dir).cache()
    assert known.count() == docs.where("text rlike '\\\\p{L}'").count() and known.columns == list(pipeline.COLUMNS)
    one = pipeline.keep_one_of_each(spark, known, sf_dir).cache()
    assert one.count() == near_components([r.text for r in known.collect()])
    clean = pipeline.drop_leaks(spark, one, sf_dir).cache()
    leaks = {r.doc_id for r in queries.op4_leaks(spark, sf_dir).select("doc_id").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()} - leaks
    mixed = pipeline.mix_sources(spark, clean, sf_dir)
    want = mixing.mix(clean).where("taken > 0").agg(F.sum(F.col("taken") / F.col("size"))).first()[0]
    assert mixed.count() == want


def test_run_returns_the_tokens_of_what_the_stages_keep(spark):
    import corpus_pipeline as pipeline
    from tokenizers import Tokenizer

    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, step in pipeline.STAGES[:-1]:
        docs = step(spark, docs, small).cache()
    plain = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    want = [(r.doc_id, plain.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in docs.collect()]
    got = pipeline.run(spark, small).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)


def test_leaks_go_by_row(spark, tmp_path):
    import corpus_pipeline as pipeline

    item, clean = passage(50, 30), [passage(60 + i, 40) for i in range(3)]
    bad = passage(70, 10) + " " + item + " " + passage(71, 10)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, bad), (None, clean[0]), (7, bad), (7, clean[1]), (8, clean[2]), (8, clean[2]), (9, None), (10, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert rows_of(kept, "doc_id", "text") == sorted([r for r in rows if r[1] != bad], key=str)
    assert pipeline.drop_leaks(spark, docs.limit(0), str(tmp_path)).count() == 0
