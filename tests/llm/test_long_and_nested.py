"""Long texts, low-rank vectors, dictionaries and nested key encodings, each against brute force or a round trip."""

import base64
import json
import re

import numpy as np
import pytest

from tidewell.llm import language, queries, secrets, token_store, vectors, warc
from tidewell.session import scratch_path
from tests.llm.test_corpus_operators import passage, rows_of


def longest_matches(text, sources):
    """Phrases of one parse from the start of a text, by trying every length."""
    at = n = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and any(text[at : at + size + 1] in s for s in sources):
            size += 1
        at, n = at + max(1, size), n + 1
    return n


@pytest.mark.parametrize("lane", [7, 64, 1024])
def test_long_texts_are_parsed_as_one(monkeypatch, lane):
    monkeypatch.setattr(language, "LANE", lane)
    training = (("aa", (passage(1, 120), "a" * 40)), ("bb", (passage(2, 120),)), ("cc", ("日本語の文章 и кириллица " + passage(3, 20),)))
    source = passage(1, 120)
    texts = [source * 3, passage(4, 900), "a" * 700, "日本 кирилл " * 60 + passage(2, 200), "x", "", None, source[5:300] + passage(2, 120)[7:400]]
    p = language.Parser(training)
    rate, _ = p.phrases(texts)
    for k, (_, sources) in enumerate(training):
        for i, t in enumerate(texts):
            assert rate[k, i] == pytest.approx(longest_matches(t, sources) / len(t) if t else 0)


def test_codes_beyond_the_table_in_long_texts(monkeypatch):
    monkeypatch.setattr(language, "ALPHABET", 3)
    monkeypatch.setattr(language, "LANE", 16)
    training = (("aa", (passage(1, 60),)), ("bb", (passage(2, 60),)))
    texts = [passage(1, 60)[3:] * 2, passage(5, 100)]
    rate, _ = language.Parser(training).phrases(texts)
    want = [[longest_matches(t, sources) / len(t) for t in texts] for _, sources in training]
    assert rate == pytest.approx(np.array(want))


def test_languages_with_clashing_columns_and_repeated_rows(spark):
    training = (("aa", (passage(3, 60),)), ("bb", ("zzz qqq xxx yyy",)))
    rows = [(1, passage(3, 10), "p", 0.5), (1, passage(3, 10), "p", 0.5), (None, "zzz qqq", None, None), (2, "", "q", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    kept = language.identify(docs, training, keep=True).select("lang_pred", "row.*").collect()
    assert sorted((tuple(r)[0], *tuple(r)[1:]) for r in kept if r.doc_id is not None) == sorted((x, *r) for x, r in zip(("aa", "aa", "und"), (rows[0], rows[1], rows[3])))
    tied = language.identify(docs, (("aa", ("qq",)), ("bb", ("qq",)))).collect()
    assert {r.lang_pred for r in tied if r.doc_id == 1} == {"aa"} and all(r.score == 0 for r in tied)


@pytest.mark.parametrize("rank", [2, 3, 64])
def test_every_link_is_found_from_both_ends(spark, monkeypatch, rank):
    r = np.random.default_rng(rank)
    # Low-rank vectors lie close to the borders of their lists; 200 lists here.
    x = (r.normal(size=(3000, rank)) @ r.normal(size=(rank, 64))).astype(np.float32)
    if rank == 64:
        x[1500:] = x[:1500] + r.normal(size=(1500, 64)) * x.std() * 0.19
    spark_rows = [(i, v.tolist(), 0, "clash") for i, v in enumerate(x.astype(np.float32))] + [(7, x[8].tolist(), 0, "again"), (None, x[9].tolist(), 0, "")]
    df = spark.createDataFrame(spark_rows, "vec_id long, embedding array<float>, label int, n_links string")
    fit = vectors.Quantiser
    monkeypatch.setattr(vectors, "Quantiser", lambda sample, lists, threshold: fit(sample, 200, threshold))
    got = rows_of(vectors.near_vectors(df), "vec_id", "n_links", "component_id", "kept")
    ids = [q[0] for q in spark_rows]
    y = np.concatenate((x, x[8:9], x[9:10])).astype(np.float64)
    y /= np.linalg.norm(y, axis=1)[:, None]
    near = y @ y.T >= 0.98
    np.fill_diagonal(near, False)
    label = np.arange(len(y))
    while True:
        low = np.minimum(label, np.where(near, label[None, :], len(y)).min(1))
        if (low == label).all():
            break
        label = low
    smallest = {c: min(i for i, z in zip(ids, label) if z == c and i is not None) for c in set(label)}
    want = [(i, int(n), smallest[c], i == smallest[c]) for i, n, c in zip(ids, near.sum(1), label)]
    assert got == sorted(want, key=str) and near.sum() > 1000


def test_dictionaries_of_few_and_long_rows(spark):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    for rows in ([(i, passage(i, 4000)) for i in range(6)], [(i, passage(i % 9, 3000)) for i in range(130)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        manifest, dictionary = token_store.write_token_store(docs, scratch_path(spark, "t"), path)
        assert 0 < len(dictionary) <= token_store.DICTIONARY_BYTES
        enc = token_store.encoder(path, 0)
        got = {r.doc_id: bytes(r.ids) for r in token_store.read_token_store(manifest, dictionary).collect()}
        assert got == {i: np.frombuffer(x, "<u2").astype("<u4").tobytes() for i, x in zip(range(len(rows)), enc.encode([t for _, t in rows]))}
        pages = spark.createDataFrame([(i, "u", f"<p>{i}" + t) for i, t in rows], "page_id long, url string, html string")
        written = warc.write_archives(warc.decide(pages), scratch_path(spark, "w"))
        first = written.first().path
        with open(first.removeprefix("file:"), "rb") as f:
            assert int.from_bytes(f.read(4), "little") == warc.DICTIONARY_MAGIC and int.from_bytes(f.read(4), "little") > 0
        assert {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(written).collect()} == {i: f"<p>{i}" + t for i, t in rows}


def test_payload_bounds_and_a_wrong_digest(spark):
    pages = [(1, "a", "x" * 999), (2, "b", "x" * 999), (3, "c", "y" * 1000), (4, "d", "y" * 1000), (5, "e", "é" * 499 + "z"), (6, "f", "é" * 499 + "z")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, record_type string")
    decided = warc.decide(df)
    kinds = rows_of(warc.read_archives(warc.write_archives(decided, scratch_path(spark, "w"))), "page_id", "payload_bytes", "record_type")
    assert kinds == [(1, 999, "response"), (2, 999, "response"), (3, 1000, "revisit"), (4, 1000, "response"), (5, 999, "response"), (6, 999, "response")]
    from pyspark.sql import functions as F

    wrong = decided.withColumn("payload_digest", F.sha1(F.lit("other")))
    with pytest.raises(Exception, match="differs from its record's digest"):
        warc.read_archives(warc.write_archives(wrong, scratch_path(spark, "w"))).collect()


def der(tag, *parts):
    body = b"".join(parts)
    n = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + n + body


def string(data):
    return len(data).to_bytes(4, "big") + data


RSA = der(0x30, der(2, b"\0"), *(der(2, bytes(range(1, 30)) * k) for k in (4, 1, 4, 2, 2, 2, 2, 2)))
EC = der(0x30, der(2, b"\1"), der(4, bytes(range(32))), der(0xA0, der(6, b"\x2a\x86\x48")))
PUBLIC = string(b"ssh-ed25519") + string(bytes(32))
PRIVATE = b"\1\2\3\4" * 2 + string(b"ssh-ed25519") + string(bytes(32)) + string(bytes(64)) + string(b"me")
PRIVATE += bytes(range(1, 9))[: -len(PRIVATE) % 8]
OPENSSH = b"openssh-key-v1\0" + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4, "big") + string(PUBLIC) + string(PRIVATE)


def kinds_of(text):
    return [(k, text[s:e]) for s, k, e in secrets.find_spans(text) if k not in ("assign", "access", "hex")]


@pytest.mark.parametrize("key", [RSA, EC, OPENSSH])
def test_keys_are_found_wherever_they_start(key):
    plain = base64.b64encode(key).decode()
    assert secrets.is_private_key(key) and not secrets.is_private_key(key[:-1]) and not secrets.is_private_key(key + b"\0")
    for before in ("", "key ", "/", "a", "ab", "abc", "x/y+z"):
        assert kinds_of(f"é {before}{plain} end") == [("der", plain)]
    for width in (40, 64, 76):
        wrapped = "\n".join(re.findall(f".{{1,{width}}}", plain))
        assert kinds_of(f"text:\n{wrapped}\n\nmore")[:1] == [("der", wrapped)] or len(wrapped.split("\n")[-1]) < 4
        pem = f"-----BEGIN PRIVATE KEY-----\n{wrapped}\n-----END PRIVATE KEY-----"
        assert kinds_of(f"a {pem} b") == [("pem", pem)]
    assert kinds_of(f"a {key.hex()} b") == [("hexkey", key.hex())] and kinds_of("f" + key.hex().upper()) == [("hexkey", key.hex().upper())]
    assert kinds_of(plain[:-8]) == [] and kinds_of(key.hex()[:-2]) == []


def test_what_only_looks_like_a_key():
    for data in (b"openssh-key-v1\0" + bytes(20), b"openssh-key-v1\0" + string(b"none") * 2 + string(b"") + (1).to_bytes(4, "big") + string(b"") + string(bytes(16)), der(0x30, der(2, b"\0"), der(2, bytes(60))), bytes(range(80))):
        assert kinds_of(base64.b64encode(data).decode()) == [] and kinds_of(data.hex()) == []


def test_signed_tokens_with_any_header_text():
    def part(value):
        return base64.urlsafe_b64encode(value.encode()).decode().rstrip("=")

    body = part(json.dumps({"sub": "1"}))
    for head in ('{"alg":"HS256"}', '{ "alg": "RS256" }', '{\n  "typ": "JWT", "alg": "none"}'):
        token = f"{part(head)}.{body}.c2ln"
        for before in ("", "see ", "a.", "words.that.precede-the-token.", "https://host.example.com."):
            assert ("jwt", token) in kinds_of(before + token)
    assert kinds_of(f"{part('[1, 2, 3, 4, 5]')}.{body}.c2ln") == [] and kinds_of(f"{part('{}          ')}.{body}.c2ln") == []


def base_spans(text):
    """The base kinds by their definition, without looking first whether a pattern can match."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_base_kinds_against_their_definition(spark):
    r = np.random.default_rng(4)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "deadbeef", "é", "x.y-z_9", "\n", "K", "ſ"]
    texts = ["".join(r.choice(bits, r.integers(1, 40))) for _ in range(3000)] + ["pa" + "x" * 300_000 + " token=" + "a" * 200_000, "", None]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    for row in secrets.scan_secrets(df).collect():
        base = [(s.start, secrets.KINDS.index(s.kind), s.end) for s in row.spans if s.kind in ("assign", "access", "hex")]
        assert base == base_spans(texts[row.doc_id] or "")


def test_driver_needs_no_encoder_for_a_token_store(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    token_store.encoder.cache_clear()
    path = queries.tokenizer_path("byte_bpe_50k.json")
    manifest, dictionary = token_store.write_token_store(docs, scratch_path(spark, "t"), path)
    assert token_store.encoder.cache_info().misses == 0
    assert dictionary and token_store.read_token_store(manifest, dictionary).count() == 40
