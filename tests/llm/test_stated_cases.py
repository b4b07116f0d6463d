"""Cases at a limit, clashing column names and empty tables, as the docstrings state them."""

import pytest
from pyspark.sql import functions as F

from tidewell.llm import mixing, token_counts, warc
from tidewell.llm.queries import tokenizer_path


def test_token_limit_is_exclusive(spark):
    clash = "doc_id long, text string, n_tokens string, n_bytes string, over_limit string"
    docs = spark.createDataFrame([(1, "word " * 4095 + "word", "x", "y", "z"), (2, "word " * 4096 + "word", "x", "y", "z"), (None, None, "", "", "")], clash)
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, tokenizer_path("piece_bpe_32k.model")).collect()}
    assert got == {1: (4096, False), 2: (4097, True), None: (0, False)}
    assert token_counts.count_tokens(docs.limit(0), tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_mix_reads_three_columns_only(spark):
    rows = [(i, "w " * (i % 5), ["a", "b", None][i % 3], "s", "h", "k", "t") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, hash string, key string, target string")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    got = sorted(map(tuple, mixing.mix(docs).select(*columns).collect()))
    assert got == sorted(map(tuple, mixing.mix(docs.select("doc_id", "text", "source")).select(*columns).collect()))
    assert [r[1] for r in got] == [i % 5 for i in range(60)] and all(r[4] <= 3 * r[1] for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size,kinds", [(999, ["response", "response"]), (1000, ["revisit", "response"])])
def test_revisits_start_at_a_thousand_bytes(spark, size, kinds):
    ddl = "page_id long, url string, html string, payload string, record_type string"
    pages = spark.createDataFrame([(1, "u", "x" * size, "p", "r"), (2, "v", "x" * size, "p", "r")], ddl)
    got = warc.decide(pages).orderBy("page_id").collect()
    assert [r.record_type for r in got] == kinds and [r.payload_bytes for r in got] == [size, size]
    assert [r.refers_to for r in got] == [2 if kinds[0] == "revisit" else None, None]
    assert warc.decide(pages.where(F.lit(False))).count() == 0
