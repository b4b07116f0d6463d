"""Language identification with more letters than the dense table has."""

import numpy as np
import pytest

from tidewell.llm import language


def passage(first, letters, n, seed):
    r = np.random.default_rng(seed)
    return " ".join("".join(chr(first + int(c)) for c in r.integers(0, letters, r.integers(1, 5))) for _ in range(n))


LATIN = tuple("".join(chr(97 + int(c)) for c in np.random.default_rng(k).integers(0, 26, 400)) for k in range(20))
HAN, HANGUL, GEORGIAN = (passage(0x4E00, 300, 300, 1),), (passage(0xAC00, 300, 300, 2),), (passage(0x10D0, 30, 300, 3),)
TRAINING = (("aa", LATIN), ("ka", GEORGIAN), ("ko", HANGUL), ("zh", HAN))


def test_every_letter_of_the_training_text_counts(spark):
    texts = [(1, HAN[0][50:90]), (2, HANGUL[0][50:90]), (3, GEORGIAN[0][50:90]), (4, LATIN[0][50:90]), (5, "\u0e01\u0e02"), (6, passage(0x4E00, 300, 40, 9))]
    found = language.identify(spark.createDataFrame(texts, "doc_id long, text string"), TRAINING).collect()
    got = {r.doc_id: r.lang_pred for r in found}
    assert [got[i] for i in (1, 2, 3, 4, 6)] == ["zh", "ko", "ka", "aa", "zh"]
    assert all(r.score > 0.3 for r in found if r.doc_id in (1, 2, 3, 4))


def test_parse_equals_longest_matches_beyond_the_table():
    p = language.Parser(TRAINING)
    texts = [HAN[0][:60] + HANGUL[0][30:70] + "\u0e01 abc " + GEORGIAN[0][:30], passage(0x4E00, 300, 30, 8), LATIN[1][:50]]
    rate, _ = p.phrases(texts)
    for k, (_, slices) in enumerate(TRAINING):
        for i, t in enumerate(texts):
            at = n = 0
            while at < len(t):
                size = max((s for s in range(len(t) - at + 1) if any(t[at : at + s] in x for x in slices)), default=0)
                at, n = at + max(1, size), n + 1
            assert rate[k, i] == pytest.approx(n / len(t))
