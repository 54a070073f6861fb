import random
import zlib

import numpy as np
import pytest

from anchorline.llm import langid

DDL = "doc_id long, text string, lang string"
PARTS = {"en": ["the", "ing", "tion", "wh", "sh", "ou"], "fr": ["eau", "oi", "é", "ç", "que", "è"], "de": ["sch", "ß", "ü", "ung", "keit", "ver"]}


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(240):
        lang = list(PARTS)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(PARTS[lang], k=rng.randint(1, 4))) for _ in range(60)), None if i % 17 == 0 else lang))
    return rows + [(1000, None, "en"), (1001, "", "en"), (1002, "12 +- 3\n", None), (1003, "é", None), (1004, "日本語の文章", None), (1005, "the " * 60000, None)]


@pytest.fixture(scope="module")
def out(spark):
    return {r.doc_id: r for r in langid.op4(spark.createDataFrame(corpus(), DDL).repartition(3)).collect()}


def test_split_and_held_out_accuracy(out):
    rows = corpus()
    assert set(out) == {r[0] for r in rows}
    for i, t, _ in rows:
        r = out[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1
        if i < 240:
            assert r.lang_pred == list(PARTS)[i % 3]
    assert [out[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and out[1000].score == 0
    assert out[1004].lang_pred in PARTS and out[1004].rejected
    assert not any(out[i].rejected for i in range(200))


def test_matches_plain_arithmetic(spark):
    rows = [r for r in corpus() if r[2]]
    model = langid.learn(spark.createDataFrame(rows, DDL))
    texts = [t for _, t, _ in rows if t is not None]
    df = np.zeros(langid.BUCKETS)
    for t in texts:
        df[langid.grams(t)[0]] += 1
    assert np.allclose(model.idf, np.log((1 + len(texts)) / (1 + df)) + 1)
    dense = model.by_bucket.T
    assert np.allclose(np.linalg.norm(dense, axis=1), 1, atol=1e-4)
    for t in texts[:20]:
        x = np.zeros(langid.BUCKETS)
        at, n = langid.grams(t)
        x[at] = (1 + np.log(n)) * model.idf[at]
        cos = dense @ (x / np.linalg.norm(x))
        lang, score, _ = model.predict(t)
        assert lang == model.langs[int(cos.argmax())] and abs(score - cos.max()) < 1e-4


def test_grams_count_runs_of_letters():
    at, n = langid.grams("Ab, ab!")
    # a, b twice; gap-a, ab, b-gap twice; gap-ab, ab-gap twice, b-gap-a once
    assert sorted(n.tolist()) == [1, 2, 2, 2, 2, 2, 2, 2]


def test_nothing_to_learn_and_clashing_columns(spark):
    assert langid.op4(spark.createDataFrame([], DDL)).count() == 0
    df = spark.createDataFrame([(1, "text", None, 0.5, 1), (1, "text", None, 0.5, 2), (None, "x", None, 0.1, 3)], DDL + ", score double, held_out int")
    assert [r.lang_pred for r in langid.op4(df).collect()] == ["und"] * 3


def test_very_long_texts_and_repeated_rows(spark):
    de, en = "der die das und nicht ein ist ", "the and of that with this was "
    rows = [(i, (de if i % 2 else en) * 20, "de" if i % 2 else "en") for i in range(40)]
    rows += [(50, en * 30_000, None), (51, de * 30_000, None), rows[0], rows[0]]
    out = langid.op4(spark.createDataFrame(rows, DDL)).collect()
    assert len(out) == len(rows) and {r.doc_id: r.lang_pred for r in out if r.doc_id > 40} == {50: "en", 51: "de"}
    again = [tuple(r) for r in out if r.doc_id == 0]
    assert len(again) == 3 and len(set(again)) == 1
