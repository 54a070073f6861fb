import random
import zlib

import numpy as np
import pyarrow as pa

from anchorline.llm import toxicity as tx

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"
BAD = ["zorgle", "fnarp", "quibbex", "drozz"]


def corpus(n=600, seed=3):
    """Toxic texts hold two bad words or more; a third of all rows has a label."""
    rng = random.Random(seed)
    docs, labels, truth = [], [], {}
    for i in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice('aeiou')}{rng.randrange(30)}" for _ in range(rng.choice([5, 40, 300]))]
        truth[i] = rng.random() < 0.15
        if truth[i]:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words)))
        if rng.random() < 0.5:
            labels.append((i, int(truth[i])))
    return docs, labels, truth


def scores(spark, docs, labels, docs_ddl=DOCS, labels_ddl=LABELS):
    return tx.op13(spark.createDataFrame(docs, docs_ddl).repartition(3), spark.createDataFrame(labels, labels_ddl)).collect()


def test_held_out_texts_are_told_apart(spark):
    docs, labels, truth = corpus()
    out = scores(spark, docs, labels)
    assert len(out) == len(docs)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in out if r.held_out]
    caught = [r.predicted for r in held if truth[r.doc_id]]
    spared = [not r.predicted for r in held if not truth[r.doc_id]]
    assert np.mean(caught) > 0.95 and np.mean(spared) > 0.98


def test_held_out_labels_and_clean_labels_of_the_loss_are_not_read(spark):
    docs, labels, _ = corpus(300)
    turned = [(i, 1 - t) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, t) for i, t in labels]
    assert sorted(scores(spark, docs, labels)) == sorted(scores(spark, docs, turned))


def test_edges(spark):
    docs, labels, _ = corpus(300)
    docs += [(1000, None), (1001, ""), (None, "zorgle drozz fnarp quibbex"), (1002, " ".join(["bela1"] * 40_000)), (1003, " ".join(["bela1"] * 40_000) + " zorgle fnarp quibbex drozz")]
    docs += [docs[0], docs[0]]
    labels += [(None, 1), (1002, None), (5, 0), (5, 1), (999_999, 1)]
    out = scores(spark, [(*d, "x", 1.0) for d in docs], [(*r, 1) for r in labels], DOCS + ", toxic string, score double", LABELS + ", text int")
    assert len(out) == len(docs)
    by = {r.doc_id: r for r in out}
    assert by[1000].score == by[1001].score < 0.15 and not by[1000].held_out is None
    assert by[None].predicted == 1 and by[1002].predicted == 0 and by[1003].predicted == 1
    assert len({r.score for r in out if r.doc_id == 0}) == 1
    assert scores(spark, [], labels) == [] and {r.score for r in scores(spark, docs[:9], [])} == {0.0}
    assert {r.predicted for r in scores(spark, docs[:9], [(1, 0)])} == {0}


def test_reruns_and_partitions_agree(spark):
    docs, labels, _ = corpus(300)
    first = {r.doc_id: r.score for r in scores(spark, docs, labels)}
    again = {r.doc_id: r.score for r in scores(spark, docs[::-1], labels[::-1])}
    assert max(abs(first[i] - again[i]) for i in first) < 1e-9


def test_features_against_plain_sets():
    texts = ["Idiot, idiot! Über-große Wörter", None, "", "a bb ccc dddd eeeee　ffffff", "x" * 50_000]
    found, starts = tx.features(pa.array(texts), np.ones(tx.BUCKETS, bool))

    def plain(text):
        words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        return {int(g) for w in words for g in tx.grams([w])[0]}

    for i, t in enumerate(texts):
        got = found[starts[i] : starts[i + 1]].tolist()
        assert got == sorted(set(got)) and set(got) == plain(t)
    some = np.zeros(tx.BUCKETS, bool)
    some[found[::2]] = True
    part, at = tx.features(pa.array(texts), some)
    assert [set(part[at[i] : at[i + 1]].tolist()) for i in range(len(texts))] == [{g for g in plain(t) if some[g]} for t in texts]
    found, starts = tx.grams(["abcdef", "ab"])
    assert np.diff(starts).tolist() == [5, 1]  # <abcdef> itself and its four runs; <ab> is shorter than a run


def test_risk_is_corrected_and_its_gradient_right():
    rng = np.random.default_rng(1)
    f, toxic, rest = rng.normal(size=50), (rng.random(50) < 0.3).astype(float), np.ones(50)
    risk, slope = tx.risk_step(f, toxic, rest, 0.2)
    numeric = [(tx.risk_step(f + 1e-6 * np.eye(50)[i], toxic, rest, 0.2)[0] - risk) / 1e-6 for i in range(50)]
    assert np.allclose(slope, numeric, atol=1e-6)
    # learnt by heart: the toxic ones alone score high, which the prior says is too few
    risk, slope = tx.risk_step(np.where(toxic > 0, 9.0, -9.0), toxic, 1 - toxic, 0.4)
    assert 0 <= risk < 1e-3 and (slope[toxic > 0] >= 0).all() and (slope[toxic == 0] <= 0).all()
