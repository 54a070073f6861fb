import random
import re

import xxhash

from anchorline.llm import substring_dedup as sd

DDL = "doc_id long, text string"


def cut(text):
    out, now = [], []
    for line in re.split("\n", text):
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        for k, w in enumerate(words):
            low = w.encode().lower()
            now.append(low)
            if low[-1:] in b".!?" or xxhash.xxh64_intdigest(low) % sd.BREAK == 0 or k == len(words) - 1:
                out.append(tuple(now))
                now = []
    return out


def brute(rows):
    """Every run of sentences that is long enough, as a tuple of words instead of hashes."""
    seen, gone = {}, {}
    docs = {r: cut(r[1] or "") for r in rows}
    for r in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        s = docs[r]
        for i in range(len(s)):
            span, n = (), 0
            for j in range(i + 1, len(s) + 1):
                span = hash((span, s[j - 1]))
                n += len(s[j - 1])
                if j - i < sd.RUN or n < sd.WORDS:
                    continue
                if seen.setdefault((span, n), (r, i)) != (r, i):
                    gone.setdefault(r, set()).update(range(i, j))
    return {r: [w for k, x in enumerate(docs[r]) if k not in gone.get(r, ()) for w in x] for r in docs}, {r: len(g) for r, g in gone.items()}


def corpus():
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ende.", "so!", "who?", "x,"]
    make = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" "] * 12 + ["\n", ". ", "  "]) for _ in range(n))
    passages = [make(n) for n in (20, 60, 60, 120)]
    rows = []
    for i in range(80):
        text = make(rng.choice([0, 5, 60, 200]))
        if i % 3 == 0:
            text = make(30) + " " + passages[i % 4] + " " + text + (passages[(i + 1) % 4] if i % 2 else "")
        rows.append((i, text))
    rows += [(200, rows[3][1]), (201, rows[3][1].upper()), (202, "spam " * 3000), (203, None), (204, ""), (205, make(40) * 3)]
    return rows


def test_true_sentences_only(spark):
    said = "The first one of these sentences has a good many words in it. And the second one does not stop short either."
    rows = [(1, "Alpha beta gamma. " + said), (2, said + " Delta."), (3, "loose words " + said[20:90])]
    out = {r.doc_id: (r.text, r.removed_sentences) for r in sd.op3(spark.createDataFrame(rows, DDL), every=0).collect()}
    assert out == {1: (rows[0][1], 0), 2: ("Delta.", 2), 3: (rows[2][1], 0)}


def test_against_brute_force(spark):
    rows = corpus()
    kept, gone = brute(rows)
    out = {r.doc_id: r for r in sd.op3(spark.createDataFrame(rows, DDL).repartition(5)).collect()}
    assert len(out) == len(rows)
    for r in rows:
        got = out[r[0]]
        assert [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (got.text or "").encode())] == kept[r], r
        assert got.removed_sentences == gone.get(r, 0)
        if r not in gone:
            assert got.text == r[1] and got.first_doc_ids == []
    assert out[200].first_doc_ids == [3] or out[200].removed_words


def test_repeated_passage_of_fifty_words(spark):
    rng = random.Random(3)
    passage = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "the"]) + str(rng.randrange(90)) for _ in range(55))
    side = lambda: " ".join(f"u{rng.randrange(10**6)}" for _ in range(70))
    rows = [(i, f"{side()} {passage} {side()}") for i in range(12)]
    out = {r.doc_id: r for r in sd.op3(spark.createDataFrame(rows, DDL)).collect()}
    assert out[0].removed_words == 0
    assert all(out[i].removed_words > 25 and out[i].first_doc_ids == [0] for i in range(1, 12))
    assert all(out[i].removed_words <= 55 for i in out)


def test_rows_pass_through(spark):
    long = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, long, 5, "a"), (1, long, 6, "b"), (2, long, 7, "c"), (None, long + " x", 8, "d"), (3, None, 9, "e")], DDL + ", pos int, covered string")
    out = sd.deduplicated(df)
    assert out.columns == df.columns
    rows = {r.covered: r.text for r in out.collect()}
    assert rows["d"] == long + " x" and rows["e"] is None
    assert rows.get("a") == rows.get("b") and len((rows.get("a") or "").split()) < 30
    assert sd.op3(spark.createDataFrame([], DDL)).count() == 0 and sd.deduplicated(df.limit(0)).count() == 0


def test_all_sentences_of_repeated_runs_go(spark):
    rng = random.Random(8)
    make = lambda n: " ".join(rng.choice("abcdefghijklm") + str(rng.randrange(80)) + rng.choice(["", "", "", ".", "!"]) for _ in range(n))
    passages = [make(n) + "." for n in (18, 25, 40)]
    rows = [(i, f"{make(20)}. {passages[i % 3]} {make(25)}") for i in range(30)]
    left, _ = brute(rows)
    out = {r.doc_id: r for r in sd.op3(spark.createDataFrame(rows, DDL)).collect()}
    for r in rows:
        assert out[r[0]].text.lower().encode().split() == left[r]
    assert all(out[i].removed_words >= len(passages[i % 3].split()) for i in range(3, 30))


def test_repeated_hashes_are_not_sent_through_the_driver(spark, monkeypatch):
    """A packed file of hashes is many times as large once it is a table in memory."""
    written, saved = [], sd.common.saved
    monkeypatch.setattr(sd.common, "saved", lambda df, name, **o: written.append(df) or saved(df, name, **o))
    text = " ".join(f"w{i}" for i in range(200))
    sd.repeated(spark.createDataFrame([(1, text), (2, text)], DDL)).collect()
    for df in written:
        df.collect()
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()
