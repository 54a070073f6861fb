import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from anchorline.llm import simhash


def slow_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    sums = [sum(xxhash.xxh64_intdigest(r, 42) >> b & 1 for r in runs) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * sums[b] > len(runs))


def slow_components(rows):
    found = {i: slow_fingerprint(t) for i, t in rows}
    label = {i: i for i in found}
    changed = True
    while changed:
        changed = False
        for i in found:
            for j in found:
                if (found[i] ^ found[j]).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return {i: (f"{found[i]:016x}", label[i]) for i in found}


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_against_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choices([f"w{k}" for k in range(400)], k=300)) for _ in range(6)]
    rows = []
    for i in range(60):
        words = base[i % 6].split()
        for _ in range(i // 20):
            words[rng.randrange(len(words))] = f"X{i}"
        rows.append((100 - i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "ONE"), (205, "one two"), (206, "È one two three")]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op10(docs(spark, rows)).collect()}
    assert got == slow_components(rows)
    assert got[201] == ("0" * 16, 200)


def test_hot_keys_in_blocks_lose_no_link(spark):
    rng = random.Random(5)
    fps = list({rng.getrandbits(64) for _ in range(20)} | {0xFFFFFFFF00000000 ^ (1 << a) ^ (1 << b) for a in range(32) for b in range(32)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    def roots(block):
        return {r.node: r.root for r in simhash.components(simhash.links(df, block=block)).collect()}
    assert roots(16) == roots(100_000)
    assert len(set(roots(16).values())) == 1


def test_every_flip_of_up_to_three_bits_is_found(spark):
    rng = random.Random(7)
    pairs = []
    for _ in range(200):
        f = rng.getrandbits(64)
        g = f
        for b in rng.sample(range(64), rng.randint(1, 3)):
            g ^= 1 << b
        pairs.append((f, g))
    sign = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(sign(x),) for p in pairs for x in p], "fp long").distinct()
    found = {frozenset((r.a, r.b)) for r in simhash.links(df).collect()}
    assert {frozenset((sign(a), sign(b))) for a, b in pairs} <= found


def test_empty_repeated_and_clashing(spark):
    assert simhash.op10(docs(spark, [])).count() == 0
    rows = spark.createDataFrame([(1, "a b c d", 5, "x"), (1, "a b c d", 6, "y"), (None, None, 7, "z")], "doc_id long, text string, fp long, key string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.op10(rows).collect()), key=str)
    assert got == [(1, 1), (1, 1), (None, None)]


def test_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_seven_bits_over_four_segments(spark):
    rng = random.Random(11)
    pairs = []
    for _ in range(150):
        f = rng.getrandbits(64)
        g = f
        for b in rng.sample(range(64), rng.randint(1, 7)):
            g ^= 1 << b
        pairs.append((f, g))
    sign = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(sign(x),) for p in pairs for x in p], "fp long").distinct()
    found = {frozenset((r.a, r.b)) for r in simhash.links(df, distance=7).collect()}
    assert {frozenset((sign(a), sign(b))) for a, b in pairs} <= found


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(1)
    base = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(200)) for _ in range(15)]
    rows = []
    for i in range(45):
        words = base[i % 15].split()
        if i >= 15:
            words[rng.randrange(200)] = f"edit{i}"
        rows.append((100 + i, " ".join(words), i, "x"))
    rows += [(7, rows[3][1], 900, "copy"), (200, None, 1, "n"), (201, "", 2, "n"), (202, "short one", 3, "s"), (203, "short two", 4, "s"), (203, "short two", 5, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, root string")
    out = simhash.survivors(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted([7, *(100 + i for i in range(15) if i != 3), 200, 202, 203])
    assert simhash.survivors(df.limit(0)).count() == 0


def test_texts_without_ids_or_with_one_id_all_stay(spark):
    rng = random.Random(9)
    texts = [" ".join(f"n{rng.randrange(10**6)}" for _ in range(120)) for _ in range(12)]
    rows = [(None, t, i) for i, t in enumerate(texts[:8])] + [(5, t, i) for i, t in enumerate(texts[8:])]
    rows += [(None, texts[0], 50), (5, texts[9], 51), (None, texts[10], 52)]
    out = simhash.survivors(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect()
    assert sorted(r.text for r in out) == sorted(texts)
    assert {r.doc_id for r in out if r.text in texts[8:]} == {5}


def test_links_at_four_fifths_of_the_shingles_and_not_below(spark):
    rng = random.Random(13)
    rows, gone = [], set()
    for k in range(60):
        words = [f"j{rng.randrange(10**7)}" for _ in range(104)]
        # of 100 shingles 80 or 79 are kept, all others are lost with the words at the end
        n = 80 if k % 2 else 79
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[: n + 4]))]
        gone |= {2 * k + 1} if k % 2 else set()
    # a chain: each end is within reach of the middle only
    words = [f"c{i}" for i in range(130)]
    rows += [(500, " ".join(words[:104])), (501, " ".join(words[10:114])), (502, " ".join(words[20:124]))]
    out = simhash.survivors(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r.doc_id for r in out.collect()} == {i for i, _ in rows} - gone - {501, 502}


def test_groups_without_a_middle_are_compared_in_blocks(spark, monkeypatch):
    """Chains of edits: each text is near its neighbours only; and many texts of one family that are just not near."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(21)
    base = [f"b{i}" for i in range(200)]
    rows, chain = [], list(base)
    for i in range(60):
        rows.append((i, " ".join(chain)))
        chain = list(chain)
        for _ in range(3):
            chain[rng.randrange(200)] = f"c{i}x{rng.randrange(999)}"
    far = [f"d{i}" for i in range(200)]
    for i in range(60):
        other = list(far)
        for _ in range(9):
            other[rng.randrange(200)] = f"e{i}x{rng.randrange(999)}"
        rows.append((100 + i, " ".join(other)))
    sets = {i: set(simhash.shingle_set(t).tolist()) for i, t in rows}
    near = {(i, j) for i in sets for j in sets if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    root = {i: i for i in sets}
    for _ in sets:
        for i, j in near:
            root[i] = root[j] = min(root[i], root[j])
    kept = {r.doc_id for r in simhash.survivors(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(root.values())
    held = [(i, i, np.array(sorted(s), np.uint64)) for i, s in sets.items()]
    found = simhash.forest(held)
    assert set(found) <= near and len(found) == len(sets) - len(set(root.values()))


def test_exploded_rows_are_not_sent_through_the_driver(spark):
    """Keys of fingerprints, 66 for each, and rows dealt over salts are more than Spark takes them for."""
    fps = spark.createDataFrame([(i * 977,) for i in range(50)], "fp long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")
    for df in (simhash.links(fps), simhash.joined(edges, edges.select("a", F.col("b").alias("m")), "a", "b")):
        df.collect()
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()
