import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from anchorline.llm import encoding, packing, token_files

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BITS = ["a", "É", "é", "é", "́", " ", "  ", "\n", "\n\n", "\t", "\xa0", "　", "\x1c", "\x85", ".", "...", "'s", "'", "3", "14", "%", "Σ", "ΑΣ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "日本", "\r\n", "\x0b", "the", "The", "‍", "😀", "İ", "İ.", "\0", "thion,", "Thion."]


def plain(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_same_ids(path):
    rng = random.Random(1)
    texts = ["", " ", "x" * 500, *("".join(rng.choices(BITS, k=rng.randint(0, 12))) for _ in range(6000))]
    mine = encoding.Encoder(path, cached=3000)
    got, whole = [], pa.array(texts)
    for i in range(0, len(texts), 300):
        ids, at = mine.encode(whole.slice(i, 300))
        got += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    assert got == plain(path, texts)
    ids, at = mine.encode(pa.array([None, "a"], pa.string()))
    assert at.tolist() == [0, 0, len(ids)] and mine.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_short_windows_are_cut():
    packer = packing.Packer(0, 32, np.array([], np.uint32))
    rows = packer.add(1, np.arange(500, dtype=np.uint32)) + packer.flush(open_end=False)
    assert sum(r[2] for r in rows) == 500 and max(r[2] for r in rows) == 32


def some_texts(n=120):
    rng = random.Random(4)
    words = ["the", "thion", "ereau", "über", "of", "|", "x1"]
    return ["".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "\n"]) for _ in range(rng.choice([0, 3, 50, 700]))) for _ in range(n)] + ["", "no sentence end " * 4000, "z" * 30000]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_packing_partitions_every_document(spark):
    texts = some_texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, None), (None, "null id")]
    ids = {i: x + [1] for (i, _), x in zip(rows, plain(WORD, [t or "" for _, t in rows]))}
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), WORD).toPandas()
    got, fill = {}, {}
    for r in pieces.itertuples():
        doc = None if r.doc_id != r.doc_id else int(r.doc_id)
        got.setdefault(doc, []).append((r.start, r.length))
        assert r.doc_tokens == len(ids[doc]) and crc(ids[doc][r.start : r.start + r.length]) == r.ids_crc32
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, spans in got.items():
        spans.sort()
        assert [a for a, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]] and sum(n for _, n in spans) == len(ids[doc])
    assert set(got) == set(ids)
    padding = 0
    for spans in fill.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]]
        size = sum(n for _, n in spans)
        assert size <= 2048
        padding += 0 if size & (size - 1) == 0 else 2048 - size
    assert padding < 0.01 * sum(map(len, ids.values()))


def brute_cuts(positions, penalties, length):
    where, cost = [0, *positions], [0.0]
    for i in range(1, len(where)):
        best = min(cost[j] + length - (where[i] - where[j]) for j in range(i) if where[i] - where[j] <= length)
        spare = [cost[j] + packing.SPARE for j in range(i) if where[i] - where[j] in packing.UNPADDED and where[i] - where[j] < length]
        cost.append(min([best, *spare]) + penalties[i - 1])
    return cost


def cost_of(cuts, positions, penalties, length):
    total, before, at = 0, 0, dict(zip(positions, penalties))
    for c in cuts:
        size = c - before
        total += at[c] + (min(packing.SPARE, length - size) if size in packing.UNPADDED and size < length else length - size)
        before = c
    return total


def test_cuts_are_of_least_cost():
    rng = random.Random(9)
    for _ in range(60):
        steps = [rng.choice([1, 3, 17, 64, 120, 256]) for _ in range(rng.randint(1, 120))]
        positions = np.cumsum(steps).tolist()
        penalties = [rng.choice([0, 4, 24]) for _ in positions]
        length = rng.choice([256, 300, 1024])
        cuts = packing.best_cuts(positions, penalties, length, open_end=False)
        assert cuts[-1] == positions[-1]
        assert cost_of(cuts, positions, penalties, length) == brute_cuts(positions, penalties, length)[-1]


def test_blocks_of_a_shard_join(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 5000)
    packer, rows, sizes = packing.Packer(3, 2048, np.array([7], dtype=np.uint32)), [], {}
    rng = np.random.default_rng(0)
    for i in range(60):
        ids = rng.integers(0, 30, size=int(rng.integers(1, 9000))).astype(np.uint32)
        sizes[i] = len(ids)
        rows += packer.add(i, ids)
    rows += packer.flush(open_end=False)
    assert {i: sum(r[2] for r in rows if r[0] == i) for i in sizes} == sizes
    assert [r[1] for r in rows if r[0] == 5][0] == 0


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), WORD).count() == 0
    twice = spark.createDataFrame([(1, "a", 1), (1, "a", 2)], "doc_id long, text string, start int")
    assert packing.pack(twice, WORD).count() == 2


def test_token_files_round_trip(spark):
    texts = some_texts(60)
    rows = [(3 * i, t, "s") for i, t in enumerate(texts)] + [(700, None, "s")]
    rng = random.Random(1)
    mixed = rng.sample(rows, len(rows))
    got = {r.doc_id: r for r in token_files.op6(spark.createDataFrame(mixed, "doc_id long, text string, ids string").repartition(6), BYTE).collect()}
    start = 0
    for (i, _, _), x in zip(rows, plain(BYTE, [t or "" for _, t, _ in rows])):
        x = x + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(x), crc(x))
        start += len(x)
    assert len(got) == len(rows)


def test_token_files_lookup_and_edge_cases(spark, tmp_path):
    path = str(tmp_path / "t")
    token_files.write(spark.createDataFrame([(i, "a b") for i in range(500)], "doc_id long, text string"), path, BYTE)
    found = token_files.lookup(spark, path, [7, 499, 9000])
    assert sorted(r.doc_id for r in found.collect()) == [7, 499]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert token_files.op6(spark.createDataFrame([], "doc_id long, text string"), BYTE).count() == 0
    assert token_files.op6(spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, text string"), BYTE).count() == 3


def test_a_very_long_text_is_one_row(spark):
    text = "thion the  Thion. " * 40_000
    got = {r.doc_id: r for r in token_files.op6(spark.createDataFrame([(1, "a"), (2, text), (3, None)], "doc_id long, text string"), BYTE).collect()}
    [first, x] = plain(BYTE, ["a", text])
    assert (got[2].start, got[2].n_tokens, got[2].ids_crc32) == (len(first) + 1, len(x) + 1, crc([*x, 2])) and got[3].n_tokens == 1
