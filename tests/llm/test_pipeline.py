import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from anchorline.llm import common

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The documents after each stage but the last, and the last one's rows."""
    docs = common.table(spark, SF, "documents")
    out = {"documents": docs}
    for name, stage in cp.STAGES:
        docs = common.saved(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages_keep_the_columns(kept):
    columns = kept["documents"].columns
    for name, _ in cp.STAGES[:-1]:
        assert kept[name].columns == columns and kept[name].dtypes == kept["documents"].dtypes


def test_quality_takes_out_what_the_plain_rules_reject(kept):
    def good(text):
        w = words(text)
        threes = list(zip(w, w[1:], w[2:]))
        often = Counter(threes)
        covered = {i + k for i, t in enumerate(threes) if often[t] > 1 for k in range(3)}
        return len(w) >= 50 and 2 * len(covered) <= len(w)

    before = {r.doc_id: r.text for r in kept["documents"].collect()}
    after = {r.doc_id: r.text for r in kept["quality_rules"].collect()}
    plain = {i for i, t in before.items() if good(t)}
    assert set(after) <= plain and all(after[i] == before[i] for i in after)
    clean = {i for i in plain if " | " not in before[i] and "%%%" not in before[i]}
    assert len(clean - set(after)) <= 0.02 * len(clean)


def shingles(text):
    w = words(text.translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near_dedup_keeps_the_least_id_of_each_component(kept):
    """Equal to a brute force over all pairs: links from a similarity of 0.8 on, exactly."""
    sets = {r.doc_id: shingles(r.text) for r in kept["quality_rules"].collect()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    after = {r.doc_id for r in kept["simhash_near_dedup"].collect()}
    assert after == {i for i in root if top(i) == i} and len(after) < len(sets)


def test_span_dedup_only_takes_away(kept):
    before = {r.doc_id: r.text for r in kept["simhash_near_dedup"].collect()}
    after = {r.doc_id: r.text for r in kept["substring_dedup"].collect()}
    assert set(after) <= set(before)
    for i, t in after.items():
        rest = iter(words(before[i]))
        assert all(w in rest for w in words(t))


def test_mix_meets_targets(kept):
    before = {r.doc_id: r for r in kept["substring_dedup"].collect()}
    after = Counter(r.doc_id for r in kept["mixing"].collect())
    assert set(after) <= set(before) and max(after.values()) <= 2
    size = {i: len(words(r.text)) for i, r in before.items()}
    assert abs(sum(size[i] * n for i, n in after.items()) / sum(size.values()) - 1.5) < 0.1


def test_packing_holds_every_row_whole(kept):
    pieces = kept["packing"].toPandas()
    per_doc = pieces.groupby("doc_id").agg(n=("length", "sum"), size=("doc_tokens", "max"))
    times = Counter(r.doc_id for r in kept["mixing"].collect())
    assert all(per_doc.n[i] == per_doc["size"][i] * times[i] for i in times)
    fill = pieces.groupby("sequence_id").length.sum()
    assert fill.max() <= 2048


def test_run_gives_what_the_stages_give(spark, kept):
    def pieces(df):
        return Counter((r.doc_id, r.doc_tokens) for r in df.where("start = 0").collect()), df.agg(F.sum("length")).first()[0]

    ran = common.saved(cp.run(spark, SF), "ran")
    assert ran.columns == kept["packing"].columns
    assert pieces(ran) == pieces(kept["packing"])


def stored(spark, tmp_path, rows):
    ddl = "doc_id long, source string, lang string, text string, _row int, words int"
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_empty_table(spark, tmp_path):
    assert cp.run(spark, stored(spark, tmp_path, [])).count() == 0


def test_nulls_repeated_rows_and_clashing_names(spark, tmp_path):
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60 + i)) + "."
    rows = [(None, None, None, text(i), None, i) for i in range(4)] + [(i, "s", "en", text(i), i, None) for i in range(4, 8)]
    rows += [(5, "s", "en", text(5), 5, None), (9, "s", None, None, None, None), (None, None, None, None, None, None), (10, None, "en", "", 1, 1), (11, "t", "en", "long words here. " + " ".join(f"v{k}" for k in range(60_000)), 1, 1)]
    sf = stored(spark, tmp_path, rows)
    docs = common.table(spark, sf, "documents")
    names = docs.columns
    seen = {}
    for name, stage in cp.STAGES[:-1]:
        docs = common.saved(stage(spark, docs, sf), name)
        assert docs.columns == names
        seen[name] = docs.collect()
    # the rules drop the texts without words; of the repeated row one is left; nothing else is alike
    assert len(seen["quality_rules"]) == 10 and len(seen["simhash_near_dedup"]) == len(seen["substring_dedup"]) == 9
    assert {r.text for r in seen["substring_dedup"]} == {r[3] for r in rows if r[3]}
    assert cp.run(spark, sf).count() > 0
