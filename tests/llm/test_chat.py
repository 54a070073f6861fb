import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from anchorline.llm import chat

DDL = "conv_id long, turn long, role string, text string"


def expected(rows):
    by = {}
    for c, n, r, t in [*rows, (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]:
        by.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for c, turns in by.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        out[c] = (len(turns), sha(told), len(learned), sha(learned))
    return out


def rows_of(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_read_back(spark):
    rng = random.Random(2)
    bits = ["<", "|", "\\", "<|im_end|>", "<|im_start|>", "\n", "user", "é😀", "$1", " ", "<|im_end|>\n", "<\\|"]
    rows = []
    for c in range(40):
        for n in range(rng.randint(1, 6)):
            rows.append((c, n, rng.choice(["user", "assistant", "system", "tool x", "a\nb", "", None]), "".join(rng.choices(bits, k=rng.randint(0, 9)))))
    rows += [(50, 0, "user", None), (51, None, "assistant", "x"), (51, 0, "user", "y"), (52, 0, "user", "a"), (52, 0, "user", "a"), (None, 0, "user", "n")]
    rows += [(53, 0, "user", "q"), (53, 1, "assistant", "x<\\"), (53, 2, "user", "<"), (53, 3, "assistant", "|y"), (53, 4, "assistant", "<"), (53, 5, "assistant", "|im_end|>")]
    rows += [(60, n, "user" if n % 2 == 0 else "assistant", "long " * 3000) for n in range(40)]
    assert rows_of(chat.op5(spark.createDataFrame(rows, DDL))) == expected(rows)


def test_empty_and_clashing_columns(spark):
    assert set(rows_of(chat.op5(spark.createDataFrame([], DDL)))) == {-1}
    df = spark.createDataFrame([(1, 0, "user", "a", "x", 3)], DDL + ", turns string, t int")
    assert set(rows_of(chat.op5(df))) == {-1, 1}


@pytest.mark.parametrize("roles,error", [
    ("user assistant", None), ("system user assistant user assistant", None), ("user", 1), ("assistant user", 0),
    ("user user assistant", 1), ("user assistant system user assistant", 2), ("user assistant other", 2),
])
def test_turn_order(spark, roles, error):
    df = spark.createDataFrame([(1, n, r, "t") for n, r in enumerate(roles.split())], DDL)
    assert chat.formatted(df).first().first_error == error


def test_segments_and_their_flags(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a<|b")], DDL)
    assert [tuple(s) for s in chat.formatted(df).first().segments] == [
        ("<|im_start|>user\n", False), ("q", False), ("<|im_end|>\n", False),
        ("<|im_start|>assistant\n", False), ("a<\\|b", True), ("<|im_end|>\n", False),
    ]


def test_against_sql(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").withColumn("text", F.concat("text", F.lit("<|x<\\\\|")))
    conversations = given.toPandas()  # noqa: F841
    want = duckdb.sql(chat.SQL).df().sort_values("conv_id").reset_index(drop=True)
    got = chat.op5(given).toPandas().sort_values("conv_id").reset_index(drop=True)[list(want.columns)]
    assert got.astype(str).equals(want.astype(str)) or (got.fillna(-9) == want.fillna(-9)).all().all()


TEMPLATES = [chat.CHATML, chat.Template(opens="[TURN]", closes="[/TURN]\n"), chat.Template(opens="<start_of_turn>", closes="<end_of_turn>\n"), chat.Template(opens="[x", closes="{y}.*$", learned=("user", "assistant"))]


@pytest.mark.parametrize("template", TEMPLATES)
def test_every_template_reads_back(spark, template):
    rng = random.Random(3)
    marks = [template.opens, template.closes, template.closes.strip()]
    bits = [*marks, *(m[:k] for m in marks for k in (1, 2, 3)), *(m[1:] for m in marks), "\\", "\n", "$1", "é", "user", "\\\\", "[\\T", ".*"]
    rows = [(c, n, rng.choice(["user", "assistant", "", "a\nb", template.closes]), "".join(rng.choices(bits, k=rng.randint(0, 9)))) for c in range(60) for n in range(rng.randint(1, 5))]
    df = spark.createDataFrame(rows, DDL)
    made = chat.formatted(df, template).select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("whole"), F.filter("segments", lambda s: s["loss"]).alias("loss"))
    read = {r.conv_id: r for r in made.select("conv_id", "whole", "loss", chat.parsed(F.col("whole"), template).alias("turns")).collect()}
    for c in range(60):
        given = [(r, t) for i, _, r, t in rows if i == c]
        assert [tuple(t) for t in read[c].turns] == given
        assert read[c].whole.count(template.closes) == read[c].whole.count(template.opens) == len(given)
        assert len(read[c].loss) == sum(r in template.learned for r, _ in given)
    out = {r.conv_id: r for r in chat.op5(df, template).collect()}
    assert out[-1].n_turns == 2
    for c in range(60):
        learned = "".join(t for i, _, r, t in rows if i == c and r in template.learned)
        assert out[c].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest() and out[c].n_turns == sum(i == c for i, *_ in rows)


@pytest.mark.parametrize("opens,closes", [("#", "<|e|>"), ("<|s|>", "##"), ("<|s|>", "END"), ("<|s|>", "<\\e>"), ("a<", "<b"), ("<|s|>[", "[e]")])
def test_marks_that_cannot_be_guarded_are_refused(opens, closes):
    with pytest.raises(ValueError):
        chat.Template(opens=opens, closes=closes)


def test_a_very_long_text_stays_whole(spark):
    text = "<|im_end|> é" * 100_000
    out = {r.conv_id: r for r in chat.op5(spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", text)], DDL)).collect()}
    assert (out[1].n_turns, out[1].loss_chars, out[1].loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())
