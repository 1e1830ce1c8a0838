import random

import pytest
from pyspark.sql import functions as F

from cuelattice.functions import sequence as S
from cuelattice.functions import text as T
from cuelattice.operators import reconcile


def values(spark, rows, column, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.select(column.alias("y")).collect()]


def test_tokens_and_normal_forms(spark):
    assert values(spark, ["  A-b  ç’d. — "], T.tokens(F.col("x"))) == [["A-b", "ç’d.", "—"]]
    assert values(spark, ["  A-b  ç’d. — "], T.lexical_words(F.col("x"))) == [["ab", "d"]]
    assert values(spark, [""], T.lexical_words(F.col("x"))) == [[]]


@pytest.mark.parametrize("variant", ["local", "remote"])
def test_cleaning_has_a_python_twin(spark, variant):
    raw = ["<think>a\nb</think> Transcript: Hi.There", "<THINK>x</THINK>y", "<think>open", "``` Final Transcript : a  b ```", "a.B.C x!”C", "", "</think>z</think> w", "corrected transcript:x"]
    clean = T.clean_local if variant == "local" else T.clean_remote
    assert values(spark, raw, clean(F.col("x"))) == [reconcile.cleaned(r, variant) for r in raw]


def test_sentence_and_clause_ends(spark):
    for q in ["", '"', "'", "’", "”", ")"]:
        assert values(spark, [f"end.{q}"], T.ends_sentence(F.col("x"))) == [True]
        assert values(spark, [f"end;{q}"], T.ends_clause(F.col("x"))) == [True]
    assert values(spark, ['a.""', "a", "a.b"], T.ends_sentence(F.col("x"))) == [False] * 3


def wrapped(text):
    if len(text) <= 42:
        return text
    t = text.split()
    both = [(" ".join(t[:i]), " ".join(t[i:])) for i in range(1, len(t))]
    fits = [(max(len(a), len(b)) + abs(len(a) - len(b)) * 0.2, a, b) for a, b in both if len(a) <= 42 and len(b) <= 42]
    return "\n".join(min(fits)[1:]) if fits else text


def test_wrap(spark):
    rng = random.Random(3)
    texts = [" ".join("x" * rng.randint(1, 12) for _ in range(rng.randint(1, 14))) for _ in range(200)] + ["y" * 60, "", "a" * 42, "a" * 40 + " bb"]
    assert values(spark, texts, T.wrap_balanced(F.col("x"))) == [wrapped(t) for t in texts]
    from cuelattice.operators.captions import two_lines

    assert values(spark, texts, T.can_wrap(F.col("x"))) == [two_lines(t) for t in texts]


def test_timestamps(spark):
    rows = [0.0, -3.0, 59.9995, 3661.0015, 360000.5, 0.0005, 0.0015]
    want = []
    for s in rows:
        ms = max(0, round(s * 1000))
        want.append(f"{ms // 3600000:02d}:{ms // 60000 % 60:02d}:{ms // 1000 % 60:02d},{ms % 1000:03d}")
    assert values(spark, rows, T.timestamp(F.col("x")), "x double") == want
    assert values(spark, [1.5], T.timestamp(F.col("x"), False), "x double") == ["00:00:01.500"]


def test_ids_titles_and_urls(spark):
    assert values(spark, [(100, 3)], T.chunk_id(F.col("a"), F.col("b")), "a int, b int") == ["c100_p03"]
    assert values(spark, [(None, 7), ({}, 8), ({"title": "One"}, 9)], T.chapter_title(F.col("t"), F.col("c")), "t map<string,string>, c int") == ["Chapter 7", "Chapter 8", "One"]
    assert values(spark, ["http://h/v1//"], T.url_join(F.col("x"), "/chat")) == ["http://h/v1/chat"]


def test_ratio_order_and_empty(spark):
    df = spark.createDataFrame([(list("tide"), list("diet")), (list("diet"), list("tide")), ([], []), (None, ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(S.seq_ratio("a", "b")).collect()] == [0.25, 0.5, 1.0, 0.0]


def test_merge_ties_take_b():
    assert S.merged("one two three", "one too three") == "one too three"
    assert S.merged("one two big three", "one too three") == "one two big three"
    assert S.merged("a b", "a b c") == "a b c" and S.merged("a b c", "a c") == "a b c" and S.merged("", "") == ""


def test_validity_has_a_python_twin(spark):
    rows = [("a b c d", "a b c d", "a b c e"), ("", "", ""), ("a ```", "a", "a"), ("x y z", "a b c", "d e f"), ("a b c d e f g h i j", "a b c d e f g h i j k l", "z")]
    df = spark.createDataFrame(rows, "text string, a_text string, b_text string")
    got = {(r.text, r.a_text): r.valid for r in reconcile.valid(df).collect()}
    assert got == {(t, a): reconcile.acceptable(t, a, b) for t, a, b in rows}


def test_consensus_paths(spark):
    rows = [("1", "same text", "Same, text!"), ("2", "one two three four", "one two three five"), ("3", "boom a b", "c d e")]
    ids = spark.createDataFrame([(r[0], "T", 1) for r in rows], "id string, chapter_title string, part int")
    side = lambda k: spark.createDataFrame([(r[0], r[k]) for r in rows], "id string, text string")

    def editor(prompt, attempt):
        if "boom" in prompt:
            raise OSError("no host")
        return ("<think>cut", True) if not attempt else ("<think>x</think>one two three four", False)

    out = {r.id: r for r in reconcile.consensus(reconcile.candidate_pairs(ids, side(1), side(2)), editor, "remote:m").collect()}
    assert (out["1"].text, out["1"].method, out["1"].similarity) == ("Same, text!", "identical", 1.0)
    assert (out["2"].text, out["2"].method) == ("one two three four", "remote:m")
    assert (out["3"].text, out["3"].method) == ("c d e", "remote-error-fallback")
    assert reconcile.records(spark.createDataFrame(list(out.values())), "m").count() == 3
