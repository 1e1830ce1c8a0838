"""Segmentation, timing, repair and report against plain loops."""

import random
import re

from pyspark.sql import functions as F

from cuelattice.operators import captions as C

WORDS = "doc_id long, pos int, text string, start double, end double"


def made(seed, docs=6, n=120):
    rng, rows = random.Random(seed), []
    for d in range(docs):
        at = 0
        for p in range(n):
            text = "w" * rng.randint(1, 11) + rng.choice(["", "", "", ".", ",", ".”", "?)", ";", "y" * 45 if rng.random() < 0.02 else ""])
            long = rng.choice([0, 60, 200, 900]) if rng.random() < 0.9 else 3000
            rows.append((d, p, text, at / 1000, (at + long) / 1000))
            at += long + rng.choice([0, 0, 40, 300, 999, 1000])
    return rows


def loop(words):
    out, current = [], []
    for w in words:
        if current:
            text = " ".join(x[2] for x in current).strip()
            cand, dur = f"{text} {w[2]}", current[-1][4] - current[0][3]
            cut = w[3] - current[-1][4] >= 1.0 or len(cand) > 78 or (len(cand) > 42 and not C.two_lines(cand))
            cut = cut or (w[4] - current[0][3] > 6.5 and dur >= 1.0)
            cut = cut or bool(re.search("[.!?][\"'’”)]?$", current[-1][2]) and dur >= 1.0 and len(text) >= 20)
            cut = cut or bool(re.search("[,;:][\"'’”)]?$", current[-1][2]) and dur >= 3.5 and len(text) >= 48)
            if cut:
                out.append(current)
                current = []
        current.append(w)
    return out + ([current] if current else [])


def finish(groups):
    cues = []
    for i, g in enumerate(groups):
        start, raw = g[0][3], max(w[4] for w in g)
        nxt = groups[i + 1][0][3] if i + 1 < len(groups) else raw + 1.0
        want = min(max(raw + 0.08, start + 0.8), start + 6.5)
        end = min(want, nxt - 0.04) if nxt > start + 0.08 else min(raw, start + 6.5)
        cues.append([start, max(end, start + 0.08)])
    for a, b in zip(cues, cues[1:]):
        if a[1] >= b[0]:
            if b[0] <= a[0]:
                a[1] = min(a[0] + 6.5, max(a[1], a[0] + 0.8))
                b[0] = a[1] + 0.04
            else:
                a[1] = max(a[0] + 0.01, b[0] - 0.04)
    return cues


def test_cues_match_a_loop(spark):
    rows = made(1) + [(99, i, "aaaaaaaa", 10.0, 10.0) for i in range(12)] + [(99, 12, "late", 10.5, 10.6)]
    df = spark.createDataFrame(rows, WORDS)
    cut = C.segment(C.islands(df, "doc_id"), "doc_id")
    timed = C.timed(C.cues(cut, "doc_id"), "doc_id")
    fixed = {(r.doc_id, r.cue): r for r in C.repair(timed, "doc_id").collect()}
    for d in {r[0] for r in rows}:
        groups = loop([r for r in rows if r[0] == d])
        want = finish(groups)
        assert sum(1 for k in fixed if k[0] == d) == len(groups)
        for i, (g, (s, e)) in enumerate(zip(groups, want), 1):
            r = fixed[d, i]
            assert r.text == " ".join(w[2] for w in g).strip() and r.n_words == len(g)
            assert abs(r.start - s) < 1e-9 and abs(r.end - e) < 1e-9
    # coincident starts invert a cue: the report shows it, overlaps do not
    chunks = spark.createDataFrame([(99, 0, "c00_p01", False)], "doc_id long, chunk_pos int, id string, surface_restored boolean")
    report = C.report(C.repair(timed, "doc_id").where("doc_id = 99"), df.where("doc_id = 99"), chunks, "doc_id").first()
    assert report.inverted_cues >= 1 and report.overlap_count == 0 and report.surface_restore_failures == ["c00_p01"]
    assert report.zero_duration_words_from_aligner_quantization == 12


def test_gap_is_inclusive(spark):
    df = spark.createDataFrame([(1, 0, "a", 0.0, 1.0), (1, 1, "b", 2.0, 2.5), (1, 2, "c", 3.499, 4.0)], WORDS)
    assert [r.island for r in C.islands(df, "doc_id").orderBy("pos").collect()] == [1, 2, 2]


def test_no_words(spark):
    empty = spark.createDataFrame([], WORDS)
    chunks = spark.createDataFrame([(1, 0, "c", True)], "doc_id long, chunk_pos int, id string, surface_restored boolean")
    cues = C.repair(C.timed(C.cues(C.segment(C.islands(empty, "doc_id"), "doc_id"), "doc_id"), "doc_id"), "doc_id")
    r = C.report(cues, empty, chunks, "doc_id").first()
    assert (r.chunks, r.cues, r.words, r.first_cue_start, r.max_cps) == (1, 0, 0, None, 0)


def test_render_and_transcript(spark):
    cue = spark.createDataFrame([(1, 1, 0.0, 1.5, "Hi\nthere")], "doc_id long, cue long, start double, end double, text string")
    assert C.srt_blocks(cue, "doc_id").first().block == "1\n00:00:00,000 --> 00:00:01,500\nHi\nthere\n\n"
    assert C.vtt_blocks(cue, "doc_id").first().block == "00:00:00.000 --> 00:00:01.500\nHi\nthere\n\n"
    rows = [("b", 0, 1, "One", " a "), ("b", 1, 1, "One", "b"), ("b", 2, 2, "Two", "c")]
    parts = C.transcript_parts(spark.createDataFrame(rows, "book string, chunk_pos int, chapter_id int, chapter_title string, text string"), "book").orderBy("chunk_pos").collect()
    assert "".join(p.part for p in parts) + "\n" == "One\n\na b \n\nTwo\n\nc \n"


def test_word_order_ties(spark):
    rows = [("b", 1, 0, "x", 1.0, 1.0), ("b", 0, 1, "y", 1.0, 1.0), ("b", 0, 0, " ", 0.0, 0.0), ("b", 0, 2, "z", 0.5, 2.0)]
    df = spark.createDataFrame(rows, "book string, chunk_pos int, word_pos int, text string, start double, end double")
    assert [r.text for r in C.sorted_words(df, "book").orderBy("pos").collect()] == ["z", "y", "x"]


def test_constants_are_used():
    assert not C.two_lines("a" * 43) and C.two_lines("a" * 42 + " " + "b" * 42) and not C.two_lines("a" * 43 + " b")
    assert F is not None


def test_cut_gives_the_cues_of_segments(spark):
    odd = [(7, 0, " a", 0.0, 0.5), (7, 1, "b  c", 0.6, 0.9), (7, 2, None, 0.9, 1.0), (7, 3, "d\u00a0e " * 9, 1.0, 2.2), (7, 4, "f.", 2.2, 2.4), (None, 0, "g", 0.0, 1.0), (None, 1, "h", 2.5, 3.0)]
    df = spark.createDataFrame(made(3, docs=5, n=300) + odd, WORDS)
    want = C.cues(C.segment(C.islands(df.where("text IS NOT NULL"), "doc_id"), "doc_id"), "doc_id")
    got = C.cut(df, "doc_id")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_repair_keeps_all_columns(spark):
    df = spark.createDataFrame([("b", i, "t%d" % i, float(i), i + 1.5) for i in range(1, 30)], "book string, cue long, text string, start double, end double")
    rows = C.repair(df, "book").orderBy("cue").collect()
    assert [r.text for r in rows] == ["t%d" % i for i in range(1, 30)] and [r.end for r in rows][:2] == [1.96, 2.96] and rows[-1].end == 30.5
