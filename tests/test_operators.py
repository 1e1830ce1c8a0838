"""Fusion, surface restoring, records, planning."""

import random

import numpy as np
import pytest

from cuelattice.operators import captions, chunks, fusion, records, surface


def fuse_loop(words):
    cands = [(i, w[4]) for i, w in enumerate(words) if w[4] is not None]
    ok = {}
    for k, (i, delta) in enumerate(cands):
        near = sorted(d for _, d in cands[max(0, k - 4) : k + 5] if abs(d) <= 4.0)
        ok[i] = bool(near) and abs(delta) <= 4.0 and abs(delta - near[len(near) // 2]) <= 0.8
    out, prev = [], float("-inf")
    for i, (_, _, s, e, d) in enumerate(words):
        if ok.get(i):
            s, e = min(s, s + d), max(e, e + d)
        s = round(max(prev, s), 3)
        out.append([s, max(round(e, 3), s)])
        prev = s
    for i, w in enumerate(out):
        nxt = out[i + 1][0] if i + 1 < len(out) else w[0] + 1.5
        w[1] = round(min(w[1], min(w[0] + 1.5, nxt) if nxt > w[0] else w[0] + 1.5), 3)
    return out, ok


def test_fusion_matches_a_loop(spark):
    rng, rows = random.Random(4), []
    for d in range(5):
        at = 0
        for p in range(80):
            n = rng.choice([50, 300, 2500])
            rows.append((d, p, at / 1000, (at + n) / 1000, rng.choice([None, 0.1, 0.2, -0.3, 1.5, 4.3, -4.3])))
            at += n - rng.choice([0, 0, 20])
    df = spark.createDataFrame(rows, "id long, pos int, start double, end double, delta double")
    df = df.selectExpr("*", "start + delta AS w_start", "end + delta AS w_end")
    acc = fusion.anchors(df.where("delta IS NOT NULL"), ["id"], "pos").select("id", "pos", "accepted")
    got = {(r.id, r.pos): r for r in fusion.fuse(df.join(acc, ["id", "pos"], "left"), ["id"]).collect()}
    for d in range(5):
        want, ok = fuse_loop([r for r in rows if r[0] == d])
        for i, (s, e) in enumerate(want):
            assert got[d, i].accepted == ok.get(i)
            assert abs(got[d, i].new_start - s) < 1e-9 and abs(got[d, i].new_end - e) < 1e-9
            assert got[d, i].new_end <= got[d, i].new_start + 1.5 + 1e-9
        assert all(a[0] <= b[0] for a, b in zip(want, want[1:]))


def test_compose(spark):
    pairs = lambda x: spark.createDataFrame(x, "id int, i int, j int")
    out = fusion.compose(pairs([(1, 0, 5), (1, 1, 6)]), pairs([(1, 5, 9), (2, 6, 1)]), ["id"]).collect()
    assert [(r.a_idx, r.q_idx, r.w_idx) for r in out] == [(0, 5, 9)]


def test_missing_times(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a", None, 1.0), ("b", 1.0, None)], "text string, start double, end double")
    assert [tuple(r) for r in fusion.repair_times(df, F.lit(9.0)).collect()] == [("b", 1.0, 9.0)]


S, I = "id int, pos int, text string", "id int, pos int, text string, start double, end double"


def test_restore_and_its_failures(spark):
    surfaces = [(1, 0, "It’s"), (1, 1, "A-OK."), (2, 0, "a"), (2, 1, "—"), (2, 2, "b"), (3, 0, "x"), (4, 0, "…")]
    items = [(1, 0, "its", 0.0, 1.0), (1, 1, "a", 1.0, 2.0), (1, 2, "ok", 2.0, 3.0), (2, 0, "a", 0.0, 1.0), (2, 1, "b", 1.0, 2.0), (3, 0, "y", 0.0, 1.0), (4, 0, "!", 0.0, 1.0)]
    out = surface.restore(spark.createDataFrame(surfaces, S), spark.createDataFrame(items, I), "id").collect()
    got = {(r.id, r.pos): (r.text, r.start, r.end, r.restored) for r in out}
    # It’s loses its curly mark in both forms; the dash has no letters and fails its chunk; other characters fail theirs
    assert got[1, 0] == ("It’s", 0.0, 1.0, True) and got[1, 1] == ("A-OK.", 1.0, 3.0, True)
    assert [k for k, v in got.items() if not v[3]].sort() == [(2, 0), (2, 1), (3, 0), (4, 0)].sort() and len(got) == 6
    assert got[2, 1] == ("b", 1.0, 2.0, False)


def test_records(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "id string, seq int, v string")
    assert sorted(map(tuple, records.last_wins(rows, "id", "seq").select("id", "v", "first_pos").collect())) == [("a", "z", 1), ("b", "y", 2)]
    chunks_ = spark.createDataFrame([("a", 0), ("c", 1), ("d", 2)], "id string, chunk_pos int")
    assert sorted(r.id for r in records.pending(chunks_, rows).collect()) == ["c", "d"]
    with pytest.raises(ValueError, match="missing 2 records; first: c"):
        records.require_complete(chunks_, rows)
    methods = spark.createDataFrame([("1", "remote-error-FALLBACK"), ("2", None), ("3", "identical")], "id string, method string")
    assert sorted(r.id for r in records.purge_fallbacks(methods).collect()) == ["2", "3"]
    done = records.completeness(chunks_.selectExpr("'k' AS book", "id"), rows, "book", "id").first()
    assert (done.chunks, done.recorded, done.lines, done.complete) == (3, 1, 2, False)


def test_planner_invariants(spark):
    rng = np.random.default_rng(0)
    samples = rng.normal(size=100 * 2000).astype(np.float32)
    samples[100 * 205 : 100 * 215] = 0
    planner = chunks.Planner(100, 210.0, 30.0, 270.0)
    first, energies = planner.energies(samples, 0)
    cuts = list(planner.parts(energies, len(samples)))
    assert first == 0 and cuts[0][0] == 0 and cuts[-1][1] == len(samples) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert all(120 * 100 <= b - a <= 270 * 100 for a, b in cuts[:-1]) and abs(cuts[0][1] - 21_000) <= 5
    assert list(planner.parts(np.empty(0), 0)) == []
    # too few windows: the wanted end itself
    assert planner.quietest(energies, 0, 18_000 + 6_000 + 9) == 21_000
    # energies of a stretch that begins inside a cell add up to those of the whole
    at, part = planner.energies(samples[7:1007], 7)
    assert at == 7 // planner.cell and part.sum() == pytest.approx(float(np.square(samples[7:1007], dtype=np.float64).sum()))
    chapters = spark.createDataFrame([("b", 3, "T", 500, 500 + len(samples))], "book_id string, chapter_id int, chapter_title string, start_frame long, end_frame long")
    audio = spark.createDataFrame([("b", at, np.r_[np.zeros(500, np.float32), samples][at : at + 30_000].tolist()) for at in range(0, 500 + len(samples), 30_000)], "book_id string, start_frame long, samples array<float>")
    out = chunks.plan(chapters, audio, rate=100).orderBy("start_frame").collect()
    assert [(r.start_frame - 500, r.end_frame - 500) for r in out] == cuts and out[0].id == "c03_p01"
    with pytest.raises(Exception, match="no chapters"):
        chunks.summary(chunks.described(chapters.limit(0).selectExpr("book_id", "chapter_id", "chapter_title", "1 AS part", "start_frame", "end_frame"))).collect()


def test_surfaces_of_a_long_chunk(spark):
    """Against a loop over overlaps, with empty tokens inside and at the edges of items."""
    rng = random.Random(3)
    letters = "".join(rng.choice("abcdefgh") for _ in range(600))

    def cut(text, extra):
        out, at = [], 0
        while at < len(text):
            n = rng.randint(1, 7)
            out.append(text[at : at + n])
            at += n
            if rng.random() < extra:
                out.append("--")
        return out

    for extra in (0.0, 0.03):
        tokens, items = cut(letters, extra), cut(letters, 0.05)
        s = spark.createDataFrame([("x", i, t) for i, t in enumerate(tokens)], "id string, pos int, text string")
        i = spark.createDataFrame([("x", k, t, float(k), k + 0.5) for k, t in enumerate(items)], "id string, pos int, text string, start double, end double")
        bare = lambda t: t.replace("-", "")
        place = lambda parts: [(sum(len(bare(p)) for p in parts[:k]), sum(len(bare(p)) for p in parts[: k + 1])) for k in range(len(parts))]
        want = []
        for (lo, hi), t in zip(place(tokens), tokens):
            met = [k for k, (a, b) in enumerate(place(items)) if a < hi and b > lo]
            want.append((t, float(met[0]), met[-1] + 0.5, True) if met else None)
        got = [(r.text, r.start, r.end, r.restored) for r in surface.restore(s, i).orderBy("pos").collect()]
        assert got == (want if None not in want else [(t, float(k), k + 0.5, False) for k, t in enumerate(items)])


def test_repair_reads_a_book_in_order(spark):
    """Against a plain loop over lists, with equal and moved starts, in several books."""
    rng, rows = random.Random(4), []
    for book in "xyz":
        at = 0.0
        for cue in range(1, 120):
            at += rng.choice([0.0, 0.0, 0.3, 2.0, 7.0, 20.0])
            rows.append((book, cue, at, at + rng.choice([0.1, 1.0, 3.0, 6.5]), "t"))
    want = {}
    for book in "xyz":
        c = [[r[2], r[3]] for r in rows if r[0] == book]
        for k in range(len(c) - 1):
            (s0, e0), (s1, _) = c[k], c[k + 1]
            if e0 >= s1:
                if s1 <= s0:
                    c[k][1] = min(s0 + 6.5, max(e0, s0 + 0.8))
                    c[k + 1][0] = c[k][1] + 0.04
                else:
                    c[k][1] = max(s0 + 0.01, s1 - 0.04)
        want |= {(book, k + 1): tuple(x) for k, x in enumerate(c)}
    df = spark.createDataFrame(rows, "book string, cue long, start double, end double, text string").repartition(5)
    assert {(r.book, r.cue): (r.start, r.end) for r in captions.repair(df, "book").collect()} == want
