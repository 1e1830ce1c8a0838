"""Whole jobs with stand-in models."""

import glob
import hashlib
import json
import os
import threading
import wave
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from cuelattice.operators import backends, reconcile
from cuelattice.plans import job as J


def media(spark, job):
    rng = np.random.default_rng(2)
    chapters = [(job["id"], 0, "One fine day, it began.", 0, 30_000), (job["id"], 1, "The end?", 30_000, 31_999)]
    audio = [(job["id"], at, rng.normal(size=1000).tolist()) for at in range(0, 31_000, 1000)]
    return spark.createDataFrame(chapters, "book_id string, chapter_id int, chapter_title string, start_frame long, end_frame long"), spark.createDataFrame(audio, "book_id string, start_frame long, samples array<float>")


def told(tmp_path, name, **more):
    return {"id": name, "work_dir": f"{tmp_path}/w-{name}", "output_dir": f"{tmp_path}/o-{name}", "basename": f"book_{name}", **more}


def test_job_and_queue(spark, tmp_path):
    job = told(tmp_path, "b")
    report = J.run_job(spark, job, media=media, rate=100).first()
    assert report.chunks == 3 and report.words == 12 and report.cues >= 2 and report.overlap_count == 0 and report.surface_restore_failures == []
    out = job["output_dir"]
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == ["SHA256SUMS", "book_b.en.srt", "book_b.en.vtt", "book_b.transcript.txt", "book_b.word_timestamps.json", "subtitle_qc.json"]
    srt = open(f"{out}/book_b.en.srt").read()
    assert srt.startswith("1\n00:00:00,000 --> ") and srt.endswith("\n\n") and not srt.endswith("\n\n\n") and srt.count(" --> ") == report.cues
    assert open(f"{out}/book_b.en.vtt").read().startswith("WEBVTT\n\n00:00:00.000 --> ")
    assert open(f"{out}/book_b.transcript.txt").read().startswith("One fine day, it began.\n\nOne fine day, it began. ")
    words = json.load(open(f"{out}/book_b.word_timestamps.json"))
    assert len(words) == 12 and list(words[0]) == ["text", "start", "end"]
    qc = json.load(open(f"{out}/subtitle_qc.json"))
    assert len(qc) == 13 and qc["cues"] == report.cues and qc["surface_restore_failures"] == []
    sums = dict(reversed(line.split("  ")) for line in open(f"{out}/SHA256SUMS").read().splitlines())
    assert sums == {n: hashlib.sha256(open(f"{out}/{n}", "rb").read()).hexdigest() for n in ("book_b.en.srt", "book_b.en.vtt")}
    assert spark.read.parquet(f"{job['work_dir']}/fused").agg({"fused_word_timings": "sum"}).first()[0] == 12
    assert spark.read.parquet(f"{job['work_dir']}/first/wave=*").where("elapsed_seconds >= 0").count() == 3
    jobs = [job, told(tmp_path, "c"), told(tmp_path, "d")]
    assert J.run_queue(spark, jobs, media=media, rate=100) == ["c", "d"] and J.run_queue(spark, jobs, media=media, rate=100) == []


def counted(folder, name, broken=None):
    """A recogniser that leaves a file for each call and fails at one chunk."""

    def factory():
        def recognise(chunk):
            open(f"{folder}/{name}-{chunk['id']}-{os.getpid()}-{len(os.listdir(folder))}", "w").close()
            if chunk["id"] == broken:
                raise RuntimeError("broken off")
            return backends.even_spread(chunk)

        return recognise

    return factory


def test_a_broken_run_goes_on_by_chunks(spark, tmp_path):
    calls, job = tmp_path / "calls", told(tmp_path, "b")
    calls.mkdir()
    of = lambda name, chunk: len(glob.glob(f"{calls}/{name}-{chunk}-*"))
    models = lambda broken: J.Models(counted(calls, "a", broken), counted(calls, "b"), lambda: J.spread_text, backends.second_candidate, "remote:x")
    with pytest.raises(Exception, match="broken off"):
        J.run_job(spark, job, models("c00_p02"), media, rate=100, wave=1)
    assert of("a", "c00_p01") == 1 and of("b", "c00_p01") == 0 and of("a", "c01_p01") == 0
    J.run_job(spark, job, models(None), media, rate=100, wave=1)
    assert of("a", "c00_p01") == 1 and of("a", "c01_p01") == 1 and of("b", "c00_p01") == 1


def test_failed_edits_are_asked_for_again(spark, tmp_path):
    def differs():
        return lambda chunk: ("a completely other text", [("a", 0.0, 0.5)])

    def fails(prompt, attempt):
        raise OSError("no server")

    job = told(tmp_path, "b", glossary=str(tmp_path / "terms.txt"))
    (tmp_path / "terms.txt").write_text("Ada, Bly\n")
    models = lambda editor: J.Models(backends.even_spread_factory, differs, lambda: J.spread_text, editor, "remote:x")
    book = J.prepare(spark, job, models(fails), media, rate=100)
    assert {r.method for r in J.edit(spark, book, models(fails)).collect()} == {"remote-error-fallback"}
    right = lambda prompt, attempt: (prompt.partition("CANDIDATE A:\n")[2].partition("\n\nCANDIDATE B:")[0] if "Ada, Bly" in prompt else "", False)
    assert {r.method for r in J.edit(spark, book, models(right)).collect()} == {"remote:x"}
    assert spark.read.parquet(f"{job['work_dir']}/consensus/wave=0").count() == 3  # the failed ones stay as they were


def test_job_from_a_wave_file(spark, tmp_path):
    rng = np.random.default_rng(3)
    with wave.open(str(tmp_path / "in.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(16_000)
        sound = (rng.normal(size=16_000 * 300) * 3000).astype("<i2")
        sound[16_000 * 205 : 16_000 * 215] = 0  # a quiet place
        w.writeframes(sound.tobytes())
    (tmp_path / "in.json").write_text(json.dumps({"chapters": [{"id": 0, "start_time": "0.0", "end_time": "310.0", "tags": {"title": "Far too long"}}]}))
    job = told(tmp_path, "w", source=str(tmp_path / "in.wav"))
    chunks = J.prepare(spark, job).plan.orderBy("chunk_pos").collect()
    assert [r.end_frame for r in chunks][-1] == 16_000 * 300 and len(chunks) == 2 and abs(chunks[0].end - 210) <= 0.05
    (manifest,) = glob.glob(f"{job['work_dir']}/manifest/part-*")
    assert [c["id"] for c in json.load(open(manifest))["chunks"]] == ["c00_p01", "c00_p02"]


class Stub(BaseHTTPRequestHandler):
    protocol_version = "HTTP/1.1"
    asked: list[dict] = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Stub.asked.append({"path": self.path, **body})
        user = body["messages"][1]["content"]
        if "boom" in user:
            self.send_response(500)
            self.send_header("Content-Length", "0")
            self.end_headers()
            return
        cut = body.get("max_tokens") == 4096 and "long" in user
        text = "half" if cut else user.partition("CANDIDATE A:\n")[2].partition("\n\nCANDIDATE B:")[0]
        answer = {"choices": [{"message": {"content": f"<think>x</think>Transcript: {text}"}, "finish_reason": "length" if cut else "stop"}]} if "completions" in self.path else {"message": {"content": text}, "done_reason": "stop"}
        data = json.dumps(answer).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *_):
        pass


def test_editor_over_http(spark):
    server = ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        base = f"http://127.0.0.1:{server.server_port}/v1/"
        editor = backends.HttpEditor(base, "m", system="be exact")
        rows = [("1", "T", 1, "one two three four long", "one two three five long"), ("2", "T", 2, "boom is here now", "boom is there now"), ("3", "T", 3, "same words", "Same words!"), ("4", "T", 4, "red green blue", "red green blues")]
        side = lambda i: spark.createDataFrame([(r[0], r[i]) for r in rows], "id string, text string")
        pairs = reconcile.candidate_pairs(spark.createDataFrame([r[:3] for r in rows], "id string, chapter_title string, part int"), side(3), side(4))
        out = {r.id: r for r in reconcile.consensus(pairs.coalesce(1), editor, "remote:m").collect()}
        assert out["1"].text == rows[0][3] and out["1"].method == "remote:m"
        assert out["2"].method == "remote-error-fallback" and out["3"].method == "identical" and out["4"].text == "red green blue"
        assert all(r.elapsed_seconds >= 0 for r in out.values())
        long = [a for a in Stub.asked if "long" in a["messages"][1]["content"]]
        assert [a["max_tokens"] for a in long] == [4096, 8192] and long[1]["messages"][1]["content"].endswith(backends.AGAIN) and long[0]["messages"][0]["content"] == "be exact"
        chat = backends.HttpEditor(base, "m", style="chat")
        assert chat("CANDIDATE A:\nhi\n\nCANDIDATE B:", 1) == ("hi", False) and Stub.asked[-1]["path"] == "/v1/api/chat" and Stub.asked[-1]["options"]["num_predict"] == 8192
        with pytest.raises(ValueError):
            backends.HttpEditor(base, "m", style="other")
        with pytest.raises(OSError):
            backends.HttpEditor("http://127.0.0.1:1", "m", connect=0.5)("x", 0)
    finally:
        server.shutdown()


def test_plan_clips_chapters_and_needs_room(spark):
    from cuelattice.operators import chunks

    chapters, audio = media(spark, {"id": "b"})
    late = chapters.union(spark.createDataFrame([("b", 2, "after the end", 40_000, 50_000)], chapters.schema))
    out = chunks.plan(late, audio, rate=100).orderBy("start_frame").collect()
    assert out[-1].end_frame == 31_000 and {r.chapter_id for r in out} == {0, 1}
    with pytest.raises(ValueError, match="no room"):
        chunks.plan(chapters, audio, rate=100, longest=100.0)
    # other blocks of the same audio give the same plan
    whole = audio.groupBy("book_id").agg(F.lit(0).cast("long").alias("start_frame"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("start_frame", "samples"))), lambda x: x["samples"])).alias("samples"))
    assert chunks.plan(late, whole, rate=100).orderBy("start_frame").collect() == out
