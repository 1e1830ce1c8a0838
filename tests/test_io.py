"""Sources, sinks, backends and incremental runs."""

import glob
import json
import wave

import numpy as np
import pytest

from cuelattice.operators import backends
from cuelattice.sources import readers, schemas, sinks
from cuelattice.streaming import incremental


def test_records_last_wins_and_malformed(spark, tmp_path):
    p = tmp_path / "r.jsonl"
    p.write_text('{"id":"a","text":"1"}\n\n{"id":"b","text":"2"}\n{"id":"a","text":"3"}\n')
    out = readers.records(spark, str(p), "id string, text string")
    assert [(r.id, r.text) for r in out.orderBy("first_pos").collect()] == [("a", "3"), ("b", "2")]
    p.write_text('{"id":\n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.records(spark, str(p), "id string, text string").collect()
    assert readers.records(spark, str(tmp_path / "none"), "id string, text string", missing_ok=True).count() == 0
    with pytest.raises(Exception, match="(?i)path"):
        readers.records(spark, str(tmp_path / "none"), "id string, text string")


def test_manifest_and_chapters(spark, tmp_path):
    probe = tmp_path / "p.json"
    probe.write_text(json.dumps({"chapters": [{"id": 0, "start_time": "0.0", "end_time": "1.5", "tags": {"title": "One"}}, {"id": 1, "start_time": "1.5", "end_time": "2"}]}))
    got = readers.chapters(spark, str(probe)).collect()
    assert [(r.chapter_title, r.start_frame, r.end_frame) for r in got] == [("One", 0, 24000), ("Chapter 1", 24000, 32000)]
    probe.write_text("{}")
    with pytest.raises(Exception, match="no chapters"):
        readers.chapters(spark, str(probe)).collect()
    chunk = spark.createDataFrame([("b", 1, "c00_p02", 0, "T", 2, 5, 9, 0.1, 0.2, 0.1), ("b", 0, "c00_p01", 0, "T", 1, 0, 5, 0.0, 0.1, 0.1)], "book_id string, chunk_pos int, " + schemas.CHUNK)
    sinks.write_manifest(chunk, str(tmp_path / "m"), "a.wav")
    back = readers.manifest(spark, str(tmp_path / "m")).orderBy("chunk_pos").collect()
    assert [r.id for r in back] == ["c00_p01", "c00_p02"] and back[0].book_id == "a.wav"


def test_audio(spark, tmp_path):
    def save(name, channels, rate):
        with wave.open(str(tmp_path / name), "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(2)
            w.setframerate(rate)
            w.writeframes(np.arange(10 * channels, dtype="<i2").tobytes())

    save("ok.wav", 1, 16_000)
    out = readers.audio(spark, str(tmp_path / "ok.wav"), block=4).orderBy("start_frame").collect()
    assert [r.start_frame for r in out] == [0, 4, 8] and abs(out[1].samples[0] - 4 / 32768) < 1e-9
    save("bad.wav", 2, 16_000)
    with pytest.raises(Exception, match="expected mono"):
        readers.audio(spark, str(tmp_path / "bad.wav")).collect()


def write_config(tmp_path, jobs, **more):
    p = tmp_path / "q.json"
    p.write_text(json.dumps({"jobs": jobs, **more}))
    return str(p)


def test_queue(spark, tmp_path):
    jobs, editor, runtime = readers.queue(spark, write_config(tmp_path, [{"id": "one", "source": "in.m4b"}]), "/root/p")
    r = jobs.first()
    assert (r.source, r.work_dir, r.output_dir, r.basename, r.glossary) == ("/root/p/in.m4b", "/root/p/work/one", "/root/p/output/one", "one", None)
    assert editor["base_url_env"] == "EDITOR_BASE_URL" and runtime["whisper_input_group_size"] == 1
    for jobs, message in (
        ([{"id": "a", "source": "s"}, {"id": "a", "source": "t"}], "duplicate job id"),
        ([{"id": "a", "source": "s", "output_basename": "../x"}], "unsafe characters"),
        ([{"id": "a\n", "source": "s", "output_basename": "b\nc"}], "unsafe characters"),
        ([{"id": "a", "source": " "}], "non-empty"),
        ([], "non-empty array"),
    ):
        with pytest.raises(ValueError, match=message):
            readers.queue(spark, write_config(tmp_path, jobs), "/r")
    with pytest.raises(ValueError, match="positive"):
        readers.queue(spark, write_config(tmp_path, [{"id": "a", "source": "s"}], runtime={"qwen_batch_size": 0}), "/r")


def test_block_files_keep_order(spark, tmp_path):
    rows = spark.createDataFrame([("x", i, f"{i}\n") for i in range(50, 0, -1)] + [("y", 1, "only\n")], "book string, cue long, block string")
    sinks.write_blocks(rows, str(tmp_path / "vtt"), "book", "cue", head="WEBVTT\n\n")
    (f,) = glob.glob(str(tmp_path / "vtt/book=x/part-*"))
    assert open(f).read() == "WEBVTT\n\n" + "".join(f"{i}\n" for i in range(1, 51))
    assert sinks.hashes(spark, f).count() == 1


def test_purge_is_a_new_version(spark, tmp_path):
    rows = spark.createDataFrame([("1", "remote-error-fallback"), ("2", "identical")], "id string, method string")
    sinks.append_records(rows, str(tmp_path / "a"))
    assert [r.id for r in sinks.purge(spark, str(tmp_path / "a"), str(tmp_path / "b"), "id string, method string").collect()] == ["2"]
    assert spark.read.json(str(tmp_path / "a")).count() == 2
    sinks.mark_complete(spark, str(tmp_path / "done"), "job")
    assert spark.read.parquet(str(tmp_path / "done")).first().id == "job"


def test_resume_takes_new_files_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    add = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).write.mode("append").json(src)
    run = lambda: incremental.resume(spark, src, "id string", lambda d: d.selectExpr("id", "upper(id) AS text"), out, ck)
    add(["a", "b", "a"])
    run()
    run()
    add(["b", "c"])
    run()
    assert sorted(r.text for r in incremental.results(spark, out).collect()) == ["A", "B", "C"]


def test_word_sessions(spark, tmp_path):
    rows = spark.createDataFrame([("b", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:00.5"), ("b", "2024-01-01 00:00:02")], "book string, t string").selectExpr("book", "timestamp(t) AS t")
    rows.write.parquet(str(tmp_path / "w"))
    stream = incremental.word_sessions(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "w")), "book", "t")
    q = stream.writeStream.outputMode("complete" if False else "append").format("memory").queryName("sessions").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = incremental.word_sessions(rows, "book", "t").collect()
    assert sorted(r.words for r in batch) == [1, 2]


def test_backend(spark):
    rows = spark.createDataFrame([("c00_p01", 0, "two words", 1, 0, 32000, 10.0, 12.0, 2.0)], schemas.CHUNK)
    r = backends.transcribe(rows, backends.even_spread_factory, "stand-in").first()
    assert r.text == "two words" and [(w.text, w.start, w.end) for w in r.words] == [("two", 10.0, 11.0), ("words", 11.0, 12.0)]
    assert backends.second_candidate("x CANDIDATE B:\nhi\n\nReturn only the", 0) == ("hi", False)


def test_verification(spark):
    row = spark.createDataFrame([(("12.5", "99"), [], [(0,), (1,)])], schemas.MEDIA)
    from pyspark.sql import functions as F

    r = readers.verification(row, F.lit("12.0")).first()
    assert (r.source_duration, r.output_duration, r.output_size, r.chapter_count) == (12.0, 12.5, 99, 2)
