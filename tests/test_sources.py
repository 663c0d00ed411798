import io
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.audio import clips, dsp, frames
from corpusloom.operators import stages
from corpusloom.sources import epub, fetch, sinks, tables, vtt
from corpusloom.streaming import metrics

VTT = """WEBVTT

00:01.000 --> 00:02.500 align:start
First line
second “line”

NOTE asr-fallback
00:00:03.000 --> 00:00:04.000
dropped

01:00:05.000 --> 01:00:06.000
Last"""


def test_cues(spark):
    df = spark.createDataFrame([(1, VTT), (2, ""), (3, None), (4, VTT.replace("\n", "\r\n"))], "k int, t string")
    rows = [r.c for r in df.select(vtt.cues(F.col("t")).alias("c")).collect()]
    want = [(1.0, 2.5, 'First line second "line"'), (3605.0, 3606.0, "Last")]
    assert [tuple(c) for c in rows[0]] == want == [tuple(c) for c in rows[3]] and rows[1] == [] and rows[2] is None
    assert len(df.select(vtt.cues(F.col("t"), drop_fallback=False)).first()[0]) == 3
    strict = df.select(vtt.block_cues(F.col("t"))).first()[0]
    assert [c.text for c in strict] == ["dropped", "Last"]
    text = df.limit(1).select(vtt.vtt_text(vtt.cues(F.col("t")))).first()[0]
    again = spark.createDataFrame([(text,)], "t string").select(vtt.cues(F.col("t"))).first()[0]
    assert [tuple(c) for c in again] == want


def test_captions(spark):
    raw = "WEBVTT\nKind: captions\nLanguage: en\n\n00:00:01.000 --> 00:00:02.000\nA <c>one</c>\n\n00:00:02.000 --> 00:00:03.000\nA one\nA one more\nmore\nend"
    assert spark.createDataFrame([(raw,)], "t string").select(vtt.caption_text(F.col("t"))).first()[0] == "A one A one more end"


def test_metadata_round_trip(spark, tmp_path):
    rows = [("wavs/a.wav", 'say "hi, there', "ann", "train"), ("wavs/b.wav", "a|b", "ann", "eval")]
    df = spark.createDataFrame(rows, "audio_file string, text string, speaker_name string, split string")
    sinks.write_metadata(df, str(tmp_path / "out"))
    back = spark.read.option("sep", "|").option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert sorted((r.audio_file, r.text) for r in back.collect()) == [("wavs/a.wav", 'say "hi, there'), ("wavs/b.wav", "a/b")]
    (tmp_path / "metadata_train.csv").write_text('audio_file|text|speaker_name\nx.wav|"a ""b"" c"|ann\n')
    assert [tuple(r) for r in tables.read_metadata(spark, str(tmp_path / "metadata_train.csv")).select("audio_file", "text", "split").collect()] == [("x.wav", 'a "b" c', "train")]
    (tmp_path / "metadata_bad.csv").write_text("file|text|who\nx|y|z\n")
    with pytest.raises(Exception):
        tables.read_metadata(spark, str(tmp_path / "metadata_bad.csv")).collect()


def test_json_readers(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps([{"word": "a", "start": 0.0, "end": 1.0, "prob": 0.5}, {"word": "b", "start": 1, "end": 2, "prob": 1}]))
    assert [(r.pos, r.word) for r in tables.asr_words(spark, str(tmp_path / "w.json")).orderBy("pos").collect()] == [(0, "a"), (1, "b")]
    (tmp_path / "k.json").write_text(json.dumps({"files": {"x": {"regions": [{"curation_decision": "exclude", "snapped_start_sec": 1.0, "snapped_end_sec": 2.0}, {"curation_decision": "keep", "snapped_start_sec": 5.0, "snapped_end_sec": 6.0}]}}}))
    assert [tuple(r) for r in tables.keep_out_regions(spark, str(tmp_path / "k.json"), "x").collect()] == [(1.0, 2.0)]
    with pytest.raises(Exception, match="no regions"):
        tables.keep_out_regions(spark, str(tmp_path / "k.json"), "y").collect()
    (tmp_path / "c.jsonl").write_text('{"messages": [{"role": "user", "content": "x"}]}\nnot json\n')
    rows = tables.read_chat(spark, str(tmp_path / "c.jsonl")).collect()
    assert sorted(r._corrupt_record or "" for r in rows) == ["", "not json"]
    maps = spark.createDataFrame([("p", 10.0, [[-1.0, 1.0], [9.5, 20.0], [5.0, 5.0]])], "path string, duration double, silences array<array<double>>")
    assert sorted((r.start, r.end) for r in tables.silences(maps, 10).collect()) == [(0, 10), (95, 100)]
    levels = spark.createDataFrame([("p", i, v) for i, v in enumerate([0, 0, 9, 0, 0, 0])], "path string, frame int, level int")
    assert [(r.start, r.end) for r in tables.level_runs(levels, ["path"], "frame", "level", 1, 0.1).collect()] == [(0.1, 0.2)]
    log = spark.createDataFrame([("{'eval_loss': 3.5, 'epoch': 1.0}",), ("noise",), ("USABLE=9 SKIPPED=1 MEDOFF=0.1 P95OFF=0.4 MAXOFF=1.2",)], "value string")
    assert [tuple(r) for r in tables.eval_losses(log).collect()] == [(1.0, 3.5)] and tables.probe_summary(log).first().maxoff == 1.2


def test_channel_join_fails_on_a_missing_video(spark):
    v = spark.createDataFrame([("a", "long", "2020")], tables.VIDEOS)
    d = spark.createDataFrame([("a", ["t"], (0.1, 5))], tables.VERDICTS)
    s = spark.createDataFrame([({"a": ("t", "d", ["x"], "2020")}, [])], tables.SNIPPETS)
    assert tables.channel_rows(v, d, s).first().snippet.description == "d"
    with pytest.raises(Exception, match="no video"):
        tables.channel_rows(v, spark.createDataFrame([("b", ["t"], None)], tables.VERDICTS), s).collect()


def make_epub():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:x"><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></container>')
        z.writestr("OPS/p.opf", '<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="b" href="b.xhtml"/><item id="a" href="a%20x.xhtml"/><item id="m" href="gone.xhtml"/></manifest><spine><itemref idref="b"/><itemref idref="a"/><itemref idref="m"/></spine></package>')
        z.writestr("OPS/b.xhtml", "<h1>Two &amp; More</h1><p>second text</p>")
        z.writestr("OPS/a x.xhtml", "<p>first text</p>")
    return out.getvalue()


def test_epub(spark, tmp_path):
    (tmp_path / "x.epub").write_bytes(make_epub())
    books = epub.read_books(spark, str(tmp_path / "x.epub"))
    rows = books.orderBy("spine_idx").collect()
    assert [(r.file, r.heading, r.text.split()) for r in rows] == [("OPS/b.xhtml", "Two & More", ["Two", "&", "More", "second", "text"]), ("OPS/a x.xhtml", None, ["first", "text"]), ("OPS/gone.xhtml", None, [])]
    for w in epub.words(books).join(books, ["path", "spine_idx"]).collect():
        assert w.text[w.char_off :].startswith(w.word)
    assert epub.glossary_text(epub.read_books(spark, str(tmp_path / "x.epub"), "name")).first().text == "first text Two & More second text"


def test_fetch(spark):
    calls, waits = [], []

    def flaky(ids):
        calls.append(ids)
        if len(calls) < 3:
            raise OSError
        return {i: "x" for i in ids}

    assert fetch.with_retries(flaky, ["a"], sleep=waits.append) == ({"a": "x"}, 3) and waits == [1.0, 2.0]
    assert fetch.with_retries(lambda ids: 1 / 0, ["a"], tries=2, sleep=waits.append) == ({}, 2)
    wanted, done = (spark.createDataFrame([(x,) for x in xs], "id string") for xs in (["a", "b", "b", None], ["a"]))
    assert [(r.id, r.body, r.ok) for r in fetch.fetch_batches(wanted, done, lambda ids: {i: i * 2 for i in ids}).collect()] == [("b", "bb", True)]
    assert fetch.pace(5) == (60.0, False) and fetch.pace(25)[1] and fetch.pace(0) == (0.0, False)


def test_registry_sink(spark, tmp_path):
    path = str(tmp_path / "reg")
    a = spark.createDataFrame([("x", 1), ("y", 2)], "id string, n int")
    sinks.upsert_table(spark, path, a, "id")
    out = sinks.upsert_table(spark, path, spark.createDataFrame([("y", 9), ("z", 3)], "id string, n int"), "id")
    assert sorted(map(tuple, out.collect())) == [("x", 1), ("y", 9), ("z", 3)]
    sinks.append_metric(spark, str(tmp_path / "m"), "cut", temp=84.0, mhz=2000.0)
    row = tables.metrics(spark, str(tmp_path / "m")).first()
    assert row.stage == "cut" and json.loads(row.event)["temp"] == 84.0
    clips = spark.createDataFrame([(3.0,), (7.0,), (None,)], "seconds double")
    assert "| 0-5 s | 1 |" in sinks.cut_report(clips) and "0 clips" in sinks.cut_report(clips.limit(0))
    words = spark.createDataFrame([("s", 0, "Hi", "book", 0.0, 1.0), ("s", 1, "um", "whisper", 1.0, 1.1), ("s", 2, "there", "book", 3.0, 4.0)], "stem string, pos int, word string, source string, start_s double, end_s double")
    assert sinks.transcript(words, "stem").first().text == "Hi [um]\n\nthere"


def test_stages(spark):
    now = spark.createDataFrame([("p", s, 5, 7, n) for n, s in enumerate(("merge", "align", "verify", "cut"))], "part_set string, stage string, size long, mtime_ns long, n long")
    then = spark.createDataFrame([("p", "merge", 5, 7, 0, True), ("p", "align", 5, 8, 1, True), ("p", "verify", 5, 7, 2, False)], "part_set string, stage string, size long, mtime_ns long, n long, passed boolean")
    states = stages.stage_states(now, then)
    assert {r.stage: r.state for r in states.collect()} == {"merge": "done", "align": "stale", "verify": "failed", "cut": "missing"}
    assert stages.next_stages(states).first().next_stage == "align"
    raw = {"name": "x", "kind": "voice", "max_seq_length": 2048, "max_clip_seconds": 20.0, "epochs": 3, "batch": 4, "learning_rate": 1e-4, "assistant_only": True}
    assert stages.Profile.load(raw).epochs == 3
    for bad in ({**raw, "max_clip_seconds": 38.0}, {**raw, "epochs": "3"}, {**raw, "more": 1}, {k: v for k, v in raw.items() if k != "name"}, {**raw, "batch": 0}):
        with pytest.raises(ValueError):
            stages.Profile.load(bad)
    assert stages.parse_ranges("1-2.5, 4-5") == [(1.0, 2.5), (4.0, 5.0)]
    for bad in ("", "3", "5-4", "a-b"):
        with pytest.raises(ValueError):
            stages.parse_ranges(bad)


def test_streaming(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps({"ts": t, "stage": "x", "temp": 70.0 + t / 100, "mhz": 2000.0}) for t in (0.0, 100.0, 1400.0)))
    stream = metrics.throttle_alerts(metrics.read_metrics(spark, str(src)))
    q = stream.writeStream.format("memory").queryName("alerts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.hottest, r.throttled) for r in spark.sql("select * from alerts").collect()) == [(71.0, False), (84.0, True)]
    for _ in range(2):
        metrics.ingest(spark.readStream.schema(metrics.METRIC).json(str(src)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


RATE = 24_000


def tone(seconds, hz=440.0, amp=0.5):
    return amp * np.sin(2 * np.pi * hz * np.arange(int(seconds * RATE)) / RATE)


def quiet(seconds):
    return np.zeros(int(seconds * RATE))


def test_audio_frames(spark, tmp_path):
    x = np.concatenate([quiet(0.3), tone(1.0), quiet(0.5), tone(0.5), quiet(0.4)])
    (tmp_path / "a.wav").write_bytes(frames.encode(x, RATE))
    y, rate = frames.decode(frames.encode(x, RATE))
    assert rate == RATE and np.abs(x - y).max() < 1e-3
    with pytest.raises(ValueError, match="clips"):
        frames.decode(frames.encode(x, RATE), 20.0)
    lead, inner, tail = frames.pauses(x, RATE)
    assert abs(lead - 0.3) < 0.02 and abs(tail - 0.4) < 0.02 and len(inner) == 1 and abs(inner[0][1] - inner[0][0] - 0.5) < 0.03
    assert frames.read_frames(spark, str(tmp_path / "a.wav")).count() == len(x) // 480
    parts = frames.speech_intervals(x)
    assert len(parts) == 2 and abs(parts[0][0] / RATE - 0.3) < 0.06
    assert frames.edges_quiet(x, RATE) == (True, True) and frames.edges_quiet(tone(0.2), RATE) == (False, False)
    shorter = frames.cap_pauses(x, RATE, inner, [0.2])
    assert abs((len(x) - len(shorter)) / RATE - (inner[0][1] - inner[0][0] - 0.2)) < 0.01
    assert abs(frames.pauses(frames.trim_tail(x, RATE, 0.2), RATE)[2] - 0.2) < 0.02 and len(frames.trim_tail(tone(0.5), RATE, 0.1)) == 12_000
    assert 0.3 * RATE > frames.quietest(np.concatenate([tone(0.1), quiet(0.1), tone(0.1)]), 0, int(0.3 * RATE), RATE) > 0.1 * RATE
    assert frames.decode(frames.encode(np.zeros(0), RATE))[0].size == 0


def test_dsp():
    rng = np.random.default_rng(1)
    dull, bright = tone(1.0, 500) + 1e-4 * rng.standard_normal(RATE), tone(1.0, 5000) + 1e-4 * rng.standard_normal(RATE)
    assert dsp.brightness(bright, RATE)[0] > dsp.brightness(dull, RATE)[0] and dsp.tilt(bright, RATE) > dsp.tilt(dull, RATE)
    noise = 0.01 * rng.standard_normal(4 * RATE)
    lines = dsp.tones(tone(4.0, 3000, 0.1) + noise, RATE)
    assert len(lines) == 1 and abs(lines[0][0] - 3000) < 12 and lines[0][1] > 0.9 and lines[0][2] > 8
    short = np.concatenate([tone(0.1, 3000, 0.1), np.zeros(4 * RATE - RATE // 10)]) + noise
    assert dsp.tones(noise, RATE) == [] == dsp.tones(noise[:8000], RATE) and not [t for t in dsp.tones(short, RATE) if t[1] > 0.5]
    flat = np.zeros((2, 60))
    flat[:, 30] = 9.0
    assert (dsp.local_median(flat) == 0).all() and dsp.running_median(np.array([1.0, 9.0, 2.0]), 3).tolist() == [1.0, 2.0, 2.0]
    speech = np.concatenate([0.3 * tone(1.0, 800), 1e-3 * rng.standard_normal(RATE)])
    hum = dsp.cleanliness(speech + 0.002 * np.sin(2 * np.pi * 240 * np.arange(len(speech)) / RATE), RATE)
    clean = dsp.cleanliness(speech, RATE)
    assert hum["hum"] > clean["hum"] + 10 and -62 < clean["floor"] < -58 and abs(clean["hiss"]) < 2 and dsp.cleanliness(speech[:1000], RATE) is None
    loud = tone(1.5) + 1e-3 * rng.standard_normal(len(tone(1.5)))
    dead = dsp.cleanliness(np.concatenate([loud, quiet(0.1), loud]), RATE)
    assert abs(dead["dropout"] - 0.1 / 3.1) < 0.001 and dsp.cleanliness(np.concatenate([loud, quiet(0.099), loud]), RATE)["dropout"] == 0
    assert dsp.cleanliness(np.clip(6 * loud, -1, 1), RATE)["clipped"] > 0.5
    c = dsp.bands()
    gains = np.linspace(-3, 3, len(c))
    x = rng.standard_normal(RATE) * 0.1
    assert np.allclose(dsp.apply_eq(dsp.apply_eq(x, RATE, c, gains), RATE, c, gains, invert=True), x, atol=1e-9)
    assert np.abs(dsp.eq_plan(np.zeros(27), np.linspace(-40, 40, 27))).max() == 6.0
    assert len(dsp.resample(x, 24_000, 48_000)) == 48_000 and np.allclose(dsp.resample(dsp.resample(tone(0.1), 24_000, 48_000), 48_000, 24_000), tone(0.1), atol=1e-6)
    assert np.abs(np.fft.rfft(dsp.notch(tone(1.0, 1000), RATE, 1000))[1000]) < 0.2 * np.abs(np.fft.rfft(tone(1.0, 1000))[1000])
    assert len(dsp.crossfade(x, x, 100)) == 2 * RATE - 100 and dsp.bed(tone(1.0), RATE, 1.0) is None and len(dsp.bed(quiet(0.5), RATE, 1.0)) == RATE
    assert dsp.edge_kind(quiet(1.0), RATE) == "dead" and dsp.edge_kind(tone(1.0), RATE) == "hot"
    assert abs(dsp.onset(np.concatenate([1e-4 * rng.standard_normal(RATE), tone(1.0)]), RATE, 0.5, 1.5) - 1.0) < 0.02
    s = dsp.summary(np.concatenate([tone(1.0), quiet(0.5), tone(1.0), quiet(0.5)]), RATE)
    assert abs(s["tail"] - 0.5) < 0.02 and abs(s["internal"] - 0.5) < 0.02 and 0.6 < s["speech"] < 0.7


def test_audio_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    still = lambda n: 1e-4 * rng.standard_normal(int(n * RATE))
    x = np.concatenate([still(0.2), tone(1.0, 800, 0.3), still(0.5), tone(0.5, 800, 0.3), still(1.5)])
    for name, y in (("a", x), ("b", tone(1.0, 3000, 0.3)), ("empty", np.zeros(0))):
        (tmp_path / f"{name}.wav").write_bytes(frames.encode(y, RATE))
    files = clips.read_audio(spark, str(tmp_path))
    m = {r.path.rsplit("/", 1)[-1]: r for r in clips.measures(files).collect()}
    assert len(m) == 3 and abs(m["a.wav"].seconds - 3.7) < 0.01 and abs(m["a.wav"].tail - 1.5) < 0.02 and abs(m["a.wav"].lead - 0.2) < 0.02 and m["a.wav"].floor < -70
    assert m["a.wav"].head_quiet and not m["b.wav"].head_quiet and m["b.wav"].edge == "hot" and m["empty.wav"].seconds == 0 and m["empty.wav"].floor is None
    assert {r.path.rsplit("/", 1)[-1] for r in clips.tones(files).collect()} >= {"a.wav"}
    one = files.where("path like '%/a.wav'").select("path")
    r = clips.quiet_points(files, one.withColumn("g0", F.lit(1.2)).withColumn("g1", F.lit(1.7))).collect()
    assert len(r) == 1 and 1.2 < r[0].quiet < 1.7
    out = {r.path.rsplit("/", 1)[-1]: r for r in clips.trimmed(files, files.select("path", F.when(F.col("path").endswith("a.wav"), 0.5).alias("goal"))).collect()}
    assert abs(out["a.wav"].cut - 1.0) < 0.03 and out["b.wav"].cut == 0 and abs(frames.pauses(*frames.decode(bytes(out["a.wav"].content)))[2] - 0.5) < 0.03
    full = files.where("path not like '%empty.wav'")
    double = frames.decode(bytes(clips.resampled(full, 2 * RATE).first().content))
    assert double[1] == 2 * RATE and len(double[0]) in (2 * RATE, 2 * len(x))
    levels = clips.band_levels(full)
    assert levels.count() == 2 * 27 and clips.eq_gains(levels, levels) == [0.0] * 27
    gains = [3.0] * 13 + [-3.0] * 14
    back = {r.path: r.content for r in clips.equalised(clips.equalised(full, gains), gains, invert=True).collect()}
    assert all(np.abs(frames.decode(bytes(c))[0] - frames.decode(bytes(r.content))[0]).max() < 0.01 for r in full.collect() for c in [back[r.path]])
    tone_out = frames.decode(bytes(clips.notched(full.where("path like '%/b.wav'"), [3000.0]).first().content))[0]
    assert np.abs(np.fft.rfft(tone_out))[3000] < 0.3 * np.abs(np.fft.rfft(tone(1.0, 3000, 0.3)))[3000]
    assert [r.path.rsplit("/", 1)[-1] for r in clips.beds(full, 0.5).collect()] == ["a.wav"]
    masks = clips.clean_gates(clips.measures(files))
    assert clips.measures(files).where(masks["no_floor"]).count() == 1


def test_state_after_each_item(spark, tmp_path):
    folder = str(tmp_path / "state")
    wanted = spark.createDataFrame([(f"v{i}",) for i in range(6)] + [(None,)], "id string")

    def call(ids):
        if ids[0] in ("v2", "v4"):
            raise OSError("down")
        return {i: f"text of {i}" for i in ids}

    first = {r.id: r for r in fetch.fetch_resumable(wanted, folder, call, tries=1).collect()}
    assert {i for i, r in first.items() if r.ok} == {"v0", "v1", "v3", "v5"} and first["v2"].body is None
    again = {r.id: r for r in fetch.fetch_resumable(wanted, folder, lambda ids: {i: "late" for i in ids}, tries=1).collect()}
    assert all(r.ok for r in again.values()) and again["v2"].body == "late" and again["v0"].body == "text of v0"
