"""The whole job over a hand-made event, and streaming."""

import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from talkloom.plans import config, providers, render, steps, transcripts
from talkloom.plans.job import Job
from talkloom.sources import artifacts, listing

TALK = "We run Kubernetes in production on four hundred nodes. Prometheus told us that latency fell by 40%. Autoscaling with KEDA saved half of the cost. "


@pytest.fixture(scope="module")
def event(tmp_path_factory):
    root = tmp_path_factory.mktemp("event")
    data = root / "ev"
    (data / "transcripts").mkdir(parents=True)
    (data / "slides").mkdir()
    (root / "ev.toml").write_text(
        '[conference]\nname = "Test Event"\n[conference.recordings]\nvideo_ids = []\n[query]\ntop_k = 5\n[report]\nappendix_strategy = "by_cluster"\n[odd]\nx = 1\n'
    )
    titles = ["Kubernetes at scale", "Tracing with OpenTelemetry", "Saving cost with KEDA", "Cilium for everyone", "Closing Remarks"]
    sessions = [
        {
            "title": t,
            "abstract": f"About {t}.",
            "speakers": json.dumps([{"name": "Ann Lee", "company": "Engineer, Acme"}]),
            "track": "Ops",
            "format": "talk",
            "time": "",
            "tags": [],
        }
        for t in titles
    ]
    (data / "schedule.json").write_text(json.dumps(sessions))
    for i, t in enumerate(titles):
        segments = [{"start": 10.0 * k, "end": 10.0 * k + 9, "text": f"{t}. {TALK}", "speaker": "Speaker 1"} for k in range(20)]
        doc = {
            "video_id": f"video{i}",
            "title": t + "!",
            "language": "en",
            "duration_sec": 200.0,
            "model": "m",
            "backend": "b",
            "diarized": True,
            "full_text": " ".join(s["text"] for s in segments),
            "segments": segments,
        }
        (data / "transcripts" / f"video{i}.json").write_text(json.dumps(doc))
    slides = {
        "video_id": "video0",
        "slides": [
            {"index": 0, "timestamp_sec": "00:15", "image_file": "", "text": "see https://example.org/a", "description": "a chart"},
            {"index": 1, "timestamp_sec": "1:40", "image_file": "", "text": "", "description": ""},
        ],
    }
    (data / "slides" / "video0.json").write_text(json.dumps(slides))
    return root


def test_unknown_settings_are_told_of(event):
    with pytest.warns(UserWarning, match="unknown setting odd"):
        c = config.load(str(event / "ev.toml"))
    assert c.conference.name == "Test Event" and c.query.top_k == 5 and c.data_dir == str(event / "ev")


@pytest.mark.filterwarnings("ignore:unknown setting")
def test_run(spark, event):
    job = Job(spark, config.load(str(event / "ev.toml")))
    job.run()
    matched = {r["title"]: r for r in job.load("matched").collect()}
    assert len(matched) == 5 and matched["Kubernetes at scale"]["video_id"] == "video0"
    assert "[SLIDE 1 at 0m15s]" in matched["Kubernetes at scale"]["slide_aligned"] and matched["Kubernetes at scale"]["slide_references"] == ["https://example.org/a"]
    talks = job.load("talks", "talk")
    assert {r["title"] for r in talks.collect()} == set(matched) - {"Closing Remarks"}
    assert {"Kubernetes", "KEDA", "Prometheus"} & set(talks.where("title = 'Kubernetes at scale'").first()["tools_and_projects"])
    before = talks.count()
    job.analyze()
    assert job.load("talks", "talk").count() == before  # done talks are not asked for again
    agenda = job.load("agenda").first()
    assert agenda["company_presence"] == {"Acme": 5} and agenda["track_distribution"] == {"Ops": 5}
    assert [r["rank"] for r in job.load("ranking").orderBy("rank").collect()] == list(range(1, len(agenda["clusters"]) + 1))
    kinds = {r["chunk_type"] for r in job.load("index").select("chunk_type").distinct().collect()}
    assert {"transcript_segment", "talk_abstract", "slide_content", "talk_summary", "cluster_summary"} <= kinds
    assert "Kubernetes" in job.ask("What runs on Kubernetes?")
    assert job.ask("x", track="None such") == steps.NO_HITS
    text = Path(job.dir, "reports", "briefing.md").read_text()
    assert "# Intelligence Briefing: Test Event" in text and Path(job.dir, "reports", "book", "src", "SUMMARY.md").exists()
    assert Path(job.dir, "reports", "ranking_report.md").read_text().count("**Relevance Score:**") == len(agenda["clusters"])
    drawn = job.visualize()
    assert all(Path(f).read_text().startswith("<svg") for f in drawn) and {
        "track_distribution.svg", "keyword_cloud.svg", "maturity_strip.svg"
    } <= {Path(f).name for f in drawn}
    whole = job.load("recordings", "synthesis").first()
    assert whole["narrative"] and whole["recommended_actions"] and whole["maturity_landscape"] and whole["emerging_technologies"]
    assert {r["cluster_name"] for r in job.load("clusters", "synthesis").collect()} == {c["name"] for c in agenda["clusters"]}
    assert {"maturity_assessment", "recommended_action", "conference_narrative"} <= kinds
    assert "### Recommended Actions" in text and "- Adopt " in text and "## Appendix" in text
    assert "![Track Distribution](./images/track_distribution.svg)" in text
    assert "**Kubernetes at scale**" in text and "> — " in text  # a deep dive's talks, and a quote woven in
    job.report()
    assert (Path(job.dir) / "reports" / "SUMMARY.md").read_text().count("briefing.md") == 1


@pytest.mark.filterwarnings("ignore:unknown setting")
def test_short_reports_without_synthesis(spark, tmp_path):
    job = Job(spark, config.Config(data_dir=str(tmp_path)))
    assert job.report() == [] and job.extract() == [] and job.collect().count() == 0
    assert job.load("recording_index").count() == 0


class Scripted:
    """Answers every call with JSON; counts its calls in a file."""

    def complete(self, system, prompt, max_tokens):
        with open(Scripted.log, "a") as f:
            f.write(system + "\n")
        if "narrative" in system or "connects" in system:
            return json.dumps({"narrative": "told", "cross_cutting_themes": [], "common_problems": ["p"]})
        if "technologies relate" in system:
            return json.dumps(
                {"emerging_technologies": [], "technology_relationships": [{"entity_a": " ", "relation": "extends", "entity_b": "x", "supporting_talks": []}]}
            )
        if "disagree" in system:
            return json.dumps(
                {
                    "tensions": [
                        {
                            "topic": "T",
                            "side_a": {"position": "a", "supporting_talks": []},
                            "side_b": {"position": "b", "supporting_talks": []},
                            "severity": "minor",
                            "implication": "",
                        }
                    ],
                    "maturity_landscape": [],
                }
            )
        return json.dumps({"recommended_actions": [{"action": "Do", "category": "adopt", "urgency": "immediate", "supporting_evidence": ""}]})


def test_four_answers_are_asked_for_once(spark, tmp_path):
    from talkloom.plans import synthesis
    from talkloom.schemas import schema

    Scripted.log = str(tmp_path / "calls")
    agenda = spark.createDataFrame(
        [([("one", "", ["A", "B"], [], []), ("two", "", ["B", "none"], [], []), ("empty", "", ["none"], [], [])], [], "", {}, {})],
        schema("agenda"),
    )
    talk = lambda t, stance: (
        t, "s", ["k"], ["p"], ["X"], [], "production", "practitioner", [], [("X", "adopt", "e")], ["c"], [("X", stance, "e")], [], [], ""
    )
    talks = spark.createDataFrame([talk("A", "enthusiastic"), talk("B", "critical")], schema("talk")).withColumn("_pos", F.monotonically_increasing_id())
    log = Scripted.log
    make = lambda: _scripted(log)
    clusters = artifacts.checkpointed(synthesis.by_cluster(agenda, talks, None, make))
    got = {r["cluster_name"]: r for r in clusters.collect()}
    assert set(got) == {"one", "two"} and got["one"]["narrative"] == "told" and got["one"]["tensions"][0]["topic"] == "T"
    assert got["one"]["technology_relationships"] == []  # the blank one goes
    assert got["one"]["emerging_technologies"][0]["technology"] == "X" and got["one"]["recommended_actions"][0]["action"] == "Do"
    assert Path(log).read_text().count("\n") == 8  # four calls for each of two clusters
    synthesis.over_all(clusters, make).collect()
    assert Path(log).read_text().count("\n") == 12
    assert synthesis.by_cluster(agenda, talks, clusters, make).count() == 0
    local = {r["cluster_name"]: r for r in synthesis.by_cluster(agenda, talks).collect()}
    assert local["one"]["tensions"][0]["topic"] == "X" and local["one"]["tensions"][0]["severity"] == "significant" and local["two"]["tensions"] == []
    assert [a["action"] for a in local["one"]["recommended_actions"]] == ["Adopt X", "Watch: c"]


def _scripted(log):
    Scripted.log = log
    return Scripted()


def test_charts(tmp_path):
    from talkloom.plans import charts

    charts.pie("P", [("a", 3), ("b", 1)], f"{tmp_path}/p.svg")
    charts.pie("P", [("a", 3)], f"{tmp_path}/one.svg")
    charts.bars("B", [("a", 0.9)], f"{tmp_path}/b.svg", charts.THRESHOLDS)
    charts.stacked("S", ("x", "y"), [("a", (1, 2)), ("b", (0, 0))], f"{tmp_path}/s.svg")
    charts.strip("M", [("K", "adopt", "benchmarked"), ("L", "odd", "")], f"{tmp_path}/m.svg")
    charts.cloud("C", [("w" * 30, 1.0)] * 40, f"{tmp_path}/c.svg")
    text = {f.stem: f.read_text() for f in tmp_path.glob("*.svg")}
    assert text["p"].count("<path") == 2 and "75%" in text["p"] and "<circle" in text["one"]
    assert text["b"].count("<line") == 2 and text["s"].count("<rect") == 4 and text["m"].count("<circle") == 2


def test_preflight(monkeypatch):
    from talkloom.plans import preflight

    monkeypatch.setattr(preflight, "which", lambda name: None)
    monkeypatch.setattr(preflight, "_package", lambda name: name != "cv2")
    monkeypatch.delenv("HF_TOKEN", raising=False)
    told = preflight.missing(config.Config())
    assert "scenes needs cv2" in told and "speakers needs HF_TOKEN" in told and "speech needs ffmpeg" in told
    assert preflight.missing(config.Config(), has_media=False) == []
    assert preflight.device("cuda") == "cuda"


def test_freshness_follows_inputs(spark, tmp_path):
    from talkloom.streaming.manifest import Manifest

    m = Manifest(spark, f"{tmp_path}/m.json")
    (tmp_path / "in").write_text("a")
    m.made("x", [f"{tmp_path}/in"])
    assert m.fresh("x", [f"{tmp_path}/in"]) and not m.fresh("y", [f"{tmp_path}/in"])
    (tmp_path / "in").write_text("ab")
    assert not m.fresh("x", [f"{tmp_path}/in"])


def test_bad_json_names_its_file(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"title": ')
    with pytest.raises(Exception, match=r"bad\.json"):
        artifacts.read_json(spark, f"{tmp_path}/bad.json", "ranking").collect()
    assert artifacts.read_optional(spark, f"{tmp_path}/none.json", "ranking").count() == 0


LISTING = """<span class="event"><a class="name" href="event/1abc/x">A talk <span class="vs">Room 1</span></a></span>
<span class="event"><a class="name" href="event/1abc/x">Again</a></span><span class="event"><a class="name" href="http://else">No</a></span>"""
DETAIL = """<div class="tip-description"><strong>About</strong>First.<br>Second.</div><div class="tip-roles"><div class="sched-person-session"><h2><a>Ann Lee</a></h2>
<div class="sched-event-details-role-company">Acme</div></div></div><div class="sched-event-type"><a>Ops</a></div><div class="sched-event-details-timeandplace">Mon 9:00   Room</div>
<ul class="tip-custom-fields"><li>Beginner</li></ul>"""


def test_schedule_pages(spark):
    p = spark.createDataFrame([("http://h", LISTING)], "url string, html string")
    got = listing.listing_sessions(p).select("url", "title", "venue", "event_id").collect()
    assert [tuple(r) for r in got] == [("http://h/event/1abc/x", "A talk", "Room 1", "1abc")]
    d = listing.detail_sessions(spark.createDataFrame([("u", DETAIL)], "url string, html string")).first()
    assert (d["abstract"], d["track"], d["time"], d["tags"]) == ("First.\nSecond.", "Ops", "Mon 9:00", ["Beginner"])
    assert [tuple(s) for s in d["speakers"]] == [("Ann Lee", "Acme")]


def test_video_ids(spark):
    urls = spark.createDataFrame([("abcdefghijk", 0), ("short", 1), ("abcdefghijk", 2), ("ABCDEFGHIJ_", 3)], "video_id string, _pos int")
    got = [r["video_id"] for r in listing.video_ids(urls, ["mine"], spark).orderBy("_pos").collect()]
    assert got == ["abcdefghijk", "ABCDEFGHIJ_", "mine"]


def test_transcript_shaping(spark):
    raw = spark.createDataFrame(
        [("v", "t", [(("00:00:01,500", "00:00:02.250"), " hi ")], ("en",))],
        "video_id string, title string, transcription array<struct<timestamps:struct<`from`:string,`to`:string>,text:string>>, result struct<language:string>",
    )
    got = transcripts.from_cli(raw).first()
    assert (got["duration_sec"], got["full_text"], got["segments"][0]["start"]) == (2.2, "hi", 1.5)  # 2.25 is a tie: to the even digit
    named = transcripts.label_speakers(
        spark.createDataFrame(
            [("v", "t", [(0.0, 1.0, "a", "S9"), (1.0, 2.0, "b", "S2")])],
            "video_id string, title string, segments array<struct<start:double,end:double,text:string,speaker:string>>",
        )
    ).first()
    assert [s["speaker"] for s in named["segments"]] == ["Speaker 2", "Speaker 1"]


class Failing:
    def complete(self, system, prompt, max_tokens):
        if "bad" in prompt:
            raise RuntimeError("no")
        return '{"name": "x", "rank": 3}'


def test_failures_stay_with_their_row(spark):
    df = spark.createDataFrame([("good",), ("bad",)], "prompt string")
    got = {r["prompt"]: r for r in providers.complete(df, "s", Failing).collect()}
    assert got["good"]["answer"]["error"] is None and "no" in got["bad"]["answer"]["error"]
    from talkloom.schemas import schema

    parsed = {r["prompt"]: r for r in providers.complete_json(df, "s", schema("ranking"), Failing).collect()}
    assert parsed["good"]["parsed"]["rank"] == 3 and parsed["bad"]["parsed"] is None and parsed["bad"]["error"]


def test_cross_references():
    page = render.cross_references("**A** and *A* and *Sec*", {"A": "appendix.md#a"}, {"Sec": "sec.md"}, True)
    assert page == "**[A](appendix.md#a)** and *[A](appendix.md#a)* and *[Sec](sec.md)*"


def test_grounding_of_drafts(spark):
    s = spark.createDataFrame(
        [("s", "t", "Cut by 30% said Ann Lee, by Max Muster.", [("Kubernetes at large scale", "c", True), ("zzz yyy", "c", False)], "")],
        "section_id string, title string, prose string, citations array<struct<talk_title:string,claim:string,needs_quote:boolean>>, key_takeaway string",
    )
    titles = spark.createDataFrame([("Kubernetes at scale in production",)], "title string")
    people = spark.createDataFrame([("speaker", "Ann Lee")], "kind string, name string")
    got = steps.ground(s, titles, spark.createDataFrame([], "percentage string"), people).first()
    assert got["prose"].startswith("Cut significantly said Ann Lee") and "Muster" not in got["prose"]
    assert [c["talk_title"] for c in got["citations"]] == ["Kubernetes at scale in production"]


def test_arrivals(spark, tmp_path):
    from talkloom.streaming.arrivals import arriving, counts_by_window, into_table, rolling_chunks

    ddl = "conv_id long, turn long, text string, ts timestamp"
    rows = spark.range(6).select(
        (F.col("id") % 2).alias("conv_id"),
        F.col("id").alias("turn"),
        F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"),
        F.timestamp_seconds(F.col("id") * 60).alias("ts"),
    )
    rows.where("turn < 4").coalesce(1).write.parquet(f"{tmp_path}/in/a")
    rows.where("turn >= 4").coalesce(1).write.parquet(f"{tmp_path}/in/b")
    stream = arriving(spark, f"{tmp_path}/in/*", ddl, files=1)
    q = into_table(rolling_chunks(stream, "conv_id", "turn", "text", "turn", window=12, overlap=4), f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got[0] == (0, 0, 0.0, "word 0 word 2") and len(got) >= 2
    counted = counts_by_window(arriving(spark, f"{tmp_path}/in/*", ddl), "ts", "conv_id")
    w = counted.writeStream.format("memory").queryName("n_by_window").outputMode("complete").trigger(availableNow=True).start()
    w.awaitTermination(120)
    assert spark.table("n_by_window").agg(F.sum("n")).first()[0] == 6


def test_cli_reports_errors(capsys):
    from talkloom.cli import main

    assert main(["check"]) == 0 and "ffmpeg" in capsys.readouterr().out
    assert main(["clean", "--config", "/nonexistent/x.toml"]) == 1


def test_patience():
    import urllib.error

    from talkloom.sources.rest import patient

    calls, waited = [], []

    def fetch(url):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(url, 429, "", None, None)
        return "page"

    assert patient(fetch, "u", (1, 2, 4), waited.append) == "page" and waited == [1, 2]

    def gone(url):
        raise urllib.error.HTTPError(url, 404, "", None, None)

    with pytest.raises(urllib.error.HTTPError):
        patient(gone, "u", (1,), waited.append)


def test_site_and_api(spark, tmp_path):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from talkloom.plans.config import Conference, Config
    from talkloom.sources.schedule import fetch_schedule

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            body = json.dumps(
                [{"name": "From API", "speakers": [{"name": "A", "company": "C"}]}]
            ) if "/api/" in self.path else DETAIL if "/event/" in self.path else LISTING
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        scraped = steps.clean_schedule(fetch_schedule(spark, Config(Conference(schedule_url=url)))).collect()
        assert [(r["title"], r["track"], r["abstract"]) for r in scraped] == [("A talk", "Ops", "First. Second.")]
        called = steps.clean_schedule(fetch_schedule(spark, Config(Conference(schedule_url=url, sched_api_key="k")))).first()
        assert called["title"] == "From API" and called["speakers"][0]["company"] == "C"
    finally:
        server.shutdown()
    assert fetch_schedule(spark, Config()).count() == 0


class Frames:
    def read(self, content, path):
        if b"bad" in content:
            raise RuntimeError("no")
        from talkloom.plans import media

        cut = [(1, 9.0, 0), (0, 3.0, (1 << 40) - 1), (2, 12.0, 1)]
        return media.dumps([{"index": i, "timestamp_sec": s, "image_file": f"{i}.png", "dhash": h, "text": f"t{i}"} for i, s, h in cut])


class Describer:
    def read(self, content, path):
        return json.dumps({"description": content.decode()})


def test_frames_and_descriptions(spark):
    from talkloom.plans import media

    videos = spark.createDataFrame([("/v/one.mp4", b"x"), ("/v/two.mp4", b"bad"), ("/v/three.mp4", b"x")], "path string, content binary")
    done = spark.createDataFrame([("three",)], "video_id string")
    got, failed = media.frames(videos, done, Frames)
    assert [(r["video_id"], r["error"]) for r in failed.collect()] == [("two", "RuntimeError: no")]
    assert sorted((r["index"], r["text"]) for r in got.collect()) == [(0, "t0"), (1, "t1")]  # the third is near the second
    images = spark.createDataFrame([("/i/0.png", b"a chart"), ("/i/1.png", b" ")], "path string, content binary")
    slides = got.withColumn("description", F.lit("")).unionByName(
        spark.createDataFrame(
            [("one", 7, 20.0, "7.png", 5, "t7", ""), ("one", 8, 21.0, "8.png", 6, "t8", "known")],
            "video_id string, index int, timestamp_sec double, image_file string, dhash long, text string, description string",
        )
    )
    told, missing = media.describe(slides, images, Describer)
    assert {r["index"]: r["description"] for r in told.collect()} == {0: "a chart", 1: media.NO_CONTENT, 7: "", 8: "known"}
    assert [(r["index"], r["error"]) for r in missing.collect()] == [(7, "no such picture")]
    packed = media.as_slides(told).first()["slides"]
    assert [s["index"] for s in packed] == [0, 1, 7, 8]
    meta = spark.createDataFrame([("a", 100.0), ("b", 900.0), ("c", None)], "video_id string, duration double")
    assert {r["video_id"]: r["threshold"] for r in media.thresholds(meta).collect()} == {"a": 27.0, "b": 20.0, "c": 27.0}


class Recogniser:
    def read(self, content, path):
        return json.dumps(
            {"transcription": [{"timestamps": {"from": "00:00:00,000", "to": "00:00:04,510"}, "text": content.decode()}], "result": {"language": "en"}}
        )


def test_transcribing(spark):
    from talkloom.plans import media

    videos = spark.createDataFrame([("/v/one.mp4", b" hello "), ("/v/two.mp4", b"there")], "path string, content binary")
    got, failed = media.transcribe(videos, None, Recogniser, titles=spark.createDataFrame([("one", "A talk")], "video_id string, title string"))
    assert {
        (r["video_id"], r["title"], r["full_text"], r["duration_sec"])
        for r in got.collect()
    } == {("one", "A talk", "hello", 4.5), ("two", "two", "there", 4.5)}
    assert failed.count() == 0


def test_the_command_line_recogniser(tmp_path):
    from types import SimpleNamespace

    from talkloom.plans import media

    called = []

    def run(command, capture_output, timeout):
        called.append((command[0], timeout))
        if command[0] == "whisper-cli":
            Path(command[command.index("-of") + 1] + ".json").write_text("{}")
        return SimpleNamespace(returncode=0, stderr=b"")

    assert media.CommandLine("m", run=run).read(b"x", "/v/a.mp4") == "{}" and called == [("ffmpeg", 600), ("whisper-cli", 3600)]
    with pytest.raises(RuntimeError, match="ffmpeg failed: no codec"):
        media.CommandLine(run=lambda *a, **k: SimpleNamespace(returncode=1, stderr=b"no codec")).read(b"x", "a")


def test_steps_are_told_of(caplog):
    from talkloom import console

    with caplog.at_level("INFO", "talkloom"), console.step("clean"):
        console.progress("clean", 1, 2)
    with pytest.raises(ValueError), caplog.at_level("INFO", "talkloom"), console.step("bad"):
        raise ValueError
    text = " ".join(r.getMessage() for r in caplog.records)
    assert "[clean] 1 of 2" in text and "[clean] done in" in text and "[bad] failed" in text


def test_reports_go_to_any_file_system(spark, tmp_path):
    root = f"file://{tmp_path}/reports"
    render.add_to_summary(f"{root}/SUMMARY.md", {"A": "a.md"})
    render.add_to_summary(f"{root}/SUMMARY.md", {"A": "a.md", "B": "b.md"})
    assert artifacts.read_text(f"{root}/SUMMARY.md") == "# Summary\n- [A](a.md)\n- [B](b.md)\n" and artifacts.read_text(f"{root}/none.md", "x") == "x"
    section = {"section_id": "s", "title": "One", "prose": "See *T*.", "section_type": "maturity", "thin": False}
    for folder in (f"{root}/book", f"{tmp_path}/book"):
        artifacts.write_text(f"{folder}/src/old.md", "old")
        pages = render.book(folder, "N", "thesis", {"summary": "s"}, [section, section | {"title": "Two", "thin": True}], [{"title": "T"}], [], {"maturity": [("images/m.svg", "M")]})
        assert pages == ["SUMMARY.md", "appendix.md", "briefs.md", "index.md", "one.md"] and not artifacts.exists(spark, f"{folder}/src/old.md")
        assert "*[T](appendix.md#t)*" in artifacts.read_text(f"{folder}/src/one.md") and "![M](../../images/m.svg)" in artifacts.read_text(f"{folder}/src/one.md")


def test_work_is_answered_once_a_crash_loses_one_batch(spark, tmp_path):
    from talkloom.streaming import work

    queue, mark, paths = f"{tmp_path}/queue", f"{tmp_path}/mark", {"out": f"{tmp_path}/out", "odd": f"{tmp_path}/odd"}
    asked: list[int] = []

    def answer(batch):
        rows = artifacts.checkpointed(batch)
        asked.extend(r["i"] for r in rows.collect())
        return {"out": rows.selectExpr("i", "2 * i AS twice"), "odd": rows.where("i % 2 = 1")}

    drain = lambda f=answer: work.drain(spark, queue, "i long", mark, f, paths, files=1)
    assert drain() == 0 and work.results(spark, paths["out"], "i long, twice long").count() == 0
    work.enqueue(spark.range(20).toDF("i").coalesce(1), queue, 5)

    def lost(batch):
        found = answer(batch)
        if len(asked) > 10:  # the third batch is stored in part
            found["out"].withColumn("batch", F.lit("x")).count()
            raise RuntimeError("lost")
        return found

    with pytest.raises(Exception, match="lost"):
        drain(lost)
    assert len(asked) == 15 and work.results(spark, paths["out"], "i long, twice long").count() == 10
    assert drain() == 10 and len(asked) == 25 and sorted(asked[:10] + asked[15:]) == list(range(20))  # the lost batch alone is asked again
    work.enqueue(spark.range(20, 23).toDF("i").coalesce(1), queue, 5)
    assert drain() == 3 and drain() == 0
    got = sorted(map(tuple, work.results(spark, paths["out"], "i long, twice long").collect()))
    assert got == [(i, 2 * i) for i in range(23)]
    assert sorted(r["i"] for r in work.results(spark, paths["odd"], "i long").collect()) == list(range(1, 23, 2))


@pytest.mark.filterwarnings("ignore:unknown setting")
def test_a_crashed_analysis_goes_on_and_failed_talks_are_tried_again(spark, event, tmp_path, monkeypatch):
    for name in ("ev/transcripts", "ev/slides"):
        shutil.copytree(event / name, tmp_path / name)
    for name in ("ev.toml", "ev/schedule.json"):
        shutil.copy(event / name, tmp_path / name)
    job = Job(spark, config.load(str(tmp_path / "ev.toml")))
    job.collect()
    matched = job.clean()
    was = steps.analyze_work
    monkeypatch.setattr(steps, "analyze_work", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        job.ask_about_talks(matched)
    calls = []

    def all_fail(batch, make, waits):
        calls.append(batch.count())
        talks, failed = was(batch, make, waits)
        return talks.limit(0), talks.selectExpr("title", "'no answer' AS error")

    monkeypatch.setattr(steps, "analyze_work", all_fail)
    job.ask_about_talks(matched)  # what the crash left, and then again, since all of it failed
    share = job.load("talk_failures").first()
    assert calls == [4, 4] and share["failed"] == share["n"] == 4 and share["warn"]
    monkeypatch.setattr(steps, "analyze_work", was)
    job.ask_about_talks(matched)
    assert job.load("talks", "talk").count() == 4 and job.load("talk_failures").first()["failed"] == 0
    assert job.load("talk_errors").count() == 8


def test_large_clusters_are_reduced_in_rounds(spark, tmp_path, monkeypatch):
    """Talks beyond a prompt's budget are answered in parts, and the answers again, until each cluster has one prompt."""
    from talkloom.plans import synthesis
    from talkloom.schemas import schema

    monkeypatch.setattr(synthesis, "BUDGET", 400)
    titles = [f"T{i:02}" for i in range(24)]
    agenda = spark.createDataFrame([([("large", "", titles, [], []), ("small", "", ["T00"], [], [])], [], "", {}, {})], schema("agenda"))
    talk = lambda t: (t, f"summary of {t}", ["k"], ["p"], [], [], "production", "practitioner", [], [], ["c"], [], [], [], "")
    talks = spark.createDataFrame([talk(t) for t in titles], schema("talk")).withColumn("_pos", F.monotonically_increasing_id())
    log = Scripted.log = str(tmp_path / "calls")
    make = lambda: _scripted(log)
    got = {r["cluster_name"]: r for r in artifacts.checkpointed(synthesis.by_cluster(agenda, talks, None, make)).collect()}
    assert set(got) == {"large", "small"} and got["large"]["narrative"] == "told" and got["large"]["recommended_actions"][0]["action"] == "Do"
    calls = Path(log).read_text().splitlines()
    parts = sum("some of the talks" in c for c in calls)
    assert sum("one cluster of talks" in c for c in calls) == 8 and parts > 24 and parts % 4 == 0


def test_parts_hold_every_text_once_and_few_characters(spark):
    from talkloom.operators import aggregates

    rows = [("a", i, "x" * (i % 37)) for i in range(500)] + [("b", 0, "y" * 999), ("b", 1, "z"), (None, 3, "n"), ("c", 5, "first"), ("c", 5, "later")]
    df = spark.createDataFrame(rows, "k string, o int, t string").repartition(7)
    got = aggregates.in_parts(df, "k", "o", "t", 100).collect()
    for r in got:
        assert len(r["payload"]) <= 100 + 37 + 2 or r["k"] == "b"
    joined = {}
    for r in sorted(got, key=lambda r: (r["k"] or "", r["part"])):
        joined.setdefault(r["k"], []).extend(r["payload"][1:-1].split(","))
    assert joined == {"a": ["x" * (i % 37) for i in range(500)], "b": ["y" * 999, "z"], "c": ["first"]}
    pairs = aggregates.in_parts(df.where("k = 'a'"), "k", "o", "t", 1, least=2).collect()
    assert len(pairs) == 250 and sorted(r["part"] for r in pairs) == list(range(250))


def test_arriving_segments_keep_the_chunks_up(spark, tmp_path, monkeypatch):
    import random

    from talkloom.operators import chunks
    from talkloom.streaming import arrivals

    rng = random.Random(5)
    rows = [(f"v{i % 7}", i // 7, f"segment {i} " + "word " * rng.randrange(20)) for i in range(300)] + [(None, 0, "lost"), ("one", 0, "alone"), ("v1", 999, None)]
    rng.shuffle(rows)
    ddl, paths = "video_id string, i int, text string", [str(tmp_path / x) for x in ("in", "out", "mark")]
    table = lambda part: spark.createDataFrame(part, ddl)
    keep = lambda: arrivals.keep_chunks(spark, paths[0], ddl, *paths[1:], "video_id", "i", "text", "i", 300, 60, buckets=4)
    seen: list = []
    was, crash = chunks.windows, []

    def windows(*a, **k):
        if crash and crash.pop():
            raise RuntimeError("lost")
        return was(*a, **k)

    monkeypatch.setattr(chunks, "windows", windows)
    for part in (rows[:120], rows[120:121], rows[121:]):
        table(part).coalesce(1).write.mode("append").parquet(paths[0])
        crash.append(True)
        with pytest.raises(Exception, match="lost"):  # after the segments are stored, before the chunks are
            keep()
        assert keep() == len(part)
        seen += part
        want = was(table(seen), "video_id", "i", "text", "i", 300, 60)
        got = spark.read.parquet(f"{paths[1]}/chunks").select(want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert keep() == 0


def test_clusters_overlap_and_hold_every_talk(spark):
    import numpy as np

    words = {"a": "kubernetes scheduler cluster nodes", "b": "tracing spans metrics logs", "c": "wallet payment ledger bank"}
    rows = [(f"{g}{i}", f"{words[g]} {words[g]} extra{i % 3}") for g in words for i in range(6)]
    rows += [("ab", f"{words['a']} {words['b']}"), ("none", "?"), ("a0", "repeated title")]
    df = spark.createDataFrame(rows, "title string, text string")
    got: dict[str, set] = {}
    for r in steps.overlapping(df, 3, margin=0.2).collect():
        got.setdefault(r["title"], set()).add(r["c"])
    assert set(got) == {t for t, _ in rows} and len(got["none"]) == 1
    homes = {g: {frozenset(got[f"{g}{i}"]) for i in range(1, 6)} for g in words}
    assert all(len(h) == 1 for h in homes.values()) and len(set.union(*homes.values())) == 3
    assert got["ab"] == set().union(*homes["a"], *homes["b"]) and len(got["ab"]) == 2
    centres = [[1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    x = spark.createDataFrame([("p", [2.0, 0.0]), ("q", [0.0, 3.0]), ("z", [0.0, 0.0])], "title string, x array<double>")
    far = {(r["title"], r["c"]): r["distance"] for r in steps.centre_distances(x, centres).collect()}
    want = {("p", 0): 0, ("p", 1): 1 - np.sqrt(0.5), ("q", 0): 1, ("q", 1): 1 - np.sqrt(0.5)}
    assert {k: pytest.approx(v, abs=1e-9) for k, v in want.items()} == {k: far[k] for k in want} and {far[k] for k in far if k[0] == "z" or k[1] == 2} == {1.0}
    assert steps.overlapping(df.where("title = 'ab'"), 3).select("title", "c").collect()[0]["c"] == 0
