"""Videos to transcripts, slides and descriptions through the job, over runs that fail and go on."""

import functools
import json

from pyspark.sql import functions as F

from talkloom.plans import config, extraction, media
from talkloom.plans.job import Job
from talkloom.sources import artifacts


class Reader:
    def __init__(self, log):
        self.log = log

    def note(self, what):
        with open(self.log, "a") as f:
            f.write(what + "\n")


class Speech(Reader):
    def read(self, content, path):
        self.note(f"speech {path[-5:]}")
        said = json.loads(content)["said"]
        return json.dumps({"transcription": [{"timestamps": {"from": "00:00:00,000", "to": "00:00:04,510"}, "text": said}], "result": {"language": "en"}})


class Video(Reader):
    """A video is JSON: shots of (frames, brightness, what the picture shows); a picture is what it shows."""

    def _shots(self, content):
        at = 0
        for n, light, shows in json.loads(content)["shots"]:
            for _ in range(n):
                yield at, light, shows
                at += 1

    def frames(self, content, path):
        self.note(f"video {path[-5:]}")
        for at, light, _ in self._shots(content):
            if light is None:
                raise ValueError("broken stream")
            grey = [(i * light) % 7 for i in range(72)]
            yield at, at / 30, [light] * 12, grey

    def pictures(self, content, path, numbers):
        yield from ((at, shows.encode()) for at, _, shows in self._shots(content) if at in numbers)


class Words(Reader):
    def read(self, content, path):
        return json.dumps({"text": f" {content.decode()} text\n"})


class Blank(Reader):
    def read(self, content, path):
        return json.dumps({"description": " "})


class Eyes(Reader):
    def read(self, content, path):
        self.note(f"eyes {path}")
        if content == b"odd":
            raise RuntimeError("cannot see")
        return json.dumps({"description": f"shows {content.decode()}"})


def logged(log):
    return extraction.Readers(*(functools.partial(part, str(log)) for part in (Speech, Video, Words, Eyes)), "m")


def land(data, name, shots, said="hello", duration=None):
    (data / "videos" / f"{name}.mp4").write_text(json.dumps({"shots": shots, "said": said}))
    if duration is not None:
        (data / "videos" / f"{name}.json").write_text(json.dumps({"video_id": name, "title": f"Talk {name}", "duration": duration}))


def test_extraction_resumes_and_tries_failures_again(spark, tmp_path):
    log = tmp_path / "log"
    use = logged(log)
    data = tmp_path / "ev"
    (data / "videos").mkdir(parents=True)
    (data / "slides").mkdir()
    land(data, "a", [(40, 1, "title"), (20, 100, "chart"), (5, 1, "flash"), (30, 103, "chart again"), (30, 202, "odd")], duration=600.0)
    land(data, "b", [(40, 5, "still")])
    land(data, "c", [(20, 1, "x"), (3, None, "y")])
    land(data, "d", [(20, 1, "x"), (20, 99, "y")], duration=60.0)
    job = Job(spark, config.Config(data_dir=str(data)), readers=use)
    job.extract()
    heard = {r["video_id"]: r for r in job.documents("transcripts", "transcript").collect()}
    assert set(heard) == set("abcd") and heard["a"]["title"] == "Talk a" and heard["b"]["title"] == "b" and heard["a"]["full_text"] == "hello"
    seen = {r["video_id"]: [tuple(s) for s in r["slides"]] for r in job.documents("slides", "slides").collect()}
    assert set(seen) == {"a", "b"} and seen["b"] == []
    # The flash is too near the cut before it; the way back from it is none either, as it comes within fifteen frames.
    grey = lambda light: [(i * light) % 7 for i in range(72)]
    assert grey(103) != grey(100) and [s[0] for s in seen["a"]] == sorted(s[0] for s in seen["a"])
    assert seen["a"][0] == (0, "0.0", "slides/a/0001.jpg", "title text", "shows title")
    assert seen["a"][1][1:] == ("1.33", "slides/a/0002.jpg", "chart text", "shows chart")
    assert [s[4] for s in seen["a"] if s[3] == "odd text"] == [""]
    errors = {(r["step"], r["video_id"], r["error"]) for r in artifacts.read_table(spark, job.path("extract_errors")).collect()}
    assert errors == {("frames", "c", "ValueError: broken stream"), ("describe", "a", "RuntimeError: cannot see")}

    before = log.read_text().splitlines()
    land(data, "c", [(20, 1, "x"), (20, 100, "y")])
    (data / "slides" / "d.json").write_text(json.dumps({"video_id": "d", "slides": []}))
    Job(spark, config.Config(data_dir=str(data)), readers=use).extract()
    again = log.read_text().splitlines()[len(before) :]
    assert sorted(x for x in again if not x.startswith("eyes")) == ["video c.mp4"]  # nothing that is done is done twice
    assert sorted(x for x in again if "/a/" in x) == [f"eyes {s[2]}" for s in seen["a"] if s[3] == "odd text"]
    now = {r["video_id"]: [tuple(s) for s in r["slides"]] for r in job.documents("slides", "slides").collect()}
    assert [s[3:] for s in now["c"]] == [("x text", "shows x"), ("y text", "shows y")] and now["a"] == seen["a"] and now["d"] == []


def test_without_readers_nothing_is_done(spark, tmp_path):
    (tmp_path / "videos").mkdir()
    land(tmp_path, "a", [(3, 1, "x")])
    job = Job(spark, config.Config(data_dir=str(tmp_path)), readers=extraction.Readers())
    assert job.extract() and not job.has("heard") and not artifacts.exists(spark, f"{tmp_path}/extract_work")


def test_descriptions_that_are_there_stay(spark):
    seen = spark.createDataFrame(
        [("v", [(1, "2", "b", "t", ""), (0, "1", "a", "t", "own")]), ("w", [])],
        "video_id string, slides array<struct<index:int,timestamp_sec:string,image_file:string,text:string,description:string>>",
    )
    told = spark.createDataFrame([("v", 0, "later"), ("v", 1, "later"), ("v", 1, "later")], extraction.TOLD)
    got = {r["video_id"]: [(s["index"], s["description"]) for s in r["slides"]] for r in extraction.described(seen, told).collect()}
    assert got == {"v": [(0, "own"), (1, "later")], "w": []}
    assert [r["path"] for r in extraction.open_descriptions(seen).collect()] == ["b"]
    images = spark.createDataFrame([("b", b"x"), ("other/b", b"y")], "path string, content binary")
    rows = spark.createDataFrame([("v", 1, "b", "")], "video_id string, index int, image_file string, description string")
    assert media.describe(rows, images, functools.partial(Blank, ""), whole=True)[0].where(F.col("description") == media.NO_CONTENT).count() == 1
