"""The job over one event's folder: artifacts are Parquet tables under the data folder; fresh ones are not made again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.console import say, step
from talkloom.operators import aggregates, ordering, reports
from talkloom.plans import charts, drafting, extraction, preflight, providers, render, steps, synthesis
from talkloom.plans.config import Config
from talkloom.schemas import ddl, schema
from talkloom.sources import artifacts, listing, schedule
from talkloom.streaming import work
from talkloom.streaming.manifest import Manifest

#: Talks in a file of the work that is still to be done; a batch is a file for each task that can run at a time.
FILE = 64
#: Videos or pictures in a file of the work of extraction.
PIECES = 4
#: Where what was extracted is kept, by kind.
EXTRACTED = {"transcript": "heard", "slides": "seen"}
WORK, FAILED = "title string, speakers string, prompt string", "title string, error string"
#: Warnings shown, words of the word cloud.
WARNINGS, WORDS = 15, 80


class Job:
    def __init__(
        self,
        spark: SparkSession,
        config: Config,
        make=providers.LocalCompleter,
        waits: tuple[float, ...] | None = None,
        readers: extraction.Readers | None = None,
    ):
        """``make`` gives the model; its failed calls are tried again after ``waits`` (by default, the local one's are not).

        ``readers`` extract what was said and shown in videos; by default those that this machine has.
        """
        self.spark, self.config, self.dir = spark, config, config.data_dir
        self.make_model = make
        self.readers = readers or extraction.readers(config)
        self.waits = waits if waits is not None else () if make is providers.LocalCompleter else providers.RETRY_AFTER
        self.manifest = Manifest(spark, f"{self.dir}/manifest.json")

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def has(self, name: str) -> bool:
        return artifacts.exists(self.spark, self.path(name))

    def load(self, name: str, kind: str | None = None) -> DataFrame:
        """An artifact, or an empty table of its schema."""
        if name == "talks":
            return work.results(self.spark, self.path(name), ddl("talk"))
        if self.has(name):
            return self.spark.read.parquet(self.path(name))
        return self.spark.createDataFrame([], schema(kind or name))

    def make(self, name: str, inputs: list[str], build) -> DataFrame:
        """Build and write an artifact unless the manifest says that it was made of these very inputs."""
        sources = [self.path(i) if "/" not in i else i for i in inputs]
        if not (self.has(name) and self.manifest.fresh(name, sources)):
            artifacts.write_artifact(build(), self.path(name))
            self.manifest.made(name, sources)
        return self.spark.read.parquet(self.path(name))

    def documents(self, folder: str, kind: str) -> DataFrame:
        """Transcripts or slides: the files of a folder, and what was extracted of other videos."""
        given = artifacts.read_optional_documents(self.spark, f"{self.dir}/{folder}/*.json", kind)
        made = work.results(self.spark, self.path(EXTRACTED[kind]), ddl(kind)).dropDuplicates(["video_id"])
        both = given.unionByName(ordering.unprocessed(made, given, "video_id"))
        if kind != "slides":
            return both
        told = work.results(self.spark, self.path("told"), extraction.TOLD)
        return extraction.described(both, told) if self.has("told") else both

    def collect(self) -> DataFrame:
        """The schedule, from wherever it is configured (a schedule.json in the folder if nowhere), and the recordings' index."""
        c = self.config.conference
        if c.schedule_url:  # a site may change at any time: it is always asked, its detail pages only once
            got = artifacts.checkpointed(schedule.fetch_schedule(self.spark, self.config, self.path("detail_pages")))
            artifacts.write_artifact(got, self.path("schedule"))
        elif c.schedule or artifacts.exists(self.spark, f"{self.dir}/schedule.json"):
            file = c.schedule or f"{self.dir}/schedule.json"
            self.make("schedule", [file], lambda: artifacts.read_schedule(self.spark, file))
        artifacts.write_artifact(self.recorded(), self.path("recording_index"))
        return self.load("schedule", "raw_session")

    def recorded(self) -> DataFrame:
        """(video_id, path, meta_title, duration) of the videos that are configured, or listed in playlist.txt, and lie in the folder videos."""
        rec, lines = self.config.conference.recordings, f"{self.dir}/playlist.txt"
        if rec.source_url:
            patterns = self.spark.createDataFrame([("youtube.com", "youtube", 0), ("youtu.be", "youtube", 1)], "domain string, provider string, place int")
            if listing.providers(self.spark.createDataFrame([(rec.source_url,)], "url string"), patterns).where("provider is not null").isEmpty():
                raise ValueError(f"no video provider is known for {rec.source_url}")
        ids = self.spark.createDataFrame([], "video_id string, _pos long")
        if artifacts.exists(self.spark, lines):
            ids = artifacts.with_position(self.spark.read.text(lines)).select(F.trim("value").alias("video_id"), "_pos")
        found = self.spark.createDataFrame([], "video_id string, path string")
        if artifacts.exists(self.spark, f"{self.dir}/videos/*.mp4"):
            media = artifacts.media(self.spark, f"{self.dir}/videos")
            found = media.select(F.regexp_extract("path", r"([^/]+)\.mp4$", 1).alias("video_id"), "path")
        meta = artifacts.read_optional_documents(self.spark, f"{self.dir}/videos/*.json", "video_meta")
        return schedule.with_sidecar(schedule.recordings(ids, rec.video_ids, found), meta)

    def extract(self) -> list[str]:
        """Extract what was said and shown in the folder videos, as far as there are readers and it is not done; gives what stands in
        the way of the rest, empty if nothing does. What failed is in the table extract_errors and is tried again by the next run."""
        use, have = self.readers, artifacts.exists(self.spark, f"{self.dir}/videos/*.mp4")
        paths = {name: self.path(name) for name in ("pictures", "heard", "seen", "told", "extract_errors")}
        drain = lambda: extraction.drain(self.spark, self.dir, paths, use, self.config.extract.scene_threshold)
        if left := drain():
            say("extract", f"{left} pieces of work that an earlier run had left")
        if have:
            found = artifacts.media(self.spark, f"{self.dir}/videos").select(F.regexp_extract("path", r"([^/]+)\.mp4$", 1).alias("video_id"), "path")
            meta = artifacts.read_optional_documents(self.spark, f"{self.dir}/videos/*.json", "video_meta")
            videos = schedule.with_sidecar(found, meta).withColumnRenamed("meta_title", "title")
            self._extract(extraction.open_work(videos, self.documents("transcripts", "transcript"), self.documents("slides", "slides"), use), drain)
        if use.eyes:
            own = work.results(self.spark, self.path("seen"), ddl("slides"))  # whose pictures are there
            told = work.results(self.spark, self.path("told"), extraction.TOLD)
            self._extract(extraction.open_descriptions(extraction.described(own, told)), drain)
        return preflight.missing(self.config, have)

    def _extract(self, todo: DataFrame, drain) -> None:
        todo = artifacts.checkpointed(todo)
        if not todo.isEmpty():
            work.enqueue(todo, f"{self.dir}/extract_work", PIECES)
            say("extract", f"{drain()} pieces of work")

    def clean(self) -> DataFrame:
        self.collect()
        clean = self.make("schedule_clean", ["schedule"], lambda: steps.clean_schedule(self.load("schedule", "raw_session")))
        folders = [f"{self.dir}/transcripts", f"{self.dir}/slides"]
        return self.make(
            "matched",
            ["schedule_clean", *folders, "heard", "seen", "told"],
            lambda: steps.match(clean, self.documents("transcripts", "transcript"), self.documents("slides", "slides")),
        )

    def analyze(self) -> None:
        matched, clean = self.load("matched", "session"), self.load("schedule_clean", "session")
        self.ask_about_talks(matched)
        agenda = self.make("agenda", ["talks"], lambda: steps.cluster_talks(self.load("talks", "talk"), clean))
        self.make("ranking", ["agenda"], lambda: steps.rank_clusters(agenda, self.config.analyze.eval_topics))
        placed = self.talks()

        def synthesized() -> DataFrame:
            new = synthesis.by_cluster(agenda, placed, done_clusters, self.make_model, self.waits)
            return new if done_clusters is None else artifacts.checkpointed(new.unionByName(done_clusters.select(new.columns)))

        done_clusters = None
        if self.has("clusters"):  # those of this agenda are not asked for again
            named = agenda.select(F.explode("clusters").alias("c")).select(F.col("c.name").alias("cluster_name")).distinct()
            done_clusters = artifacts.checkpointed(self.load("clusters", "synthesis").join(named, "cluster_name", "left_semi"))
        clusters = self.make("clusters", ["agenda", "talks"], synthesized)
        self.make("recordings", ["clusters"], lambda: synthesis.over_all(clusters, self.make_model, self.waits))

    def ask_about_talks(self, matched: DataFrame) -> None:
        """Have the talks analysed that aren't yet. Talks that failed are tried again by the next run."""
        queue, paths = f"{self.dir}/work", {"talks": self.path("talks"), "talk_errors": self.path("talk_errors")}

        def answer(batch: DataFrame) -> dict[str, DataFrame]:
            return dict(zip(paths, steps.analyze_work(batch, self.make_model, self.waits)))

        def drain() -> int:
            return work.drain(self.spark, queue, WORK, f"{self.dir}/work_progress", answer, paths)

        if left := drain():
            say("analyze", f"{left} talks that an earlier run had left")
        todo = artifacts.checkpointed(steps.talks_to_analyze(matched, self.load("talks", "talk")))
        if not todo.isEmpty():
            work.enqueue(todo, queue, FILE)
            say("analyze", f"{drain()} talks")
        # What is still to be done has failed.
        known = self.load("talks", "talk")
        failed = ordering.unprocessed(todo.select("title").distinct(), known, "title").select(F.lit("failed").alias("error"))
        share = aggregates.failure_share(failed.unionByName(known.select(F.lit(None).cast("string").alias("error"))))
        artifacts.write_artifact(share, self.path("talk_failures"))

    def talks(self) -> DataFrame:
        """The talks in order of the schedule, whatever order their analyses were stored in."""
        talks = self.load("talks", "talk")
        order = artifacts.with_position(self.load("matched", "session")).groupBy("title").agg(F.min("_pos").alias("_pos"))
        last = 1 << 62
        return talks.join(order, "title", "left").withColumn("_pos", F.coalesce("_pos", F.lit(last)))

    def index(self) -> DataFrame:
        recordings = self.load("recordings", "synthesis")
        heard, seen = self.documents("transcripts", "transcript"), self.documents("slides", "slides")
        chunk_table = steps.all_chunks(
            artifacts.with_position(self.load("matched", "session")),
            heard,
            seen,
            self.talks(),
            self.load("ranking"),
            self.load("agenda"),
            recordings,
        )
        return steps.build_index(chunk_table, self.path("index"))

    def ask(self, question: str, k: int = 0, types: list[str] | None = None, track: str | None = None) -> str:
        row = steps.ask(self.path("index"), question, k or self.config.query.top_k, types, track).first()
        return row["answer"]

    def visualize(self) -> list[str]:
        agenda, ranking = self.load("agenda"), self.load("ranking")
        top = agenda.select(F.explode("top_keywords").alias("keyword"))
        own = agenda.select(F.explode("clusters").alias("c")).select(F.explode("c.keywords").alias("keyword"))
        clusters, recordings, talks = self.load("clusters", "synthesis"), self.load("recordings", "synthesis"), self.talks()
        members = steps.cluster_members(agenda, talks).join(talks.select("title", "evidence_quality"), "title").select("cluster", "evidence_quality")
        evidence, kinds = aggregates.evidence_by_cluster(members, ranking), aggregates.TALK_EVIDENCE
        maps = lambda c: agenda.select(F.explode(c).alias("k", "n"))
        pairs = lambda df: [(str(r[0]), float(r[1])) for r in df.collect()]
        stakeholders = aggregates.stakeholders(recordings.select(F.explode("stakeholder_map").alias("s")).select("s.*")).select("role", "talk_count")
        strip = reports.maturity_strip(artifacts.with_position(clusters), recordings).select(
            "technology", F.coalesce("ring", F.lit("assess")), F.coalesce("evidence_quality", F.lit(""))
        )
        tables = {
            "topic_frequency": (charts.bars, "Top Conference Topics", pairs(aggregates.weighted_keywords(top, own))),
            "company_presence": (charts.bars, "Company Presence", pairs(aggregates.recount(maps("company_presence"), "k"))),
            "track_distribution": (charts.pie, "Track Distribution", pairs(maps("track_distribution").orderBy(F.desc("n"), "k"))),
            "cluster_relevance": (lambda *a: charts.bars(*a, charts.THRESHOLDS), "Cluster Relevance", pairs(reports.cluster_relevance(ranking))),
            "maturity_strip": (charts.strip, "Technology Maturity", [tuple(r) for r in strip.collect()]),
            "evidence_quality": (
                lambda title, data, path: charts.stacked(title, kinds, data, path),
                "Evidence Quality by Cluster",
                [(r["cluster"], tuple(r[k] for k in kinds)) for r in evidence.collect()],
            ),
            "stakeholders": (charts.bars, "Stakeholders", pairs(stakeholders)),
            "keyword_cloud": (charts.cloud, "Words", pairs(aggregates.weighted_keywords(top, own, WORDS))),
        }
        out = []
        for name, (draw, title, data) in tables.items():
            if data:
                out.append(f"{self.dir}/reports/images/{name}.svg")
                draw(title, data, out[-1])
        return out

    def report(self) -> list[str]:
        """The briefing, the book and the two short reports; where there is no synthesis, the short reports alone."""
        name, r, topics = self.config.conference.name, self.config.report, self.config.analyze.eval_topics
        agenda, ranking, clusters = self.load("agenda"), self.load("ranking"), artifacts.with_position(self.load("clusters", "synthesis"))
        talks, clean, recordings = self.talks(), self.load("schedule_clean", "session"), self.load("recordings", "synthesis")
        folder, files = f"{self.dir}/reports", []
        if one := render.rows(agenda.limit(1)):
            files.append(f"{folder}/agenda_report.md")
            artifacts.write_text(files[-1], render.agenda_report(name, one[0]))
        if ranked := render.rows(ranking.orderBy("rank")):
            files.append(f"{folder}/ranking_report.md")
            artifacts.write_text(files[-1], render.ranking_report(name, ranked))
        if clusters.isEmpty() or recordings.isEmpty():
            return files
        out = artifacts.checkpointed(steps.outline(ranking, r.word_budget, r.appendix_strategy))
        specs = out.select(F.posexplode("sections").alias("_pos", "s")).select("_pos", "s.*")
        facts = drafting.facts_of(agenda, ranking, talks, clusters, recordings)
        drafts = drafting.drafts(specs, facts, topics, self.make_model, self.waits)
        people, percentages = aggregates.known_people(clean), steps.source_percentages(talks, clusters, recordings)
        grounded = artifacts.checkpointed(steps.ground(drafts, talks.select("title"), percentages, people))
        ordered = reports.in_order(grounded, specs)
        quotes = self.spark.createDataFrame([], "section_id string, talk_title string, speaker string, quote string, timestamp_sec double, video_id string")
        if not r.skip_enrichment and self.has("index"):
            quotes = artifacts.checkpointed(steps.quotes(ordered, steps.load_index(self.spark, self.path("index")), most=r.max_quotes_per_section))
            ordered = drafting.woven(ordered, quotes, self.make_model, self.config.llm.model, self.waits)
        ordered = artifacts.checkpointed(ordered.withColumn("thin", reports.thin_briefs(ordered))).orderBy("priority", "_pos")
        found, counts = steps.validate(ordered.select(*grounded.columns), clean, talks)
        artifacts.write_artifact(found, self.path("report_warnings"))
        artifacts.write_artifact(counts, self.path("report_stats"))
        listed = reports.appendix(talks, ranking, agenda, out, r.appendix_strategy)
        place = aggregates.rank_of(F.col("x.urgency"), {u: i for i, u in enumerate(aggregates.URGENCIES)}, 99)
        actions = recordings.select(F.explode("recommended_actions").alias("x")).select("x.action", place.alias("place"))
        thesis = render.rows(out.select("thesis"))[0]["thesis"] or f"{name} in {len(ranked)} clusters."
        summary = render.rows(drafting.executive_summary(ordered, actions, name, thesis, topics, self.make_model, self.waits))[0]
        sections, extra = render.rows(ordered), render.rows(listed.drop("pos"))
        told: dict[str, list[dict]] = {}
        for q in render.rows(quotes.orderBy("section_id", "talk_title", "timestamp_sec", "quote")):
            told.setdefault(q["section_id"], []).append(q)
        images: dict[str, list[tuple[str, str]]] = {}
        for c in render.rows(reports.section_charts(self.spark).orderBy("section_type", "place")):
            if artifacts.exists(self.spark, f"{folder}/{c['path']}"):
                images.setdefault(c["section_type"], []).append((c["path"], c["caption"]))
        warnings = [w["message"] for w in render.rows(found.orderBy("section_id", "kind", "message").limit(WARNINGS))]
        totals = render.rows(reports.section_counts(ordered, listed, len(summary["summary"].split())))[0]
        files.append(f"{folder}/briefing.md")
        artifacts.write_text(
            files[-1],
            render.briefing(name, thesis, summary, sections, told, extra, self.config.llm.model, images=images, counts=totals, warnings=warnings),
        )
        guide = render.rows(reports.reading_guide(self.spark, grounded).orderBy("role", "place"))
        render.book(f"{folder}/book", name, thesis, summary, sections, extra, guide, images)
        render.add_to_summary(
            f"{folder}/SUMMARY.md",
            {"Briefing": "briefing.md", "Agenda": "agenda_report.md", "Ranking": "ranking_report.md", "Book": "book/src/index.md"},
        )
        return files

    def run(self) -> None:
        for name in ("collect", "extract", "clean", "analyze", "index", "visualize", "report"):
            with step(name):
                getattr(self, name)()
