"""The jobs: growing input, reruns, crashes, odd rows, command lines."""

import logging
import subprocess
import sys
from collections import Counter, defaultdict

import pytest

from jobs import chunk_store, keyword_board, settings
from jobs.queries import ORACLE_SQL, QUERIES
from talkloom.operators.chunks import fold_segments

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(same, name):
    same(QUERIES[name], ORACLE_SQL[name])


# Keyword board -----------------------------------------------------------------------------------------------------


def slow_board(rows, shown=50, least=2):
    import re

    talks, words = Counter(s for _, _, s in rows), defaultdict(Counter)
    for _, t, s in rows:
        words[s].update({w for w in re.findall("[a-z0-9]+", (t or "").lower()) if len(w) > 2})
    out = []
    for s, c in words.items():
        top = sorted((-n, w) for w, n in c.items() if n >= least)[:shown]
        out += [(w, -n, talks[s], round(-100 * n / talks[s], 2), i + 1, s) for i, (n, w) in enumerate(top)]
    return sorted(out, key=str)


def held(df):
    return sorted(map(tuple, df.collect()), key=str)


PARTS = [
    [(1, "Kubernetes on the edge", "a"), (2, "edge of kubernetes", "a"), (3, None, "a"), (4, "", "b"), (None, "edge edge", None), (None, "edge", None)],
    [(5, "the Edge", "a"), (5, "the Edge", "a"), (6, "mesh the mesh", "b"), (7, "mesh it", "b"), (8, "ab 12 123", "b")],
    [(9, "x123 123", "b"), (10, "mesh edge", "c/d"), (11, "mesh edge", "c/d")],
]


def test_board_takes_only_what_is_new(spark, tmp_path, caplog):
    folder, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    seen = []
    with caplog.at_level(logging.INFO, "jobs"):
        for part in PARTS:
            docs(spark, part).coalesce(1).write.mode("append").parquet(folder)
            seen += part
            found = keyword_board.run(spark, folder, out, mark)
            assert found["documents"] == len(part) and found["batches"] == 1
            assert held(keyword_board.read(spark, out)) == slow_board(seen)
    assert f"read {len(PARTS[2])} new documents" in caplog.text
    again = keyword_board.run(spark, folder, out, mark)
    assert again["documents"] == again["batches"] == 0 and held(keyword_board.read(spark, out)) == slow_board(seen)


def test_batches_of_any_size_give_the_same_board(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [r for part in PARTS for r in part]
    docs(spark, rows).repartition(5).write.parquet(folder)
    for files in (1, 2, 64):
        out = str(tmp_path / f"out{files}")
        found = keyword_board.run(spark, folder, out, f"{out}-mark", shown=2, least_talks=1, files=files)
        assert found["documents"] == len(rows) and found["batches"] == -(-5 // files)
        assert held(keyword_board.read(spark, out)) == slow_board(rows, 2, 1)


def test_a_batch_that_crashes_is_run_again_and_counts_once(spark, tmp_path, monkeypatch):
    folder, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    docs(spark, PARTS[0]).coalesce(1).write.parquet(folder)
    keyword_board.run(spark, folder, out, mark)
    docs(spark, PARTS[1]).coalesce(1).write.mode("append").parquet(folder)
    was, writes = keyword_board.counted, []

    def written_then_lost(batch):
        """What a driver leaves that dies between a batch's write and its commit."""
        rows = was(batch)
        added = rows.selectExpr("keyword", "talks", "1L AS batch", "track")
        added.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "track").parquet(f"{out}/added")
        writes.append(1)
        raise RuntimeError("lost")

    monkeypatch.setattr(keyword_board, "counted", written_then_lost)
    with pytest.raises(Exception, match="lost"):
        keyword_board.run(spark, folder, out, mark)
    monkeypatch.setattr(keyword_board, "counted", was)
    assert writes and keyword_board.run(spark, folder, out, mark)["documents"] == len(PARTS[1])
    assert held(keyword_board.read(spark, out)) == slow_board(PARTS[0] + PARTS[1])


def test_board_of_an_empty_table(spark, tmp_path):
    docs(spark, PARTS[0]).limit(0).write.parquet(str(tmp_path / "in"))
    found = keyword_board.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"))
    assert found["documents"] == found["board"] == 0 and keyword_board.read(spark, str(tmp_path / "out")).count() == 0


# Chunk store -------------------------------------------------------------------------------------------------------


def slow_store(rows, dialogues, window, overlap):
    talks, track = defaultdict(set), {}
    for i, t, s in rows:
        if i is not None:
            talks["talk_text", str(i)] |= {(p, line.strip(" \t\r\n")) for p, line in enumerate(t.split("\n") if t is not None else [])}
            track[str(i)] = min((x for x in (track.get(str(i)), s) if x is not None), default=None)
    for i, p, t in dialogues:
        if i is not None:
            talks["transcript_segment", str(i)].add((p, (t or "").strip(" \t\r\n")))
    out = []
    for (kind, talk), lines in talks.items():
        lines = sorted(x for x in lines if x[1])
        for n, (start, text) in enumerate(fold_segments(((float(p), t) for p, t in lines), window, overlap)):
            out.append((f"{kind}:{talk}:{n}", talk, n, start, text, kind, track[talk] if kind == "talk_text" else None))
    return sorted(out, key=str)


def test_store_equals_plain_folds_and_reruns_replace_it(spark, tmp_path):
    rows = [(i, "\n".join(f"line {j} of talk {i}" for j in range(i % 9)), f"t{i % 3}") for i in range(40)]
    rows += [(100, None, "a"), (101, "", None), (102, "\n \n\t", "a"), (103, "only", None), (104, "x" * 5000 + "\ny", "a/b=c"), (None, "lost", "a")]
    rows += [(3, "another text\nunder the id", "t9"), (3, rows[3][1], "t0"), (105, "word\n" * 20_000, "t1")]
    talks = [(1, 1, "hello"), (1, 0, "first\nturn"), (1, 1, "hello"), (2, 0, None), (2, 1, " "), (None, 0, "lost"), (3, 5, "z" * 90)]
    docs(spark, rows).write.parquet(str(tmp_path / "d"))
    spark.createDataFrame(talks, "conv_id long, turn int, text string").write.parquet(str(tmp_path / "c"))
    for _ in range(2):
        found = chunk_store.run(spark, str(tmp_path / "d"), str(tmp_path / "c"), str(tmp_path / "o"), window=60, overlap=20)
        got = held(chunk_store.read(spark, str(tmp_path / "o")))
        assert got == slow_store(rows, talks, 60, 20)
        assert found == {"documents": len(rows), "conversations": len(talks), "chunks": len(got)}
    one = chunk_store.read(spark, str(tmp_path / "o")).where("track = 't1'")
    assert one.count() == sum(r[6] == "t1" for r in got) and "PartitionFilters: [isnotnull(track" in one._jdf.queryExecution().toString()
    inventory = {(r["chunk_type"], r["track"]): r["chunks"] for r in spark.read.schema(chunk_store.INVENTORY).parquet(str(tmp_path / "o/inventory")).collect()}
    assert inventory == Counter((r[5], r[6]) for r in got)


def test_store_of_empty_tables(spark, tmp_path):
    docs(spark, PARTS[0]).limit(0).write.parquet(str(tmp_path / "d"))
    spark.createDataFrame([], "conv_id long, turn int, text string").write.parquet(str(tmp_path / "c"))
    assert chunk_store.run(spark, str(tmp_path / "d"), str(tmp_path / "c"), str(tmp_path / "o"))["chunks"] == 0
    with pytest.raises(ValueError, match="overlap"):
        chunk_store.run(spark, str(tmp_path / "d"), str(tmp_path / "c"), str(tmp_path / "o"), window=10, overlap=10)


def test_settings_that_are_missing_or_unknown(tmp_path):
    (tmp_path / "a.toml").write_text('documents = "x"\nfloor = 3\n')
    with pytest.raises(ValueError, match="lacks output"):
        settings.load(str(tmp_path / "a.toml"), ("documents", "output"), ())
    with pytest.raises(ValueError, match="unknown settings: floor"):
        settings.load(str(tmp_path / "a.toml"), ("documents",), ())


def test_command_line(sf_dir, tmp_path):
    config = f'documents = "{sf_dir}/documents.parquet"\noutput = "{tmp_path}/out"\ncheckpoint = "{tmp_path}/mark"\n'
    (tmp_path / "board.toml").write_text(config)
    ran = subprocess.run(
        [sys.executable, "-m", "jobs.keyword_board", "--config", str(tmp_path / "board.toml")],
        capture_output=True, text=True, timeout=300, cwd=settings.__file__.rsplit("/", 2)[0],
    )
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert "new documents in 1 batches" in ran.stderr and (tmp_path / "out/board").is_dir()


def test_documents_of_one_id_each_are_not_moved(spark, tmp_path, monkeypatch):
    """Only documents that share an id are shuffled by talk, and a store of both kinds is the same as one of shuffled rows."""
    rows = [(i, "\n".join(f"line {j} of {i} " + "x" * 300 for j in range(i % 12)), "ab"[i % 2]) for i in range(40)]
    rows += [(7, "another\nline", "a"), (7, "another\nline", None), (None, "none", "a")]
    asked = []
    real = chunk_store.chunks.windows

    def windows(laid, *a, **k):
        asked.append((k.get("together", False), {r["id"] for r in laid.select("talk.id").distinct().collect()}))
        return real(laid, *a, **k)

    monkeypatch.setattr(chunk_store.chunks, "windows", windows)
    got = chunk_store.told(docs(spark, rows).select("doc_id", "text", "source"), 2000, 400)
    alone, shared = asked
    assert alone[0] and "7" not in alone[1] and not shared[0] and shared[1] == {"7"}
    monkeypatch.setattr(chunk_store.chunks, "windows", lambda laid, *a, **k: real(laid, *a, **{**k, "together": False}))
    assert held(got) == held(chunk_store.told(docs(spark, rows).select("doc_id", "text", "source"), 2000, 400))
