"""Files in and out, the command line, the stream, and a live completer against a local server."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmine.plans.cli import main
from quillmine.plans.completers import LiveCompleter, MockCompleter, message_text
from quillmine.plans.config import Config
from quillmine.sources import documents, storage
from quillmine.streaming.papers import latest_topics, mine_stream, paper_stream

from .test_pipeline import SAMPLE


def test_papers_and_json(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "my paper.v2.md").write_text(SAMPLE, encoding="utf-8")
    (tmp_path / "in" / "b.md").write_text("", encoding="utf-8")
    got = {r["paper_id"]: r["markdown"] for r in storage.read_papers(spark, str(tmp_path / "in")).collect()}
    assert got["my paper.v2"] == SAMPLE
    (tmp_path / "a.jsonl").write_text('﻿{"x": 1}\n\n  \n{"x": 2}\n', encoding="utf-8")
    assert sorted(r["x"] for r in storage.read_jsonl(spark, str(tmp_path / "a.jsonl"), "x int").collect()) == [1, 2]
    (tmp_path / "bad.jsonl").write_text('{"x": \n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        storage.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "x int").collect()
    out = spark.createDataFrame([("p", "é", None)], "paper_id string, a string, b string")
    storage.write_jsonl(out, str(tmp_path / "out"))
    storage.append_jsonl(out, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    storage.write_json(out, str(tmp_path / "docs"))
    assert json.loads(spark.read.text(str(tmp_path / "docs")).first()["value"]) == {"paper_id": "p", "a": "é", "b": None}


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "paper.md").write_text(SAMPLE, encoding="utf-8")
    root = str(tmp_path / "out")
    assert main(["run", "--input", str(tmp_path / "paper.md"), "--output", root, "--mode", "mock", "--paper-id", "x"], spark) == 0
    assert "chunks: 3" in capsys.readouterr().out
    doc = json.loads((tmp_path / "out" / "final_json" / "x.json").read_text(encoding="utf-8"))
    table = storage.Stages(spark, root).read("final_topics")
    assert doc["paper_id"] == "x" and doc["counts"] == {"accepted": 0, "review": len(doc["final_topics"])}
    read = storage.read_json(spark, f"{root}/final_json/x.json", T.StructType([T.StructField("final_topics", T.ArrayType(T.StructType([f for f in table.schema if f.name != "paper_id"])))]))
    assert read.selectExpr("inline(final_topics)").collect() == table.orderBy("topic_ordinal").drop("paper_id").collect() != []
    assert main(["from-merge", "--output", root, "--mode", "mock"], spark) == 0
    topic = {"topic_id": "topic_0001", "paper_id": "x", "title": "A longer title", "normalized_title": "a", "merged_derivation_logic": "l", "implementation_steps": ["a", "b", "c"], "source_candidate_ids": [], "source_chunk_ids": [], "evidence_quotes": ["q"]}
    partial = {"paper_id": "x", "source": "s", "topics": [{"topic": topic, "source_round": 1, "source_group": 2, "source_group_file": "f"}] * 2}
    (tmp_path / "partial.json").write_text(json.dumps(partial), encoding="utf-8")
    assert main(["from-partial-score", "--input", str(tmp_path / "partial.json"), "--output", root + "2", "--mode", "mock"], spark) == 0
    found = json.loads((tmp_path / "out2" / "final_json" / "x.json").read_text(encoding="utf-8"))["final_topics"]
    assert {d["topic_id"] for d in found} == {"r1_g2_topic_0001", "r1_g2_topic_0001__2"} and {d["source_group_file"] for d in found} == {"f"}


class Counting(MockCompleter):
    asked = []

    def generate(self, calls):
        Counting.asked.append(calls.count())
        return super().generate(calls)


def test_documents_are_whole_and_listed(spark, tmp_path):
    final = spark.createDataFrame([("a/b", 2, "accepted", None), ("a/b", 1, "review", "é")], "paper_id string, topic_ordinal int, status string, title string")
    papers = spark.createDataFrame([("a/b",), ("a/b",), ("none",), (None,)], "paper_id string")
    for _ in range(2):  # a second run replaces
        documents.write_documents(documents.paper_documents(final, papers), str(tmp_path / "out"), F.col("paper_id"), F.col("document"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["_documents.json", "a%2Fb.json", "none.json"]
    a, none, listed = (json.loads((tmp_path / "out" / n).read_text(encoding="utf-8")) for n in ("a%2Fb.json", "none.json", "_documents.json"))
    assert [t["topic_ordinal"] for t in a["final_topics"]] == [1, 2] and a["final_topics"][1]["title"] is None and a["final_topics"][0]["title"] == "é" and a["counts"] == {"accepted": 1, "review": 1}
    assert none == {"paper_id": "none", "counts": {"accepted": 0, "review": 0}, "final_topics": []} and listed == {"documents": 2, "names": ["a%2Fb.json", "none.json"]}


def test_stream(spark, tmp_path):
    """A paper that comes again asks nothing; one that comes with a changed chunk asks for that chunk only."""
    (tmp_path / "in").mkdir()
    root = str(tmp_path / "out")

    def arrives(folder, text):
        (tmp_path / "in" / folder).mkdir()
        (tmp_path / "in" / folder / "one.md").write_text(text, encoding="utf-8")
        Counting.asked = []
        mine_stream(paper_stream(spark, str(tmp_path / "in" / "*")), root, str(tmp_path / "check"), answers=Counting()).awaitTermination(240)
        return Counting.asked

    assert arrives("a", SAMPLE) == [9]
    first = latest_topics(spark, root).collect()
    assert {r["paper_id"] for r in first} == {"one"} and {r["batch"] for r in first} == {0}
    assert arrives("b", SAMPLE) == []
    assert arrives("c", SAMPLE.replace("Nobody has compared", "Nobody has yet compared")) == [3]
    found = latest_topics(spark, root).collect()
    assert len(found) > 0 and len({r["batch"] for r in found}) == 1 and found[0]["batch"] > 0


def test_live_completer(spark):
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append(body["model"])
            if "fail" in body["messages"][0]["content"]:
                self.send_error(500)
                return
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": [{"text": "a"}, "b"]}}]}).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    live = LiveCompleter(Config(mode="live", retry_count=1, retry_backoff_seconds=1), f"http://127.0.0.1:{server.server_port}/", in_flight=2)
    calls = spark.createDataFrame([("p", "t", "glm5", "ok"), ("p", "u", "qwen397", "fail")], "paper_id string, topic_id string, judge_model string, prompt string")
    got = {r["topic_id"]: (r["raw_output"], r["status"]) for r in live.judge(calls).collect()}
    server.shutdown()
    assert got == {"t": ("ab", "ok"), "u": ("", "request_failed")} and seen.count("qwen/qwen3.5-397b-a17b") == 2


def test_message_text():
    assert message_text({}) == "" and message_text({"choices": [{"message": {"content": "x"}}]}) == "x"


def test_manifest_decides_what_is_reused(spark, tmp_path):
    stages, made = storage.Stages(spark, str(tmp_path)), []

    def make():
        made.append(1)
        return spark.range(3)

    for made_from in ({"a": 1}, {"a": 1}, {"a": 2}):
        assert stages.table("t", made_from, make).count() == 3
    assert len(made) == 2
    stages.commit("t", stages.manifest("t")["version"], {"a": 2}, False, {})
    stages.table("t", {"a": 2}, make)
    assert len(made) == 3
    stages.clear("t")
    with pytest.raises(FileNotFoundError):
        stages.read("t")
