"""All stages on the sample paper with deterministic answers, and resuming."""

import json
import time

import pytest
from pyspark.sql import functions as F

from quillmine.plans.completers import MockCompleter
from quillmine.plans.config import Config
from quillmine.operators import chunking
from quillmine.plans import pipeline
from quillmine.plans.pipeline import Run, chunk_fingerprints, mine, partial_topics
from quillmine.plans.prompts import TEMPLATE
from quillmine.sources import storage
from quillmine.sources.storage import Stages

SAMPLE = """# Sample paper

## Abstract
This text sums up a framework for coupled oscillators and says that effects of finite size are not understood well. Existing derivations take ideal borders for granted and leave out random perturbations, too.

## Discussion
Models of today work well where coupling is weak, but whether they hold where it is strong, and where borders are not the same in all directions, has not been made clear. Nobody has compared strengths of perturbation so far.

## Conclusion
Future work should test whether the formulation can be carried over to settings out of equilibrium, and whether further parameters of control make it more stable.
"""


@pytest.fixture
def papers(spark):
    return spark.createDataFrame([("sample", SAMPLE), ("other", SAMPLE.replace("coupled", "driven"))], "paper_id string, markdown string")


def test_all_stages(spark, papers):
    out = mine(spark, papers.where("paper_id = 'sample'"))
    chunks = out["chunks"].orderBy("chunk_index").collect()
    assert [c["section_path"] for c in chunks] == [["Sample paper", s] for s in ("Abstract", "Discussion", "Conclusion")] and {c["priority"] for c in chunks} == {"high"}
    assert out["candidates"].count() == 18 and out["deduped"].count() == 6
    assert {r["source_type"] for r in out["deduped"].collect()} == {"high_value_inference", "explicit_future_work"}
    n = out["clusters"].count()
    members = [x for r in out["clusters"].collect() for x in r["candidate_ids"]]
    assert len(members) == len(set(members)) == 6
    assert out["topics"].count() == n and out["scores"].count() == 3 * n
    for r in out["aggregates"].collect():
        assert (r["final_overall"], r["overall_spread"], r["evidence_spread"], r["status"], r["veto_reason"]) == (3.97, 0.04, 0.5, "review", None)
    assert out["final"].count() == n


def test_resume_asks_nothing_again(spark, papers, tmp_path):
    class Counting(MockCompleter):
        asked = 0

        def generate(self, calls):
            Counting.asked += 1
            return super().generate(calls)

        judge = lambda self, calls: (setattr(Counting, "asked", Counting.asked + 1), MockCompleter.judge(self, calls))[1]

    root = str(tmp_path / "run")
    first = Run(spark, root, answers=Counting()).all(papers).orderBy("paper_id", "topic_ordinal").collect()
    assert Counting.asked == 2
    again = Run(spark, root, answers=Counting()).all(papers).orderBy("paper_id", "topic_ordinal").collect()
    assert Counting.asked == 2 and first == again and {r["paper_id"] for r in first} == {"sample", "other"}
    assert json.loads((tmp_path / "run" / "run_state.json").read_text())["status"] == "completed"
    merged = Run(spark, root, answers=Counting()).from_merge().orderBy("paper_id", "topic_ordinal").collect()
    assert merged == first
    with pytest.raises(FileNotFoundError):
        Run(spark, str(tmp_path / "none")).from_merge()


def test_a_run_that_was_cut_short_keeps_its_answers(spark, papers, tmp_path):
    """The last call of a task fails; what the task has committed before stays, and the next run asks only for the rest."""

    class Failing(MockCompleter):
        fail, asked = True, []

        def generate(self, calls):
            Failing.asked.append(calls.count())
            found, fail = super().generate(calls.coalesce(1).sortWithinPartitions("paper_id", "chunk_index", "run_index")), Failing.fail

            def slow(batches):
                for n, batch in enumerate(batches):
                    if fail and n == 4:
                        time.sleep(5)  # the sink has had the time that a server's answer takes
                        raise ValueError("cut short")
                    yield batch

            return found.mapInArrow(slow, found.schema)

    # Workers pass rows on when 64 KB have come together, so prompts have a size that makes them.
    root, config, template = str(tmp_path / "run"), Config(calls_per_write=4, heartbeat_chunk_interval=1), TEMPLATE + " word" * 10_000
    with pytest.raises(Exception, match="cut short"):
        Run(spark, root, config, template, answers=Failing()).all(papers)
    state = json.loads((tmp_path / "run" / "run_state.json").read_text())
    kept = spark.read.parquet(f"{root}/calls").count()
    assert state["status"] == "failed" and state["calls"]["calls"]["mode"] == "generated" and 12 <= kept < 18 and Failing.asked == [18]
    Failing.fail = False
    final = Run(spark, root, config, template, answers=Failing()).all(papers)
    assert Failing.asked == [18, 18 - kept] and final.count() > 0
    assert len(list((tmp_path / "run" / "calls").glob("part-*"))) <= kept // 4 + 1  # a task that ends leaves one file
    state = json.loads((tmp_path / "run" / "run_state.json").read_text())
    assert state["status"] == "completed" and state["calls"]["calls"]["mode"] == "resumed" and state["calls"]["calls"]["answered"] == f"{18 - kept}/{18 - kept}"
    Run(spark, root, config, answers=Failing()).from_merge()
    state = json.loads((tmp_path / "run" / "run_state.json").read_text())
    assert state["entry"] == "from-merge" and state["calls"]["judge_calls"]["mode"] == "reused"


def test_a_driver_that_is_lost_between_data_and_pointer_leaves_the_old_version(spark, papers, tmp_path, monkeypatch):
    root, a, b = str(tmp_path / "run"), papers.where("paper_id = 'sample'"), papers.where("paper_id = 'other'")
    ids = lambda df: {r["paper_id"] for r in df.collect()}
    assert ids(Run(spark, root).chunks(a)) == {"sample"}

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(Stages, "commit", lost)
    with pytest.raises(RuntimeError, match="lost"):
        Run(spark, root).chunks(b)
    monkeypatch.undo()
    made = []
    monkeypatch.setattr(pipeline, "make_chunks", lambda *x: (made.append(1), chunking.chunks(*x))[1])
    assert ids(Run(spark, root).chunks(a)) == {"sample"} and not made  # the old version is whole and is taken as it is
    assert ids(Run(spark, root).chunks(b)) == {"other"} and len(made) == 1
    assert len(list((tmp_path / "run" / "chunks").iterdir())) == 2  # the current version and the one before; the lost one is gone


def test_rows_and_digests_are_measured_while_tables_are_written(spark, papers, tmp_path):
    root = str(tmp_path / "run")
    run = Run(spark, root)
    run.all(papers)
    for stage, columns in (("candidates", pipeline.CANDIDATE), ("clusters", pipeline.CLUSTER), ("merged_topics", pipeline.TOPIC), ("scores", pipeline.SCORE)):
        table = run.stages.read(stage)
        assert run.counts[stage] == run.stages.measured(stage)["rows"] == table.count() > 0
        assert storage.digest_of(run.stages.measured(stage)) == storage.content_digest(table, *columns)
    assert run.counts["chunks"] == run.stages.read("chunks").count() and run.counts["final_topics"] == run.stages.read("final_topics").count()
    empty = run.stages.table("empty", {}, lambda: spark.range(0))
    assert empty.count() == 0 and run.stages.measured("empty")["rows"] == 0


def test_an_aborted_first_write_leaves_nothing_in_the_way(spark, papers, tmp_path):
    class Broken(MockCompleter):
        def generate(self, calls):
            return super().generate(calls.withColumn("prompt", F.raise_error(F.lit("at once")).cast("string")))

    root = str(tmp_path / "run")
    with pytest.raises(Exception, match="at once"):
        Run(spark, root, answers=Broken()).all(papers)
    assert Run(spark, root).all(papers).count() > 0


def test_refused_requests_are_not_repeated():
    from urllib.error import HTTPError

    from quillmine.plans.completers import worth_another

    refused = lambda code: HTTPError("http://x", code, "", {}, None)
    assert not worth_another(refused(401)) and not worth_another(refused(400))
    assert worth_another(refused(429)) and worth_another(refused(503)) and worth_another(TimeoutError())


def test_template_lookup(tmp_path, monkeypatch):
    from quillmine.plans.cli import template

    monkeypatch.chdir(tmp_path)
    assert template(None) == TEMPLATE
    (tmp_path / "prompts").mkdir()
    for name in ("Prompt_A_b.md", "Prompt_A_a.md", "other.md"):
        (tmp_path / "prompts" / name).write_text(name)
    assert template(None) == "Prompt_A_a.md" and template("prompts/other.md") == "other.md"


def test_partial_topic_ids(spark):
    rows = [("p", 1, "1", "2", "f", None, ("r1_g2_topic_0001",)), ("p", 2, "1", "2", "f", None, ("topic_0001",)), ("p", 3, None, "", "f", "", ("x",))]
    partial = spark.createDataFrame(rows, "paper_id string, position int, source_round string, source_group string, source_group_file string, original_topic_id string, topic struct<topic_id:string>")
    assert [r["topic_id"] for r in partial_topics(partial).orderBy("topic_ordinal").collect()][:2] == ["r1_g2_topic_0001", "r1_g2_topic_0001__2"]


def test_config_clamps():
    c = Config(noise_min_chars=0, chunk_min_chars=-1, chunk_target_max_chars=1, chunk_hard_max_chars=0, retry_backoff_seconds=0)
    assert (c.noise_min_chars, c.chunk_min_chars, c.chunk_target_max_chars, c.chunk_hard_max_chars, c.retry_backoff_seconds) == (1, 1, 1, 1, 1)
    assert c.raised["chunk_min_chars"] == (-1, 1) and "chunk_target_max_chars" not in c.raised and not Config().raised


def test_fingerprint_is_of_order_not_partitions(spark, papers):
    from quillmine.operators.chunking import chunks

    found = chunks(papers)
    a, b = chunk_fingerprints(found).collect(), chunk_fingerprints(found.repartition(7)).collect()
    assert sorted(a) == sorted(b)


def test_scores_are_parsed_once_each(spark, monkeypatch):
    """Scores are stored before they are filtered: a filter by what was parsed would parse each answer again for each number."""
    from quillmine.plans import pipeline

    plans, stored = {}, pipeline.stored
    monkeypatch.setattr(pipeline, "stored", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and stored(df, name))
    papers = spark.createDataFrame([("p", "One sentence about a model of heat and of its limits. " * 8)], "paper_id string, markdown string")
    found = pipeline.mine(spark, papers)
    assert plans["scores"].count("parseJson") == 1, plans["scores"]
    assert found["scores"].where("parse_error is not null").count() == 0 < found["scores"].count()
