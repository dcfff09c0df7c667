"""Command line: ``python -m quillmine run|from-merge|from-partial-score``."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.documents import paper_documents, write_documents
from ..sources.storage import read_papers
from .config import Config
from .deploy import ship
from .pipeline import Run
from .prompts import TEMPLATE

TOPIC = (
    "topic_id string, paper_id string, merge_model string, title string, normalized_title string, merged_derivation_logic string, implementation_steps array<string>, "
    "source_candidate_ids array<string>, source_chunk_ids array<string>, evidence_quotes array<string>, merge_notes string, raw_output string"
)
PARTIAL = f"paper_id string, source string, topics array<struct<topic:struct<{TOPIC.replace(' string', ':string').replace(' array', ':array')}>,source_round:string,source_group:string,source_group_file:string,original_topic_id:string>>"


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="quillmine", description="Mines research topics from Markdown papers.")
    out.add_argument("entry", choices=("run", "from-merge", "from-partial-score"))
    out.add_argument("--input", help="Markdown file, folder or glob (run); partial topics JSON (from-partial-score)")
    out.add_argument("--paper-id", help="id of a single paper; by default the file's name without suffix")
    out.add_argument("--output", required=True, help="folder of stage tables and final JSON")
    out.add_argument("--prompt", help="file with the candidate prompt's template; by default the first prompts/Prompt_A_*.md, else the engine's own")
    out.add_argument("--mode", choices=("live", "mock"), default="live")
    out.add_argument("--no-resume", action="store_true")
    d = Config()
    for name in ("candidate_runs", "noise_min_chars", "chunk_min_chars", "chunk_target_max_chars", "chunk_hard_max_chars", "cluster_threshold", "cluster_batch_size", "merge_group_size", "request_timeout_seconds", "retry_count", "retry_backoff_seconds", "heartbeat_chunk_interval", "heartbeat_score_interval", "calls_per_write", "calls_in_flight"):
        out.add_argument("--" + name.replace("_", "-"), type=type(getattr(d, name)), default=getattr(d, name))
    return out


def template(path: str | None, folder: str = "prompts") -> str:
    """The candidate prompt's template: of ``path``, else the first ``Prompt_A_*.md`` by name in ``folder``, else the engine's own."""
    found = [Path(path)] if path else sorted(Path(folder).glob("Prompt_A_*.md"))
    return found[0].read_text("utf-8-sig") if found else TEMPLATE


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    fields = {k: v for k, v in vars(args).items() if k in Config.__dataclass_fields__}
    spark = ship(spark or SparkSession.builder.appName("quillmine").getOrCreate())
    run = Run(spark, args.output, Config(**fields, resume_enabled=not args.no_resume), template(args.prompt))
    for name, (said, least) in run.config.raised.items():
        print(f"{name}: {said} is too low, {least} is used", file=sys.stderr)
    if args.entry == "run":
        papers = read_papers(spark, args.input)
        out = run.all(papers.withColumn("paper_id", F.lit(args.paper_id)) if args.paper_id else papers)
    elif args.entry == "from-merge":
        out = run.from_merge()
    else:
        rows = spark.read.schema(PARTIAL).option("multiLine", True).json(args.input)
        flat = rows.select("paper_id", F.posexplode("topics").alias("_at", "t")).select("paper_id", (F.col("_at") + 1).alias("position"), "t.*")
        out = run.from_partial(flat)
    papers = out if args.entry == "from-partial-score" else run.stages.read("chunks")
    write_documents(paper_documents(out, papers), f"{args.output}/final_json", F.col("paper_id"), F.col("document"))
    for name, n in run.counts.items():
        print(f"{name}: {n}")
    return 0
