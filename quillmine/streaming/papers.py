"""New papers as they arrive: a file stream whose micro-batches go through all stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.config import Config
from ..plans.pipeline import Run
from ..sources.storage import Stages


def paper_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """(paper_id, markdown) of Markdown files that appear in a folder."""
    rows = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path, wholetext=True)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    return rows.select(F.regexp_replace(F.url_decode(name), r"\.[^.]*$", "").alias("paper_id"), F.col("value").alias("markdown"))


def new_papers(papers: DataFrame) -> DataFrame:
    """``papers`` without those whose id came with the same content before, in this batch or an earlier one.

    The stream's state store keeps a key of id and digest for each paper, never its text.
    """
    return papers.withColumn("_digest", F.sha2(F.col("markdown").cast("binary"), 256)).dropDuplicates(["paper_id", "_digest"]).drop("_digest")


def mine_stream(papers: DataFrame, root: str, checkpoint: str, config: Config | None = None, trigger: dict | None = None, answers=None) -> StreamingQuery:
    """Runs all stages on the new papers of each micro-batch, in a folder of stage tables of its own.

    A repeated batch finds its tables. A paper that comes again is left out; one that comes with changes is mined anew, but answers are
    shared by all batches, so only calls whose prompts have changed are made.
    """

    def work(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            Run(batch.sparkSession, f"{root}/batch={number}", config, answers=answers, answers_root=f"{root}/answers").all(batch)

    return new_papers(papers).writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def latest_topics(spark: SparkSession, root: str) -> DataFrame:
    """The final topics of each paper's latest batch, with ``batch``. A paper whose latest version has no topics has none."""
    batches = [Stages(spark, f"{root}/{n}") for n in Stages(spark, root).names(root) if n.startswith("batch=")]
    done = [b for b in batches if b.manifest("final_topics")]
    if not done:
        raise FileNotFoundError(f"{root}: no batch has ended")

    def of(stage: str) -> DataFrame:
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("long")
        return spark.read.parquet(*(b.path(stage) for b in done)).withColumn("batch", number)

    last = of("chunks").groupBy("paper_id").agg(F.max("batch").alias("batch"))
    return of("final_topics").join(last, ["paper_id", "batch"], "left_semi")
