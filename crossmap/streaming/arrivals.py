"""Framework documents that arrive in a folder, mapped as they come.

Each micro-batch is a set of new documents. Their requirements are added to
the requirement table, then the framework pairs that are not finished yet, and
those of a framework that arrived again, are computed and stored. Of documents
of the same name in one micro-batch, the last path counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from crossmap.functions import text
from crossmap.operators.flatten import flatten_requirements
from crossmap.operators.sizes import gather
from crossmap.plans.stored import update_candidates
from crossmap.sources.dimension import framework_dim
from crossmap.sources.documents import decode_documents, latest
from crossmap.sources.tables import read_requirements

FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def arriving_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of (framework, path, content) of the documents that appear in a folder."""
    files = (
        spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", "*.{yaml,yml}").load(folder)
    )
    content = F.decode("content", "UTF-8").alias("content")
    return files.select(text.framework_name(F.col("path")).alias("framework"), "path", content)


def map_arrivals(documents: DataFrame, folder: str, checkpoint: str, **options) -> DataStreamWriter:
    """Stream writer that keeps requirements and candidates under a folder up to date.

    Requirements are written by framework with dynamic overwrite, so a
    micro-batch that runs again leaves the same rows.
    """

    def handle(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        table = f"{folder}/requirements"
        chosen = batch.join(latest(batch.select("framework", "path")), ["framework", "path"], "left_semi")
        fresh = flatten_requirements(decode_documents(chosen), framework_dim(spark))
        writer = gather(fresh, "framework").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("framework").parquet(table)
        changed = batch.select("framework").distinct()
        update_candidates(read_requirements(spark, table), folder, changed=changed, **options)

    return documents.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
