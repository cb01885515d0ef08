"""The message-topic job: parameters → file → normalization → representation → revision.

``process`` is the whole chain over one frame of messages; ``start_messages`` runs it per
micro-batch. Counters are the only grouping.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from recordflow.functions import text
from recordflow.operators import harvest, normalize, project, publish
from recordflow.operators.progress import counter_flags
from recordflow.sinks.representations import Representations, Revisions
from recordflow.sinks.tables import ChangeTable
from recordflow.streaming.notifications import start_notifications

JOB_NAME = "normalization"


@dataclass(frozen=True)
class Inputs:
    """``params`` by task_id, ``content`` (resource_url, file_content) by resource."""

    params: DataFrame
    content: DataFrame
    base_url: str


def process(messages: DataFrame, inputs: Inputs, *keep: str) -> DataFrame:
    """Each message with its new representation and revision, or with an exception.

    ``keep`` names columns of the messages that are handed on.
    """
    known = project.url_parts(harvest.task_params_join(messages, inputs.params)).withColumn(
        "resource_url", F.col("record_id"))
    retrieved = harvest.retrieve_file(known, inputs.content).withColumn(
        "_clean", normalize.normalized_statements(text.utf8_text(F.col("file_content"))))
    cleaned = F.col("_clean")
    deleted = F.col("marked_as_deleted")
    normalized = retrieved.withColumns({
        "exception": F.coalesce(
            "exception",
            F.when(~deleted & F.col("file_content").isNull(), F.lit("no file")),
            F.when(~deleted & cleaned.isNull(), F.lit(normalize.NOTHING_LEFT))),
        "file_content": project.keep_deleted(
            deleted, F.col("file_content"), text.utf8_bytes(cleaned)),
    })
    written = publish.write_representation(normalized, inputs.base_url)
    revised = publish.add_revision(
        written, *keep, "file_content", "output_mime_type", "cloud_id", "new_representation_name", "new_version")
    return revised.withColumns({
        "file_content": F.when(F.col("result_resource").isNotNull(), F.col("file_content")),
        "job_name": F.lit(JOB_NAME),
    })


def message_flags() -> dict:
    return counter_flags(F.col("marked_as_deleted"), F.lit(False), F.col("state") == "ERROR")


def start_messages(messages: DataFrame, inputs: Inputs, order: list[str],
                   counters: ChangeTable, folder: str, checkpoint: str,
                   interval: str | None = None, rows_per_range: int | None = None,
                   representations: Representations | None = None, revisions: Revisions | None = None,
                   ) -> StreamingQuery:
    """Runs the job over a stream; ``order`` columns tell the messages of a batch apart.

    Results with their numbers go to ``folder``, one sub-folder per micro-batch. Messages are
    processed once for their results and once, without content, for the counters' state.
    ``representations`` and ``revisions`` take up what a batch made, before its notifications.
    """
    limits = {} if rows_per_range is None else {"rows_per_range": rows_per_range}

    def store(rows: DataFrame, batch_id: int) -> None:
        if representations is not None:
            representations.write(rows.where("result_resource is not null"), batch_id)
        if revisions is not None:
            revisions.write(rows, batch_id)

    return start_notifications(
        process(messages, inputs, *order), message_flags(), order, counters, folder, checkpoint,
        interval, name=JOB_NAME, first=store, **limits)
