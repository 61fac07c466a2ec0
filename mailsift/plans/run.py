"""The end-to-end digest job: messages in, dated outputs out.

Stages are written once and read back, so every consumer (lists, prompts,
reports, counts) reuses them instead of recomputing extraction and dedupe,
and a lost executor only repeats the stage it was in:

    <out>/items       K1  saved items, JSON lines
    <out>/lists       K2  Markdown list of saved items, one text file per report
    <out>/prompts     K3  prompts (selected items)
    <out>/summaries   K4  model output per report and backend
    <out>/reports     K5  report documents
    <out>/funnel      A2  stage counts
    <out>/health      A2  messages decoded, pages read, and those that could not be (of the last run)

Each holds a folder per report; only the folders of this run's reports change (K7).
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsift.operators.documents import (
    build_prompts, render_item_list, render_report, report_metadata,
)
from mailsift.operators.inference import Factory, infer
from mailsift.operators.items import number_items
from mailsift.operators.metrics import funnel_counts
from mailsift.plans.digest import DigestParams, Health, digest_stages
from mailsift.session import written
from mailsift.sinks import (
    write_items_jsonl, write_reports, write_summaries, write_text_documents, write_text_files,
)


def run_digest(messages: DataFrame, p: DigestParams, out_dir: str, generated_at: str,
               backend: str = "echo", backends: Mapping[str, Factory] | None = None,
               options: Mapping[str, object] | None = None) -> dict[str, str]:
    """Run the whole digest for every report in ``messages``; returns the output paths.

    Touches the folders of those reports alone: a report that has nothing left
    loses its files (I6), and reports of other runs are neither read nor
    written. Stages shared by several outputs are written once in the
    session's shared folder.
    """
    by = list(p.report_by)
    paths = {k: os.path.join(out_dir, k)
             for k in ("items", "lists", "prompts", "summaries", "reports", "funnel", "health")}
    health = Health()
    stages = digest_stages(messages, p, health)
    touched = written(messages.select(*by).distinct(), "touched")

    # Saved set (before the keyword filter), numbered per report.
    saved = written(number_items(stages["saved"], p.item_order, by=by), "saved")
    write_items_jsonl(saved, paths["items"], partition_by=by, touched=touched)
    write_text_files(render_item_list(saved, by), paths["lists"], "markdown", by, touched=touched)

    selected = written(stages["numbered"], "selected")
    prompts = written(build_prompts(selected, p.terms, by), "prompts")
    write_text_documents(prompts, paths["prompts"], "prompt", by, touched=touched)

    # Model calls run once; everything downstream reads the written table.
    summaries = written(infer(prompts, backend, key=[*by, "chunk"], backends=backends,
                              partitions=messages.sparkSession.sparkContext.defaultParallelism,
                              options=options), "summaries")
    write_summaries(summaries, paths["summaries"], partition_by=[*by, "backend"],
                    touched=touched.withColumn("backend", F.lit(backend)))

    meta = report_metadata(selected, p.terms, by, generated_at)
    reports = written(render_report(meta, summaries, by), "reports")
    write_text_documents(reports, paths["reports"], "html", by, touched=touched)

    # Scanned and matched are counted on header columns; no body is decoded for it.
    funnel = written(funnel_counts({"scanned": stages["scanned"], "matched": stages["matched"],
                                    "saved": saved, "selected": selected}, by), "funnel")
    write_reports(funnel, paths["funnel"], by, touched)
    # Errors were counted by the job that extracted the items; messages of no report have no folder.
    spark = messages.sparkSession
    spark.createDataFrame(sorted(health.counts().items()), "what string, n long").coalesce(1) \
        .write.mode("overwrite").json(paths["health"])
    return paths
