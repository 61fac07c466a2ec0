"""Partitioned, rerun-safe writers for items, documents and summaries."""

from mailsift.sinks.writers import (
    commit, existing_folders, overwrite_partitions, recover, remove_emptied, report_key,
    text_file_digests, write_items_jsonl, write_reports, write_summaries, write_text_documents,
    write_text_files,
)

__all__ = ["commit", "existing_folders", "overwrite_partitions", "recover", "remove_emptied",
           "report_key", "write_items_jsonl", "write_reports",
           "text_file_digests", "write_summaries", "write_text_documents", "write_text_files"]
