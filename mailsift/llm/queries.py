"""The operator queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.llm import (chat, licenses, maintext, mixing, neighbours, pieces, ppm, quality,
                          repair, repeats, sharding, simhash, slices)
from mailsift.llm._store import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_texts(_table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant")
                                  .alias("role"), said.alias("text"))
    done = chat.format_conversations(rows.unionByName(extra))
    done = done.withColumn("formatted", chat.formatted_text(F.col("segments"))) \
        .withColumn("back", chat.read_back(F.col("formatted")))
    turns = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                               F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                    lambda s: chat.unescape(s["text"])), "")
    return done.select("conv_id", F.size("back").cast("long").alias("n_turns"),
                       F.sha2(turns, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid_order",
                       "bad_turn")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_rows(_table(spark, sf_dir, "embeddings"),
                                   F.col("vec_id") % 100 == 0)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.duplicate_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.summary(licenses.scan(docs)).select(
        "doc_id", F.col("lic_words").alias("n_words"), "n_base", "first_word", "last_word",
        "base_labels", "labels", "score")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_copies(_table(spark, sf_dir, "documents"), keep=("doc_id",))
    return plan.select("row.doc_id", F.col("mix_size").alias("size"), "source_size", "target",
                       (F.col("copies") * F.col("mix_size")).alias("taken"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality_verdicts(_table(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("row.doc_id", *[F.col(f"q_counts.{n}").alias(n) for n in names],
                       F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.sample_segmentations(_table(spark, sf_dir, "documents"))


def op9_maintext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.main_text(_table(spark, sf_dir, "pages"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = sharding.text_sizes(_table(spark, sf_dir, "documents"))
    rows = sharding.shard_by_bytes(sizes, shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       "slot", F.lit(None).cast("int").alias("grown_shard"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows damaged by the checksum of their place (nulls: one space)."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"),
                      (F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))) % 20).alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")) \
        .otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1)
    copies = F.explode(F.array_repeat(F.struct(role.alias("role"), text.alias("text")), times))
    return hit.select("conv_id", "turn", copies.alias("row")).select("conv_id", "turn", "row.*")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    report, repaired = repair.repair(damaged(rows))
    same = lambda c: F.col("conv_id").eqNullSafe(F.col(c))
    report = written(report, "report").withColumnRenamed("conv_id", "of_report")
    digests = repair.line_digests(repaired).withColumnRenamed("conv_id", "of_digest")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (rows.select("conv_id").distinct().join(report, same("of_report"), "left")
            .join(digests, same("of_digest"), "left")
            .select("conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("row.doc_id", "n_bytes", removed.alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op13_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = slices.compress(_table(spark, sf_dir, "embeddings"))
    return slices.error_by_label(written(coded, "coded")).select(
        "row.vec_id", "code", "error", "label_error",
        F.lit(slices.books_digest(books)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_ppm, op2_chat, op3_neighbours, op4_simhash, op5_licenses, op6_mixing,
                                  op7_quality, op8_pieces,
                                  op9_maintext, op10_sharding, op11_repair, op12_repeats,
                                  op13_slices)}
