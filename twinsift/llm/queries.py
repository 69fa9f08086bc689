"""The registered queries of this subpackage: thin wrappers that apply each
operator to its whole table and derive the contract's columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinsift.llm import common, oracle


def word_tokenizer() -> str:
    """The vocabulary file; executors have the library, so only its name
    leaves the driver in the general operators' parameters."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_prefix_tree(spark, sf_dir):
    from twinsift.llm import chat_format

    c = common.table(spark, sf_dir, "conversations")
    probe = "</s>[INST] ok [/INST]"
    kinds = {f.name: f.dataType for f in c.schema}
    extra = spark.range(2).select(F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    tree, convs = chat_format.prefix_tree(c.select("conv_id", "turn", "role", "text").unionByName(extra))
    tree, convs = common.stored(tree, "chat-tree"), common.stored(convs, "chat-conversations")
    return chat_format.digests(chat_format.read_conversations(tree, convs))


def _crc(column: str, modulus: int):
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(modulus))


def op2_language_id(spark, sf_dir):
    from twinsift.llm import language_id

    docs = common.table(spark, sf_dir, "documents")
    held = F.coalesce(_crc("doc_id", 3) == 1, F.lit(False))
    model = language_id.fit(docs.where(~held))
    out = language_id.predict(docs, model, keep={"held_out": held})
    return out.select("doc_id", "held_out", F.col("nearest").alias("lang_pred"), "score", "rejected")


def op3_token_blocks(spark, sf_dir):
    from twinsift.llm import token_blocks

    path = common.shared_folder(spark, "token-blocks")
    token_blocks.write_blocks(common.table(spark, sf_dir, "documents"), path, word_tokenizer())
    return token_blocks.read_blocks(spark, path)


def op4_katz(spark, sf_dir):
    from twinsift.llm import katz

    out = katz.score(common.table(spark, sf_dir, "documents"), _crc("doc_id", 10) == 0)
    return out.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op5_host_rules(spark, sf_dir):
    from twinsift.llm import quality_rules

    out = quality_rules.host_level_rules(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", *[F.round(r, 6).alias(r) for r in quality_rules.RULES.values()])


def op6_decontaminate(spark, sf_dir):
    from twinsift.llm import decontaminate

    return decontaminate.contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op7_mixing(spark, sf_dir):
    from twinsift.llm import mixing

    out = mixing.mix(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op8_toxicity(spark, sf_dir):
    from twinsift.llm import toxicity

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"), training=_crc("doc_id", 5) != 0)
    out = toxicity.scored(docs, model)
    held = F.coalesce(_crc("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"),
                      (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
                      F.col("toxicity_example_ids").alias("example_ids"), F.col("toxicity_example_cosines").alias("example_cosines"))


def op9_simhash(spark, sf_dir):
    from twinsift.llm import simhash

    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    from twinsift.llm import warc

    path = common.shared_folder(spark, "warc")
    warc.write_archives(warc.with_revisits(common.table(spark, sf_dir, "pages")), path)
    out = warc.read_pages(spark, path, payloads=False)
    return out.select(F.col("x_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                      F.col("rec_type").alias("record_type"),
                      F.when(F.col("refers_to").isNotNull(), warc.referred_id("refers_to")).cast("long").alias("refers_to"))


def op11_uniform_threshold(spark, sf_dir):
    from twinsift.llm import exact_topk

    out = exact_topk.top_k(common.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 50 == 0, k=5)
    return out.withColumnRenamed("id", "vec_id")


def op12_max_sketches(spark, sf_dir):
    from twinsift.llm import max_sketch

    return max_sketch.search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op13_angular_negatives(spark, sf_dir):
    from twinsift.llm import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(common.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.col("id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_prefix_tree, op2_language_id, op3_token_blocks, op4_katz, op5_host_rules,
                                   op6_decontaminate, op7_mixing, op8_toxicity, op9_simhash, op10_warc,
                                   op11_uniform_threshold, op12_max_sketches, op13_angular_negatives)}

ORACLE_SQL = {"op1_prefix_tree": oracle.OP1, "op4_katz": oracle.OP4, "op5_host_rules": oracle.OP5, "op7_mixing": oracle.OP7,
              "op10_warc": oracle.OP10, "op11_uniform_threshold": oracle.OP11, "op12_max_sketches": oracle.OP12, "op13_angular_negatives": oracle.OP13}
