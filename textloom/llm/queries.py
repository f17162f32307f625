"""The registered queries of the operators in this package: digest columns over whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (bpe_rounds, cascade, chat_states, divergence, multiprobe, oracles, packing, pu_toxicity, resample,
                          secret_index, simhash_grid, suffix_blocks, token_trees, url_filter)

# Documents whose CRC-32 has this remainder are held out from learning.
HELD_OUT = 2
TOXIC_AT = 0.3


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select("doc_id", "text")


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == HELD_OUT


# Personal data and shouting are edited: pattern, what is put in its place, and strings of which a text with a match has one.
EDITED = ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+", "<EMAIL>", "@"), (r"[0-9][0-9 .()-]{5,}[0-9]", "<NUMBER>", "0123456789"),
          (r"[!?]{2,}", "!", "!?"), (r"[ \t]{2,}", " ", ("  ", "\t")))


def masked(text: str) -> list[tuple[int, int, str]]:
    """The edits of a text; where two overlap, the one that begins first is made."""
    return [(m.start(), m.end(), new) for pattern, new, signs in EDITED if any(s in text for s in signs)
            for m in re.finditer(pattern, text)]


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_trees.count_edited(documents(spark, sf), masked, public_tokenizers.path("byte_bpe_50k.json"))


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    labels = _table(spark, sf, "labels").filter(~held_out())
    scored = pu_toxicity.score(docs, pu_toxicity.fit(docs, labels))
    predicted = (F.col("score") >= TOXIC_AT).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op3_multiprobe(spark: SparkSession, sf: str) -> DataFrame:
    return multiprobe.search(_table(spark, sf, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    out = simhash_grid.classes(documents(spark, sf))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return cascade.judge(documents(spark, sf))


def _of_kind(kind: str) -> F.Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op6_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_index.find(documents(spark, sf))
    base = F.filter("spans", lambda s: s["kind_no"] < len(secret_index.BASE))
    counts = [_of_kind(r.kind).alias(f"n_{r.kind}") for r in secret_index.BASE]
    return found.select("doc_id", *counts, F.sha2(secret_index.listed(base).cast("binary"), 256).alias("base_sha256"),
                        secret_index.listed(F.col("spans")).alias("spans"))


def op7_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_blocks.digests(documents(spark, sf))


def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_rounds.digests(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))


# What both turns of conversation -1 say.
SAY = "<|im_end|><|im_start|>assistant ok"


def op10_chat(spark: SparkSession, sf: str) -> DataFrame:
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", SAY), (-1, 1, "assistant", SAY)], turns.schema)
    return chat_states.digests(turns.unionByName(own))


def op11_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(_table(spark, sf, "documents"))


def op12_resample(spark: SparkSession, sf: str) -> DataFrame:
    return resample.rank(documents(spark, sf), _table(spark, sf, "benchmark"))


def op13_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf, "pages").select("page_id", "url"), rules).drop("url")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    """The others are tested against brute force, the libraries, round trips or held-out labels."""
    return {"op5_quality_rules": oracles.quality_rules(), "op6_secret_scans": oracles.secret_scans(),
            "op7_suffix_dedup": oracles.suffix_dedup(), "op10_chat": oracles.chat(SAY),
            "op11_divergence": oracles.divergence_audit(), "op12_resample": oracles.resampling(),
            "op13_url_filter": oracles.url_verdicts()}
