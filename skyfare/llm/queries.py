"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.llm import lang_id
from skyfare.llm.best_fit import cut_documents, pack_best_fit
from skyfare.llm.common import joined_on
from skyfare.llm.conversation_repair import COUNTS, repair, repaired_digests
from skyfare.llm.exact_dedup import exact_dedup
from skyfare.llm.license_scan import license_scan
from skyfare.llm.license_texts import PHRASES, TEMPLATES
from skyfare.llm.line_dedup import line_dedup
from skyfare.llm.merkle_manifest import build_manifest, folded, hex_text, leaf_digest, proof_text, proofs
from skyfare.llm.multi_index import nearest_neighbours
from skyfare.llm.packing import pack
from skyfare.llm.sentence_pieces import decode_pieces, encode_pieces
from skyfare.llm.simhash import simhash_components
from skyfare.llm.token_counts import token_counts
from skyfare.llm.token_files import read_token_files, write_token_files
from skyfare.session import scratch_path, table_path

#: Documents of more tokens are marked by op4.
TOKEN_LIMIT = 512
#: Longest sequence, tokens of a batch (padding included) and number of bucket lengths for op5.
SEQUENCE, BATCH_TOKENS, BUCKETS = 2048, 16384, 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_table(spark, sf_dir, "documents"), shingle=3, reach=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def packed(docs: DataFrame) -> DataFrame:
    """Documents packed by their token counts."""
    counts = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pack(counts, SEQUENCE, BATCH_TOKENS, BUCKETS)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(_table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def held_out(id_col: str = "doc_id"):
    """Documents of the third fold, by the CRC-32 of the id as text; the model never sees them."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = lang_id.fit(docs.filter(~held_out()))
    return (lang_id.predict(docs, model)
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = decode_pieces(encode_pieces(_table(spark, sf_dir, "documents"), model), model)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.crc32(ids).alias("ids_crc32"),
                       F.sha2("text", 256).alias("decoded_sha256"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents"), PHRASES, TEMPLATES)

    def joined(labels):
        return F.array_join(F.sort_array(F.array_distinct(labels)), ",")

    base = F.col("places.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, F.col("spans.label"))).alias("labels"), "score")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    manifest = write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                 folder, end_id=2)
    return read_token_files(spark, folder, manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given to the user, by a hash of their key."""
    rows = turns.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("how", F.crc32(key) % 20).filter("how != 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("how") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    rows = damaged(turns)
    found = repair(rows)
    both = joined_on(found.report, repaired_digests(rows, found), ["conv_id"], "inner")
    every = joined_on(turns.select("conv_id").distinct(), both, ["conv_id"], "left")
    return every.select("conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in COUNTS],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: What a manifest leaf is made of.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; of some, a leaf of the lower-cased text is folded instead of their own."""
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    other = leaf_digest([F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in LEAF])
    manifest = build_manifest(docs.withColumn("tampered", F.when(tampered, other)), "doc_id", "source", LEAF, ["tampered"])
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    found = proofs(manifest, manifest.leaves.select("tree", "rank", "doc_id", "leaf", "tampered"))
    back = hex_text(folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select("doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
                        root.alias("root"), F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
                        back.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


#: Tokens of a packed sequence and the id that ends a document for op13.
CAPACITY, END_ID = 4096, 1


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                           CAPACITY, END_ID)
    light = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack_best_fit(light, CAPACITY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_multi_index": op2_multi_index,
        "op3_simhash": op3_simhash,
        "op4_token_counts": op4_token_counts,
        "op5_packing": op5_packing,
        "op6_line_dedup": op6_line_dedup,
        "op7_language_id": op7_language_id,
        "op8_sentence_pieces": op8_sentence_pieces,
        "op9_license_scan": op9_license_scan,
        "op10_token_files": op10_token_files,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_best_fit_packing": op13_best_fit_packing,
    }
