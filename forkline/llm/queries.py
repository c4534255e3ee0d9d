"""The registered queries of this subpackage and their SQL."""

import public_tokenizers
from pyspark.sql import functions as F

from forkline.llm import bpe, hyperminhash, langid, lines, merkle, packing, permutation, pii, quality, ring, substring, urls, whitening
from forkline.llm.common import table


def tokenizer(name="byte_bpe_50k.json"):
    return public_tokenizers.path(name)


def quality_rules(spark, sf_dir):
    return quality.measure_lines(table(spark, sf_dir, "documents")).drop("clean_text")


def substring_dedup(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def permutation_index(spark, sf_dir):
    return permutation.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def bounded_ring(spark, sf_dir):
    return ring.shard(table(spark, sf_dir, "documents"), 24)


def _spans(col):
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def pii_field(spark, sf_dir):
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(_spans(base), 256).alias("base_sha256"),
                        _spans(F.col("spans")).alias("spans"))


def near_duplicates(spark, sf_dir):
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


def pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


def language_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


def bpe_round_trip(spark, sf_dir):
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer())


def perfect_hash_lines(spark, sf_dir):
    return lines.drop_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def chebyshev_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def merkle_manifest(spark, sf_dir):
    proofs = merkle.manifest(table(spark, sf_dir, "documents"), claim=merkle.tampered()).prove("claim")
    proof = F.array_join(F.zip_with("before", "after", lambda b, a: F.concat(b, a)), "")
    return proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_quality_rules": quality_rules,
    "op2_substring_dedup": substring_dedup,
    "op3_permutation_index": permutation_index,
    "op4_bounded_ring": bounded_ring,
    "op5_pii_field": pii_field,
    "op6_hyperminhash": near_duplicates,
    "op7_shortest_pack_first": pack,
    "op8_language_spans": language_spans,
    "op9_url_filter": url_filter,
    "op10_bpe": bpe_round_trip,
    "op11_perfect_hash_lines": perfect_hash_lines,
    "op12_chebyshev_whitening": chebyshev_whitening,
    "op13_merkle_manifest": merkle_manifest,
    "pipeline": pipeline,
}

ORACLES = {"op1_quality_rules": quality.ORACLE, "op2_substring_dedup": substring.ORACLE, "op6_hyperminhash": hyperminhash.ORACLE,
           "op11_perfect_hash_lines": lines.ORACLE, "op13_merkle_manifest": merkle.ORACLE}
