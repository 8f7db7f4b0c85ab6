"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from riskloom.llm import sql
from riskloom.llm.frames import table

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register


@query("op2_secret_scan", sql.SECRETS)
def op2_secret_scan(spark, sf_dir):
    from riskloom.llm.secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    import public_tokenizers

    from riskloom.llm.tokens import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_line_dedup", sql.LINE_DEDUP)
def op8_line_dedup(spark, sf_dir):
    from riskloom.llm.line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query("op9_quality_rules", sql.QUALITY)
def op9_quality_rules(spark, sf_dir):
    from riskloom.llm.quality import quality

    return quality(table(spark, sf_dir, "documents")).drop("text_key")


@query("op10_warc_round_trip", sql.WARC)
def op10_warc_round_trip(spark, sf_dir):
    from riskloom.llm.warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"))


@query("op7_decontamination", sql.CONTAMINATION)
def op7_decontamination(spark, sf_dir):
    from riskloom.llm.contamination import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key", "items")


@query("op1_substring_dedup", sql.SUBSTRING_DEDUP)
def op1_substring_dedup(spark, sf_dir):
    from riskloom.llm.repeats import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op4_suffix_array_dedup")
def op4_suffix_array_dedup(spark, sf_dir):
    from riskloom.llm.byte_dedup import byte_dedup

    return byte_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3_jaccard_join", sql.JACCARD)
def op3_jaccard_join(spark, sf_dir):
    from riskloom.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op5_mixing")
def op5_mixing(spark, sf_dir):
    from riskloom.llm.mixing import mixed_sample

    return mixed_sample(table(spark, sf_dir, "documents"))


@query("op11_near_vectors", sql.NEAR_VECTORS)
def op11_near_vectors(spark, sf_dir):
    from riskloom.llm.vector_graphs import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op12_spelling_variants", sql.SPELLING)
def op12_spelling_variants(spark, sf_dir):
    from riskloom.llm.spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


@query("op13_prefix_trie", sql.PREFIX_TRIE)
def op13_prefix_trie(spark, sf_dir):
    from riskloom.llm.prefix_trie import conversation_trie

    return conversation_trie(table(spark, sf_dir, "conversations")).drop("key")


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
