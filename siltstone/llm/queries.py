"""The training-data operators as queries over the test tables, and SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm.sql import ORACLE
from siltstone.session import scratch_path

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
#: Most ids in a sequence, and the id that ends each document.
CAPACITY, END_ID = 1024, 2


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.page_difference import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.jaccard_join import link_components

    return link_components(table(spark, sf_dir, "documents"))


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.language_mixture import identify_documents

    return identify_documents(table(spark, sf_dir, "documents"))


def op4_config_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.config_packing import pack_documents

    return pack_documents(
        table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), CAPACITY, END_ID
    )


def op5_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.bpe_transducer import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


def op6_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.bottom_k import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_gear_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.gear_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.line_crf import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.ngram_ratio import judge_documents

    return judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_rans_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.rans_output import read_documents, write_tokens

    folder = scratch_path(spark, "rans")
    write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer(WORD_BPE), END_ID)
    return read_documents(spark, folder)


def op11_bottom_k_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.minhash_dedup import deduplicate

    return deduplicate(table(spark, sf_dir, "documents"))


def op12_misra_gries_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.phrase_mining import mine_phrases

    return mine_phrases(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.merkle_manifest import verify_documents

    return verify_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_page_difference": op1_page_difference,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_mixture": op3_language_mixture,
    "op4_config_packing": op4_config_packing,
    "op5_bpe_transducer": op5_bpe_transducer,
    "op6_bottom_k": op6_bottom_k,
    "op7_gear_dedup": op7_gear_dedup,
    "op8_line_crf": op8_line_crf,
    "op9_ngram_ratio": op9_ngram_ratio,
    "op10_rans_output": op10_rans_output,
    "op11_bottom_k_dedup": op11_bottom_k_dedup,
    "op12_misra_gries_phrases": op12_misra_gries_phrases,
    "op13_merkle_manifest": op13_merkle_manifest,
}
