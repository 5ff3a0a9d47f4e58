"""The registered queries of this package, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillframe.llm import archive, bpe, chat, infill, langid, lm, mixing, nearcopies, neighbours, pages, partcodes, substring, topk
from quillframe.llm.common import table


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark, path) -> DataFrame:
    return substring.digest(table(spark, path, "documents"))


def op2_language_id(spark, path) -> DataFrame:
    return langid.identify(table(spark, path, "documents"))


def op3_bpe(spark, path) -> DataFrame:
    return bpe.digest(table(spark, path, "documents"), tokenizer_file())


def op4_near_copies(spark, path) -> DataFrame:
    return nearcopies.link(table(spark, path, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op5_source_mix(spark, path) -> DataFrame:
    return mixing.mix(table(spark, path, "documents"))


def op6_chat_format(spark, path) -> DataFrame:
    turns = chat.chains(chat.with_probe(table(spark, path, "conversations")))
    return chat.digest(chat.conversations_of(turns))


def op8_main_text(spark, path) -> DataFrame:
    return pages.main_texts(table(spark, path, "pages"))


def op7_top_k(spark, path) -> DataFrame:
    return topk.search(table(spark, path, "embeddings"))


def op9_near_vectors(spark, path) -> DataFrame:
    return neighbours.link(table(spark, path, "embeddings"))


def op10_lm_scoring(spark, path) -> DataFrame:
    return lm.score(table(spark, path, "documents"))


def op11_warc(spark, path) -> DataFrame:
    return archive.digest(table(spark, path, "pages"))


def op12_part_codes(spark, path) -> DataFrame:
    return partcodes.digest(table(spark, path, "embeddings"))


def op13_infill(spark, path) -> DataFrame:
    return infill.digest(table(spark, path, "documents"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_language_id, op3_bpe, op4_near_copies, op5_source_mix, op6_chat_format, op7_top_k, op8_main_text,
                                   op9_near_vectors, op10_lm_scoring, op11_warc, op12_part_codes, op13_infill)}

ORACLES = {
    "op1_substring_dedup": substring.oracle(),
    "op4_near_copies": nearcopies.oracle(),
    "op5_source_mix": mixing.oracle(),
    "op6_chat_format": chat.oracle(),
    "op7_top_k": topk.oracle(),
    "op11_warc": archive.oracle(),
    "op12_part_codes": partcodes.oracle(),
    "op13_infill": infill.oracle(),
}
