"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telestrata.llm import (
    bpe,
    collocations,
    decontam,
    langid,
    mainhtml,
    neardup,
    pii,
    quality,
    sentencepiece,
    spelling,
    toxicity,
    urls,
    warc,
)
from telestrata.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_neardup(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.classes(table(spark, sf, "documents"))


def op3_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"))


def op4_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digests(table(spark, sf, "documents"))


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return langid.identify(docs, langid.fit(docs))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = bpe.with_token_counts(docs, vocabulary("byte_bpe_50k.json"))
    return counted.selectExpr(
        "doc_id",
        "cast(octet_length(coalesce(text, '')) as bigint) as n_bytes",
        "cast(n_tokens as bigint) as n_tokens",
        "n_tokens > 1024 as over_limit",
    )


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf, "labels")))


def op8_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return sentencepiece.encoded(docs, vocabulary("piece_bpe_32k.model")).drop("text")


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"))


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op11_html(spark: SparkSession, sf: str) -> DataFrame:
    return mainhtml.texts(table(spark, sf, "pages"))


def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.groups(table(spark, sf, "documents"))


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_neardup": op2_neardup,
    "op3_urls": op3_urls,
    "op4_pii": op4_pii,
    "op5_language": op5_language,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_warc": op9_warc,
    "op10_decontaminate": op10_decontaminate,
    "op11_html": op11_html,
    "op12_spelling": op12_spelling,
    "op13_collocations": op13_collocations,
}
