"""The registered queries of this subpackage, and those that SQL can express as SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carledger.llm import boilerplate, bpe, decontaminate, divergence, language, neardup, neighbours, pages, pieces, private, quality, spans, turntrie
from carledger.llm.tables import prepare

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of two-word shingles are similar to 0.8 or more."""
    return neardup.groups(_table(spark, sf_dir, "documents"), width=2)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learnt from labels."""
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold passages of the benchmark."""
    return decontaminate.digests(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract(_table(spark, sf_dir, "pages"))


def op7_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document, and of terms that reveal them."""
    return private.digests(_table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that aren't held out."""
    return language.predictions(_table(spark, sf_dir, "documents"))


def op9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of repeated spans, but for the first place of each."""
    return spans.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that many sites share."""
    return boilerplate.digests(_table(spark, sf_dir, "documents"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of pieces and decoded text of every document, as digests."""
    return pieces.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return turntrie.trie(_table(spark, sf_dir, "conversations"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the words of each source lie from the others of its language, and its ten most telling terms."""
    return divergence.divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_rotated_codes": op1_rotated_codes,
    "op2_minhash": op2_minhash,
    "op3_bpe": op3_bpe,
    "op4_quality": op4_quality,
    "op5_decontaminate": op5_decontaminate,
    "op6_pages": op6_pages,
    "op7_private": op7_private,
    "op8_language": op8_language,
    "op9_spans": op9_spans,
    "op10_boilerplate": op10_boilerplate,
    "op11_pieces": op11_pieces,
    "op12_turn_trie": op12_turn_trie,
    "op13_divergence": op13_divergence,
}

ORACLES: dict[str, str] = {
    "op2_minhash": neardup.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op10_boilerplate": boilerplate.ORACLE,
    "op12_turn_trie": turntrie.ORACLE,
    "op13_divergence": divergence.ORACLE,
}
