"""Every operator of this subpackage as a query over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    collocations,
    embedding_dedup,
    html_text,
    language,
    line_dedup,
    minhash,
    neighbours,
    packing,
    sentence_pieces,
    token_output,
    tokens,
    urls,
    whitening,
)

# Tokens of a training sequence.
SEQUENCE = 4096
# Words of the shortest passage whose repeats are removed.
PASSAGE_WORDS = 50
URL_RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document under the multilingual byte vocabulary, and back to bytes."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = bpe.encode(documents, ranks, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    return bpe.digests(decoded).drop("ids", "decoded")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from those that are not held out."""
    return language.predicted(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laid-out visible text of each page."""
    return html_text.rendered(_table(spark, sf_dir, "pages", "page_id", "html"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents, cut into pieces, in sequences of 4096 tokens."""
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packed_documents(documents)


def packed_documents(documents: DataFrame) -> DataFrame:
    """Pieces of documents by the word vocabulary, each document ended by id 1, and places."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    pieces = tokens.pieces(documents, vocabulary, 1, SEQUENCE)
    return packing.pack_table(pieces, SEQUENCE, ["doc_id", "piece", "ids_crc32"])


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of each page's URL."""
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    return urls.judge(pages, urls.train(urls.labelled_urls(spark)), URL_RULES).drop("url")


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors of largest inner product for each whose id is divisible by 20."""
    embeddings = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return neighbours.nearest(embeddings, F.col("vec_id") % 20 == 0, k=20)


def op7_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label with a cosine of 0.93 or more, grouped."""
    embeddings = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return embedding_dedup.near_duplicate_vectors(embeddings, least=0.93)


def op8_superminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share four fifths of their two-word shingles, grouped."""
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return minhash.near_duplicates(documents, words=2, percent=80)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more, inside lines too, that were seen before."""
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return line_dedup.without_repeats(documents, min_words=PASSAGE_WORDS)


def op10_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed id matrices of all documents by the English byte vocabulary, ended by id 50256."""
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_output.packed_matrices(
        documents, ranks, public_tokenizers.PATTERN, 50256, SEQUENCE, 50256
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened principal components of each vector."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document's pieces, how many of its bytes they cover, and back to text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = sentence_pieces.encode(documents, model)
    widths = F.zip_with("ends", "begins", lambda end, begin: end - begin)
    covered = F.aggregate(widths, F.lit(0).cast("long"), lambda total, width: total + width)
    encoded = encoded.select("doc_id", "ids", covered.alias("n_bytes_covered"))
    decoded = sentence_pieces.decode(encoded, model)
    return bpe.digests(decoded).drop("ids", "decoded")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language whose words belong together most."""
    return collocations.collocations(_table(spark, sf_dir, "documents", "text", "lang"))


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_language_id": op2_language_id,
    "op3_html_text": op3_html_text,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_url_filter": op5_url_filter,
    "op6_nearest_vectors": op6_nearest_vectors,
    "op7_vector_near_dedup": op7_vector_near_dedup,
    "op8_superminhash_dedup": op8_superminhash_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_matrices": op10_token_matrices,
    "op11_whitening": op11_whitening,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op9_line_dedup": line_dedup.oracle(PASSAGE_WORDS),
    "op13_collocations": collocations.oracle(),
}
