"""Queries: joins, mixing and token files."""

from __future__ import annotations

from ..session import scratch_path
from . import mixing, ngramjoin, tokenfiles
from .catalog import query, table


@query("op6_source_mixing")
def op6_source_mixing(spark, sf_dir):
    drawn = mixing.mix(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", "taken", "copies")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op10_token_files")
def op10_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    tokenfiles.write_token_files(table(spark, sf_dir, "documents"), path, word_tokenizer(), lower_words=True)
    return tokenfiles.read_checks(spark, path)


@query("op5_ngram_jaccard_join")
def op5_ngram_jaccard_join(spark, sf_dir):
    return ngramjoin.ngram_jaccard_classes(table(spark, sf_dir, "documents"))
