"""The corpus pipeline as a query."""

from __future__ import annotations

from .catalog import query


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
