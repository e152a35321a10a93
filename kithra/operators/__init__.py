"""DataFrame operators: search, training, codecs, text joins, evaluation."""
