"""Operations of a training-data pipeline: dedup, filters, classifiers, tokenizers, shards."""
