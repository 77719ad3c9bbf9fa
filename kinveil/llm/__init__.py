"""Operations of a training-data pipeline: dedup, language, sharding, tokens, media, urls, mixing, search."""
