"""Operations of a training-data pipeline: search, packing, secrets, archives, language, near-duplicates, chat, tokens,
quality, mixing, hard negatives, a quality classifier and prefix tries. Nothing else in the library imports this package."""
