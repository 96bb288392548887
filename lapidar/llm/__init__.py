"""Operations of a training-data pipeline: extraction, deduplication, scoring, mixing, packing, search."""
