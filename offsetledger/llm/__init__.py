"""Operations of a training-data pipeline: extraction, cleaning, deduplication, packing, search."""
