"""Operations of a training-data pipeline: scans, filters, duplicates, mixing, sharding, tokenizing."""
