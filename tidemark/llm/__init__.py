"""Operations of a training-data pipeline, one module each, next to the query that applies it."""
