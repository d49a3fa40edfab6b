"""Operations of a training-data pipeline, their queries and the same queries in SQL."""
