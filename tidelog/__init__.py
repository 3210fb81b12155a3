"""Transactional change data on Spark: decode, check, fold, evolve and report ordered change logs."""
