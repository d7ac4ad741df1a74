"""basketseq: basket-sequence features for next-basket models, on PySpark."""
