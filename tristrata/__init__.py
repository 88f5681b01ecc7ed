"""Three-layer (bronze, silver, gold) batch analytics written as Spark DataFrame plans."""
