"""Order-entry data on Spark: generate, apply, answer, audit and analyse whole tables at once."""
