"""Table operators: cleaning, sampling, evaluation and forests."""
