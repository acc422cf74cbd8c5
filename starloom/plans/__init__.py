"""Plans: training, recommendation, evaluation and data preparation built from the operators."""
