"""Table jobs: DataFrame in, DataFrame out."""
