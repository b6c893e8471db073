"""Corpus statistics on Spark: word counts, co-occurrence, document frequency and TF-IDF."""
