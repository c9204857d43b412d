"""Input sources: typed file readers and writers, and the analyses' inputs derived from the test tables."""
