"""qafila: verse-corpus curation and instruction-data building on Spark."""
