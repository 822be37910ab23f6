"""DataFrame operators of the curation and dataset pipeline."""
