"""The per-document pipeline on a stream of documents."""
