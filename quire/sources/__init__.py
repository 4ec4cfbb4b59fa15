"""Readers and writers: the driver's Parquet tables and the retrieval file
formats (vocabulary, file list, inverted file, topic XML, document XML,
document lengths, judgments, run files)."""
