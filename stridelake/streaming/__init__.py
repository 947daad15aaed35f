"""Resumable ingest: ledger, batches and the file stream."""
