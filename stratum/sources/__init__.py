"""Readers and writers: raw feeds (JSON / CSV), stored tables, feed exports, test adapters."""
