"""Whole runs: a parallel backfill and a run window by window, under one set of rules."""
