"""Operators: load (dedupe, insert-only, quarantine, summaries), lookup, progress, quality."""
