"""Operators for preparing training text: tokens, licences, quality, leaks, copies, toxicity, pages and archives."""
