"""Training-data operators: tokens, secrets, decontamination, licences, dedup, PII, WARC, toxicity.

Nothing else in the library imports this subpackage.
"""
