"""Training-data operators: dedup, classification, extraction, tokenising, decontamination, archives.

Nothing else in the library imports this subpackage.
"""
