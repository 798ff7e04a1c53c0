"""Training-data operators: decontamination, de-duplication, scoring, scanning and packing of text corpora.

Nothing else in the library imports this subpackage.
"""
