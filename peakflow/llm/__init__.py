"""Training-data operators: search, scans, token counts, classifiers and deduplication.

Nothing else in the library imports this subpackage. Each module holds one operator;
``queries`` registers one query per operator, which derives digest columns from the
operator's own output.
"""
