"""Training-data operators: token counts, near-duplicates, licences, exact search, line and
span deduplication, mixing, WARC archives, decontamination and a quality classifier.

Nothing outside this package imports it; ``queries.py`` lists what the driver may run.
"""
