"""Row-local steps on streams.

Cleaning, encoding, parsing and scoring have no state, so the same functions
take a streaming DataFrame. Nothing else here is meant for streams: dictionaries,
samples by count, ids and training need a whole table.
"""
