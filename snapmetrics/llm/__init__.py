"""Training-data operators: packing, deduplication, cleaning, scoring,
search, tokenizing and archives.  Nothing else in the library imports this
subpackage."""
