"""Training-data operators: archives, deduplication, scoring, formatting, mixing,
packing, sharding and token counts. Nothing else in the library imports this."""
