"""Training-data operators: extraction, filtering, deduplication, mixing and sharding.

Nothing outside this subpackage imports it; ``queries`` lists its registered queries.
"""
