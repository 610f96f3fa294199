"""Training-data pipeline operators (packing, near duplicates, search,
classifiers, sharding, fingerprints, web archives, mixing).

Nothing outside this folder imports it; ``queries.py`` registers the driver
queries of these operators.
"""
