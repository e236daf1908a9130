"""casona: property-listing analytics as PySpark jobs.

Raw pages -> extracted records -> normalized -> resolved -> enriched -> canonical -> published,
plus the search, operations and sync queries over the result.
"""
