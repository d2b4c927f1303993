"""Training-data operators: near-duplicates, classifiers, packing, mixing, sanitising, media.

Nothing outside this subpackage imports it.  ``queries.py`` lists the driver queries.
"""
