"""Training-data operators (deduplication, filtering, mixing, packing).

Nothing else in the library imports this subpackage; its queries are added by
``__spark_entry__.py`` when it is present. See README.md in this folder for
the method, the defined results for odd input and measured figures.
"""
