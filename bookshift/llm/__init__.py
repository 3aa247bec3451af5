"""Training-data operators on text tables (documents, conversations, pages).

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when it is installed.
"""
