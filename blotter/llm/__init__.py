"""Operations of a training-data pipeline over documents, pages and vectors.

Nothing outside this package imports it; ``catalog.QUERIES`` and
``catalog.ORACLE`` are added to the driver entry when the package is present.
"""
