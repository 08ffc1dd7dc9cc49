"""Operations of a training-data pipeline: deduplication, extraction, packing, token counts, quality.

Every operator takes a DataFrame and returns a DataFrame. Nothing else in the library imports this
subpackage. ``queries.py`` binds the operators to the tables with production parameters.
"""
