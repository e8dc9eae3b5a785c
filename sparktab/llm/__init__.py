"""Operations of a training-data pipeline: archives, tokenizers, deduplication, privacy, quality.

Nothing else in the library imports this subpackage.
"""
