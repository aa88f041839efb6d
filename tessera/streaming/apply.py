"""Applying fitted transforms to a stream.

The reference scores new batches with preprocessing fitted on training data.
Every ``apply_*`` of ``tessera.operators.clean`` / ``features`` is a
stateless projection with literal parameters, so the same functions run
unchanged on a streaming DataFrame. Nothing is fitted on the stream and no
state is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators.clean import CleanState, apply_clean
from tessera.roles import Roles


def clean_stream(stream: DataFrame, state: CleanState, roles: Roles = Roles()) -> DataFrame:
    """T14 apply on a streaming DataFrame (inline dictionaries only: a
    joined dictionary would be a stream-static join, also supported)."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return apply_clean(stream, state, roles)
