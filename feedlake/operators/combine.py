"""Union sources by column name (G6 guard included)."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


def combine_sources(frames: Sequence[DataFrame]) -> DataFrame | None:
    """Union all by column name; a column missing from a frame is null there;
    duplicates are kept. Returns ``None`` (with a warning) for no frames.

    The fold builds one ``Union`` node over all inputs: one job scans them
    together, each input reading only its own files.
    """
    frames = list(frames)
    if not frames:
        log.warning("no sources processed; nothing to combine")
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
