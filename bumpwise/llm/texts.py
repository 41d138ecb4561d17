"""Arrow helpers for texts inside tasks."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc


def lowered_texts(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, null as empty, in buffers of their own.

    The string kernels misread the offsets of a sliced array, so the texts are copied first.
    """
    return pc.ascii_lower(pa.array([text or "" for text in texts.to_pylist()], pa.large_string()))
