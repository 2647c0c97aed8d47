from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsemart.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="pulsemart-test-")
    s = get_session(
        "local[*]",
        app="pulsemart-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt},
    )
    yield s
    s.stop()
