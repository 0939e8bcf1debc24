"""What the tests of the library share besides fixtures; the name is not used in any folder below."""

from __future__ import annotations

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def rows(df):
    """The rows as sorted tuples; geometry and other structs compare by text."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))
