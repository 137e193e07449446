"""Column helpers and scale helpers."""

from vigil.functions.scan import RunSpec, running
from vigil.functions.sizing import bounded_broadcast, materialize
from vigil.functions.text import (WHITESPACE_CLASS, split_on_space, split_on_whitespace,
                                  strip_whitespace, try_double)

__all__ = ["RunSpec", "running", "bounded_broadcast", "materialize", "WHITESPACE_CLASS",
           "split_on_space", "split_on_whitespace", "strip_whitespace", "try_double"]
