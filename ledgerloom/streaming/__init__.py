"""Micro-batch runs over newly landed files."""
from .microbatch import run_stream
