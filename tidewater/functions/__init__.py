"""Scalar expressions."""

from tidewater.functions.exprs import *  # noqa: F401,F403
