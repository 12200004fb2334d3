"""Scalar column functions (``Column -> Column``)."""

from cyclecount.functions.columns import *  # noqa: F401,F403
