"""Scalar expressions (F1-F13): JVM-side Column builders, no Python UDF."""

from ledgerline.functions.expressions import *  # noqa: F401,F403
