"""Imports every module that registers queries."""

from ratingloom.plans import (  # noqa: F401
    core,
    exchange,
    insight,
    linearmodels,
    models,
    patterns,
    synthetic,
    trained,
    vectors,
)
