"""peakflow: movement-traffic cleaning, peak labelling and analytics as Spark DataFrame operators."""

from .spec import FLIGHTS, MovementSpec  # noqa: F401

__version__ = "0.1.0"
