"""tidepanel: panel time-series analytics as PySpark DataFrame functions."""

from tidepanel.spec import ENERGY, PanelSpec

__all__ = ["ENERGY", "PanelSpec"]
