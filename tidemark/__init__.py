"""Article attention analytics on Spark: edits as the leading signal, views as the lagging one."""

from tidemark.params import Params

__all__ = ["Params"]
