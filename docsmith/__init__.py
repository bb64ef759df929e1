"""docsmith: nested search documents from a normalised media catalogue, on Spark."""

from .params import Options, Params  # noqa: F401
