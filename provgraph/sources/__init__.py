from provgraph.sources.tables import Sources
from provgraph.sources.adapter import load_testdata

__all__ = ["Sources", "load_testdata"]
