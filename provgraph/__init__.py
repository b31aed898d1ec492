"""provgraph: physician <-> organisation affiliation scoring as Spark jobs.

Layout
------
- ``sources``   : source-role schemas and the adapter that derives the claim
                  roles from the driver's TPC-H-style tables.
- ``functions`` : Column-expression helpers for the SQL dialect semantics the
                  pipeline depends on (month differences, T-SQL casts, ...).
- ``operators`` : one module per pipeline stage (edges, rollup, shares,
                  patients, directory, decay, scoring, assemble).
- ``plans``     : the end-to-end DAG, materialisation points and publishing.
"""

from provgraph.config import PipelineConfig

__all__ = ["PipelineConfig"]
