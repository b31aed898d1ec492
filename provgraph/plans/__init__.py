"""End-to-end DAG, materialisation points, publishing and the query registry."""
