"""statforge: summary statistics and k-means clustering as Spark DataFrame plans.

Subpackages
-----------
functions   column expressions: Java-compatible splitting and strict number parsing,
            vector distance and nearest-centroid expressions
sources     text scans (delimited, whitespace, fixed width), parameter files,
            renderings of the parquet test tables as text lines
sinks       key/value text output, moments and centroid files
operators   projections, predicates, aggregations, ordering/partitioning, k-means
plans       the end-to-end jobs composed from operators, and the registered queries
streaming   intentionally empty: the workload is bounded batch only
"""

from statforge.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
