"""snapmetrics: snapshot metrics on Spark.

Resolve a regular time grid to blocks (backward as-of), rebuild nested entity
state at every snapshot block from change logs, flatten / rename / rescale
it, roll versions up to their parent, turn running totals into changes and
rolling 7/14/30-snapshot sums and means, derive rates, and publish dated
outputs and "latest" views - all as DataFrame plans.
"""

__version__ = "0.1.0"
