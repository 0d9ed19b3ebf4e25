"""trustframe: Spark-native operators for auditing and preparing data for
binary classifiers: cleaning, encoding, exact seeded sampling, reweighing,
group fairness, drift, monitoring, scoring and attribution.

Every operator is a function ``DataFrame -> DataFrame`` with explicit
parameters; nothing holds a global session.
"""

from trustframe.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
