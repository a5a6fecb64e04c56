"""Training-data operators: dedup, scans, quality, mixing, packing, output.

Each module holds one operator with its own interface; :mod:`clickpulse.llm.queries`
registers one query for each. Nothing outside this subpackage imports it.
"""

import os

from pyspark import SparkContext


def _let_workers_import() -> None:
    """Python workers on this machine find the package where the driver found
    it, whatever its working directory. A cluster ships it (``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    running = SparkContext._active_spark_context
    for env in (os.environ, *([running.environment] if running else [])):
        path = env.get("PYTHONPATH", "")
        if root not in path.split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, path)))


_let_workers_import()
