"""Python functions for executors that may lack this package."""

from __future__ import annotations

import os
import sys
from pathlib import Path

from pyspark import cloudpickle


def ship(*modules: str) -> None:
    """Let executors run the modules' functions even if they cannot import this package.

    Where the package's folder is on PYTHONPATH, executors import it; else its
    functions travel inside the task.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = [os.path.realpath(p) for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()] if p]
    if root not in known:
        for name in modules:
            cloudpickle.register_pickle_by_value(sys.modules[name])
