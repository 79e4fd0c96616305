"""Python code and objects that are used inside tasks."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from typing import Any

from pyspark import SparkContext, cloudpickle


def ship_with_tasks(module_name: str) -> None:
    """Send the functions of a module with the task instead of importing the module there.

    Executors then need NumPy and pandas, but not this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def share(context: SparkContext, value: Any) -> Callable[[], Any]:
    """Broadcast ``value`` with its class by value and return the function that gives it inside a task.

    A plain broadcast names the class by its module, which an executor without this package can't import. A worker loads
    a value once and keeps it, with whatever it has learned meanwhile, until a task asks for another one: then the old one
    goes and its memory is handed back, so the steps of a long job don't pile up in a reused worker.
    """
    packed = context.broadcast(cloudpickle.dumps(value))
    name = uuid.uuid4().hex

    def shared() -> Any:
        import pickle
        import sys

        kept = sys.__dict__.setdefault("_stockloom_shared", {})
        if name not in kept:
            kept.clear()
            hand_back_memory()
            kept[name] = pickle.loads(packed.value)
        return kept[name]

    return shared


def hand_back_memory() -> None:
    """Return freed memory of this process to the system, where its C library can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


ship_with_tasks(__name__)
