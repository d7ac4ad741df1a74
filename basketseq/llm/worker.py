"""What a Python worker keeps between its tasks.

Functions travel with their tasks, so their modules' globals are new in each task;
a module of the worker's own is not.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

_KEPT = "_basketseq_worker_kept"


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """The value of ``key``, made at its first use in this process."""
    store = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
