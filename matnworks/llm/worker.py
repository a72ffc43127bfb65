"""What a Python worker keeps from one task to the next."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any


def keep(key: Hashable, make: Callable[[], Any]) -> Any:
    """The object that ``make`` returned in this process for ``key``; functions sent by value have no other memory."""
    held = sys.modules.setdefault("matnworks_worker", types.ModuleType("matnworks_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]
