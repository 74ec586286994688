"""What a Python worker keeps between tasks."""

from __future__ import annotations

import sys
import types


def kept() -> dict:
    """A dictionary of the running process.

    Functions may travel to the workers by value, with copies of their module's variables, so a cache in a module would be empty in every task.
    """
    name = "_tideline_worker"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("kept", {})
