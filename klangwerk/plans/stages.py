"""Stage reuse by content: a stage runs again only if what it reads, its options or its code changed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from pathlib import Path


def signature(inputs: dict[str, str], options: dict, code: list[str] = ()) -> str:
    """inputs: name -> content digest; code: paths of the modules that the stage runs."""
    sums = {p: hashlib.sha256(Path(p).read_bytes()).hexdigest() for p in code}
    return hashlib.sha256(json.dumps([inputs, options, sums], sort_keys=True).encode()).hexdigest()


def run_stage(state: str, own: str, stage: Callable[[str], dict[str, str]], there: Callable[[dict[str, str]], bool] = bool) -> dict[str, str]:
    """The outputs named in the state file, if its signature is `own` and they are still `there`; else the stage runs.

    A state file that can't be read counts as none. While the stage runs there is none either, so that a
    build that was stopped starts the stage again.
    """
    path = Path(state)
    try:
        known = json.loads(path.read_text())
        if known["signature"] == own and there(known["outputs"]):
            return known["outputs"]
    except (OSError, ValueError, KeyError, TypeError):
        pass
    path.unlink(missing_ok=True)
    outputs = stage(own)
    part = Path(f"{state}.part")
    part.write_text(json.dumps({"signature": own, "outputs": outputs}, sort_keys=True))
    part.replace(path)
    return outputs
