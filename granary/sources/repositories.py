"""Checkouts of repositories by the git command, outside of Spark."""

from __future__ import annotations

import os
import subprocess
from collections.abc import Callable


def _git(*arguments: str) -> None:
    subprocess.run(["git", *arguments], check=True, capture_output=True, timeout=600)


def clone_all(wanted: list[tuple[str, str]], root: str, git: Callable[..., None] = _git) -> dict[str, str]:
    """Clone (name, url) shallowly below ``root``, or move an old checkout forward: name to 'cloned', 'updated' or the error.

    One that fails doesn't stop the others; an old checkout then stays as it is.
    """
    os.makedirs(root, exist_ok=True)
    done: dict[str, str] = {}
    for name, url in wanted:
        target = os.path.join(root, name)
        fresh = not os.path.isdir(os.path.join(target, ".git"))
        try:
            git("clone", "--depth", "1", url, target) if fresh else git("-C", target, "pull", "--ff-only")
            done[name] = "cloned" if fresh else "updated"
        except Exception as e:
            done[name] = f"failed: {e}"
    return done
