"""Configuration on the driver: YAML files, .env files, first set variable."""

from __future__ import annotations

import os
from collections.abc import MutableMapping


def load_yaml(path: str) -> dict:
    """The mapping in a YAML file; {} if the file is missing or empty."""
    import yaml

    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def load_env(path: str, env: MutableMapping[str, str] = os.environ) -> dict[str, str]:
    """Adds KEY=VALUE lines of a file to the environment, and returns what was added. What is set already stays; the first of two lines counts.

    Blank lines, comments and lines without a key are skipped; quotes around a value go.
    """
    added: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                key, eq, value = line.strip().removeprefix("export ").partition("=")
                key, value = key.strip(), value.strip()
                if eq and key and not key.startswith("#") and key not in env:
                    if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
                        value = value[1:-1]
                    added[key] = env[key] = value
    return added


def first_set(*names: str, env: MutableMapping[str, str] = os.environ) -> str:
    """The first non-empty of the variables, stripped; else empty."""
    return next((v for n in names if (v := env.get(n, "").strip())), "")
